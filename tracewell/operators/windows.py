"""Fixed-length windows of traces: starts 0, S, 2S ... while the window fits. Array expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_window(length: int, stride: int | None) -> int:
    if length < 1:
        raise ValueError(f"the window length must be at least 1, got {length}")
    stride = length if stride is None else stride
    if stride < 1:
        raise ValueError(f"the stride must be at least 1, got {stride}")
    return stride


def samples(df: DataFrame, trace: str = "trace"):
    """Length of a trace along time: of its first channel if it has several."""
    nested = df.schema[trace].dataType.elementType.typeName() == "array"
    return F.size(F.get(F.col(trace), F.lit(0))) if nested else F.size(F.col(trace))


def cut_windows(traces: DataFrame, length: int, stride: int | None = None, trace: str = "trace") -> DataFrame:
    """One row a window: the columns of ``traces`` but the trace, then window_idx, start and xw. Traces that are
    shorter than a window give none; traces of several channels are cut along time in all of them alike."""
    stride = check_window(length, stride)
    n = samples(traces, trace)
    nested = traces.schema[trace].dataType.elementType.typeName() == "array"
    # the upper bound keeps sequence() legal for short traces, which the filter removes
    starts = F.sequence(F.lit(0), F.greatest(n - length, F.lit(0)), F.lit(stride))
    rest = [c for c in traces.columns if c != trace]
    rows = traces.filter(n >= length).select(*rest, trace, F.posexplode(starts).alias("window_idx", "start"))
    piece = lambda x: F.slice(x, F.col("start") + 1, F.lit(length))
    xw = F.transform(F.col(trace), piece) if nested else piece(F.col(trace))
    return rows.select(*rest, F.col("window_idx").cast("long").alias("window_idx"), F.col("start").cast("long").alias("start"), xw.alias("xw"))


def is_short(traces: DataFrame, length: int, trace: str = "trace") -> Column:
    """Whether a trace is shorter than a window, and so gives none."""
    return samples(traces, trace) < length


def short_summary(traces: DataFrame, length: int, trace: str = "trace") -> DataFrame:
    """Number of traces that give windows, and of those that don't."""
    short = is_short(traces, length, trace)
    return traces.agg(F.count_if(~short).alias("n_used"), F.count_if(short).alias("n_short"))


def window_rows(rates: DataFrame, bins: int, length: int, stride: int | None = None) -> DataFrame:
    """Long form: each (trace_id, bin, ...) row once for every window that holds its bin."""
    stride = check_window(length, stride)
    last = F.least(F.floor(F.col("bin") / stride), F.lit((bins - length) // stride))
    first = F.greatest(F.lit(0), F.ceil((F.col("bin") - length + 1) / stride))
    inside = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return rates.withColumn("window_idx", F.explode(inside)).withColumn("start", F.col("window_idx") * stride) if bins >= length else rates.limit(0).withColumn("window_idx", F.lit(0).cast("long")).withColumn("start", F.lit(0).cast("long"))
