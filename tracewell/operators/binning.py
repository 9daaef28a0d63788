"""Detections to counts on a declared time grid.

A spike is a row (trace_id, t, ch): seconds since the start of its trace, and an electrode. The grid comes from the
declared duration, never from the last spike. Spikes at or beyond the last edge, before zero, or on electrodes
outside the members are left out of the counts and can be counted by ``rejected``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions.expr import edge_bin, finite


def grid_bins(duration: float, dt: float) -> int:
    """Number of whole bins in the duration."""
    for name, v in (("duration", duration), ("dt", dt)):
        if not math.isfinite(v) or v <= 0:
            raise ValueError(f"{name} must be positive and finite, got {v}")
    bins = int(duration / dt)
    if bins < 1:
        raise ValueError(f"a duration of {duration} holds no bin of {dt}")
    return bins


def window_samples(window_s: float, dt: float) -> int:
    """Samples of a window: rounded half to even, while grid_bins floors."""
    n = round(window_s / dt)
    if n < 1:
        raise ValueError(f"a window of {window_s} s rounds to no sample of {dt} s")
    return n


def member_spikes(spikes: DataFrame, duration: float, dt: float, n_electrodes: int) -> DataFrame:
    """Spikes that count, with their bin. A time that is not finite stops the job."""
    if n_electrodes < 1:
        raise ValueError(f"n_electrodes must be at least 1, got {n_electrodes}")
    bins = grid_bins(duration, dt)
    sound = F.when(finite(F.col("t")), True).otherwise(F.raise_error(F.lit("a spike time is not finite")).cast("boolean"))
    inside = (F.col("t") >= 0) & (F.col("t") < F.lit(bins * dt)) & F.col("ch").between(0, n_electrodes - 1)
    return spikes.filter(sound).filter(inside).withColumn("bin", edge_bin(F.col("t"), dt))


def rejected(spikes: DataFrame, duration: float, dt: float, n_electrodes: int) -> DataFrame:
    """Per trace: spikes outside the grid's time, and spikes of other channels."""
    bins = grid_bins(duration, dt)
    late = ~((F.col("t") >= 0) & (F.col("t") < F.lit(bins * dt)))
    other = ~F.col("ch").between(0, n_electrodes - 1)
    return spikes.groupBy("trace_id").agg(F.count_if(late).alias("out_of_time"), F.count_if(~late & other).alias("other_channel"))


def bin_counts(spikes: DataFrame, duration: float, dt: float, n_electrodes: int) -> DataFrame:
    """(trace_id, bin, c) of the bins that have a spike, pooled over electrodes. Counts combine before the one
    shuffle, and pooling is the same grouping without the electrode."""
    return member_spikes(spikes, duration, dt, n_electrodes).groupBy("trace_id", "bin").agg(F.count("*").alias("c"))


def dense_grid(counts: DataFrame, traces: DataFrame, bins: int, value: str = "c") -> DataFrame:
    """Every bin of every trace, with zero where ``counts`` has none."""
    grid = traces.select("trace_id").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    return grid.join(counts, ["trace_id", "bin"], "left").withColumn(value, F.coalesce(F.col(value), F.lit(0).cast(counts.schema[value].dataType)))


def channel_counts(spikes: DataFrame, electrodes: DataFrame) -> DataFrame:
    """Spikes of every member electrode (trace_id, ch), silent ones with zero."""
    n = spikes.groupBy("trace_id", "ch").agg(F.count("*").alias("n"))
    return electrodes.join(n, ["trace_id", "ch"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
