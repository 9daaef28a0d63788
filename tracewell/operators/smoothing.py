"""Gaussian smoothing of binned counts, with half-sample symmetric reflection at both ends.

Three forms with the same result. ``smooth_rows`` works on the sparse rows: each count is scattered to its targets
(its reflections included) and the shares are summed; cost follows the bins that have spikes. ``smooth_dense`` is
NumPy on whole traces, for arrays; it holds for grids shorter than the kernel too. ``smooth_segments`` is for traces too
long for one task: time is cut into segments, each count goes to the segments within the kernel's reach (a halo), and
segments are smoothed apart; together they are the whole trace, and no task holds more than a segment and its halo.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.functions.expr import doubles, gaussian_weights
from tracewell.operators.windows import check_window

SEGMENT = 65_536


def smooth_rows(counts: DataFrame, bins: int, sigma: float, value: str = "c", out: str = "r") -> DataFrame:
    """(trace_id, bin, out) wherever the smoothed trace is not zero."""
    weights = gaussian_weights(sigma)
    r = len(weights) // 2
    if bins < max(r, 1):
        raise ValueError(f"{bins} bins are fewer than the kernel's reach of {r}; use smooth_dense")
    w = doubles(weights)
    s = F.col("bin")
    mirrored = F.array(s, -1 - s, 2 * bins - 1 - s) if r else F.array(s)
    near = F.filter(mirrored, lambda p: (p >= -r) & (p <= bins - 1 + r))
    shares = F.flatten(F.transform(near, lambda p: F.transform(F.sequence(F.lit(-r), F.lit(r)), lambda j: F.struct((p + j).alias("bin"), (F.col(value) * F.element_at(w, j + r + 1)).alias("share")))))
    spread = counts.select("trace_id", F.explode(F.filter(shares, lambda x: (x["bin"] >= 0) & (x["bin"] < bins))).alias("x"))
    return spread.groupBy("trace_id", F.col("x.bin").alias("bin")).agg(F.sum("x.share").alias(out))


def smooth_dense(counts: np.ndarray, sigma: float) -> np.ndarray:
    """Smoothed copy of counts along the last axis, not below zero."""
    weights = np.array(gaussian_weights(sigma))
    r = len(weights) // 2
    if not r:
        return np.clip(counts.astype(np.float64), 0.0, None)
    pad = [(0, 0)] * (counts.ndim - 1) + [(r, r)]
    padded = np.pad(counts.astype(np.float64), pad, mode="symmetric")
    n = counts.shape[-1]
    out = np.zeros(counts.shape, np.float64)
    for j, w in enumerate(weights):
        out += w * padded[..., j : j + n]
    return np.clip(out, 0.0, None)


def smooth_segments(counts: DataFrame, traces: DataFrame, bins: int, sigma: float, segment: int = SEGMENT, value: str = "c") -> DataFrame:
    """(trace_id, segment, start, rates): the smoothed traces of ``traces`` (trace_id) in pieces of ``segment`` bins, from
    one count a bin. Silent segments are zeros. One shuffle, by trace and segment."""
    weights = np.array(gaussian_weights(sigma))
    r = len(weights) // 2
    if bins < max(r, 1):
        raise ValueError(f"{bins} bins are fewer than the kernel's reach of {r}; use smooth_dense")
    if segment < 1:
        raise ValueError(f"a segment must have at least one bin, got {segment}")
    last, b = (bins - 1) // segment, F.col("bin")
    mirrored = F.array(b, -1 - b, 2 * bins - 1 - b) if r else F.array(b)
    near = F.filter(mirrored, lambda p: (p >= -r) & (p <= bins - 1 + r))
    first_of = lambda p: F.greatest(F.floor((p - r) / segment), F.lit(0))
    last_of = lambda p: F.least(F.floor((p + r) / segment), F.lit(last))
    # place: the bin's position in a segment with its halo
    halo = F.flatten(F.transform(near, lambda p: F.transform(F.sequence(first_of(p), last_of(p)), lambda k: F.struct(k.cast("long").alias("segment"), (p - k * segment + r).cast("long").alias("place")))))
    cells = counts.select("trace_id", F.col(value).cast("double").alias("v"), F.explode(halo).alias("x")).select("trace_id", "x.segment", F.struct("x.place", "v").alias("cell"))
    grid = traces.select("trace_id").distinct().select("trace_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("segment"), F.lit(None).cast("struct<place:bigint,v:double>").alias("cell"))
    held = cells.unionByName(grid).groupBy("trace_id", "segment").agg(F.collect_list("cell").alias("cells"), F.count_if(F.col("cell").isNull()).alias("asked")).filter("asked > 0")
    kind = counts.schema["trace_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 16):
                b = whole.slice(at, 16)
                out = []
                for k, places, values in zip(b.column("segment").to_pylist(), b.column("places"), b.column("values")):
                    size = min(segment, bins - k * segment)
                    dense = np.zeros(size + 2 * r)
                    place = places.values.to_numpy(zero_copy_only=False)
                    inside = place < len(dense)  # what lies in the halo of a full segment may be past a short one
                    np.add.at(dense, place[inside], values.values.to_numpy(zero_copy_only=False)[inside])
                    rates = np.zeros(size)
                    for j, w in enumerate(weights):
                        rates += w * dense[j : j + size]
                    out.append(np.clip(rates, 0.0, None))
                starts = pa.array([k * segment for k in b.column("segment").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("trace_id"), b.column("segment"), starts, pa.array(out, pa.list_(pa.float64()))], ["trace_id", "segment", "start", "rates"])

    schema = T.StructType([T.StructField("trace_id", kind), T.StructField("segment", T.LongType()), T.StructField("start", T.LongType()), T.StructField("rates", T.ArrayType(T.DoubleType()))])
    return held.select("trace_id", "segment", F.col("cells.place").alias("places"), F.col("cells.v").alias("values")).mapInArrow(run, schema)


def segment_windows(segments: DataFrame, bins: int, length: int, stride: int | None = None) -> DataFrame:
    """(trace_id, window_idx, start, xw): the windows of segmented traces, put together from the pieces that segments
    have of them. What is gathered for a window is its own length."""
    stride = check_window(length, stride)
    lo, hi = F.col("start"), F.col("start") + F.size("rates")  # of the segment
    first = F.greatest(F.lit(0), F.floor((lo - length) / stride) + 1)
    last = F.least(F.floor((hi - 1) / stride), F.lit((bins - length) // stride if bins >= length else -1))
    inside = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    each = segments.select("trace_id", lo.alias("lo"), hi.alias("hi"), "rates", F.explode(inside).alias("window_idx")).withColumn("start", F.col("window_idx") * stride)
    begin, end = F.greatest("lo", "start"), F.least("hi", F.col("start") + length)
    piece = F.slice("rates", (begin - F.col("lo") + 1).cast("int"), (end - begin).cast("int"))
    pieces = each.select("trace_id", "window_idx", "start", F.struct(begin.alias("at"), piece.alias("x")).alias("p"))
    met = pieces.groupBy("trace_id", "window_idx", "start").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return met.select("trace_id", "window_idx", "start", F.flatten(F.col("p.x")).alias("xw"))
