"""Rate traces as arrays, from whole detection records or from counted bins.

A detection record holds all spikes of its trace, so binning, smoothing and the division by the number of member
electrodes need no other row: one Arrow pass without a shuffle. Spikes that lie in rows of their own are counted
first; then a trace is at most one cell a bin, however many spikes it has. Silent electrodes are members: the divisor
is the declared number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.operators.binning import grid_bins
from tracewell.operators.smoothing import smooth_dense


def pooled_counts(times: np.ndarray, bins: int, dt: float) -> np.ndarray:
    """Counts on the edges k * dt; times outside [0, bins * dt) are left out."""
    if not np.isfinite(times).all():
        raise ValueError("a spike time is not finite")
    edges = np.arange(bins + 1) * dt
    inside = times[(times >= 0) & (times < edges[-1])]
    return np.bincount(np.searchsorted(edges, inside, side="right") - 1, minlength=bins).astype(np.float64)


def rate(times: np.ndarray, channels: np.ndarray, n_electrodes: int, bins: int, dt: float, sigma_s: float, per_electrode: bool = True) -> np.ndarray:
    """Pooled, smoothed rate in spikes a bin (an electrode), float32."""
    if n_electrodes < 1:
        raise ValueError(f"n_electrodes must be at least 1, got {n_electrodes}")
    member = (channels >= 0) & (channels < n_electrodes)
    smooth = smooth_dense(pooled_counts(times[member], bins, dt), sigma_s / dt)
    return (smooth / n_electrodes if per_electrode else smooth).astype(np.float32)


def build_traces(detections: DataFrame, duration: float | str, dt: float = 0.02, sigma_s: float = 0.04, per_electrode: bool = True) -> DataFrame:
    """``detections`` (det_t, det_ch, n_electrodes, ...) with det_t and det_ch replaced by ``trace``. The duration is one
    for all, or the name of the column that has it."""
    fixed = None if isinstance(duration, str) else grid_bins(duration, dt)
    if sigma_s < 0:
        raise ValueError(f"sigma_s must not be negative, got {sigma_s}")
    kept = [f for f in detections.schema if f.name not in ("det_t", "det_ch")]
    schema = T.StructType([*kept, T.StructField("trace", T.ArrayType(T.FloatType()))])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            traces = []
            every = [fixed] * b.num_rows if fixed is not None else [grid_bins(d, dt) for d in b.column(duration).to_pylist()]
            for t, c, n, bins in zip(b.column("det_t"), b.column("det_ch"), b.column("n_electrodes").to_pylist(), every):
                traces.append(rate(t.values.to_numpy(zero_copy_only=False), c.values.to_numpy(zero_copy_only=False), n, bins, dt, sigma_s, per_electrode))
            columns = [b.column(n) for n in names] + [pa.array(traces, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "trace"])

    whole = F.when(F.col("det_t").isNotNull() & F.col("det_ch").isNotNull() & F.col("n_electrodes").isNotNull(), True)
    sound = whole.otherwise(F.raise_error(F.lit("a detection record lacks det_t, det_ch or its number of electrodes")).cast("boolean"))
    return detections.filter(sound).mapInArrow(run, schema)


def traces_from_counts(counts: DataFrame, bins: int, n_electrodes: int, sigma_bins: float) -> DataFrame:
    """(trace_id, n_electrodes, trace) from (trace_id, bin, c); what is gathered for a trace is bounded by its bins."""
    if n_electrodes < 1:
        raise ValueError(f"n_electrodes must be at least 1, got {n_electrodes}")
    kind = counts.schema["trace_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            traces = []
            for cells, values in zip(b.column("bins"), b.column("counts")):
                dense = np.zeros(bins)
                dense[cells.values.to_numpy(zero_copy_only=False)] = values.values.to_numpy(zero_copy_only=False)
                traces.append((smooth_dense(dense, sigma_bins) / n_electrodes).astype(np.float32))
            members = pa.array([n_electrodes] * b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("trace_id"), members, pa.array(traces, pa.list_(pa.float32()))], ["trace_id", "n_electrodes", "trace"])

    gathered = counts.groupBy("trace_id").agg(F.collect_list(F.struct("bin", "c")).alias("cells")).select("trace_id", F.col("cells.bin").alias("bins"), F.col("cells.c").alias("counts"))
    schema = T.StructType([T.StructField("trace_id", kind), T.StructField("n_electrodes", T.LongType()), T.StructField("trace", T.ArrayType(T.FloatType()))])
    return gathered.mapInArrow(run, schema)
