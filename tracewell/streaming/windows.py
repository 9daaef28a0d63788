"""Windows of the smoothed rate from a stream of detections.

Each trace is keyed state: the counts of the bins that a coming window or its halo still needs, with the ids of their
events, so that an event that is sent again counts once. A window is emitted, once, when the watermark has passed its
last bin and the kernel's reach beyond it (or the end of the trace, where the rate is reflected); then no event that
can still arrive changes it, and it equals the window of the batch plan. Windows without spikes come too, by event-time
timeouts. Bins that no coming window needs leave the state, and so does a trace after its last window.

Events later than ``late`` are dropped; events outside the trace's time or of other channels don't enter.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tracewell.functions.expr import edge_bin, gaussian_weights
from tracewell.operators.binning import grid_bins
from tracewell.operators.windows import check_window

STATE = "next long, cells binary"


class Plan:
    """The arithmetic of the windows of one trace."""

    def __init__(self, bins: int, dt: float, sigma_bins: float, length: int, stride: int, n_electrodes: int):
        self.bins, self.dt, self.length, self.stride, self.n_electrodes = bins, dt, length, stride, n_electrodes
        self.weights = np.array(gaussian_weights(sigma_bins))
        self.reach = len(self.weights) // 2
        if bins < max(self.reach, 1):
            raise ValueError(f"{bins} bins are fewer than the kernel's reach of {self.reach}")
        self.windows = (bins - length) // stride + 1 if bins >= length else 0

    def due(self, window: int) -> float:
        """Seconds after which nothing changes a window."""
        return min(window * self.stride + self.length + self.reach, self.bins) * self.dt

    def needed_from(self, window: int) -> int:
        """The first bin that this window or a later one needs."""
        return min(window * self.stride - self.reach, self.bins - self.reach)

    def rate(self, window: int, cells: dict[int, set]) -> np.ndarray:
        start, r = window * self.stride, self.reach
        dense = np.zeros(self.length + 2 * r)
        for k, ids in cells.items():
            for p in (k, -1 - k, 2 * self.bins - 1 - k) if r else (k,):
                if -r <= p <= self.bins - 1 + r and 0 <= p - start + r < len(dense):
                    dense[p - start + r] += len(ids)
        out = np.zeros(self.length)
        for j, w in enumerate(self.weights):
            out += w * dense[j : j + self.length]
        return np.clip(out, 0.0, None) / self.n_electrodes


def streamed_windows(events: DataFrame, duration: float, dt: float, sigma_bins: float, length: int, stride: int | None, n_electrodes: int, late: str, origin: str = "1970-01-01 00:00:00") -> DataFrame:
    """(trace_id, window_idx, start, xw) from a streaming frame of (event_id, trace_id, ts, ch); traces begin at
    ``origin`` (UTC) and last ``duration`` seconds."""
    plan = Plan(grid_bins(duration, dt), dt, sigma_bins, length, check_window(length, stride), n_electrodes)
    zero = int(pd.Timestamp(origin, tz="UTC").value // 1_000)  # microseconds
    kind = events.schema["trace_id"].dataType

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        window, cells = (state.get[0], pickle.loads(state.get[1])) if state.exists else (0, {})
        if not state.hasTimedOut:
            for frame in frames:
                for k, event in zip(frame["bin"].tolist(), frame["event_id"].tolist()):
                    cells.setdefault(k, set()).add(event)
        now = (state.getCurrentWatermarkMs() * 1_000 - zero) / 1e6
        out = []
        while window < plan.windows and plan.due(window) <= now:
            out.append((key[0], window, window * plan.stride, plan.rate(window, cells).tolist()))
            window += 1
        if window >= plan.windows:
            state.remove()
        else:
            least = plan.needed_from(window)
            state.update((window, pickle.dumps({k: ids for k, ids in cells.items() if k >= least})))
            state.setTimeoutTimestamp(max(math.ceil(plan.due(window) * 1e3 + zero / 1e3), state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=["trace_id", "window_idx", "start", "xw"])

    t = (F.unix_micros("ts") - F.lit(zero)) / 1e6
    inside = (F.col("t") >= 0) & (F.col("t") < F.lit(plan.bins * dt)) & F.col("ch").between(0, n_electrodes - 1)
    rows = events.withWatermark("ts", late).withColumn("t", t).filter(inside).select("trace_id", "event_id", "ts", edge_bin(F.col("t"), dt).alias("bin"))
    schema = T.StructType([T.StructField("trace_id", kind), T.StructField("window_idx", T.LongType()), T.StructField("start", T.LongType()), T.StructField("xw", T.ArrayType(T.DoubleType()))])
    return rows.groupBy("trace_id").applyInPandasWithState(run, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
