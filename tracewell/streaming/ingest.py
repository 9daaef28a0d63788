"""Detections that arrive as a stream: counts on event-time bins with a watermark for late ones.

An extension for continuous recordings. Events (trace_id, ts, ch) are counted by trace and bin; a bin is emitted
once the watermark has passed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def streamed_counts(events: DataFrame, bin_width: str, late: str, n_electrodes: int) -> DataFrame:
    """trace_id, bin_start and c; the frame may be a stream or not."""
    member = events.filter(F.col("ch").between(0, n_electrodes - 1)).withWatermark("ts", late)
    return member.groupBy("trace_id", F.window("ts", bin_width).alias("w")).agg(F.count("*").alias("c")).select("trace_id", F.col("w.start").alias("bin_start"), "c")


def write_counts(counts: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Append finished bins to Parquet; without a trigger interval, take what is there and stop."""
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()
