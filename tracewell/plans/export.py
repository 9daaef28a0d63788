"""Traces to a published shard: windows, vectors, labels, constraints, Parquet and its description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tracewell.functions.expr import reassembled
from tracewell.operators.checks import metrics, verdict
from tracewell.operators.encoder import EncoderSpec, encode
from tracewell.operators.labels import LabelSpec
from tracewell.operators.summaries import axis_summary, content_digest
from tracewell.operators.windows import check_window, cut_windows, is_short
from tracewell.sinks import shard as sink
from tracewell.sinks.store import Store

POOLING = "mean_over_electrodes"
POOLING_NOTE = "rate = smoothed pooled counts / number of member electrodes: the mean per electrode, not the sum"
SPIKE_SOURCE = "detected"


@dataclass(frozen=True)
class ExportResult:
    parquet_path: str
    sidecar_path: str
    n_rows: int
    n_traces_used: int
    n_traces_skipped_short: int
    embedding_dim: int
    assertions_passed: list[str]
    warnings: list[str]


def embed_traces(encoder: EncoderSpec, records: DataFrame, window_stride: int | None = None, want_zraw: bool = True, batch_size: int = 256) -> DataFrame:
    """One row a window: the records' other columns, window_idx, z and zraw. No shuffle."""
    windows = cut_windows(records, encoder.window_length, window_stride).drop("start")
    return encode(windows, encoder, want_zraw, batch_size)


def export_embeddings(
    encoder: EncoderSpec,
    records: DataFrame,
    out_stem: str,
    label_spec: LabelSpec | None = None,
    ident_columns: Sequence[str] = (),
    extra_sidecar: Mapping[str, Any] | None = None,
    batch_size: int = 256,
    window_stride: int | None = None,
    want_zraw: bool = True,
    strict_in_box: bool = True,
    single_file: bool = False,
    order_by: Sequence[str] = (),
) -> ExportResult:
    """Publish ``records`` (trace, identity columns, theta_a if labelled) as ``out_stem``.parquet and .json.

    The encoder runs once: rows go to a staging folder while traces are counted, the constraints are an aggregate
    over the staged shard, and only a shard that holds them is moved into place; otherwise staging is removed.
    ``order_by`` names columns of the records (such as their path, as text) that give the order of the rows; it is
    applied before the encoder, so that sampling for the sort never encodes.
    """
    spark = records.sparkSession
    stride = check_window(encoder.window_length, window_stride)
    notes = list(encoder.warnings)
    if stride < encoder.window_length:
        notes.append(f"stride {stride} is below the window of {encoder.window_length} samples: windows overlap and rows are not independent")
    if label_spec is not None and "theta_a" not in records.columns:
        raise ValueError("a label spec is given but the records have no theta_a")
    if order_by:
        records = records.orderBy(*order_by)
    seen = Observation("traces")
    short = is_short(records, encoder.window_length)
    counted = records.observe(seen, F.count("*").alias("n"), F.count_if(short).alias("short"))
    rows = embed_traces(encoder, counted, stride, want_zraw, batch_size)
    if label_spec is not None:
        sound = F.coalesce(F.size("theta_a") == label_spec.p, F.lit(False))
        rows = rows.filter(F.when(sound, True).otherwise(F.raise_error(F.lit(f"a record has no label of {label_spec.p} entries; labelled and unlabelled rows do not mix"))).cast("boolean"))
    columns = sink.shard_columns(rows, tuple(ident_columns), encoder.embedding_dim, label_spec)
    staging = sink.staging_path(out_stem)
    try:
        sink.write_staged(rows.select(*columns), staging, single_file)
        staged = spark.read.parquet(staging)
        held, more = verdict(metrics(_with_vectors(staged, encoder, want_zraw, label_spec), label_spec), label_spec, encoder.l2_normalize, strict_in_box)
    except BaseException:
        Store(spark).delete(staging)
        raise
    counts = seen.get
    if counts["short"]:
        notes.append(f"{counts['short']} traces are shorter than the window of {encoder.window_length} samples and gave no row")
    notes += more
    notes.append(f"A8 spans shards and is not checked here; compare the digest {encoder.digest} over all shards")
    content = content_digest(staged).first()
    n_rows = content["n_rows"]
    description = {
        "schema_version": sink.SCHEMA_VERSION,
        "n_rows": n_rows,
        "n_traces_used": counts["n"] - counts["short"],
        "n_traces_skipped_too_short": counts["short"],
        "window_stride_samples": stride,
        "embedding": encoder.embedding_block(want_zraw),
        "observable": {**encoder.observable_block(), "pooling": POOLING, "pooling_note": POOLING_NOTE, "spike_source": SPIKE_SOURCE},
        "assertions_passed": sorted(set(held)),
        "warnings": notes,
        "content": {"n_rows": n_rows, "sum_a": str(content["sum_a"]), "sum_b": str(content["sum_b"])},
    }
    if label_spec is not None:
        description |= {"param_names": label_spec.param_names, "coord": label_spec.coord, "param_units": label_spec.units, "bounds_theta": [list(b) for b in label_spec.bounds_theta], "registry": label_spec.registry_block()}
        boxes = dict(zip(label_spec.column_names, label_spec.bounds_theta))
        description["axis_summary"] = [r.asDict() for r in axis_summary(staged, boxes).collect()]
    sink.publish(spark, out_stem, staging, sink.merged(description, extra_sidecar))
    return ExportResult(sink.data_path(out_stem), sink.description_path(out_stem), n_rows, counts["n"] - counts["short"], counts["short"], encoder.embedding_dim, sorted(set(held)), notes)


def _with_vectors(staged: DataFrame, encoder: EncoderSpec, want_zraw: bool, spec: LabelSpec | None) -> DataFrame:
    out = [reassembled(s, encoder.embedding_dim).alias(s) for s in (("z", "zraw") if want_zraw else ("z",))]
    if spec is not None:
        out.append(F.array(*[F.col(n) for n in spec.column_names]).alias("theta_a"))
    return staged.select(*out)
