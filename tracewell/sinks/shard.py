"""Shards: Parquet data and a JSON description beside it.

Data is written to a staging folder, checked there, and moved into place; the description is written last and marks
the shard as complete. A shard whose description is missing counts as absent and is made again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.expr import flattened, reassembled
from tracewell.operators.labels import LabelSpec
from tracewell.sinks.store import Store

SCHEMA_VERSION = 1


def data_path(stem: str) -> str:
    return f"{stem}.parquet"


def description_path(stem: str) -> str:
    return f"{stem}.json"


def is_complete(spark: SparkSession, stem: str) -> bool:
    store = Store(spark)
    return store.exists(description_path(stem)) and store.exists(data_path(stem))


def shard_columns(rows: DataFrame, ident_columns: tuple[str, ...], embedding_dim: int, spec: LabelSpec | None, theta: str = "theta_a") -> list[Column]:
    """Identity columns in the caller's order (null where the rows have none), window_idx, z, zraw and labels."""
    out = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ident_columns]
    if "window_idx" not in ident_columns:
        out.append(F.col("window_idx"))
    out += flattened("z", "z", embedding_dim)
    if "zraw" in rows.columns:
        out += flattened("zraw", "zraw", embedding_dim)
    if spec is not None:
        out += [F.get(F.col(theta), F.lit(j)).cast("double").alias(n) for j, n in enumerate(spec.column_names)]
    return out


def merged(description: dict[str, Any], extra: Mapping[str, Any] | None) -> dict[str, Any]:
    """The parts ``embedding`` and ``observable`` take further keys; other keys of ``extra`` replace what is there."""
    out = dict(description)
    for k, v in (extra or {}).items():
        both = k in ("embedding", "observable") and isinstance(v, Mapping)
        out[k] = {**out.get(k, {}), **v} if both else v
    return out


def staging_path(stem: str) -> str:
    """A place of its own for every writer."""
    return f"{stem}.staging-{uuid.uuid4().hex}"


def write_staged(rows: DataFrame, staging: str, single_file: bool = False) -> None:
    """Snappy Parquet in the staging folder; one file only if that is asked for."""
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("compression", "snappy").parquet(staging)


def _parts(stem: str) -> list[tuple[str, str]]:
    """Data and description with the places where a publication sets aside what was there before."""
    return [(p, f"{p}.previous") for p in (description_path(stem), data_path(stem))]


def restore_previous(spark: SparkSession, stem: str) -> bool:
    """Undo a publication that broke off: if the shard isn't complete and there is a previous one, that comes back."""
    store = Store(spark)
    if store.exists(description_path(stem)) and store.exists(data_path(stem)) or not any(store.exists(old) for _, old in _parts(stem)):
        return False
    for place, old in reversed(_parts(stem)):  # the description last
        if store.exists(old):
            if store.exists(place):
                store.delete(place)
            store.move(old, place)
    return True


def publish(spark: SparkSession, stem: str, staging: str, description: Mapping[str, Any]) -> None:
    """Put a staged shard into place. What was published before is set aside (its description first, so that the shard
    never counts as complete with mixed parts), deleted once the new description stands, and brought back on failure."""
    store = Store(spark)
    restore_previous(spark, stem)
    try:
        for place, old in _parts(stem):
            if store.exists(old):
                store.delete(old)
            if store.exists(place):
                store.move(place, old)
        store.move(staging, data_path(stem))
        store.write_text(description_path(stem), json.dumps(description, indent=2) + "\n")
    except BaseException:
        restore_previous(spark, stem)
        raise
    for _, old in _parts(stem):
        if store.exists(old):
            store.delete(old)


def read_description(spark: SparkSession, stem: str) -> dict[str, Any]:
    return json.loads(Store(spark).read_text(description_path(stem)))


def read_shard(spark: SparkSession, stem: str) -> tuple[DataFrame, dict[str, Any]]:
    """The data with z, zraw and theta_a as arrays again, and the description."""
    d = read_description(spark, stem)
    rows = spark.read.parquet(data_path(stem))
    width = d["embedding"]["embedding_dim"]
    labels = [f"th_{n}" for n in d.get("param_names", [])]
    vectors = [reassembled(s, width).alias(s) for s in ("z", "zraw") if f"{s}_000" in rows.columns]
    if labels:
        vectors.append(F.array(*labels).alias("theta_a"))
    parts = {f"{s}_{j:03d}" for s in ("z", "zraw") for j in range(width)} | set(labels)
    return rows.select(*[c for c in rows.columns if c not in parts], *vectors), d
