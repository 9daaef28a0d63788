"""Consistency across shards, from their descriptions: one encoder (A8), and comparable labels and observables (A10); and
of each shard with its own description, by the digest of its rows."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.operators.summaries import content_digest
from tracewell.sinks.shard import data_path, read_description

#: Parts of a description that must agree before shards are pooled.
COMPARED = ("param_names", "coord", "bounds_theta", "embedding", "observable")


def descriptions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path and text of description files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(paths).select("path", F.col("content").cast("string").alias("text"))


def digest_audit(described: DataFrame) -> DataFrame:
    """Shards an encoder digest; A8 holds if there is one row and its digest is not null."""
    digest = F.get_json_object("text", "$.embedding.dsn_checkpoint_sha256")
    return described.groupBy(digest.alias("sha256")).agg(F.count("*").alias("n_shards"), F.min("path").alias("first_path"))


def assert_one_encoder(described: DataFrame) -> str:
    found = digest_audit(described).limit(3).collect()
    if len(found) != 1 or not found[0]["sha256"]:
        raise AssertionError(f"A8: shards come from several encoders or name none: {[(r['sha256'], r['n_shards']) for r in found]}")
    return found[0]["sha256"]


def compatibility(described: DataFrame) -> DataFrame:
    """part, number of different values, and one shard of each of the first ones; A10 holds if all counts are one."""
    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.coalesce(F.get_json_object("text", f"$.{p}"), F.lit("")).alias("value")) for p in COMPARED])
    by_value = described.select("path", F.inline(parts)).groupBy("part", "value").agg(F.min("path").alias("path"))
    counts = by_value.groupBy("part").agg(F.count("*").alias("n_values"))
    first = by_value.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("path"))).filter(F.col("k") <= 10)
    return counts.join(first.groupBy("part").agg(F.array_sort(F.collect_list("path")).alias("examples")), "part")


def assert_compatible(described: DataFrame) -> None:
    bad = [r.asDict() for r in compatibility(described).filter("n_values > 1").orderBy("part").collect()]
    if bad:
        raise AssertionError(f"A10: shards differ: {json.dumps(bad)}")


def content_violations(spark: SparkSession, stems: list[str]) -> list[tuple[str, str]]:
    """Shards whose rows are not those that their descriptions tell of, with what differs. One pass over each."""
    out = []
    for stem in stems:
        told = read_description(spark, stem).get("content")
        if told is None:
            out.append((stem, "the description has no digest of the content"))
            continue
        try:
            r = content_digest(spark.read.parquet(data_path(stem))).first()
        except AnalysisException as x:  # no file is left, or none that is Parquet
            out.append((stem, f"the rows can't be read: {x.getCondition()}"))
            continue
        have = {"n_rows": r["n_rows"], "sum_a": str(r["sum_a"]), "sum_b": str(r["sum_b"])}
        if have != told:
            out.append((stem, f"{have['n_rows']} rows for {told['n_rows']}" if have["n_rows"] != told["n_rows"] else "rows differ"))
    return out
