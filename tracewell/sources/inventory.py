"""What a tree of campaigns holds: counts and first examples of both kinds of files, settings, and what is missing.

``inventory`` reads paths alone. ``detailed`` adds what the settings say and what one example of each kind of file
holds; it opens two small documents and two archives a campaign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.expr import basename
from tracewell.operators.registry import TOPOLOGY_AXES
from tracewell.sources.npz import REQUIRED, described, lacking


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path, campaign (the folder below the root), kind and the folder above the topo folder, of every file of interest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    name = basename(F.col("path"))
    kind = F.when(name.rlike(r"^mea_iter_.*\.npz$"), "detections").when(name.rlike(r"^iter_.*\.npz$"), "topology").when(name == "manifest.json", "manifest").when(name == "job_args.json", "job_args")
    below = F.regexp_extract("path", f"^.*?{_quoted(root)}/+([^/]+)/", 1)
    return files.select("path", below.alias("campaign"), kind.alias("kind"), F.regexp_replace("path", r"/[^/]+/[^/]+$", "").alias("tree")).filter("kind IS NOT NULL AND campaign <> ''")


def _quoted(root: str) -> str:
    return r"\Q" + root.rstrip("/").split("://")[-1].rstrip("/") + r"\E"


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row a campaign: n and first file of detections and topology, paths of the settings, all trees, verdict."""
    return summary(listing(spark, root))


def summary(f: DataFrame) -> DataFrame:
    """The inventory of a listing (path, campaign, kind, tree)."""
    of = lambda kind, x: F.when(F.col("kind") == kind, F.col(x))
    out = f.groupBy("campaign").agg(
        F.count_if(F.col("kind") == "detections").alias("n_detections"),
        F.min(of("detections", "path")).alias("first_detection"),
        F.array_sort(F.collect_set(of("detections", "tree"))).alias("detection_trees"),
        F.count_if(F.col("kind") == "topology").alias("n_topology"),
        F.min(of("topology", "path")).alias("first_topology"),
        F.array_sort(F.collect_set(of("topology", "tree"))).alias("topology_trees"),
        F.min(of("manifest", "path")).alias("manifest"),
        F.min(of("job_args", "path")).alias("job_args"),
    )
    return out.withColumn("verdict", readiness(F.col("n_detections"), F.col("n_topology")))


def setting_texts(spark: SparkSession, root: str) -> DataFrame:
    """path and text of the settings documents below the root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "{manifest,job_args}.json").load(root)
    return files.select("path", F.col("content").cast("string").alias("text"))


def setting_fields(found: DataFrame, texts: DataFrame) -> DataFrame:
    """An inventory with the texts of its settings and the fields that decide an export (null where there is none)."""
    for name in ("manifest", "job_args"):
        found = found.join(texts.select(F.col("path").alias(name), F.col("text").alias(f"{name}_text")), name, "left")
    field = lambda doc, key, kind: F.get_json_object(f"{doc}_text", f"$.{key}").try_cast(kind).alias(key)
    return found.select(
        "*",
        *[field("job_args", k, "double") for k in ("simtime", "conn_prob_lo", "conn_prob_hi")],
        *[field("job_args", k, "string") for k in ("conn_rule", "sweep_group")],
        F.size(F.from_json(F.get_json_object("manifest_text", "$.active_indices"), "array<int>")).alias("n_active"),
        field("manifest", "manifest_version", "string"),
    )


def detailed(spark: SparkSession, root: str) -> DataFrame:
    """The inventory with the settings' fields, and of the first file of each kind the member names and what is needed
    and missing there, the width of theta and the number of electrodes."""
    found = setting_fields(inventory(spark, root), setting_texts(spark, root))
    examples = [p for r in found.select("first_detection", "first_topology").collect() for p in r if p is not None]
    seen = described(spark, examples)
    for kind, needed, more in (("detection", (*REQUIRED, "electrode_centers"), ("theta_width", "n_electrodes")), ("topology", TOPOLOGY_AXES, ())):
        one = seen.select(F.col("path").alias(f"first_{kind}"), F.col("names").alias(f"{kind}_keys"), lacking(F.col("names"), needed).alias(f"{kind}_missing"), *more)
        found = found.join(one, f"first_{kind}", "left")
    return found


def readiness(n_detections: Column, n_topology: Column) -> Column:
    return (
        F.when((n_detections > 0) & (n_topology > 0), "READY")
        .when(n_detections > 0, "BLOCKED: no sweep output")
        .when(n_topology > 0, "BLOCKED: no detections")
        .otherwise("BLOCKED: neither detections nor sweep output")
    )
