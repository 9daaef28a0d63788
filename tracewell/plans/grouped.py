"""Many campaigns published at once: one scan, one partitioned write, one grouped check, one commit.

The number of Spark jobs doesn't depend on the number of campaigns. Layout below a root:

* ``data/run=<id>/campaign_id=<name>/`` holds the rows of one campaign and run, written with those of all others;
* ``manifests/<id>.json`` has one JSON line a campaign: its status, the reason if it was left out, and its description.

A run becomes visible when its manifest is moved into place, which is the last step; data without one is not read and a
run that breaks off leaves nothing but such data, which ``sweep`` deletes. A campaign that breaks a constraint is left
out with its reason and its partition deleted, while the others are published. Readers take, for each campaign, the
latest run that published it, so an older shard stays in force until a new one holds.

What would stop a single export (an archive that can't be read, a key that isn't unique, a broken coordinate rule) is
carried as ``problem`` in the rows or found on the listing, and rejects its campaign alone.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.functions.expr import finite, reassembled
from tracewell.operators.checks import metric_columns, verdict
from tracewell.operators.encoder import EncoderSpec
from tracewell.operators.labels import LabelSpec, label_problem, label_vector
from tracewell.operators.traces import build_traces
from tracewell.operators.unique_join import key_violations
from tracewell.operators.windows import check_window
from tracewell.plans.campaign import IDENT, CampaignRun
from tracewell.plans.export import POOLING, POOLING_NOTE, SPIKE_SOURCE, embed_traces
from tracewell.sinks import shard as sink
from tracewell.sinks.store import Store
from tracewell.sources import npz

PUBLISHED, REJECTED = "PUBLISHED", "REJECTED"
KEY = ["campaign_id", "topo_dir", "iter_idx"]
#: Bytes of boxes that are broadcast; beyond that they are joined by a shuffle.
SMALL = 8 << 20


def _data(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/data/run={run}"


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def new_run() -> str:
    """A name that sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """run, campaign_id, status, reason, n_rows, columns and description of every campaign of every committed run."""
    schema = "run string, campaign_id string, status string, reason string, n_rows long, columns string, description string"
    if not Store(spark).exists(_manifests(root)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.json").json(_manifests(root))


def in_force(spark: SparkSession, root: str) -> DataFrame:
    """The manifest row of each published campaign that readers take: that of its latest run."""
    return manifests(spark, root).filter(F.col("status") == PUBLISHED).groupBy("campaign_id").agg(F.max_by(F.struct("run", "n_rows", "columns", "description"), "run").alias("m")).select("campaign_id", "m.*")


def read_published(spark: SparkSession, root: str, campaigns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the published campaigns, with campaign_id; partitions of other runs and campaigns aren't listed."""
    rows = in_force(spark, root)
    held = (rows if campaigns is None else rows.filter(F.col("campaign_id").isin(list(campaigns)))).orderBy("campaign_id").collect()
    if not held:
        raise FileNotFoundError(f"no published campaign in {root}")
    out = None
    for columns in sorted({r["columns"] for r in held}):
        schema = T.StructType([*T.StructType.fromJson(json.loads(columns)).fields, T.StructField("run", T.StringType()), T.StructField("campaign_id", T.StringType())])
        paths = [f"{_data(root, r['run'])}/campaign_id={_folder(r['campaign_id'])}" for r in held if r["columns"] == columns]
        part = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/data").parquet(*paths).drop("run", "problem")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _folder(name: str) -> str:
    """The value of a partition as Spark writes it in a path."""
    return "".join(c if c.isalnum() and c < "\x80" or c in " -._$&(),;@~+!<>|`" else f"%{b:02X}" if c < "\x80" else c for c in name for b in [ord(c)])


def sweep(spark: SparkSession, root: str, keep: Sequence[str] = ()) -> None:
    """Delete the data of runs that no reader takes any more or that never committed; ``keep`` names runs under way."""
    store = Store(spark)
    live = {r["run"] for r in in_force(spark, root).select("run").distinct().collect()} | set(keep)
    for path in store.children(f"{root.rstrip('/')}/data"):
        if path.rsplit("run=", 1)[-1] not in live:
            store.delete(path)


def grouped_metrics(rows: DataFrame, specs: Mapping[str, LabelSpec]) -> dict[str, Row]:
    """The verdict's aggregates for every campaign, in one grouped pass; each campaign has its own box. One row a
    campaign comes to the driver, which holds their specs anyway."""
    spark = rows.sparkSession
    p = next(iter(specs.values())).p
    boxes = spark.createDataFrame([(name, [float(lo) for lo, _ in s.bounds_theta], [float(hi) for _, hi in s.bounds_theta]) for name, s in specs.items()], "campaign_id string, lo array<double>, hi array<double>")
    met = rows.join(F.broadcast(boxes) if 16 * p * len(specs) <= SMALL else boxes, "campaign_id")
    box = [(F.get("lo", F.lit(j)), F.get("hi", F.lit(j))) for j in range(p)]
    problem = F.min("problem").alias("problem")
    used = F.count_if(F.col("window_idx") == 0).alias("n_used")
    return {r["campaign_id"]: r for r in met.groupBy("campaign_id").agg(*metric_columns(met, p, box), problem, used).collect()}


def commit(
    spark: SparkSession,
    rows: DataFrame,
    specs: Mapping[str, LabelSpec],
    root: str,
    embedding_dim: int,
    rejected: Mapping[str, str] | None = None,
    describe: Callable[[str, Row, list[str], list[str]], Mapping[str, Any]] = lambda name, m, held, notes: {},
    l2_normalize: bool = True,
    strict_in_box: bool = True,
    ident_columns: Sequence[str] = (),
) -> list[dict[str, Any]]:
    """Write the rows of all campaigns (campaign_id, identity columns, window_idx, z, zraw if any, theta_a, problem) once,
    in the columns of a shard and partitioned, check them grouped by campaign, and commit those that hold. ``specs`` (of one family: the same names
    and coordinates) says which campaigns are expected, ``rejected`` which are known to fail. Returns the manifest."""
    families = {(tuple(s.param_names), tuple(s.coord)) for s in specs.values()}
    if len(families) > 1:
        raise ValueError("the campaigns of one commit must have the same label names and coordinates")
    store, run, lost = Store(spark), new_run(), dict(rejected or {})
    out: list[dict[str, Any]] = []
    live = {name: s for name, s in specs.items() if name not in lost}
    if live:
        spec = next(iter(live.values()))
        bad_width = F.when(F.coalesce(F.size("theta_a"), F.lit(-1)) != spec.p, F.lit(f"a record has no label of {spec.p} entries"))
        own = tuple(c for c in ident_columns if c != "campaign_id")
        staged = rows.select("campaign_id", F.coalesce("problem", bad_width).alias("problem"), *sink.shard_columns(rows, own, embedding_dim, spec))
        try:
            staged.write.partitionBy("campaign_id").option("compression", "snappy").parquet(_data(root, run))
            written = spark.read.schema(staged.schema).parquet(_data(root, run))
            vectors = [reassembled(c, embedding_dim).alias(c) for c in ("z", "zraw") if c in rows.columns]
            found = grouped_metrics(written.select("campaign_id", "problem", "window_idx", *vectors, F.array(*spec.column_names).alias("theta_a")), live)
        except BaseException:
            store.delete(_data(root, run))
            raise
        schema = T.StructType([f for f in staged.schema.fields if f.name != "campaign_id"]).json()
        for name, box in live.items():
            m = found.get(name)
            try:
                if m is None:
                    raise ValueError("no window came out of any trace; all are shorter than the window")
                if m["problem"] is not None:
                    raise ValueError(m["problem"])
                held, notes = verdict(m, box, l2_normalize, strict_in_box)
            except (AssertionError, ValueError) as x:
                lost[name] = str(x)
                continue
            out.append({"run": run, "campaign_id": name, "status": PUBLISHED, "reason": None, "n_rows": m["n_rows"], "columns": schema, "description": json.dumps(describe(name, m, held, notes))})
        for name in lost:
            if name in found:
                store.delete(f"{_data(root, run)}/campaign_id={_folder(name)}")
    out += [{"run": run, "campaign_id": name, "status": REJECTED, "reason": why, "n_rows": 0, "columns": None, "description": None} for name, why in lost.items()]
    store.write_text(f"{_manifests(root)}/{run}.json", "".join(json.dumps(r) + "\n" for r in sorted(out, key=lambda r: r["campaign_id"])))
    return out


def _trees(spark: SparkSession, runs: Sequence[CampaignRun], side: str) -> DataFrame:
    store = Store(spark)
    rows = [(store.qualified(t.rstrip("/")), r.name) for r in runs for t in getattr(r, side)]
    return spark.createDataFrame(rows, "tree string, campaign_id string")


def _of_campaign(files: DataFrame, trees: DataFrame) -> DataFrame:
    """Files (path, ...) with the campaign whose tree they lie in."""
    return files.withColumn("tree", F.regexp_replace("path", "/[^/]+/[^/]+$", "")).join(trees, "tree").drop("tree")


def pooled_rows(spark: SparkSession, runs: Sequence[CampaignRun], encoder: EncoderSpec, window_stride: int | None = None, want_zraw: bool = True, verify_coords: bool = True) -> DataFrame:
    """Encoded windows of all campaigns of one family as one table. The plan is the same for any number of them: one scan
    of each kind of archive, a join to the campaigns' settings, one shuffle for the sweep records. A record with a
    problem gives one row that carries it."""
    spec = runs[0].spec
    settings = spark.createDataFrame([(r.name, float(r.duration), r.n_electrodes) for r in runs], "campaign_id string, duration double, given long")
    roots = lambda side: [t for r in runs for t in getattr(r, side)]
    files = npz._files(spark, roots("detection_trees"), npz.DETECTION_GLOB)
    detections = _of_campaign(npz.decoded(files, strict=False), _trees(spark, runs, "detection_trees")).join(settings, "campaign_id")
    topology = npz.read_topology(spark, roots("topology_trees"), with_path=True)
    sweeps = _of_campaign(topology, _trees(spark, runs, "topology_trees")).drop("path")
    met = detections.join(sweeps.withColumn("met", F.lit(True)), KEY, "left")
    problem = F.coalesce(
        "problem",
        F.when(F.col("met").isNull(), F.lit("a detection record has no sweep record")),
        F.when(F.coalesce("given", "centers").isNull(), F.concat("path", F.lit(" has no electrode centres; give n_electrodes"))),
        F.when(F.coalesce("given", "centers") < 1, F.lit("n_electrodes must be at least 1")),
        F.when(~F.forall("det_t", finite), F.lit("a spike time is not finite")),
        label_problem(spec, verify_coords),
    )
    held = met.withColumn("problem", problem)
    sound = F.col("problem").isNull()
    rows = held.select(
        "campaign_id", "topo_idx", "iter_idx", "seed_run", "problem", "duration",
        F.when(sound, F.coalesce("given", "centers")).otherwise(1).alias("n_electrodes"),
        F.when(sound, F.col("det_t")).otherwise(F.array().cast("array<double>")).alias("det_t"),
        F.when(sound, F.col("det_ch")).otherwise(F.array().cast("array<bigint>")).alias("det_ch"),
        F.when(sound, label_vector(spec)).otherwise(F.array_repeat(F.lit(0.0), spec.p)).alias("theta_a"),
    )
    traces = build_traces(rows, "duration", encoder.dt, encoder.sigma_s).drop("duration", "n_electrodes")
    # a record with a problem is one window of silence, so that what is wrong reaches the grouped check
    silence = F.array_repeat(F.lit(0.0).cast("float"), encoder.window_length)
    traces = traces.withColumn("trace", F.when(F.col("problem").isNull(), F.col("trace")).otherwise(silence))
    return embed_traces(encoder, traces, window_stride, want_zraw)


def publish_campaigns(spark: SparkSession, runs: Sequence[CampaignRun], root: str, encoder: EncoderSpec, window_stride: int | None = None, want_zraw: bool = True, strict_in_box: bool = True, again: bool = False) -> list[dict[str, Any]]:
    """Publish all campaigns that aren't in force yet (all with ``again``), a commit for each family of labels. Returns
    one manifest row a campaign that was tried."""
    stride = check_window(encoder.window_length, window_stride)
    done = set() if again else {r["campaign_id"] for r in in_force(spark, root).select("campaign_id").collect()}
    todo = [r for r in runs if r.name not in done]
    if len({r.name for r in todo}) < len(todo):
        raise ValueError("campaign names repeat")
    families: dict[tuple, list[CampaignRun]] = {}
    for r in todo:
        families.setdefault((tuple(r.spec.param_names), tuple(r.spec.coord)), []).append(r)
    out: list[dict[str, Any]] = []
    for family in families.values():
        lost = {r.name: f"the duration of {r.duration} s is below the encoder's window of {encoder.window_s} s" for r in family if r.duration < encoder.window_s}
        lost |= {r.name: "no detection tree or no sweep tree" for r in family if not (r.detection_trees and r.topology_trees)}
        open_ = [r for r in family if r.name not in lost]
        n_files: dict[str, int] = {}
        if open_:
            a, b = (_of_campaign(npz.listed(spark, [t for r in open_ for t in getattr(r, side)], glob), _trees(spark, open_, side)) for side, glob in (("detection_trees", npz.DETECTION_GLOB), ("topology_trees", npz.TOPOLOGY_GLOB)))
            keys = a.groupBy(*KEY).agg(F.count("*").alias("n"))
            n_files = {r["campaign_id"]: r["n"] for r in keys.groupBy("campaign_id").agg(F.sum("n").alias("n")).collect()}
            broken = key_violations(a, b, KEY).groupBy("campaign_id").agg(F.count("*").alias("n"), F.min(F.struct("topo_dir", "iter_idx", "n_left", "n_right")).alias("x")).collect()
            lost |= {r["campaign_id"]: f"the join key is not unique or has no match, {r['n']} times: topo_dir={r['x']['topo_dir']}, iter_idx={r['x']['iter_idx']}" for r in broken}
            lost |= {r.name: "no detections" for r in open_ if r.name not in n_files and r.name not in lost}
            open_ = [r for r in open_ if r.name not in lost]
        of = {r.name: r for r in family}

        def describe(name: str, m: Row, held: list[str], notes: list[str], of=of, n_files=n_files) -> dict[str, Any]:
            spec, short = of[name].spec, n_files[name] - m["n_used"]
            base = {
                "schema_version": sink.SCHEMA_VERSION, "n_rows": m["n_rows"], "n_traces_used": m["n_used"], "n_traces_skipped_too_short": short, "window_stride_samples": stride,
                "embedding": encoder.embedding_block(want_zraw), "observable": {**encoder.observable_block(), "pooling": POOLING, "pooling_note": POOLING_NOTE, "spike_source": SPIKE_SOURCE},
                "assertions_passed": sorted(set(held)), "warnings": [*encoder.warnings, *notes],
                "param_names": spec.param_names, "coord": spec.coord, "param_units": spec.units, "bounds_theta": [list(b) for b in spec.bounds_theta], "registry": spec.registry_block(),
            }
            return sink.merged(base, of[name].extra)

        rows = pooled_rows(spark, open_, encoder, window_stride, want_zraw) if open_ else spark.createDataFrame([], "campaign_id string")
        out += commit(spark, rows, {r.name: r.spec for r in family}, root, encoder.embedding_dim, lost, describe, encoder.l2_normalize, strict_in_box, IDENT)
    return out
