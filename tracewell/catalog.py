"""Registered queries over the driver tables, and the SQL that checks them.

A user's events stand for a trace, the five event types (by name) for its electrodes; the grid is 30 days of one-hour
bins. Numeric columns of the other tables stand for parameter axes, embeddings for encoded windows.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.expr import all_finite, basename, flattened, l2_norm, to_natural, to_theta, trailing_index
from tracewell.operators.binning import bin_counts, channel_counts, dense_grid, grid_bins, rejected
from tracewell.operators.checks import UNIT_TOLERANCE, by_axis, metrics
from tracewell.operators.encoder import EncoderSpec, LinearHead, config_drift, digest_of, encode
from tracewell.operators.labels import LabelSpec, assemble_labels, build_label_spec, coord_violations
from tracewell.operators.neighbours import nearest
from tracewell.operators.registry import Registry, is_log_axis, log_set_drift, roundtrip, with_rules
from tracewell.operators.rules import record_rules, rule_counts, setting_rules, window_rules
from tracewell.operators.smoothing import segment_windows, smooth_rows, smooth_segments
from tracewell.operators.summaries import axis_summary, content_digest, described_axes, merged
from tracewell.operators.traces import traces_from_counts
from tracewell.operators.two_sample import kernel_sums, sound_rows, statistic
from tracewell.operators.unique_join import key_violations, unique_join
from tracewell.operators.windows import cut_windows, short_summary, window_rows
from tracewell.plans.audit import compatibility, digest_audit
from tracewell.plans.campaign import launch_plan
from tracewell.plans.export import export_embeddings
from tracewell.plans.grouped import commit, read_published
from tracewell.sinks.shard import read_shard
from tracewell.sinks.store import Store, scratch
from tracewell.sources import settings
from tracewell.sources.inventory import detailed, summary
from tracewell.sources.npz import first_files, lacking, listed, read_detections, read_topology
from tracewell.sources.synthetic import synthetic_detections
from tracewell.streaming.windows import streamed_windows

Query = Callable[[SparkSession, str], DataFrame]
TYPES = ("click", "error", "purchase", "signup", "view")
DURATION, DT, SIGMA_BINS, WINDOW, HOP = 2_592_000.0, 3_600.0, 2.0, 240, 120
N_E, BINS = len(TYPES), grid_bins(DURATION, DT)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros() -> Column:
    return F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', cast(ts AS timestamp_ntz))")


def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trace_id, t in seconds, ch."""
    channel = F.coalesce(*[F.when(F.col("event_type") == t, k) for k, t in enumerate(TYPES)])
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("trace_id"), (_micros() / 1e6).alias("t"), channel.cast("long").alias("ch"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_counts(spikes(spark, sf_dir), DURATION, DT, N_E)


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smooth_rows(_counts(spark, sf_dir), BINS, SIGMA_BINS).withColumn("x", F.col("r") / N_E)


def g1_bin_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def g3_dense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_grid(_counts(spark, sf_dir), spikes(spark, sf_dir), BINS)


def w1_gaussian_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smooth_rows(_counts(spark, sf_dir), BINS, SIGMA_BINS).select("trace_id", "bin", F.round("r", 9).alias("r"))


def w1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces cut into segments of 100 bins with halos, smoothed apart."""
    pieces = smooth_segments(_counts(spark, sf_dir), spikes(spark, sf_dir), BINS, SIGMA_BINS, 100)
    return pieces.select("trace_id", "start", F.posexplode("rates").alias("k", "r")).filter("r > 0").select("trace_id", (F.col("start") + F.col("k")).alias("bin"), F.round("r", 9).alias("r"))


def w2_segment_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping windows put together from segments."""
    w = segment_windows(smooth_segments(_counts(spark, sf_dir), spikes(spark, sf_dir), BINS, SIGMA_BINS, 100), BINS, WINDOW, HOP)
    return _window_sums(w.withColumn("xw", F.transform("xw", lambda x: x / N_E)))


def _window_sums(windows: DataFrame) -> DataFrame:
    total = F.aggregate("xw", F.lit(0.0), lambda a, x: a + x)
    return windows.filter(F.array_max("xw") > 0).select("trace_id", "window_idx", "start", F.round(total, 9).alias("total"), F.round(F.array_max("xw"), 9).alias("peak"))


def e6_streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream: windows that are final when the last event has come, an hour being the lateness."""
    table = _table(spark, sf_dir, "events")
    channel = F.coalesce(*[F.when(F.col("event_type") == t, k) for k, t in enumerate(TYPES)]).cast("long")
    events = spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    events = events.select("event_id", F.col("user_id").alias("trace_id"), F.col("ts").cast("timestamp").alias("ts"), channel.alias("ch"))
    found = streamed_windows(events, DURATION, DT, SIGMA_BINS, WINDOW, HOP, N_E, "1 hour", "2024-01-01")
    at = scratch(spark, "stream")
    query = found.writeStream.outputMode("append").format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return _window_sums(spark.read.schema(found.schema).parquet(f"{at}/out"))


def g4_mean_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and peak of the pooled and the per-electrode rate, and their ratio: the number of electrodes."""
    r = _rates(spark, sf_dir).groupBy("trace_id").agg(F.sum("r").alias("pooled"), F.sum("x").alias("mean"), F.max("r").alias("pooled_peak"), F.max("x").alias("mean_peak"))
    return r.select("trace_id", *[F.round(c, 9).alias(c) for c in ("pooled", "mean", "pooled_peak", "mean_peak")], F.round(F.col("pooled") / F.greatest("mean", F.lit(1e-30)), 6).alias("ratio"))


def w1_dense_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array path: whole traces, smoothed in one pass; summed up again."""
    total = F.aggregate("trace", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return _user_traces(spark, sf_dir).select("trace_id", F.size("trace").cast("long").alias("n_bins"), F.round(total * N_E).cast("long").alias("n_spikes"))


def _user_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces_from_counts(_counts(spark, sf_dir), BINS, N_E, SIGMA_BINS)


def k1_export_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User traces through windows, a fixed linear head, constraints and the sinks, and read back."""
    stem = scratch(spark, "shard")
    export_embeddings(EncoderSpec(LinearHead(np.array(HEAD)), len(HEAD), WINDOW * DT, DT), _user_traces(spark, sf_dir), stem, ident_columns=("trace_id",))
    rows, description = read_shard(spark, stem)
    unit = (F.abs(l2_norm(F.col("z")) - 1) < UNIT_TOLERANCE).alias("unit")
    return rows.select("trace_id", "window_idx", unit, F.lit(description["n_rows"]).cast("long").alias("n_rows"), F.posexplode("zraw").alias("j", "v")).select("trace_id", "window_idx", "unit", "n_rows", F.col("j").cast("long").alias("j"), F.round(F.col("v").cast("double"), 5).alias("zraw"))


def k1_grouped_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as windows, brands as campaigns with boxes of their own, published together: some have rows with a problem,
    norms that are off, constant labels or prices outside their box, and are left out. What readers then find."""
    root, k = scratch(spark, "published"), F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    parts, size = _table(spark, sf_dir, "part"), F.col("p_size").cast("double")
    off = F.when(k % 7 == 3, 1.01).otherwise(1.0)
    z = F.array((F.cos(size) * off).cast("float"), (F.sin(size) * off).cast("float"))
    problem = F.when((k % 10 == 4) & (F.col("p_partkey") % 5 == 0), F.lit("planted"))
    rows = parts.select(F.col("p_brand").alias("campaign_id"), F.col("p_partkey").alias("iter_idx"), F.lit(0).cast("long").alias("window_idx"), problem.alias("problem"), z.alias("z"), F.array(F.log(size), F.when(k % 10 == 2, F.lit(1.0)).otherwise(F.col("p_retailprice"))).alias("theta_a"))
    brands = sorted(r["p_brand"] for r in parts.select("p_brand").distinct().collect())
    registry = Registry(["size", "price"], ["", ""], [(1.0, 50.0), (0.0, 3_000.0)], [(0.0, 4.0), (0.0, 3_000.0)], list(KERNEL), {})
    specs = {b: LabelSpec(["size", "price"], ["ln", "linear"], [(0.0, 4.0), (0.0, 1_600.0 if b[-1] == "5" else 3_000.0)], ["", ""], [0, 1], registry) for b in brands}
    tried = spark.createDataFrame([(r["campaign_id"], r["status"], (r["reason"] or "")[:2]) for r in commit(spark, rows, specs, root, 2, ident_columns=("iter_idx",))], "campaign_id string, status string, reason string")
    held = read_published(spark, root).groupBy("campaign_id").agg(F.count("*").alias("n_rows"), F.sum("iter_idx").alias("ids"), F.round(F.max("th_price"), 6).alias("top_price"))
    return tried.join(held, "campaign_id", "left").select("campaign_id", "status", "reason", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "ids", "top_price")])


def a10_content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of the rows of each shard; return flags are the shards."""
    rows = _table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_partkey", "l_linenumber")
    return content_digest(rows, ["l_returnflag"]).select("l_returnflag", "n_rows", *[F.col(c).cast("string").alias(c) for c in ("sum_a", "sum_b")])


def a5_pooled_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of shards (line numbers), written as descriptions, merged without the rows."""
    own = axis_summary(_table(spark, sf_dir, "lineitem"), BOX, ["l_linenumber"])
    fields = F.struct("axis", "n", "lo", "hi", "n_outside", "mean", "m2")
    texts = own.groupBy(F.col("l_linenumber").cast("string").alias("path")).agg(F.to_json(F.struct(F.collect_list(fields).alias("axis_summary"))).alias("text"))
    return merged(described_axes(texts)).select("axis", "n", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n_outside", F.round("mean", 4).alias("mean"), F.round(F.sqrt(F.col("m2") / F.col("n")), 6).alias("deviation"))


def e3_nearest_on_sphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest other embeddings of every one, by angle."""
    return nearest(_table(spark, sf_dir, "embeddings"), 5).select("id", "rank", "neighbour", F.round("angle", 6).alias("angle"))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sound_rows(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 3 == 0)


def e4_two_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kernel discrepancy between every third embedding and the others."""
    own = kernel_sums(_samples(spark, sf_dir), 1.0)
    return own.select("m", "n", *[F.round(c, 5).alias(c) for c in ("xx", "yy", "xy")], F.round(statistic(*[F.col(c) for c in ("xx", "yy", "xy", "m", "n")]), 9).alias("discrepancy"))


def e5_permuted_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sums for four relabellings that keep the group sizes."""
    return kernel_sums(_samples(spark, sf_dir), 1.0, 4).filter("permutation >= 0").select("permutation", *[F.round(c, 5).alias(c) for c in ("xx", "yy", "xy")])


def s8_synthetic_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up records over the axes of this catalogue: sizes of what was drawn, and labels drawn from the tables' box."""
    spec = _spec(spark, sf_dir, "c_acctbal", "l_discount", "l_extendedprice")
    made = synthetic_detections(spark, spec, 32, 20.0)
    drawn = [(F.get("theta", F.lit(k)), lo, hi) for k, (lo, hi) in zip(spec.active_indices, spec.bounds_theta)]
    inside = F.array(*[(v >= lo) & (v <= hi) for v, lo, hi in drawn])
    label = F.array(*[F.round(v, 9) for v, _, _ in drawn])
    return made.withColumn("label", F.array_join(F.transform(label, lambda v: v.cast("string")), ",")).withColumn("in_box", F.forall(inside, lambda x: x)).select("label", "in_box", "iter_idx", "topo_idx", "seed_run", F.size("det_t").cast("long").alias("n_spikes"), F.array_max("det_ch").alias("last_channel"), F.array_max("det_t").alias("last_time"))


def _windows(spark: SparkSession, sf_dir: str, stride: int) -> DataFrame:
    rows = window_rows(_rates(spark, sf_dir), BINS, WINDOW, stride).groupBy("trace_id", "window_idx", "start").agg(F.sum("x").alias("total"), F.max("x").alias("peak"))
    return rows.select("trace_id", "window_idx", "start", F.round("total", 9).alias("total"), F.round("peak", 9).alias("peak"))


def w2_windows_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, WINDOW)


def w2_windows_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, HOP)


def w3_window_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array windows of the embeddings: 24 long, 16 apart, described by their ends."""
    w = cut_windows(_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("trace")), 24, 16)
    return w.select("vec_id", "window_idx", "start", F.element_at("xw", 1).cast("double").alias("first"), F.element_at("xw", -1).cast("double").alias("last"), F.size("xw").cast("long").alias("length"))


def f3_short_trace_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces that end with their last event; those below 700 bins are short."""
    n = _counts(spark, sf_dir).groupBy("trace_id").agg(F.max("bin").alias("last"))
    return short_summary(n.select(F.sequence(F.lit(0).cast("long"), "last").alias("trace")), 700)


def f1_rejected_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a grid of 20 days and four electrodes leaves out."""
    return rejected(spikes(spark, sf_dir), 20 * 86_400.0, DT, 4)


def j1_unique_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey")).distinct()
    return unique_join(users, _table(spark, sf_dir, "customer"), ["c_custkey"]).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def j1_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders against the customers of one market segment (once) and those without a balance (twice):
    right-only keys, left-only keys and keys twice on either side all occur."""
    left = _table(spark, sf_dir, "orders").filter("o_orderkey % 8 = 0").select(F.col("o_custkey").alias("custkey"))
    customers = _table(spark, sf_dir, "customer")
    part = lambda c: customers.filter(c).select(F.col("c_custkey").alias("custkey"))
    return key_violations(left, part("c_mktsegment <> 'BUILDING'").unionByName(part("c_acctbal < 0")), ["custkey"])


def j3_silent_electrode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spikes of every electrode in every 240-hour window, the silent ones with zero."""
    s = spikes(spark, sf_dir).withColumn("window_idx", F.floor(F.col("t") / (WINDOW * DT)))
    wide = s.withColumn("trace_id", F.col("trace_id") * 10 + F.col("window_idx"))
    users = _table(spark, sf_dir, "events").select("user_id").distinct()
    each = users.withColumn("w", F.explode(F.sequence(F.lit(0), F.lit(BINS // WINDOW - 1)))).withColumn("ch", F.explode(F.sequence(F.lit(0), F.lit(N_E - 1)))).select((F.col("user_id") * 10 + F.col("w")).alias("trace_id"), F.col("ch").cast("long").alias("ch"))
    return channel_counts(wide, each).select(F.floor(F.col("trace_id") / 10).alias("trace_id"), F.pmod("trace_id", F.lit(10)).alias("window_idx"), "ch", "n")


def _axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry from the ranges of numeric columns, one frozen axis and one of exactly a decade."""
    found = None
    for table, columns in (("lineitem", ("l_quantity", "l_extendedprice", "l_discount", "l_tax")), ("part", ("p_size", "p_retailprice")), ("customer", ("c_acctbal",))):
        ranges = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in columns])
        aggs = [f(F.col(c).cast("double")).alias(f"{p}_{c}") for c in columns for p, f in (("lo", F.min), ("hi", F.max))]
        rows = _table(spark, sf_dir, table).agg(*aggs).select(F.inline(ranges))
        found = rows if found is None else found.unionByName(rows)
    fixed = spark.createDataFrame([("frozen", 2.0, 2.0), ("decade", 0.1, 1.0)], "name string, lo double, hi double")
    return found.unionByName(fixed).withColumn("lo", F.col("lo") + 0.0)


def f5_log_axis_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _axes(spark, sf_dir).select("name", "lo", "hi", is_log_axis(F.col("lo"), F.col("hi")).alias("is_log"))


def f6_frozen_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rules(_axes(spark, sf_dir)).filter("is_frozen").select("name", "lo", "hi")


def j7_log_set_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log set against a stored one that has an axis too many and one too few."""
    a = _axes(spark, sf_dir).withColumnRenamed("name", "axis")
    stored = spark.createDataFrame([("l_quantity",), ("p_size",), ("l_tax",), ("decade",)], "axis string")
    return log_set_drift(a, stored)


KERNEL = ((0.1, 1.0), (50.0, 500.0), (0.5, 3.0))
#: The axes by name, which gives their number in the registry.
AXES = ("c_acctbal", "decade", "frozen", "l_discount", "l_extendedprice", "l_quantity", "l_tax", "p_retailprice", "p_size")


def _registry(spark: SparkSession, sf_dir: str) -> Registry:
    """The registry of this catalogue, read as a user's is."""
    a = with_rules(_axes(spark, sf_dir)).withColumn("axis", F.array_position(F.array(*[F.lit(n) for n in AXES]), F.col("name")) - 1)
    return Registry.read(a.select("axis", "name", F.lit("-").alias("unit"), "lo", "hi", *[to_theta(F.col(e), F.col("is_log")).alias(f"{e}_theta") for e in ("lo", "hi")]), KERNEL)


def _spec(spark: SparkSession, sf_dir: str, *names: str) -> LabelSpec:
    return build_label_spec(_registry(spark, sf_dir), [AXES.index(n) for n in names])


def s6_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as it is read: numbers, names, theta bounds, logarithmic and frozen axes."""
    r = _registry(spark, sf_dir)
    logs, frozen = r.log_axes, r.frozen
    flags = spark.createDataFrame([(k, k in logs, n in frozen) for k, n in enumerate(r.names)], "axis int, is_log boolean, is_frozen boolean")
    return r.table(spark).join(F.broadcast(flags), "axis").select("axis", "name", *[F.round(f"{e}_theta", 9).alias(f"{e}_theta") for e in ("lo", "hi")], "is_log", "is_frozen")


def s7_config_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a configuration against one with other values in region 2 and neither region 3 nor key 0."""
    n = _table(spark, sf_dir, "nation").select("n_regionkey", F.col("n_name").alias("key"), F.col("n_nationkey").cast("double").alias("v"))
    want = n.filter("n_regionkey <> 3").select("key", (F.col("v") + F.when(F.col("n_regionkey") == 2, 0.5).otherwise(1e-12)).cast("string").alias("value"))
    return config_drift(n.filter("v > 0").select("key", F.col("v").cast("string").alias("value")), want).select("key", "only_in")


def p12_label_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active axes in the given order with their coordinates and theta bounds, then a linear tail."""
    return _spec(spark, sf_dir, "p_size", "l_discount", "l_extendedprice").table(spark).select("pos", "name", "coord", *[F.round(e, 9).alias(e) for e in ("lo", "hi")])


def p13_to_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, size, price = _table(spark, sf_dir, "part"), F.col("p_size").cast("double"), F.col("p_retailprice")
    yes, no = F.lit(True), F.lit(False)
    return p.select("p_partkey", F.round(to_theta(size, yes), 9).alias("th_size"), F.round(to_theta(price, no), 9).alias("th_price"), F.round(to_natural(to_theta(size, yes), yes), 9).alias("size_back"))


def a1_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = roundtrip(_axes(spark, sf_dir).withColumn("axis", F.lit(0)))
    return r.select("name", "edge", F.round("v", 6).alias("v"), (F.col("off") <= 1e-9 * F.abs("v")).alias("holds"))


def p3_label_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen axes of a stored theta in their order, then four values in natural units."""
    spec = _spec(spark, sf_dir, "p_size", "l_quantity", "l_extendedprice", "l_discount")
    rows = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    params = [F.col(n).cast("double") if n[:2] in ("l_", "p_") else F.lit(0.5) for n in AXES]
    theta = [to_theta(v, F.lit(k in spec.registry.log_axes)) for k, v in enumerate(params)]
    tail = {"conn_prob": F.col("l_tax"), "p0_conn": F.lit(0.5), "d0_conn": F.col("p_retailprice"), "beta_conn": F.col("l_discount")}
    stored = rows.select("l_orderkey", "l_linenumber", F.array(*theta).alias("theta"), F.array(*params).alias("params"), *[v.cast("double").alias(n) for n, v in tail.items()])
    names = ("th_size", "th_quantity", "th_price", "th_discount", "th_tax", "th_p0", "th_retail", "th_beta")
    return assemble_labels(stored, spec, out="label").select("l_orderkey", "l_linenumber", *[F.round(F.get("label", F.lit(j)) + 0.0, 9).alias(n) for j, n in enumerate(names)])


def _axis_report(rows: DataFrame, box: dict[str, tuple[float, float]]) -> DataFrame:
    """What the shard's constraints find on columns that stand for label columns."""
    spec = LabelSpec(list(box), ["linear"] * len(box), list(box.values()), ["-"] * len(box), [], Registry([], [], [], [], list(KERNEL)))
    m = metrics(rows.select(F.array(F.lit(1.0)).alias("z"), F.array(*[F.col(c).cast("double") for c in box]).alias("theta_a")), spec)
    return rows.sparkSession.createDataFrame(by_axis(m, spec), "axis string, constant boolean, n_outside long")


def a4_constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _axis_report(_table(spark, sf_dir, "part").withColumn("same", F.lit(0.1)), dict.fromkeys(("p_size", "p_retailprice", "same"), (0.0, 1e9))).select("axis", "constant")


BOX = {"l_quantity": (5.0, 45.0), "l_extendedprice": (1_000.0, 100_000.0), "l_discount": (0.0, 0.1), "l_tax": (0.01, 0.08)}


def a5_box_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _axis_report(_table(spark, sf_dir, "lineitem"), BOX).select("axis", "n_outside")


def a6_coord_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose stored theta breaks the rule; every 97th is stored a little off."""
    spec = _spec(spark, sf_dir, "p_size", "p_retailprice")
    params = [F.col(n).cast("double") if n[:2] == "p_" else F.lit(0.5) for n in AXES]
    theta = [to_theta(v, F.lit(k in spec.registry.log_axes)) + (F.when(F.col("p_partkey") % 97 == 0, 1e-6).otherwise(0.0) if n == "p_size" else 0.0) for k, (n, v) in enumerate(zip(AXES, params))]
    off = coord_violations(spec, F.array(*theta), F.array(*params))
    return _table(spark, sf_dir, "part").filter(F.size(off) > 0).select("p_partkey", "p_size", F.array_join(off, ",").alias("axes"))


def v_setting_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as campaigns with settings made of their rows, and how many break each rule."""
    k = F.col("c_custkey")
    pair = F.array(F.lit(0.1), F.lit(1.0))
    settings = _table(spark, sf_dir, "customer").select(
        F.when(k % 11 == 0, F.lit(float("nan"))).when(k % 12 == 0, None).otherwise((F.col("c_acctbal") / 100).cast("double")).alias("duration"),
        F.when(k % 7 == 0, 0.0).otherwise((k % 5 + 1) * 0.5).alias("dt"),
        (k % 6).alias("n_electrodes"),
        ((k % 9 - 1) * 0.25).alias("sigma_s"),
        ((k % 13) * 0.25).alias("window_s"),
        F.when(k % 4 > 0, k % 3).alias("stride"),
        F.when(k % 14 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k % 9, k % 8, F.lit(8))).alias("active_indices"),
        (k % 3 + 7).alias("n_axes"),
        F.when(k % 10 == 0, F.array(pair, pair)).when(k % 10 == 1, F.array(pair, pair, F.array(F.lit(1.0)))).otherwise(F.array(pair, pair, pair)).alias("kernel_bounds"),
    )
    return rule_counts(settings, setting_rules())


def v_record_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records with defects by their key: times, widths, connectivity, coordinates."""
    spec = _spec(spark, sf_dir, "p_size", "p_retailprice")
    k, nan = F.col("p_partkey"), F.lit(float("nan"))
    params = [F.col(n).cast("double") if n[:2] == "p_" else F.lit(0.5) for n in AXES]
    theta = [to_theta(v, F.lit(j in spec.registry.log_axes)) + F.when(k % 29 == 0, 1e-6).otherwise(0.0) for j, v in enumerate(params)]
    rows = _table(spark, sf_dir, "part").select(
        F.array(F.col("p_size").cast("double"), F.when(k % 13 == 0, nan).otherwise(F.lit(1.0))).alias("det_t"),
        F.when(k % 17 == 0, F.slice(F.array(*theta), 2, len(AXES))).when(k % 31 == 0, None).otherwise(F.array(*theta)).alias("theta"),
        F.when(k % 19 == 0, F.slice(F.array(*params), 2, len(AXES))).when(k % 5 == 0, None).otherwise(F.array(*params)).alias("params"),
        F.lit(0.3).alias("conn_prob"),
        F.when(k % 23 != 0, 0.5).alias("p0_conn"),
        F.when(k % 37 == 0, F.lit(float("inf"))).otherwise(F.lit(100.0)).alias("d0_conn"),
        F.lit(1.0).alias("beta_conn"),
    )
    return rule_counts(rows, record_rules(spec))


def v_window_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as windows of 64 samples with outputs of 64, with defects by their id."""
    k, e = F.col("vec_id"), F.col("embedding")
    windows = _table(spark, sf_dir, "embeddings").select(
        F.when(k % 7 == 0, F.slice(e, 1, 63)).when(k % 11 == 0, F.concat(F.slice(e, 1, 63), F.array(F.lit(float("nan")).cast("float")))).when(k % 41 != 0, e).alias("xw"),
        F.when(k % 13 == 0, F.slice(e, 1, 8)).otherwise(e).alias("z"),
        F.when(k % 17 != 0, e).alias("zraw"),
        F.when(k % 19 == 0, F.array(F.lit(1.0))).when(k % 23 != 0, F.array(F.lit(1.0), F.lit(2.0))).alias("theta_a"),
    )
    return rule_counts(windows, window_rules(EncoderSpec(LinearHead(np.eye(64)), 64, 64.0, 1.0), 2))


def a7_unit_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    off = F.abs(l2_norm(F.col("embedding")) - 1.0)
    return _table(spark, sf_dir, "embeddings").agg(F.count("*").alias("n_rows"), F.count_if(off >= UNIT_TOLERANCE).alias("n_off"), (F.max(off) < UNIT_TOLERANCE).alias("holds"))


def a9_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with a value that is not finite; every 50th is given one."""
    broken = F.when(F.col("vec_id") % 50 == 0, F.concat("embedding", F.array(F.lit(float("nan")).cast("float")))).when(F.col("vec_id") % 50 == 1, F.concat("embedding", F.array(F.lit(float("-inf")).cast("float")))).otherwise(F.col("embedding"))
    return _table(spark, sf_dir, "embeddings").filter(~all_finite(broken)).select("vec_id")


HEAD = [[((31 * j + 17 * k) % 13 - 6) / 13 for k in range(64)] for j in range(8)]


def x1_linear_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as windows through the encoder contract with a fixed linear head: unnormalised and unit outputs."""
    spec = EncoderSpec(LinearHead(np.array(HEAD)), len(HEAD), 64.0, 1.0)
    rows = encode(_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("xw")), spec)
    return rows.select("vec_id", F.posexplode(F.arrays_zip("zraw", "z")).alias("j", "v")).select("vec_id", F.col("j").cast("long").alias("j"), *[F.round(F.col(f"v.{c}").cast("double"), 6).alias(c) for c in ("zraw", "z")])


def p2_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select("vec_id", *flattened("embedding", "z", 64, "double"))


def p1_trailing_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", basename(F.col("url")).alias("name"), F.coalesce(trailing_index(F.col("url")), F.lit(-1)).alias("idx"))


def s5_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", digest_of(F.col("text")).alias("sha256"))


def g13_digest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as descriptions of shards that name the digest of their text."""
    block = F.struct(F.struct(digest_of(F.col("text")).alias("dsn_checkpoint_sha256")).alias("embedding"))
    return digest_audit(_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.to_json(block).alias("text")))


def a10_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as descriptions of shards: how many values each compared part of a description has, and who has the first ones."""
    text = F.struct(F.array("p_brand").alias("param_names"), F.array(F.lit("ln")).alias("coord"), F.array(F.array("p_size", F.lit(90))).alias("bounds_theta"), F.struct("p_type").alias("embedding"), F.when(F.col("p_partkey") % 10 > 0, F.struct("p_name")).alias("observable"))
    found = compatibility(_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("path"), F.to_json(text).alias("text")))
    return found.select("part", "n_values", F.size("examples").cast("long").alias("n_examples"), F.get("examples", F.lit(0)).alias("first"))


def g12_campaign_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files, hosts as campaigns."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("detections", "topology", "manifest", "job_args")]), (F.col("page_id") % 4 + 1).cast("int"))
    files = _table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.regexp_extract("url", "://([^/]+)", 1).alias("campaign"), kind.alias("kind"), F.regexp_replace("url", "/[^/]*$", "").alias("tree"))
    return summary(files).select("campaign", "n_detections", "first_detection", F.size("detection_trees").cast("long").alias("n_trees"), "n_topology", "first_topology", "manifest", "verdict")


def l2_ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred events by the text of their id: 10 comes before 2."""
    return first_files(_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("path"), "user_id"), 100)


def u3_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types that a user lacks in the first week."""
    e = _table(spark, sf_dir, "events").withColumn("early", F.when(_micros() < 7 * 86_400_000_000, F.col("event_type")))
    return e.groupBy("user_id").agg(F.array_join(lacking(F.collect_set("early"), TYPES), ",").alias("missing"))


def j5_launch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as campaigns, with detections if their balance is positive; their orders as sweeps, the large ones as files."""
    found = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("campaign"), (F.col("c_acctbal") > 0).cast("long").alias("n_detections"), F.array("c_mktsegment").alias("detection_trees"))
    sweeps = _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("campaign")).agg(F.count_if(F.col("o_totalprice") > 300_000).alias("n_topology")).withColumn("topology_trees", F.array(F.lit("orders")))
    return launch_plan(found, sweeps).select("campaign", "status", F.coalesce("reason", F.lit("")).alias("reason"), F.get("detection_trees", F.lit(0)).alias("tree"))


def _fixture(spark: SparkSession, sf_dir: str) -> str:
    """The 25 nations as a campaign of archives, written to the shared folder; regions are its topo folders."""
    store, root = Store(spark), f"{scratch(spark, 'campaigns')}"

    def archive(**members) -> bytes:
        out = io.BytesIO()
        np.savez(out, **members)
        return out.getvalue()

    for r in _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").collect():
        n, at = int(r["n_nationkey"]), f"{root}/nations/topo_{r['n_regionkey']}"
        seed = {} if n % 2 else {"seed_run": n * 10}
        store.write_bytes(f"{at}/mea_iter_{n:05d}.npz", archive(det_t=np.arange(n + 1) * 0.25, det_ch=np.arange(n + 1) % 4, theta=np.arange(9) + n / 2, electrode_centers=np.zeros((4, 2)), **seed))
        some = {} if n % 5 == 0 else {"beta_conn": n / 10}
        store.write_bytes(f"{at}/iter_{n:05d}.npz", archive(conn_prob=n / 100, p0_conn=0.5, d0_conn=50.0 + n, **some))
    store.write_text(f"{root}/nations/manifest.json", json.dumps({"active_indices": [0, 2, 5], "manifest_version": 3}))
    store.write_text(f"{root}/nations/job_args.json", json.dumps({"simtime": 12.5, "conn_prob_lo": 0.05, "conn_rule": "weibull", "p0_hi": 1.5}))
    return root


def s1_detection_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_detections(spark, f"{_fixture(spark, sf_dir)}/nations")
    return d.select("topo_dir", "topo_idx", "iter_idx", "seed_run", "n_electrodes", F.size("det_t").cast("long").alias("n_spikes"), F.array_max("det_t").alias("last_t"), F.array_max("det_ch").alias("last_ch"), F.get("theta", F.lit(8)).alias("last_theta"), F.col("params").isNull().alias("no_params"))


def s2_topology_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_topology(spark, f"{_fixture(spark, sf_dir)}/nations").withColumn("beta_conn", F.coalesce("beta_conn", F.lit(-1.0)))


def s3_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What runs take from the two documents of a campaign: those of every region, written from its row, and none."""
    store, at, rows = Store(spark), scratch(spark, "settings"), []
    registry = Registry([], [], [], [], list(KERNEL), {"usual": [1, 2]})
    for r in _table(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey").collect():
        k = int(r["r_regionkey"])
        store.write_text(f"{at}/{k}/manifest.json", json.dumps({"active_indices": list(range(k + 1)), "sweep_group": r["r_name"]}))
        store.write_text(f"{at}/{k}/job_args.json", json.dumps({"simtime": k + 2.5, "conn_prob_lo": (k + 1) / 100, "p0_hi": k + 1.5} if k else {}))
        rows.append((r["r_name"], *(settings.read_json(spark, f"{at}/{k}/{n}.json") for n in ("manifest", "job_args"))))
    rows.append(("none", settings.read_json(spark, f"{at}/no.json"), {}))
    out = []
    for name, m, j in rows:
        axes, group = settings.active_axes(m, registry, "usual")
        lo, hi = settings.conn_prob_bounds(j)
        out.append((name, len(axes), group, lo, hi, settings.kernel_bounds(j, KERNEL)[0][1], settings.duration(j)))
    return spark.createDataFrame(out, "campaign string, n_axes long, sweep_group string, lo double, hi double, p0_hi double, duration double")


def s10_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detailed(spark, _fixture(spark, sf_dir))
    lists = [F.array_join(c, ",").alias(c) for c in ("detection_keys", "detection_missing", "topology_missing")]
    return d.select("campaign", "n_detections", "n_topology", F.size("detection_trees").cast("long").alias("n_trees"), basename(F.col("first_detection")).alias("first"), "verdict", "simtime", "conn_rule", F.col("n_active").cast("long").alias("n_active"), "manifest_version", "theta_width", "n_electrodes", *lists)


def j1_campaign_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with the one sweep record of their folder and number, every archive opened once."""
    at = f"{_fixture(spark, sf_dir)}/nations"
    keys = listed(spark, at).select("topo_dir", "iter_idx")
    return unique_join(read_detections(spark, at), read_topology(spark, at), ["topo_dir", "iter_idx"], left_keys=keys).select("topo_idx", "iter_idx", F.size("det_t").cast("long").alias("n_spikes"), "d0_conn")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w2_windows_disjoint(spark, sf_dir)


QUERIES: tuple[Query, ...] = (
    g1_bin_counts, g3_dense_grid, w1_gaussian_smooth, w1_dense_traces, g4_mean_rate, w2_windows_disjoint, w2_windows_overlap, w3_window_slices, f3_short_trace_drop,
    f1_rejected_spikes, j1_unique_join, j1_key_violations, j1_campaign_join, j3_silent_electrode, f5_log_axis_rule, f6_frozen_axes, j7_log_set_drift, p12_label_axes, p13_to_theta,
    a1_roundtrip, p3_label_assembly, a4_constant_columns, a5_box_violations, a6_coord_check, a7_unit_norm, a9_finite, x1_linear_head, p2_flatten, p1_trailing_index,
    s1_detection_scan, s2_topology_scan, s3_settings, s5_digest, s6_registry, s7_config_drift, s8_synthetic_source, s10_inventory, g13_digest_audit, g12_campaign_summary,
    a10_content_digest, a5_pooled_axes, e3_nearest_on_sphere, e4_two_sample, e5_permuted_sums, k1_grouped_publication, w1_segments, w2_segment_windows, e6_streamed_windows, l2_ordered_limit, u3_missing_keys, j5_launch_plan, k1_export_shard,
    v_setting_rules, v_record_rules, v_window_rules, a10_compatibility,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in QUERIES}


_SPIKES = "spikes AS (SELECT user_id AS trace_id, CASE event_type " + " ".join(f"WHEN '{t}' THEN {k}" for k, t in enumerate(TYPES)) + " END AS ch, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS us FROM events)"
_COUNTS = f"{_SPIKES}, counts AS (SELECT trace_id, us // 3600000000 AS bin, count(*) AS c FROM spikes WHERE us >= 0 AND us < 2592000000000 AND ch BETWEEN 0 AND 4 GROUP BY 1, 2)"
_RATES = f"""{_COUNTS}, k0 AS (SELECT j::BIGINT AS j, exp(-0.5 * (j / 2.0) ** 2) AS g FROM range(-8, 9) t(j)), kernel AS (SELECT j, g / (SELECT sum(g) FROM k0) AS w FROM k0),
virtual AS (SELECT trace_id, unnest([bin, -1 - bin, {2 * BINS - 1} - bin]) AS p, c FROM counts),
smooth AS (SELECT trace_id, p - j AS bin, sum(c * w) AS r FROM virtual, kernel WHERE p BETWEEN -8 AND {BINS + 7} AND p - j BETWEEN 0 AND {BINS - 1} GROUP BY 1, 2)"""
_HALF = "sum(('0x' || substr(d, {at}, 15))::BIGINT)::VARCHAR"
_KERNEL = "e AS (SELECT vec_id, embedding::DOUBLE[] AS v, vec_id % 3 = 0 AS x FROM embeddings), k AS (SELECT a.vec_id AS a, b.vec_id AS b, exp(-pow(list_distance(a.v, b.v), 2) / 2) AS k FROM e a JOIN e b ON a.vec_id <> b.vec_id)"
_WINDOWS = f"WITH {_RATES}, starts AS (SELECT (s // {{stride}})::BIGINT AS window_idx, s::BIGINT AS start FROM range(0, {BINS - WINDOW + 1}, {{stride}}) t(s)) SELECT trace_id, window_idx, start, round(sum(r / {N_E}), 9) AS total, round(max(r / {N_E}), 9) AS peak FROM smooth JOIN starts ON bin >= start AND bin < start + {WINDOW} GROUP BY ALL"
_RANGE = "SELECT '{c}' AS name, min({c})::DOUBLE + 0.0 AS lo, max({c})::DOUBLE AS hi FROM {t}"
_AXES = "axes AS (" + " UNION ALL ".join(_RANGE.format(c=c, t=t) for t, cs in (("lineitem", ("l_quantity", "l_extendedprice", "l_discount", "l_tax")), ("part", ("p_size", "p_retailprice")), ("customer", ("c_acctbal",))) for c in cs) + " UNION ALL VALUES ('frozen', 2.0::DOUBLE, 2.0::DOUBLE), ('decade', 0.1::DOUBLE, 1.0::DOUBLE)), ruled AS (SELECT *, CASE WHEN lo > 0 AND hi > 0 THEN log10(hi / lo) >= 1 ELSE false END AS is_log FROM axes)"


def _counted(rows: str, **rules: str) -> str:
    """SQL that counts the rows on which each condition is false or null."""
    return f"WITH t AS ({rows}) " + " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) FILTER (NOT coalesce({holds}, false)) AS n_broken, count(*) AS n_rows FROM t" for r, holds in rules.items())


def oracle_sql() -> dict[str, str]:
    """All but the source that draws records, which a test checks instead."""
    heads = ", ".join("[" + ", ".join(f"{w!r}::DOUBLE" for w in row) + "]" for row in HEAD)
    return {
        "g1_bin_counts": f"WITH {_COUNTS} SELECT * FROM counts",
        "g3_dense_grid": f"WITH {_COUNTS} SELECT trace_id, bin, coalesce(c, 0) AS c FROM (SELECT DISTINCT trace_id FROM spikes) CROSS JOIN range(0, {BINS}) t(bin) LEFT JOIN counts USING (trace_id, bin)",
        "w1_gaussian_smooth": f"WITH {_RATES} SELECT trace_id, bin, round(r, 9) AS r FROM smooth",
        "w1_dense_traces": f"WITH {_COUNTS} SELECT trace_id, {BINS}::BIGINT AS n_bins, sum(c)::BIGINT AS n_spikes FROM counts GROUP BY 1",
        "g4_mean_rate": f"WITH {_RATES} SELECT trace_id, round(sum(r), 9) AS pooled, round(sum(r / {N_E}), 9) AS mean, round(max(r), 9) AS pooled_peak, round(max(r / {N_E}), 9) AS mean_peak, round(sum(r) / greatest(sum(r / {N_E}), 1e-30), 6) AS ratio FROM smooth GROUP BY 1",
        "w2_windows_disjoint": _WINDOWS.format(stride=WINDOW),
        "w2_windows_overlap": _WINDOWS.format(stride=HOP),
        "a10_content_digest": f"WITH t AS (SELECT l_returnflag, md5(concat(length(a), ':', a, length(b), ':', b, length(c), ':', c)) AS d FROM (SELECT l_returnflag, l_linenumber::VARCHAR AS a, l_orderkey::VARCHAR AS b, l_partkey::VARCHAR AS c FROM lineitem)) SELECT l_returnflag, count(*) AS n_rows, {_HALF.format(at=1)} AS sum_a, {_HALF.format(at=16)} AS sum_b FROM t GROUP BY 1",
        "a5_pooled_axes": " UNION ALL ".join(f"SELECT '{c}' AS axis, count({c}) AS n, round(min({c})::DOUBLE, 6) AS lo, round(max({c})::DOUBLE, 6) AS hi, count(*) FILTER ({c} < {lo}::DOUBLE OR {c} > {hi}::DOUBLE) AS n_outside, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 6) AS deviation FROM lineitem" for c, (lo, hi) in BOX.items()),
        "e3_nearest_on_sphere": "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings), p AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, acos(greatest(-1, least(1, list_dot_product(a.v, b.v) / (a.n * b.n)))) AS angle FROM e a JOIN e b ON a.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY angle, neighbour)::INTEGER AS rank FROM p) SELECT id, rank, neighbour, round(angle, 6) AS angle FROM r WHERE rank <= 5",
        "e4_two_sample": f"WITH {_KERNEL}, s AS (SELECT coalesce(sum(k) FILTER (a % 3 = 0 AND b % 3 = 0), 0) AS xx, coalesce(sum(k) FILTER (a % 3 <> 0 AND b % 3 <> 0), 0) AS yy, coalesce(sum(k) FILTER (a % 3 = 0 AND b % 3 <> 0), 0) AS xy FROM k), c AS (SELECT count(*) FILTER (x) AS m, count(*) FILTER (NOT x) AS n FROM e) SELECT m, n, round(xx, 5) AS xx, round(yy, 5) AS yy, round(xy, 5) AS xy, round(xx / (m * (m - 1)) + yy / (n * (n - 1)) - 2 * xy / (m * n), 9) AS discrepancy FROM s, c",
        "e5_permuted_sums": f"WITH {_KERNEL}, l AS (SELECT s::INTEGER AS permutation, vec_id, row_number() OVER (PARTITION BY s ORDER BY md5(s || ':' || vec_id)) <= (SELECT count(*) FILTER (x) FROM e) AS x FROM e, range(0, 4) t(s)) SELECT l.permutation, round(coalesce(sum(k) FILTER (l.x AND r.x), 0), 5) AS xx, round(coalesce(sum(k) FILTER (NOT l.x AND NOT r.x), 0), 5) AS yy, round(coalesce(sum(k) FILTER (l.x AND NOT r.x), 0), 5) AS xy FROM k JOIN l ON l.vec_id = a JOIN l r ON r.vec_id = b AND r.permutation = l.permutation GROUP BY 1",
        "k1_grouped_publication": """WITH p AS (SELECT *, regexp_extract(p_brand, '[0-9]+$')::INT AS k, CASE WHEN regexp_extract(p_brand, '[0-9]+$')::INT % 10 = 2 THEN 1.0 ELSE p_retailprice END AS price FROM part),
b AS (SELECT p_brand AS campaign_id, count(*) AS n, sum(p_partkey)::BIGINT AS s, max(price) AS top, CASE WHEN bool_or(k % 10 = 4 AND p_partkey % 5 = 0) THEN 'pl' WHEN min(k) % 7 = 3 THEN 'A7'
    WHEN min(price) = max(price) OR min(p_size) = max(p_size) THEN 'A4' WHEN max(price) > CASE WHEN min(k) % 10 = 5 THEN 1600 ELSE 3000 END THEN 'A5' ELSE '' END AS reason FROM p GROUP BY 1)
SELECT campaign_id, CASE reason WHEN '' THEN 'PUBLISHED' ELSE 'REJECTED' END AS status, reason, CASE reason WHEN '' THEN n ELSE 0 END AS n_rows, CASE reason WHEN '' THEN s ELSE 0 END AS ids, CASE reason WHEN '' THEN round(top, 6) ELSE 0.0 END AS top_price FROM b""",
        "w1_segments": f"WITH {_RATES} SELECT trace_id, bin, round(r, 9) AS r FROM smooth",
        "w2_segment_windows": _WINDOWS.format(stride=HOP),
        "e6_streamed_windows": f"SELECT w.* FROM ({_WINDOWS.format(stride=HOP)}) w, (SELECT max(us) // 1000 - 3600000 AS mark FROM (SELECT epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS us FROM events)) WHERE least(start + {WINDOW + 8}, {BINS}) * 3600000 <= mark",
        "w3_window_slices": "SELECT vec_id, (s // 16)::BIGINT AS window_idx, s::BIGINT AS start, embedding[s + 1]::DOUBLE AS first, embedding[s + 24]::DOUBLE AS last, 24::BIGINT AS length FROM embeddings, range(0, 64, 16) t(s) WHERE s + 24 <= len(embedding)",
        "f3_short_trace_drop": f"WITH {_COUNTS}, n AS (SELECT trace_id, max(bin) + 1 AS n FROM counts GROUP BY 1) SELECT count(*) FILTER (n >= 700) AS n_used, count(*) FILTER (n < 700) AS n_short FROM n",
        "f1_rejected_spikes": f"WITH {_SPIKES}, x AS (SELECT *, NOT (us >= 0 AND us < 1728000000000) AS late FROM spikes) SELECT trace_id, count(*) FILTER (late) AS out_of_time, count(*) FILTER (NOT late AND NOT ch BETWEEN 0 AND 3) AS other_channel FROM x GROUP BY 1",
        "j1_unique_join": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
        "j1_key_violations": "WITH l AS (SELECT o_custkey AS custkey, count(*) AS n FROM orders WHERE o_orderkey % 8 = 0 GROUP BY 1), r AS (SELECT custkey, count(*) AS n FROM (SELECT c_custkey AS custkey FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1), m AS (SELECT custkey, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right FROM l FULL JOIN r USING (custkey)) SELECT * FROM m WHERE n_left > 1 OR n_right > 1 OR (n_left = 1 AND n_right = 0)",
        "j3_silent_electrode": f"WITH {_SPIKES}, s AS (SELECT trace_id, us // 864000000000 AS window_idx, ch::BIGINT AS ch, count(*) AS n FROM spikes GROUP BY 1, 2, 3) SELECT trace_id, window_idx, ch, coalesce(n, 0) AS n FROM (SELECT DISTINCT trace_id FROM spikes) CROSS JOIN range(0, 3) w(window_idx) CROSS JOIN range(0, 5) c(ch) LEFT JOIN s USING (trace_id, window_idx, ch)",
        "f5_log_axis_rule": f"WITH {_AXES} SELECT name, lo, hi, is_log FROM ruled",
        "f6_frozen_axes": f"WITH {_AXES} SELECT name, lo, hi FROM axes WHERE lo = hi",
        "j7_log_set_drift": f"WITH {_AXES}, s AS (SELECT unnest(['l_quantity', 'p_size', 'l_tax', 'decade']) AS name), d AS (SELECT name FROM ruled WHERE is_log) SELECT name AS axis, 'derived' AS only_in FROM (FROM d EXCEPT FROM s) UNION ALL SELECT name, 'stored' FROM (FROM s EXCEPT FROM d)",
        "p12_label_axes": f"WITH {_AXES}, a AS (SELECT * FROM (VALUES (0, 'p_size'), (1, 'l_discount'), (2, 'l_extendedprice')) v(pos, name)) SELECT pos, name, CASE WHEN is_log THEN 'ln' ELSE 'linear' END AS coord, round(CASE WHEN is_log THEN ln(lo) ELSE lo END, 9) AS lo, round(CASE WHEN is_log THEN ln(hi) ELSE hi END, 9) AS hi FROM a JOIN ruled USING (name) UNION ALL VALUES (3, 'conn_prob', 'linear', 0.1::DOUBLE, 0.6::DOUBLE), (4, 'p0_conn', 'linear', 0.1::DOUBLE, 1.0::DOUBLE), (5, 'd0_conn', 'linear', 50::DOUBLE, 500::DOUBLE), (6, 'beta_conn', 'linear', 0.5::DOUBLE, 3::DOUBLE)",
        "p13_to_theta": "SELECT p_partkey, round(ln(p_size::DOUBLE), 9) AS th_size, round(p_retailprice, 9) AS th_price, round(exp(ln(p_size::DOUBLE)), 9) AS size_back FROM part",
        "a1_roundtrip": f"WITH {_AXES}, e AS (SELECT name, is_log, 'lo' AS edge, lo AS v FROM ruled UNION ALL SELECT name, is_log, 'hi', hi FROM ruled) SELECT name, edge, round(v, 6) AS v, abs(CASE WHEN is_log THEN exp(ln(v)) ELSE v END - v) <= 1e-9 * abs(v) AS holds FROM e",
        "p3_label_assembly": "SELECT l_orderkey, l_linenumber, round(ln(p_size::DOUBLE), 9) AS th_size, round(ln(l_quantity), 9) AS th_quantity, round(ln(l_extendedprice), 9) AS th_price, round(l_discount + 0.0, 9) AS th_discount, round(l_tax + 0.0, 9) AS th_tax, 0.5::DOUBLE AS th_p0, round(p_retailprice, 9) AS th_retail, round(l_discount + 0.0, 9) AS th_beta FROM lineitem JOIN part ON l_partkey = p_partkey",
        "a4_constant_columns": "SELECT 'p_size' AS axis, min(p_size) = max(p_size) AS constant FROM part UNION ALL SELECT 'p_retailprice', min(p_retailprice) = max(p_retailprice) FROM part UNION ALL SELECT 'same', true",
        "a5_box_violations": " UNION ALL ".join(f"SELECT '{c}' AS axis, count(*) FILTER ({c} < {lo}::DOUBLE OR {c} > {hi}::DOUBLE) AS n_outside FROM lineitem" for c, (lo, hi) in BOX.items()),
        "a6_coord_check": "SELECT p_partkey, p_size, 'p_size' AS axes FROM part WHERE p_partkey % 97 = 0",
        "a7_unit_norm": "WITH n AS (SELECT abs(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) - 1) AS off FROM embeddings) SELECT count(*) AS n_rows, count(*) FILTER (off >= 1e-5) AS n_off, max(off) < 1e-5 AS holds FROM n",
        "v_setting_rules": _counted(
            "SELECT c_custkey AS k, CASE WHEN k % 11 = 0 OR k % 12 = 0 THEN NULL ELSE c_acctbal::DOUBLE / 100 END AS duration, CASE WHEN k % 7 <> 0 THEN (k % 5 + 1) * 0.5::DOUBLE END AS dt, (k % 9 - 1) * 0.25::DOUBLE AS sigma, round_even((k % 13) * 0.25::DOUBLE / dt, 0) AS length, k % 9 AS a, k % 8 AS b FROM customer",
            V1="floor(duration / dt) >= 1", V2="k % 6 >= 1 AND sigma >= 0", V3="length >= 1 AND (k % 4 = 0 OR k % 3 >= 1)", V5="k % 14 <> 0 AND a <> b AND a <> 8 AND k % 3 = 2 AND b <= 8 AND a < 9",
            V6="k % 10 > 1", V10="floor(duration / dt) >= length", V13="sigma = 0 OR sigma >= dt",
        ),
        "v_record_rules": _counted("SELECT p_partkey AS k, (k % 17 = 0 OR k % 31 = 0 OR k % 19 = 0) AS wide FROM part", V4="k % 13 <> 0", V7="NOT wide", V8="k % 23 <> 0 AND k % 37 <> 0", A6="wide OR k % 5 = 0 OR k % 29 <> 0"),
        "a10_compatibility": "WITH t AS (" + " UNION ALL ".join(f"SELECT '{part}' AS part, {v}::VARCHAR AS v, p_partkey::VARCHAR AS path FROM part" for part, v in (("param_names", "p_brand"), ("coord", "'ln'"), ("bounds_theta", "p_size"), ("embedding", "p_type"), ("observable", "CASE WHEN p_partkey % 10 > 0 THEN p_name ELSE '' END")))
        + ") SELECT part, count(DISTINCT v) AS n_values, least(10, count(DISTINCT v)) AS n_examples, min(path) AS first FROM t GROUP BY 1",
        "v_window_rules": _counted("SELECT vec_id AS k FROM embeddings", V9="k % 19 <> 0 AND k % 23 <> 0", V11="k % 7 <> 0 AND k % 11 <> 0 AND k % 41 <> 0", V12="k % 13 <> 0 AND k % 17 <> 0"),
        "a9_finite": "SELECT vec_id FROM embeddings WHERE vec_id % 50 IN (0, 1)",
        "x1_linear_head": f"WITH h AS (SELECT vec_id, list_transform([{heads}], lambda w: list_sum(list_transform(list_zip(embedding, w), lambda p: p[1]::DOUBLE * p[2]))) AS zraw FROM embeddings), n AS (SELECT *, sqrt(list_sum(list_transform(zraw, lambda x: x * x))) AS n FROM h) SELECT vec_id, j::BIGINT AS j, round(zraw[j + 1]::FLOAT::DOUBLE, 6) AS zraw, round((zraw[j + 1] / n)::FLOAT::DOUBLE, 6) AS z FROM n, range(0, 8) t(j)",
        "p2_flatten": "SELECT vec_id, " + ", ".join(f"embedding[{j + 1}]::DOUBLE AS z_{j:03d}" for j in range(64)) + " FROM embeddings",
        "p1_trailing_index": r"SELECT page_id, list_last(string_split(url, '/')) AS name, coalesce(list_last(regexp_extract_all(list_last(string_split(url, '/')), '\d+'))::BIGINT, -1) AS idx FROM pages",
        "s5_digest": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
        "g13_digest_audit": "SELECT sha256(text) AS sha256, count(*) AS n_shards, min(doc_id::VARCHAR) AS first_path FROM documents GROUP BY 1",
        "g12_campaign_summary": "SELECT regexp_extract(url, '://([^/]+)', 1) AS campaign, count(*) FILTER (page_id % 4 = 0) AS n_detections, min(url) FILTER (page_id % 4 = 0) AS first_detection, count(DISTINCT regexp_replace(url, '/[^/]*$', '')) FILTER (page_id % 4 = 0) AS n_trees, count(*) FILTER (page_id % 4 = 1) AS n_topology, min(url) FILTER (page_id % 4 = 1) AS first_topology, min(url) FILTER (page_id % 4 = 2) AS manifest, CASE WHEN n_detections > 0 AND n_topology > 0 THEN 'READY' WHEN n_detections > 0 THEN 'BLOCKED: no sweep output' WHEN n_topology > 0 THEN 'BLOCKED: no detections' ELSE 'BLOCKED: neither detections nor sweep output' END AS verdict FROM pages GROUP BY 1",
        "l2_ordered_limit": "SELECT event_id::VARCHAR AS path, user_id FROM events ORDER BY path LIMIT 100",
        "u3_missing_keys": "WITH u AS (SELECT DISTINCT user_id FROM events), r AS (SELECT user_id, unnest([" + ", ".join(f"'{t}'" for t in TYPES) + "]) AS t FROM u), m AS (FROM r EXCEPT SELECT user_id, event_type FROM events WHERE epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') < 604800000000) SELECT user_id, coalesce(string_agg(t, ',' ORDER BY t), '') AS missing FROM u LEFT JOIN m USING (user_id) GROUP BY 1",
        "j5_launch_plan": "WITH o AS (SELECT o_custkey, count(*) FILTER (o_totalprice > 300000) AS n FROM orders GROUP BY 1), r AS (SELECT c_custkey, c_mktsegment, CASE WHEN NOT c_acctbal > 0 THEN 'no detections' WHEN o_custkey IS NULL THEN 'no sweep tree of that name' WHEN n = 0 THEN 'no sweep output' ELSE '' END AS reason FROM customer LEFT JOIN o ON c_custkey = o_custkey) SELECT c_custkey::VARCHAR AS campaign, CASE WHEN reason = '' THEN 'RUN' ELSE 'SKIP' END AS status, reason, c_mktsegment AS tree FROM r",
        "s1_detection_scan": "SELECT 'topo_' || n_regionkey AS topo_dir, n_regionkey::BIGINT AS topo_idx, n_nationkey::BIGINT AS iter_idx, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 10 ELSE -1 END::BIGINT AS seed_run, 4::BIGINT AS n_electrodes, n_nationkey::BIGINT + 1 AS n_spikes, n_nationkey * 0.25::DOUBLE AS last_t, least(n_nationkey, 3)::BIGINT AS last_ch, 8 + n_nationkey / 2.0::DOUBLE AS last_theta, true AS no_params FROM nation",
        "s2_topology_scan": "SELECT 'topo_' || n_regionkey AS topo_dir, n_nationkey::BIGINT AS iter_idx, n_nationkey / 100.0::DOUBLE AS conn_prob, 0.5::DOUBLE AS p0_conn, 50.0::DOUBLE + n_nationkey AS d0_conn, CASE WHEN n_nationkey % 5 = 0 THEN -1.0::DOUBLE ELSE n_nationkey / 10.0::DOUBLE END AS beta_conn FROM nation",
        "s3_settings": "WITH r AS (SELECT r_name, r_regionkey::BIGINT AS k FROM region) SELECT r_name AS campaign, k + 1 AS n_axes, r_name AS sweep_group, CASE WHEN k > 0 THEN (k + 1) / 100 ELSE 0.1 END::DOUBLE AS lo, 0.6::DOUBLE AS hi, CASE WHEN k > 0 THEN k + 1.5 ELSE 1.0 END::DOUBLE AS p0_hi, CASE WHEN k > 0 THEN k + 2.5 ELSE 180.0 END::DOUBLE AS duration FROM r UNION ALL VALUES ('none', 2::BIGINT, 'usual', 0.1::DOUBLE, 0.6::DOUBLE, 1.0::DOUBLE, 180.0::DOUBLE)",
        "s6_registry": f"WITH {_AXES} SELECT (row_number() OVER (ORDER BY name) - 1)::INTEGER AS axis, name, round(CASE WHEN is_log THEN ln(lo) ELSE lo END, 9) AS lo_theta, round(CASE WHEN is_log THEN ln(hi) ELSE hi END, 9) AS hi_theta, is_log, lo = hi AS is_frozen FROM ruled",
        "s7_config_drift": "SELECT n_name AS key, CASE WHEN n_regionkey = 3 THEN 'have' WHEN n_nationkey = 0 THEN 'want' END AS only_in FROM nation WHERE (n_regionkey = 3 AND n_nationkey > 0) OR n_regionkey = 2 OR (n_nationkey = 0 AND n_regionkey <> 3)",
        "s10_inventory": "SELECT 'nations' AS campaign, count(*) AS n_detections, count(*) AS n_topology, 1::BIGINT AS n_trees, min_by('mea_iter_' || lpad(n_nationkey::VARCHAR, 5, '0') || '.npz', n_regionkey * 100 + n_nationkey) AS first, 'READY' AS verdict, 12.5::DOUBLE AS simtime, 'weibull' AS conn_rule, 3::BIGINT AS n_active, '3' AS manifest_version, 9::BIGINT AS theta_width, 4::BIGINT AS n_electrodes, 'det_ch,det_t,electrode_centers' || CASE WHEN min_by(n_nationkey, n_regionkey * 100 + n_nationkey) % 2 = 0 THEN ',seed_run' ELSE '' END || ',theta' AS detection_keys, '' AS detection_missing, CASE WHEN min_by(n_nationkey, n_regionkey * 100 + n_nationkey) % 5 = 0 THEN 'beta_conn' ELSE '' END AS topology_missing FROM nation",
        "j1_campaign_join": "SELECT n_regionkey::BIGINT AS topo_idx, n_nationkey::BIGINT AS iter_idx, n_nationkey::BIGINT + 1 AS n_spikes, 50.0::DOUBLE + n_nationkey AS d0_conn FROM nation",
        "k1_export_shard": f"WITH {_RATES}, w AS (SELECT trace_id, s // {WINDOW} AS window_idx, s AS start FROM (SELECT DISTINCT trace_id FROM counts), range(0, {BINS - WINDOW + 1}, {WINDOW}) t(s)), m AS (SELECT trace_id, start, CASE WHEN bin - start < 192 THEN (bin - start) // 4 ELSE 48 + (bin - start - 192) // 3 END AS b, sum((r / {N_E})::FLOAT::DOUBLE) AS total FROM smooth JOIN w USING (trace_id) WHERE bin >= start AND bin < start + {WINDOW} GROUP BY ALL), h AS (SELECT unnest([{heads}]) AS head, unnest(range(0, {len(HEAD)})) AS j) SELECT w.trace_id, window_idx::BIGINT AS window_idx, true AS unit, (SELECT count(*) FROM w) AS n_rows, j::BIGINT AS j, round(coalesce(sum(head[b + 1] * total / CASE WHEN b < 48 THEN 4 ELSE 3 END), 0)::FLOAT::DOUBLE, 5) AS zraw FROM w CROSS JOIN h LEFT JOIN m USING (trace_id, start) GROUP BY ALL",
    }
