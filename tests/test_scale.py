"""Many campaigns at once, ranged reads of archives, long traces in segments, windows from streams."""

import io
import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import ACTIVE, registry, write_campaign
from tests.test_export import demo_spec
from tracewell.operators.binning import bin_counts
from tracewell.operators.labels import LabelSpec, build_label_spec
from tracewell.operators.smoothing import segment_windows, smooth_dense, smooth_segments
from tracewell.operators.traces import traces_from_counts
from tracewell.operators.windows import cut_windows
from tracewell.plans import grouped
from tracewell.plans.campaign import IDENT, CampaignRun, campaign_records
from tracewell.plans.export import export_embeddings
from tracewell.sinks.shard import read_shard
from tracewell.sources.archive_source import Counted, NpzReader, archives, read_members
from tracewell.sources.npz import read_topology
from tracewell.streaming.windows import streamed_windows

SPEC = build_label_spec(registry(), ACTIVE)


def jobs_of(spark, f):
    group = os.urandom(8).hex()
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = f()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def a_run(root, name, n_electrodes=None, **options):
    base = write_campaign(root, name=name, seed=len(name) + ord(name[-1]), **options)
    return CampaignRun(name, [base], [base], SPEC, 2.0, {"campaign_id": name, "observable": {"n_electrodes": n_electrodes}}, n_electrodes)


def rewrite(path, **members):
    with np.load(path) as z:
        held = {k: z[k] for k in z.files} | members
    np.savez(path, **{k: v for k, v in held.items() if v is not None})


def test_campaigns_are_published_together_and_failing_ones_left_out(spark, tmp_path):
    runs = [a_run(tmp_path, n) for n in ("good_a", "good b=c", "outside", "corrupt", "twice", "rule", "late", "short", "none")]
    at = {r.name: r.detection_trees[0] for r in runs}
    rewrite(f"{at['outside']}/topo_1/iter_00001.npz", conn_prob=0.9)
    with open(f"{at['corrupt']}/topo_2/mea_iter_00002.npz", "wb") as f:
        f.write(b"no archive")
    os.rename(f"{at['twice']}/topo_1/iter_00001.npz", f"{at['twice']}/topo_1/iter_0_2.npz")
    rewrite(f"{at['rule']}/topo_1/mea_iter_00001.npz", params=np.full(7, 3.0))
    rewrite(f"{at['late']}/topo_1/mea_iter_00001.npz", det_t=np.array([0.5, np.nan]), det_ch=np.array([0, 0]))
    rewrite(f"{at['none']}/topo_1/mea_iter_00001.npz", electrode_centers=None)
    runs = [r if r.name != "short" else CampaignRun(r.name, r.topology_trees, r.detection_trees, SPEC, 1.0, {}) for r in runs]
    out = {r["campaign_id"]: r for r in grouped.publish_campaigns(spark, runs, str(tmp_path / "out"), demo_spec(2.0))}
    assert {n for n, r in out.items() if r["status"] == grouped.PUBLISHED} == {"good_a", "good b=c"}
    reasons = {"outside": "A5", "corrupt": "cannot be read", "twice": "not unique or has no match", "rule": "A6", "late": "not finite", "short": "below the encoder's window", "none": "electrode centres"}
    assert all(text in out[n]["reason"] for n, text in reasons.items())
    found = grouped.read_published(spark, str(tmp_path / "out"))
    assert {(r["campaign_id"], r["count"]) for r in found.groupBy("campaign_id").count().collect()} == {("good_a", 6), ("good b=c", 6)}
    # the same rows as a single export, and its description
    records = campaign_records(spark, at["good_a"], at["good_a"], SPEC, 2.0, "good_a")
    export_embeddings(demo_spec(2.0), records, str(tmp_path / "one"), SPEC, IDENT)
    one, text = read_shard(spark, str(tmp_path / "one"))
    names = [c for c in spark.read.parquet(str(tmp_path / "one.parquet")).columns]
    rows = lambda d: sorted(map(tuple, d.select(*names).collect()))
    assert rows(found.filter("campaign_id = 'good_a'")) == rows(spark.read.parquet(str(tmp_path / "one.parquet"))) and one.count() == 6
    described = json.loads(out["good_a"]["description"])
    assert described["assertions_passed"] == text["assertions_passed"] and described["bounds_theta"] == text["bounds_theta"] and described["n_traces_used"] == 6
    # only those left out are tried again, and a mended one joins the others
    rewrite(f"{at['outside']}/topo_1/iter_00001.npz", conn_prob=0.3)
    again = {r["campaign_id"]: r["status"] for r in grouped.publish_campaigns(spark, runs, str(tmp_path / "out"), demo_spec(2.0))}
    assert "good_a" not in again and again["outside"] == grouped.PUBLISHED
    assert grouped.read_published(spark, str(tmp_path / "out")).groupBy("campaign_id").count().count() == 3
    assert {r["campaign_id"] for r in grouped.read_published(spark, str(tmp_path / "out"), ["outside"]).select("campaign_id").collect()} == {"outside"}


def small_rows(spark, n, per=3, bad=0):
    ids = spark.range(n * per).select(F.concat(F.lit("c"), F.col("id") % n).alias("campaign_id"), F.floor(F.col("id") / n).alias("iter_idx"), (F.col("id") % n).alias("c"))
    z = F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float"))
    theta = F.array(F.col("iter_idx") + F.when(F.col("c") < bad, 100.0).otherwise(0.0))
    return ids.select("campaign_id", "iter_idx", F.lit(0).cast("long").alias("window_idx"), F.lit(None).cast("string").alias("problem"), z.alias("z"), theta.alias("theta_a"))


def test_a_thousand_campaigns_take_no_more_jobs_than_forty(spark, tmp_path):
    spec = LabelSpec(["a"], ["linear"], [(0.0, 10.0)], [""], [0], registry())
    go = lambda n, to: jobs_of(spark, lambda: grouped.commit(spark, small_rows(spark, n, bad=5), {f"c{i}": spec for i in range(n)}, str(tmp_path / to), 2, ident_columns=("iter_idx",)))
    few, jobs = go(40, "few")
    many, more = go(1_000, "many")
    assert more == jobs and sum(r["status"] == grouped.REJECTED for r in few) == 5 == sum(r["status"] == grouped.REJECTED for r in many)
    assert all(r["reason"].startswith("A5") for r in many if r["status"] == grouped.REJECTED)
    assert grouped.in_force(spark, str(tmp_path / "many")).count() == 995
    assert grouped.read_published(spark, str(tmp_path / "few")).count() == 105
    data = next((tmp_path / "many" / "data").iterdir())
    assert not (data / "campaign_id=c0").exists() and (data / "campaign_id=c999").exists()


def test_a_run_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    spec, root = LabelSpec(["a"], ["linear"], [(0.0, 10.0)], [""], [0], registry()), str(tmp_path / "out")
    put = lambda rows: grouped.commit(spark, rows, {"c0": spec, "c1": spec}, root, 2, ident_columns=("iter_idx",))
    put(small_rows(spark, 2))
    monkeypatch.setattr(grouped.Store, "write_text", lambda *a: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        put(small_rows(spark, 2, per=4))
    monkeypatch.undo()
    assert grouped.read_published(spark, root).count() == 6
    assert len(list((tmp_path / "out" / "data").iterdir())) == 2
    grouped.sweep(spark, root)
    assert len(list((tmp_path / "out" / "data").iterdir())) == 1 and grouped.read_published(spark, root).count() == 6
    put(small_rows(spark, 2, per=5))  # a newer run takes over
    assert grouped.read_published(spark, root).count() == 10


def test_few_bytes_of_an_archive_are_read(spark, tmp_path):
    d = tmp_path / "topo_1"
    d.mkdir()
    big = np.random.default_rng(0).normal(size=200_000)
    for i in range(4):
        np.savez(d / f"iter_{i:02d}.npz", det_t=big, conn_prob=0.1 * i, p0_conn=0.5, flags=np.array([[1, 2], [3, 4]], order="F"), electrode_centers=np.zeros((9, 2)))
    path = d / "iter_02.npz"
    with open(path, "rb") as f:
        seen = Counted(f)
        names, held = read_members(seen, ("conn_prob", "p0_conn", "gone", "electrode_centers_rows", "flags"))
    assert names == ["conn_prob", "det_t", "electrode_centers", "flags", "p0_conn"]
    assert held["conn_prob"] == 0.2 and held["electrode_centers_rows"] == 9 and held["flags"].tolist() == [[1, 2], [3, 4]] and "gone" not in held
    assert seen.n < 0.05 * path.stat().st_size
    schema = "path string, topo_dir string, iter_idx long, names array<string>, conn_prob double, beta_conn double, flags array<long>, electrode_centers_rows long"
    rows = archives(spark, [str(tmp_path)], schema, "iter_*.npz", chunk_files=3)
    assert rows.rdd.getNumPartitions() == 2
    got = rows.orderBy("iter_idx").collect()
    assert [(r["topo_dir"], r["iter_idx"], round(r["conn_prob"], 9), r["beta_conn"], r["flags"], r["electrode_centers_rows"]) for r in got] == [("topo_1", i, round(0.1 * i, 9), None, [1, 2, 3, 4], 9) for i in range(4)]
    packed = io.BytesIO()
    np.savez_compressed(packed, a=np.arange(5), o=np.array([{}], dtype=object))
    packed.seek(0)
    assert read_members(packed, ("a",))[1]["a"].tolist() == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="objects"):
        read_members(packed, ("o",))
    with pytest.raises(zipfile.BadZipFile):
        read_members(io.BytesIO(b"no archive"), ("a",))
    (d / "iter_07.npz").write_bytes(b"no archive")
    with pytest.raises(Exception, match="iter_07.npz cannot be read"):
        read_topology(spark, str(tmp_path)).collect()


def test_filters_on_folder_and_number_prune_archives(spark, tmp_path):
    base = write_campaign(tmp_path, n_topo=3, n_iter=4)
    reader = NpzReader(None, {"path": base, "glob": "iter_*.npz", "chunk_bytes": "1"})
    assert len(reader.listed()) == 12 == len(reader.partitions())
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    conditions = ["topo_dir = 'topo_2'", "iter_idx IN (1, 3)", "topo_dir = 'topo_1' AND iter_idx >= 2 AND conn_prob > 0", "iter_idx < 1", "topo_dir = 'none'"]
    plain = [sorted(map(tuple, read_topology(spark, base).filter(c).collect())) for c in conditions]
    try:
        spark.conf.set(key, "true")
        for name in os.listdir(f"{base}/topo_3"):  # opened by no query on other folders
            if name.startswith("iter_"):
                open(f"{base}/topo_3/{name}", "wb").close()
        pruned = [sorted(map(tuple, read_topology(spark, base).filter(c).filter("topo_dir < 'topo_3'").collect())) for c in conditions]
    finally:
        spark.conf.set(key, before)
    assert pruned == [[r for r in p if r[0] != "topo_3"] for p in plain] and pruned[0] and pruned[2]


def counts_of(spark, traces):
    rows = [(t, int(b), int(c)) for t, x in traces.items() for b, c in enumerate(x) if c]
    return spark.createDataFrame(rows, "trace_id int, bin long, c long"), spark.createDataFrame([(t,) for t in traces], "trace_id int")


@pytest.mark.parametrize("bins, sigma, segment", [(100, 2.0, 7), (100, 2.0, 100), (97, 3.0, 10), (60, 5.0, 64), (50, 0.0, 9), (41, 10.0, 3)])
def test_segments_are_the_whole_trace(spark, bins, sigma, segment):
    rng = np.random.default_rng(bins)
    traces = {1: rng.poisson(0.7, bins), 2: np.zeros(bins, int), 3: np.eye(1, bins, 0, int)[0], 4: np.eye(1, bins, bins - 1, int)[0]}
    counts, ids = counts_of(spark, traces)
    pieces = smooth_segments(counts, ids, bins, sigma, segment)
    got = {}
    for r in pieces.orderBy("trace_id", "start").collect():
        got.setdefault(r["trace_id"], []).append(r)
    for t, x in traces.items():
        assert [r["start"] for r in got[t]] == list(range(0, bins, segment))
        assert np.allclose(np.concatenate([r["rates"] for r in got[t]]), smooth_dense(x, sigma), rtol=0, atol=1e-12)
    want = {(t, k, s): smooth_dense(x, sigma)[s : s + 20] for t, x in traces.items() for k, s in enumerate(range(0, bins - 19, 15))}
    found = {(r["trace_id"], r["window_idx"], r["start"]): r["xw"] for r in segment_windows(pieces, bins, 20, 15).collect()}
    assert found.keys() == want.keys() and all(np.allclose(found[k], want[k], rtol=0, atol=1e-12) for k in want)
    assert segment_windows(pieces, bins, bins + 1).count() == 0


def test_a_trace_of_ten_million_bins(spark):
    bins, sigma = 10_000_000, 4.0
    counts = spark.range(200_000).select(F.lit(1).alias("trace_id"), F.pmod(F.xxhash64("id"), F.lit(bins)).alias("bin")).groupBy("trace_id", "bin").agg(F.count("*").alias("c"))
    dense = np.zeros(bins)
    for r in counts.toArrow().to_pylist():
        dense[r["bin"]] = r["c"]
    want = smooth_dense(dense, sigma)
    pieces = smooth_segments(counts, spark.createDataFrame([(1,)], "trace_id int"), bins, sigma)
    sizes = pieces.select(F.max(F.size("rates")), F.sum(F.size("rates"))).first()
    assert tuple(sizes) == (65_536, bins)
    got = np.zeros(bins)
    for r in pieces.filter("segment % 10 = 3 OR start + size(rates) = 10000000 OR segment = 0").toLocalIterator():
        got[r["start"] : r["start"] + len(r["rates"])] = r["rates"]
        assert np.allclose(r["rates"], want[r["start"] : r["start"] + len(r["rates"])], rtol=0, atol=1e-12)
    assert abs(pieces.select(F.sum(F.aggregate("rates", F.lit(0.0), lambda a, x: a + x))).first()[0] - 200_000) < 1e-6


def test_streamed_windows_equal_the_batch_plan(spark, tmp_path):
    """Files arrive one by one, with events out of order, sent again, and too late."""
    rng = np.random.default_rng(6)
    duration, dt, sigma, n_e = 60.0, 0.5, 2.0, 3
    at = lambda t: np.datetime64("2024-05-01T00:00:00") + np.timedelta64(int(round(t * 1e6)), "us")
    events, order = [], []
    for trace in (1, 2, 3):
        for t in np.sort(rng.uniform(0, 60 if trace < 3 else 9, 150)):
            events.append((len(events), trace, float(t), int(rng.integers(0, 4))))
    order = sorted(events, key=lambda e: e[2] + rng.uniform(0, 2.5))  # up to 2.5 s late, which the watermark of 3 s allows
    files = [order[i : i + 60] for i in range(0, len(order), 60)]
    files[3] = files[3] + files[2][:10] + files[3][:5]  # sent again
    files[-1] = files[-1] + [(9_001, 1, 1.0, 0), (9_002, 2, 2.0, 1)]  # far too late
    files.append([(9_003, 9, 100.0, 0)])  # a clock that moves the watermark past the end
    source = tmp_path / "in"
    source.mkdir()
    import pandas as pd

    for i, rows in enumerate(files):
        frame = pd.DataFrame({"event_id": [r[0] for r in rows], "trace_id": [r[1] for r in rows], "ts": [at(r[2]) for r in rows], "ch": [r[3] for r in rows]})
        frame["ts"] = frame["ts"].astype("datetime64[us]").dt.tz_localize("UTC")
        spark.createDataFrame(frame).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        name = next(p for p in (tmp_path / f"part{i}").iterdir() if p.suffix == ".parquet")
        os.rename(name, source / f"{i:03d}.parquet")
        os.utime(source / f"{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    schema = spark.read.parquet(str(source)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    found = streamed_windows(stream, duration, dt, sigma, 24, 10, n_e, "3 seconds", "2024-05-01")
    query = found.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    got = {(r["trace_id"], r["window_idx"]): r for r in spark.read.schema(found.schema).parquet(str(tmp_path / "out")).collect()}
    spikes = spark.createDataFrame([(e[1], e[2], e[3]) for e in events], "trace_id long, t double, ch int")
    batch = cut_windows(traces_from_counts(bin_counts(spikes, duration, dt, n_e), 120, n_e, sigma), 24, 10).collect()
    assert len(batch) == 3 * 10 and got.keys() == {(r["trace_id"], r["window_idx"]) for r in batch}
    for r in batch:
        same = got[r["trace_id"], r["window_idx"]]
        assert same["start"] == r["start"] and np.allclose(same["xw"], r["xw"], rtol=1e-6, atol=1e-7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30  # each once
