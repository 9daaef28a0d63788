"""Encoder, constraints, shards, sources, campaigns, audit, stream and command line."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import ACTIVE, registry, write_campaign
from tracewell import cli, submit
from tracewell.operators.checks import metrics, verdict
from tracewell.operators.encoder import EncoderSpec, LinearHead, demo_spec, config_drift, config_rows, dig, encode, file_digests, spec_from_config
from tracewell.operators.labels import assemble_labels, build_label_spec
from tracewell.operators.traces import build_traces
from tracewell.plans import audit
from tracewell.plans.campaign import IDENT, campaign_records, campaign_runs, export_campaigns, launch_plan, pending, pooled_records, write_pooled
from tracewell.plans.export import export_embeddings
from tracewell.sinks.shard import is_complete, read_shard, restore_previous
from tracewell.sinks.store import Store
from tracewell.sources.inventory import detailed, inventory
from tracewell.sources.npz import read_detections, read_topology
from tracewell.sources.synthetic import synthetic_detections
from tracewell.streaming.ingest import streamed_counts, write_counts


class Exploding:
    def forward(self, x):
        return np.full((len(x), 16), np.nan)


def windows(spark, n=37, length=512, seed=5):
    x = np.abs(np.random.default_rng(seed).standard_normal((n, length))).astype(np.float32)
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, xw array<float>")


def test_z_is_the_unit_vector_of_zraw(spark):
    rows = encode(windows(spark), demo_spec(512 * 0.02)).collect()
    z, raw = np.array([r["z"] for r in rows]), np.array([r["zraw"] for r in rows])
    assert np.abs(raw / np.linalg.norm(raw, axis=1, keepdims=True) - z).max() < 1e-5
    assert np.abs(np.linalg.norm(raw, axis=1) - 1).max() > 1e-3


def test_batches_and_partitions_do_not_matter(spark):
    spec = demo_spec(512 * 0.02)
    runs = []
    for batch, parts in ((1, 1), (5, 3), (37, 2)):
        rows = encode(windows(spark).repartition(parts), spec, batch_size=batch).orderBy("id").collect()
        runs.append(np.array([r["z"] for r in rows]))
    assert max(np.abs(r - runs[0]).max() for r in runs) <= 1e-6


def test_misfits_are_refused(spark):
    spec = demo_spec(512 * 0.02)
    with pytest.raises(Exception, match="do not fit"):
        encode(windows(spark, 4, 511), spec).collect()
    three = spark.createDataFrame([(0, [[1.0] * 512] * 3)], "id int, xw array<array<float>>")
    with pytest.raises(Exception, match="several channels"):
        encode(three, spec).collect()
    with pytest.raises(Exception, match="not finite"):
        encode(windows(spark, 1).withColumn("xw", F.transform("xw", lambda v: F.lit(float("nan")).cast("float"))), spec).collect()
    with pytest.raises(ValueError):
        encode(windows(spark), spec, batch_size=0)
    wide = EncoderSpec(LinearHead(np.ones((5, 64))), 16, 512 * 0.02)
    with pytest.raises(Exception, match="the encoder gave"):
        encode(windows(spark), wide).collect()


def test_several_channels(spark):
    spec = EncoderSpec(LinearHead(np.ones((4, 8))), 4, 0.16, in_channels=2)
    two = spark.createDataFrame([(0, [[1.0] * 8, [2.0] * 8])], "id int, xw array<array<float>>")
    assert encode(two, spec, want_zraw=False).columns == ["id", "z"]
    assert encode(two, spec).first()["zraw"] == [12.0] * 4


def test_spec_from_config(spark):
    head = LinearHead(np.ones((16, 64)))
    config = {"data": {"window_s": 180.0}}
    spec = spec_from_config(head, config, 16)
    assert spec.window_length == 9000 and len(spec.warnings) == 2 and spec.sigma_bins == 2.0
    with pytest.raises(KeyError):
        spec_from_config(head, {}, 16)
    other = {"data": {"window_s": 180.0, "n_channels": 2}, "backbone": {"embedding_size": 16}}
    assert any("n_channels" in w for w in spec_from_config(head, config, 16, expected=other).warnings)
    with pytest.raises(ValueError):
        spec_from_config(head, config, 16, expected=other, strict=True)
    assert any("less than one bin" in w for w in spec_from_config(head, config | {"cohort": {"w_size": 0.1, "gaussian_window": 0.04}}, 16).warnings)
    assert dig({"a": {"b": None}}, "a", "b", default=3) == 3
    with pytest.raises(ValueError, match="window_s"):
        spec_from_config(head, config, 16, expected={"data": {"window_s": 180.7}}, strict=True)
    rows = config_drift(config_rows(spark, {"a": {"b": 1, "c": 2.0, "x": "y"}}), config_rows(spark, {"a": {"b": 1.0 + 1e-12, "c": 2.5, "d": None, "e": 7}})).collect()
    assert sorted((r["key"], r["only_in"]) for r in rows) == sorted([("a.c", None), ("a.e", "want"), ("a.x", "have")])


def synthetic(spark, n=24, duration=10.0, **spec_options):
    spec = build_label_spec(registry(), ACTIVE, **spec_options)
    made = assemble_labels(synthetic_detections(spark, spec, n, duration, 9, seed=12), spec).drop("theta")
    return spec, build_traces(made, duration)


def test_end_to_end(spark, tmp_path):
    spec, records = synthetic(spark)
    stem = str(tmp_path / "shard")
    out = export_embeddings(demo_spec(10.0), records, stem, spec, IDENT, {"observable": {"n_electrodes": 9}, "campaign_id": "x"})
    assert (out.n_rows, out.n_traces_used, out.n_traces_skipped_short) == (24, 24, 0)
    assert out.assertions_passed == ["A2", "A3", "A4", "A5", "A7", "A9"]
    rows = spark.read.parquet(out.parquet_path)
    assert rows.columns == [*IDENT, "window_idx", *[f"z_{j:03d}" for j in range(16)], *[f"zraw_{j:03d}" for j in range(16)], *spec.column_names]
    assert dict(rows.dtypes)["z_000"] == "float" and dict(rows.dtypes)["th_Sigma"] == "double" and dict(rows.dtypes)["window_idx"] == "bigint"
    text = open(out.sidecar_path).read()
    side = json.loads(text)
    assert text.endswith("}\n") and side["observable"]["pooling"] == "mean_over_electrodes" and side["observable"]["n_electrodes"] == 9
    assert side["campaign_id"] == "x" and side["param_names"] == spec.param_names and side["embedding"]["embedding_dim"] == 16
    back, description = read_shard(spark, stem)
    assert len(back.first()["z"]) == 16 and len(back.first()["theta_a"]) == spec.p and description["n_rows"] == 24
    assert is_complete(spark, stem) and not os.path.exists(f"{stem}.staging")


def test_short_traces_are_counted(spark, tmp_path):
    _, records = synthetic(spark, 6)
    cut = records.withColumn("trace", F.when(F.col("iter_idx") < 2, F.slice("trace", 1, 100)).otherwise(F.col("trace")))
    out = export_embeddings(demo_spec(10.0), cut, str(tmp_path / "s"), ident_columns=("iter_idx", "window_idx", "absent"), want_zraw=False)
    assert (out.n_rows, out.n_traces_skipped_short) == (4, 2) and any("shorter" in w for w in out.warnings)
    assert out.assertions_passed == ["A7", "A9"]
    rows = spark.read.parquet(out.parquet_path)
    assert rows.columns[:4] == ["iter_idx", "window_idx", "absent", "z_000"] and rows.filter("absent IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="no window"):
        export_embeddings(demo_spec(100.0), cut, str(tmp_path / "none"))


def test_overlap_warns_and_gives_more_rows(spark, tmp_path):
    _, records = synthetic(spark, 2)
    out = export_embeddings(demo_spec(4.0), records, str(tmp_path / "s"), window_stride=100)
    assert out.n_rows == 2 * 4 and any("overlap" in w for w in out.warnings)


def test_constraints_fire_and_leave_nothing(spark, tmp_path):
    spec, records = synthetic(spark, 8)
    stem = str(tmp_path / "s")
    same = records.withColumn("theta_a", F.transform("theta_a", lambda v, i: F.when(i == 1, F.lit(-60.0)).otherwise(v)))
    with pytest.raises(AssertionError, match="A4.*VA"):
        export_embeddings(demo_spec(10.0), same, stem, spec)
    outside = records.withColumn("theta_a", F.transform("theta_a", lambda v, i: F.when((i == 3) & (F.col("iter_idx") < 3), F.lit(1e6)).otherwise(v)))
    with pytest.raises(AssertionError, match="A5: 3 .*Cm"):
        export_embeddings(demo_spec(10.0), outside, stem, spec)
    with pytest.raises(AssertionError, match="A9"):
        export_embeddings(EncoderSpec(Exploding(), 16, 10.0, l2_normalize=False), records, stem, spec)
    with pytest.raises(Exception, match="do not mix"):
        export_embeddings(demo_spec(10.0), records.withColumn("theta_a", F.when(F.col("iter_idx") > 2, F.col("theta_a"))), stem, spec)
    with pytest.raises(ValueError):
        export_embeddings(demo_spec(10.0), records.drop("theta_a"), stem, spec)
    assert not os.path.exists(f"{stem}.parquet") and not os.path.exists(f"{stem}.json") and not os.path.exists(f"{stem}.staging")
    out = export_embeddings(demo_spec(10.0), outside, stem, spec, strict_in_box=False)
    assert "A5" not in out.assertions_passed and any("A5: 3" in w for w in out.warnings)
    assert spark.read.parquet(out.parquet_path).filter("th_Cm = 1e6").count() == 3


def test_unit_norm_constraint(spark):
    rows = spark.createDataFrame([([1.0, 0.1],)], "z array<float>")
    with pytest.raises(AssertionError, match="A7"):
        verdict(metrics(rows), None)
    held, notes = verdict(metrics(rows), None, l2_normalize=False)
    assert held == ["A9"] and "A7 skipped" in notes[0]


def test_npz_and_campaign(spark, tmp_path):
    base = write_campaign(tmp_path)
    d = read_detections(spark, base)
    assert d.count() == 6 and {(r["topo_dir"], r["topo_idx"], r["iter_idx"], r["seed_run"], r["n_electrodes"]) for r in d.collect()} == {(f"topo_{k}", k, i, -1, 4) for k in (1, 2) for i in range(3)}
    assert read_topology(spark, base).count() == 6
    assert [read_detections(spark, base, max_records=n).count() for n in (0, 1, 4)] == [0, 1, 4]
    spec = build_label_spec(registry(), ACTIVE)
    records = campaign_records(spark, base, base, spec, 2.0, "a")
    assert records.count() == 6 and len(records.first()["trace"]) == 100
    with np.load(f"{base}/topo_2/mea_iter_00001.npz") as m, np.load(f"{base}/topo_2/iter_00001.npz") as s:
        want = [*m["theta"][ACTIVE], *(float(s[a]) for a in ("conn_prob", "p0_conn", "d0_conn", "beta_conn"))]
    assert records.filter("topo_idx = 2 AND iter_idx = 1").first()["theta_a"] == want


def test_campaign_negatives(spark, tmp_path):
    spec = build_label_spec(registry(), ACTIVE)
    base = write_campaign(tmp_path)
    os.rename(f"{base}/topo_1/iter_00002.npz", f"{base}/topo_1/iter_1.npz")  # two matches for 1, none for 2
    with pytest.raises(Exception, match="not unique or has no match|is missing"):
        campaign_records(spark, base, base, spec, 2.0, "a").collect()
    base = write_campaign(tmp_path, name="twice")
    os.link(f"{base}/topo_1/mea_iter_00001.npz", f"{base}/topo_1/mea_iter_1.npz")
    with pytest.raises(Exception, match="not unique"):
        campaign_records(spark, base, base, spec, 2.0, "a").collect()
    base = write_campaign(tmp_path, name="flat")
    np.savez(f"{base}/topo_1/iter_00000.npz", conn_prob=0.2, p0_conn=np.nan, d0_conn=np.nan, beta_conn=np.nan)
    with pytest.raises(Exception, match="flat rule"):
        campaign_records(spark, base, base, spec, 2.0, "a").collect()
    np.savez(f"{base}/topo_2/mea_iter_00000.npz", det_t=np.zeros(1), theta=np.zeros(7))
    with pytest.raises(Exception, match="det_ch"):
        read_detections(spark, base, 4).collect()


def test_inventory_and_launch_plan(spark, tmp_path):
    root = tmp_path / "all"
    write_campaign(root, name="good")
    bad = write_campaign(root, name="no_sweep")
    for d in ("topo_1", "topo_2"):
        for f in os.listdir(f"{bad}/{d}"):
            if f.startswith("iter_"):
                os.remove(f"{bad}/{d}/{f}")
    found = {r["campaign"]: r for r in inventory(spark, str(root)).collect()}
    assert found["good"]["verdict"] == "READY" and found["no_sweep"]["verdict"] == "BLOCKED: no sweep output"
    assert (found["good"]["n_detections"], found["good"]["n_topology"]) == (6, 6) and found["good"]["manifest"].endswith("manifest.json")
    assert found["good"]["first_detection"].endswith("topo_1/mea_iter_00000.npz") and len(found["good"]["detection_trees"]) == 1
    plan = launch_plan(inventory(spark, str(root)), inventory(spark, str(root)))
    assert {(r["campaign"], r["status"], r["reason"]) for r in plan.collect()} == {("good", "RUN", None), ("no_sweep", "SKIP", "no sweep output")}
    assert pending(spark, plan, str(tmp_path)) == ["good"]
    more = detailed(spark, str(root))
    good = more.filter("campaign = 'good'").first()
    assert (good["simtime"], good["conn_prob_lo"], good["conn_prob_hi"], good["conn_rule"], good["n_active"], good["manifest_version"]) == (2.0, 0.05, None, "weibull", len(ACTIVE), "3")
    assert good["detection_missing"] == good["topology_missing"] == [] and (good["theta_width"], good["n_electrodes"]) == (7, 4) and "simtime" in good["detection_keys"]
    assert more.filter("campaign = 'no_sweep'").first()["topology_keys"] is None
    runs = campaign_runs(plan, more, registry(), ["good"])
    run = lambda: export_campaigns(spark, [r for r in runs if r.name in pending(spark, plan, str(tmp_path))], str(tmp_path), demo_spec(2.0), single_file=True, order_by=["path"])
    assert {k: v.n_rows for k, v in run().items()} == {"good": 6} and run() == {}
    side = json.loads((tmp_path / "good.json").read_text())
    assert side["simulation"]["conn_rule"] == "weibull" and side["provenance"]["n_attempted"] == 6 and side["observable"]["n_electrodes"] == 4
    rows = spark.read.parquet(str(tmp_path / "good.parquet"))
    assert len(rows.inputFiles()) == 1 and [(r["topo_idx"], r["iter_idx"]) for r in rows.collect()] == [(k, i) for k in (1, 2) for i in range(3)]
    write_pooled(pooled_records(spark, runs), str(tmp_path / "pooled"))
    assert spark.read.parquet(str(tmp_path / "pooled")).filter("campaign_id = 'good'").count() == 6 and os.path.isdir(tmp_path / "pooled" / "campaign_id=good")


def test_every_archive_is_opened_once(spark, tmp_path):
    base = write_campaign(tmp_path)
    plan = campaign_records(spark, base, base, build_label_spec(registry(), ACTIVE), 2.0, "a")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("content#") and sum("Relation" in x and "content#" in x and "binaryFile" in x for x in plan.splitlines()) <= 3
    assert plan.count("MapInArrow") == 2 and plan.count("RelationV2") == 1  # detections, connectivity, traces


def test_half_written_shards_are_not_complete(spark, tmp_path):
    _, records = synthetic(spark, 2)
    stem = str(tmp_path / "good")
    export_embeddings(demo_spec(10.0), records, stem)
    os.remove(f"{stem}.json")
    assert not is_complete(spark, stem)
    export_embeddings(demo_spec(10.0), records, stem)
    assert is_complete(spark, stem) and spark.read.parquet(f"{stem}.parquet").count() == 2
    assert not [f for f in os.listdir(tmp_path) if "staging" in f or "previous" in f]


@pytest.mark.parametrize("breaks", ["move", "write_text"])
def test_the_old_shard_stays_where_a_publication_breaks_off(spark, tmp_path, monkeypatch, breaks):
    _, records = synthetic(spark, 3)
    stem = str(tmp_path / "good")
    export_embeddings(demo_spec(10.0), records, stem)
    before = (tmp_path / "good.json").read_text()
    usual, calls = getattr(Store, breaks), []

    def broken(self, *args):
        calls.append(args)
        if breaks == "write_text" or len(calls) == 3:  # the third move puts the new data into place
            raise OSError("lost")
        return usual(self, *args)

    monkeypatch.setattr(Store, breaks, broken)
    with pytest.raises(OSError, match="lost"):
        export_embeddings(demo_spec(10.0), records.limit(1), stem)
    monkeypatch.undo()
    assert is_complete(spark, stem) and (tmp_path / "good.json").read_text() == before and spark.read.parquet(f"{stem}.parquet").count() == 3
    os.rename(f"{stem}.json", f"{stem}.json.previous")  # as if the driver had been lost after the first step
    assert not is_complete(spark, stem) and restore_previous(spark, stem) and is_complete(spark, stem)


def test_audit(spark, tmp_path):
    _, records = synthetic(spark, 2)
    for k, width in ((1, 16), (2, 16)):
        export_embeddings(demo_spec(10.0, embedding_dim=width), records, str(tmp_path / f"s{k}"))
    described = audit.descriptions(spark, str(tmp_path))
    assert audit.assert_one_encoder(described) == "0" * 64
    audit.assert_compatible(described)
    export_embeddings(EncoderSpec(LinearHead(np.ones((8, 64))), 8, 10.0, digest="f" * 64), records, str(tmp_path / "s3"))
    described = audit.descriptions(spark, str(tmp_path))
    with pytest.raises(AssertionError, match="A8"):
        audit.assert_one_encoder(described)
    with pytest.raises(AssertionError, match="A10.*embedding"):
        audit.assert_compatible(described)


def test_file_digests(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    assert file_digests(spark, str(tmp_path)).first()["sha256"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, f"2024-01-01 00:00:0{i}", c) for i, c in ((0, 0), (1, 0), (5, 1), (6, 9))] + [(2, "2024-01-01 00:10:00", 0)]
    events = spark.createDataFrame(rows, "trace_id int, ts string, ch int").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    write_counts(streamed_counts(stream, "5 seconds", "1 minute", 4), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    done = {(r["trace_id"], str(r["bin_start"]), r["c"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    every = {(r["trace_id"], str(r["bin_start"]), r["c"]) for r in streamed_counts(events, "5 seconds", "1 minute", 4).collect()}
    assert done == {r for r in every if r[0] == 1} and len(done) == 2  # the last bin waits for the watermark


def test_command_line(spark, tmp_path, capsys):
    sim = tmp_path / "sim"
    reg = registry()
    reg.table(spark).write.parquet(str(sim / "registry.parquet"))
    (sim / "registry.json").write_text(json.dumps({"kernel_bounds": reg.kernel_bounds, "sweep_groups": reg.sweep_groups, "log_params": reg.log_axes}))
    base = write_campaign(tmp_path / "c")
    (tmp_path / "my_encoder.py").write_text("from tracewell.operators.encoder import demo_spec\ndef make(device):\n    return demo_spec(2.0)\n")
    common = ["--sim_dir", str(sim), "--out"]
    assert cli.main(["--mode", "synthetic", "--n_sims", "8", "--simtime", "4", *common, str(tmp_path / "syn")], spark) == 0
    campaign = ["--mode", "campaign", "--checkpoint", "my_encoder:make", "--dsn_main_dir", str(tmp_path), "--campaign", base, "--mea_out", base, "--campaign_id", "a"]
    assert cli.main([*campaign, *common, str(tmp_path / "cam")], spark) == 0
    side = json.loads((tmp_path / "cam.json").read_text())
    assert side["n_rows"] == 6 and side["observable"]["n_electrodes"] == 4 and side["provenance"]["n_attempted"] == 6
    bounds = dict(zip(side["param_names"], side["bounds_theta"]))
    assert bounds["conn_prob"] == [0.05, 0.6] and bounds["p0_conn"] == [0.1, 1.5]
    many = ["--mode", "campaigns", "--checkpoint", "my_encoder:make", "--dsn_main_dir", str(tmp_path), "--campaign", str(tmp_path / "c"), *common, str(tmp_path / "many")]
    assert "held: " in capsys.readouterr().out
    assert cli.main([*many, "--dry_run"], spark) == 0 and "campaign_a: run" in capsys.readouterr().out and not (tmp_path / "many").exists()
    assert cli.main(many, spark) == 0 and json.loads((tmp_path / "many" / "campaign_a.json").read_text())["provenance"]["n_attempted"] == 6
    assert cli.main(many, spark) == 0 and "already exported" in capsys.readouterr().out
    assert cli.main([*many, "--glob", "other*"], spark) == 4
    assert cli.main(["--mode", "inventory", "--campaign", str(tmp_path / "c")], spark) == 0
    assert cli.main(["--mode", "inventory", "--campaign", str(tmp_path / "gone")], spark) == 3
    with pytest.raises(SystemExit):
        cli.main(["--mode", "campaign"], spark)
    with pytest.raises(SystemExit, match="below the encoder's window"):
        cli.main([*campaign, "--simtime", "1", *common, str(tmp_path / "x")], spark)


def test_digest_of_the_weights(spark, tmp_path):
    (tmp_path / "weights.bin").write_bytes(b"abc")
    (tmp_path / "weighted.py").write_text(f"import dataclasses\nfrom tracewell.operators.encoder import demo_spec\ndef make(device):\n    return dataclasses.replace(demo_spec(2.0), path={str(tmp_path / 'weights.bin')!r})\ndef wrong(device):\n    return dataclasses.replace(make(device), digest='f' * 64)\n")
    assert cli.load_encoder(spark, "weighted:make", str(tmp_path), "cpu").digest.startswith("ba7816bf")
    with pytest.raises(SystemExit, match="claims the digest"):
        cli.load_encoder(spark, "weighted:wrong", str(tmp_path), "cpu")


def test_submit_prints_its_command(capsys):
    assert submit.main(["--dry_run", "--master", "local[2]", "--shared", "/shared", "--", "--mode", "synthetic"]) == 0
    said = capsys.readouterr().out
    assert "spark.executorEnv.OMP_NUM_THREADS=1" in said and said.rstrip().endswith("cli.py --mode synthetic") and "spark.checkpoint.dir=/shared" in said
    assert submit.missing("/bin/false") == list(submit.NEEDED)
