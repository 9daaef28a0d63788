"""Neighbours on the sphere, two-sample tests, digests of files and contents, merged summaries."""

import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import ACTIVE, registry, write_campaign
from tests.test_export import demo_spec
from tracewell.operators import neighbours, two_sample
from tracewell.operators.encoder import file_digests
from tracewell.operators.labels import build_label_spec
from tracewell.operators.summaries import axis_summary, content_digest, described_axes, merged, pooled_violations
from tracewell.plans.audit import content_violations, descriptions
from tracewell.plans.campaign import IDENT, campaign_records
from tracewell.plans.export import export_embeddings


def brute_neighbours(rows, k):
    rows = [(i, np.array(v, float) / np.linalg.norm(v)) for i, v in rows if i is not None and v and np.isfinite(v).all() and np.linalg.norm(v) > 0]
    x = np.array([v for _, v in rows])
    far = neighbours.angles(x, x)
    out = []
    for a, (i, _) in enumerate(rows):
        near = sorted((round(far[a, b], 9), rows[b][0]) for b in range(len(rows)) if b != a)[:k]
        out += [(i, r, n, d) for r, (d, n) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 4])
def test_neighbours_against_brute_force(spark, tmp_path, monkeypatch, k):
    for name, value in (("BLOCK", 50), ("PACK", 16), ("PIVOTS", 8)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(250)] + [(1000 + i, [1.0, 2.0, 2.0]) for i in range(40)] + [(1000, [0.0, 0.0, 1.0])]
    rows += [(2000, None), (2001, []), (2002, [float("nan"), 1.0, 0.0]), (2003, [0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (2004, [2.0, 4.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit(1)).withColumn("cell", F.lit(2))
    at = str(tmp_path / "n")
    got = sorted((r["id"], r["rank"], r["neighbour"], round(r["angle"], 9)) for r in neighbours.nearest(df, k, store=at).collect())
    assert got == brute_neighbours(rows, k)
    assert neighbours.compared(at, spark) < 0.6 * 252 * 252  # pruned, copies counted once
    assert neighbours.nearest(df.limit(0), k, store=str(tmp_path / "e")).count() == 0


def test_neighbours_send_each_vector_once_a_tile(spark, tmp_path, monkeypatch):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name, value in (("BLOCK", 32), ("PACK", 16), ("PIVOTS", 4), ("ROWS", 20), ("HITS", 50)):
        monkeypatch.setattr(neighbours, name, value, raising=False)
    rng, sent = np.random.default_rng(7), []
    for n in (512, 2_048):  # so many dimensions that nothing is pruned
        rows = [(i, rng.normal(size=24).tolist()) for i in range(n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        before = shuffled(spark)
        got = sorted((r["id"], r["rank"], r["neighbour"], round(r["angle"], 9)) for r in neighbours.nearest(df, 3, store=str(tmp_path / str(n))).collect())
        sent.append(shuffled(spark) - before)
        assert got == brute_neighbours(rows, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert 0 < sent[1] < 6 * sent[0]


def sample(spark, rng, n, shift):
    rows = [(i, (rng.normal(size=4) + (shift if i % 2 else 0.0)).tolist()) for i in range(n)]
    rows += [(n, None), (n + 1, [float("nan")] * 4)]
    return two_sample.sound_rows(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", F.col("id") % 2 == 0)


def test_kernel_sums_and_relabellings_against_brute_force(spark):
    rows = sample(spark, np.random.default_rng(2), 61, 0.5)
    held = [(r["id"], np.array(r["v"]), r["x"]) for r in rows.collect()]
    assert len(held) == 61
    v, m = np.array([h[1] for h in held]), sum(h[2] for h in held)
    k = np.exp(-((v[:, None] - v) ** 2).sum(2) / (2 * 1.3**2))
    np.fill_diagonal(k, 0.0)
    label = {-1: np.array([h[2] for h in held])}
    for s in range(5):
        digests = [hashlib.md5(f"{s}:{h[0]}".encode()).hexdigest() for h in held]
        label[s] = np.array([d <= sorted(digests)[m - 1] for d in digests])
        assert label[s].sum() == m
    got = {r["permutation"]: r for r in two_sample.kernel_sums(rows, 1.3, 5, block=8).collect()}
    assert got.keys() == label.keys()
    for s, x in label.items():
        want = [k[np.ix_(a, b)].sum() for a, b in ((x, x), (~x, ~x), (x, ~x))]
        assert np.allclose([got[s][c] for c in ("xx", "yy", "xy")], want, rtol=1e-10) and (got[s]["m"], got[s]["n"]) == (m, 61 - m)
    with pytest.raises(ValueError, match="two rows"):
        two_sample.kernel_sums(rows.filter("x"), 1.0)


def shuffled(spark):
    """Bytes that the stages of this session have written to shuffles so far."""
    sc = spark.sparkContext
    none = sc._gateway.new_array(sc._jvm.double, 0)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, none, None)
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_shuffled_kernel_sums_grow_with_the_rows(spark):
    held, sent = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to broadcast
    for n in (1_024, 8_192):
        rows = sample(spark, np.random.default_rng(5), n, 0.0).cache()
        assert rows.count() == n
        before = shuffled(spark)
        two_sample.kernel_sums(rows, 1.0, 1, block=32).collect()
        sent.append(shuffled(spark) - before)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert 0 < sent[1] < 10 * sent[0]


def test_kernel_sums_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(two_sample, "LARGEST", 3)  # 31 tiles for 91 rows, some of them empty
    rows = sample(spark, np.random.default_rng(6), 91, 0.5)
    few = {r["permutation"]: r for r in two_sample.kernel_sums(rows, 1.1, 2, block=2).collect()}
    monkeypatch.undo()
    for s, r in {r["permutation"]: r for r in two_sample.kernel_sums(rows, 1.1, 2).collect()}.items():
        assert np.allclose([few[s][c] for c in ("xx", "yy", "xy", "m", "n")], [r[c] for c in ("xx", "yy", "xy", "m", "n")], rtol=1e-10)


def test_kernel_sums_of_rows_that_come_in_another_order_each_time(spark):
    def stirred(batches):
        for b in batches:
            yield b.take(np.random.default_rng().permutation(b.num_rows))

    rows = sample(spark, np.random.default_rng(8), 300, 0.5)
    v, x = (np.array(c) for c in zip(*[(r["v"], r["x"]) for r in rows.collect()]))
    k = np.exp(-((v[:, None] - v) ** 2).sum(2) / (2 * 1.2**2))
    np.fill_diagonal(k, 0.0)
    held = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")  # executors that fetch blocks in another order do the same
    got = two_sample.kernel_sums(rows.coalesce(1).mapInArrow(stirred, rows.schema), 1.2, block=32).first()
    spark.conf.set("spark.sql.exchange.reuse", held)
    assert np.allclose([got[c] for c in ("xx", "yy", "xy")], [k[np.ix_(a, b)].sum() for a, b in ((x, x), (~x, ~x), (x, ~x))], rtol=1e-10)


def test_the_permutation_test_tells_a_shift_from_none(spark):
    same, p_same = two_sample.permutation_test(sample(spark, np.random.default_rng(3), 120, 0.0), 2.0, 39, block=64)
    far, p_far = two_sample.permutation_test(sample(spark, np.random.default_rng(3), 120, 1.0), 2.0, 39, block=64)
    assert far > same and p_far == 1 / 40 and p_same > 0.1


def test_the_linear_estimate_lies_by_the_exact_one(spark):
    rows = sample(spark, np.random.default_rng(4), 2_000, 0.8).cache()
    exact = two_sample.kernel_sums(rows, 2.0).select(two_sample.statistic(*[F.col(c) for c in ("xx", "yy", "xy", "m", "n")])).first()[0]
    mean, error, pairs = two_sample.linear(rows, 2.0)
    assert pairs > 350 and 0 < error < 0.05 and abs(mean - exact) < 4 * error


def test_files_over_two_gigabytes_are_digested(spark, tmp_path):
    size = (2 << 30) + 12_345
    with open(tmp_path / "big.ckpt", "wb") as f:
        f.truncate(size)  # sparse
    (tmp_path / "small.ckpt").write_bytes(b"abc")
    want = hashlib.sha256()
    zeros = bytes(1 << 20)
    for _ in range(size >> 20):
        want.update(zeros)
    want.update(bytes(size & ((1 << 20) - 1)))
    got = {os.path.basename(r["path"]): (r["length"], r["sha256"]) for r in file_digests(spark, str(tmp_path)).collect()}
    assert got == {"big.ckpt": (size, want.hexdigest()), "small.ckpt": (3, hashlib.sha256(b"abc").hexdigest())}


def test_a_digest_of_rows_shows_every_damage(spark):
    rows = spark.range(200).select("id", (F.col("id") % 7).cast("string").alias("b"), F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("x"))
    base = tuple(content_digest(rows).first())
    assert base == tuple(content_digest(rows.repartition(7).select("x", "id", "b")).first())
    damaged = (
        rows.withColumn("x", F.when(F.col("id") == 17, 0.25).otherwise(F.col("x"))), rows.filter("id <> 17"), rows.unionByName(rows.filter("id = 17")),
        rows.withColumn("b", F.when(F.col("id") == 3, F.lit(None)).otherwise(F.col("b"))), rows.withColumn("b", F.concat("b", F.lit(""))).withColumnRenamed("b", "c").withColumn("c", F.concat("c", F.lit(" "))),
        rows.filter("id <> 17").unionByName(rows.filter("id = 18")),
    )
    assert all(tuple(content_digest(d).first()) != base for d in damaged)
    assert tuple(content_digest(rows.limit(0)).first()) == (0, 0, 0)


def test_shards_are_audited_by_content_and_pooled_by_summaries(spark, tmp_path):
    spec, stems = build_label_spec(registry(), ACTIVE), []
    for k, name in enumerate(("a", "b", "c")):
        base = write_campaign(tmp_path, name=name, seed=k)
        stems.append(str(tmp_path / f"shard_{name}"))
        export_embeddings(demo_spec(2.0), campaign_records(spark, base, base, spec, 2.0, name), stems[-1], spec, IDENT)
    assert content_violations(spark, stems) == []
    pooled = merged(described_axes(descriptions(spark, [f"{s}.json" for s in stems])))
    every = spark.read.parquet(*[f"{s}.parquet" for s in stems])
    want = {r["axis"]: r for r in axis_summary(every, dict(zip(spec.column_names, spec.bounds_theta))).collect()}
    got = {r["axis"]: r for r in pooled.collect()}
    assert got.keys() == want.keys() and got
    for axis, r in want.items():
        assert all(np.isclose(got[axis][c], r[c], rtol=1e-9) for c in ("n", "lo", "hi", "n_outside", "mean", "m2"))
    assert pooled_violations(descriptions(spark, [f"{s}.json" for s in stems])).count() == 0
    # damage: a lost file, and a row that was written twice
    part = next(p for p in (tmp_path / "shard_b.parquet").iterdir() if p.suffix == ".parquet")
    rows = spark.read.parquet(f"{stems[2]}.parquet")
    first = rows.limit(1).toPandas()
    spark.createDataFrame(first, rows.schema).write.mode("append").parquet(f"{stems[2]}.parquet")
    os.remove(part)
    found = dict(content_violations(spark, stems))
    assert found.keys() == {stems[1], stems[2]} and found[stems[2]] == "7 rows for 6"
    text = json.loads((tmp_path / "shard_a.json").read_text())
    text["axis_summary"][0] |= {"n_outside": 2}
    (tmp_path / ".shard_a.json.crc").unlink(missing_ok=True)
    (tmp_path / "shard_a.json").write_text(json.dumps(text))
    bad = pooled_violations(descriptions(spark, [f"{s}.json" for s in stems])).collect()
    assert [(r["axis"], r["rule"], r["n_outside"]) for r in bad] == [(text["axis_summary"][0]["axis"], "A5", 2)]
