"""Top-k search, mixing, packing and the pipeline."""

import importlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, empty
from tracewell.llm import mixing, packing, queries, topk_search

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_top(rows, k, scale=1024):
    ok = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(ok):
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for j, (i, w) in enumerate(ok) if j != at and len(w) == len(v))[:k]
            out += [(q, r, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("chunk", [1, 4_096])
def test_top_k_with_ties_and_awkward_vectors(spark, chunk):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(40).round(1).tolist()) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(120, 150)] + [(201, None), (202, []), (203, [float("nan")] * 40), (204, [None] * 40), (205, [float("inf")] * 40), (None, rows[0][1]), (300, [1.0, 2.0]), (301, [2.0, -1.0]), (302, [0.5])]
    rows += [(0, rng.standard_normal(40).round(1).tolist()), (7, rows[7][1]), (7, rows[8][1])]  # ids that repeat, a query's among them
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(3)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk_search.top_k(df, F.col("vec_id") % 100 == 0, 10, chunk_queries=chunk)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 10)
    assert got.count() == 10 * 3 + 1


def test_top_k_of_very_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.integers(-2, 20)).tolist()) for i in range(300)]
    rows += [(300, [2.0e6] * 8), (301, [2.0e6] * 8), (302, [-2.0e6] * 8), (400, [3.0e6] * 8), (401, [3.0e38] * 8), (402, [2.9e38] * 8)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(3)
    assert sorted(tuple(r) for r in topk_search.top_k(df, F.col("vec_id") % 100 == 0, 10).collect()) == brute_top(rows, 10)


@given(st.lists(st.integers(-(10**30), 10**30), max_size=20))
def test_texts_that_sort_as_scores(scores):
    assert sorted(scores, key=topk_search.ordered) == sorted(scores)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert topk_search.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], 0)], VECTORS)
    assert topk_search.top_k(one, F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_drop_and_keep_what_they_must():
    rng = np.random.default_rng(2)
    q, m = rng.integers(-500, 500, 64), rng.integers(-500, 500, (64, 900))
    scores, rest = q @ m, topk_search._remaining(m)
    floor = float(np.sort(scores)[-10])
    at, got = topk_search.search_block(q, topk_search._remaining(q[:, None])[:, 0], m, rest, floor)
    assert (scores[at] == got).all() and set(np.flatnonzero(scores >= floor)) <= set(at) and len(at) < 900


def brute_targets(sizes, weights, budget=1.5, most=2):
    """Bisection on the unit of weight."""
    lo, hi = 0.0, 10.0 * sum(sizes.values()) + 1
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(most * n, mid * weights[s]) for s, n in sizes.items()) < budget * sum(sizes.values()):
            lo = mid
        else:
            hi = mid
    return {s: min(most * n, hi * weights[s]) for s, n in sizes.items()}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=9))
def test_targets(sizes):
    named = {f"s{i}": n for i, n in enumerate(sizes)}
    weights = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(named)}
    got, want = mixing.targets(named, weights), brute_targets(named, weights)
    assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in named)


def test_mix_query(spark, sf):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    words = {d: len((r["text"] or "").encode().split()) for d, r in docs.items()}
    sizes = {}
    for d, r in docs.items():
        sizes[r["source"]] = sizes.get(r["source"], 0) + words[d]
    goal = brute_targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))})
    rows = queries.op7_mixing(spark, sf).collect()
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[s] and abs(r["target"] - goal[s]) < 1e-6 * goal[s]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    assert len(rows) == len(docs) and max(abs(taken[s] - goal[s]) / goal[s] for s in goal) < 0.1  # ten documents a source, the smallest of which bounds the miss
    again = queries.op7_mixing(spark, sf).collect()
    assert sorted(rows) == sorted(again)


def test_rates_solve_the_dual_with_priors(spark):
    cells = spark.createDataFrame([("a", -1.0, 300), ("a", 1.0, 200), ("b", 0.0, 100), (None, 0.5, 50), ("full", 0.0, 10), ("none", 0.0, 0)], "source string, prior double, tokens long")
    sizes, goal = {"a": 500, "b": 100, None: 50, "full": 10, "none": 0}, {"a": 620.0, "b": 30.0, None: 60.0, "full": 20.0, "none": 0.0}
    got = mixing.solve(cells, goal, sizes)
    r = lambda b, s: 2 / (1 + np.exp(-(b + got.tilt[s])))
    assert abs(300 * r(-1, "a") + 200 * r(1, "a") - 620) < 1e-5 and abs(100 * r(0, "b") - 30) < 1e-5 and abs(50 * r(0.5, None) - 60) < 1e-5
    assert got.full == {"full": 2.0, "none": 0.0} and r(1, "a") > r(-1, "a")
    with pytest.raises(RuntimeError):
        mixing.solve(cells, goal, sizes, rounds=1)


def mix_docs(spark):
    """A source of 400 equal rows, one of rows of many sizes, and one whose only document is too long for its target."""
    words = lambda n: F.trim(F.repeat(F.lit("w "), n.cast("int")))
    equal = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), words(F.lit(50)).alias("text"), F.lit("a").alias("source"))
    sizes = spark.range(300).select(F.col("id").alias("doc_id"), words(F.col("id") * 3 + 1).alias("text"), F.lit("b").alias("source"))
    return equal.unionByName(sizes).unionByName(spark.range(1000, 1001).select(F.col("id").alias("doc_id"), words(F.lit(90_000)).alias("text"), F.lit("c").alias("source")))


@pytest.mark.parametrize("chunk", [7])
def test_targets_hold_with_repeated_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    docs = mix_docs(spark)
    found = mixing.plan(docs)
    by = {r["source"]: r for r in found.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("copies").alias("most"), F.countDistinct("rate").alias("rates")).collect()}
    assert abs(by["a"]["taken"] - by["a"]["target"]) <= 25 and abs(by["b"]["taken"] - by["b"]["target"]) <= 2
    assert abs(by["c"]["taken"] - by["c"]["target"]) <= 45_000 and all(r["most"] <= 2 for r in by.values()) and by["b"]["rates"] > 3
    again = mixing.plan(docs.repartition(7))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
    out = {r["source"]: r["n"] for r in mixing.mixed(docs).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w"))).alias("n")).collect()}
    assert out == {s: r["taken"] for s, r in by.items() if r["taken"]}


def test_ranks_number_the_rows_of_a_key(spark):
    rows = spark.range(100).select(F.when(F.col("id") < 60, 1).when(F.col("id") < 63, 2).otherwise(F.col("id")).cast("long").alias("key"), F.col("id").alias("row"))
    repeated = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    ranks = {}
    for r in mixing.ranked(rows, repeated).collect():
        ranks.setdefault((r["key"], r["n"]), []).append(r["rank"])
    assert len(ranks) == 39 and all(sorted(x) == list(range(n)) for (_, n), x in ranks.items())


def test_mix_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = mixing.plan(docs)
    assert got.count() == len(rows) and {r["size"] for r in got.filter("doc_id IN (2, 3, 4)").collect()} == {0}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == got.agg(F.sum("copies")).first()[0] and out.filter("doc_id IN (2, 3, 4)").count() == 0
    assert mixing.plan(empty(spark)).count() == mixing.mixed(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.plan(docs, max_sources=2)


def check_packing(rows, words, lengths):
    """Every word once, bins in order without gaps or overflow, the smallest length that holds each bin."""
    whole, bins = {}, {}
    for r in rows:
        whole.setdefault(r["doc_id"], []).append((r["start"], r["n_words"]))
        if r["bin"] is not None:
            bins.setdefault(r["bin"], []).append((r["offset"], r["n_words"], r["capacity"]))
    for d, n in words.items():
        at = 0
        for start, size in sorted(whole[d]):
            assert start == at
            at += size
        assert at == n
    for parts in bins.values():
        at = 0
        for offset, size, _ in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert {c for *_, c in parts} == {min(x for x in lengths if x >= at)}
    return bins


def test_packing_query(spark, sf):
    words = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bins = check_packing(queries.op10_packing(spark, sf).collect(), words, packing.LENGTHS)
    assert sum(words.values()) / sum(p[0][2] for p in bins.values()) > 0.9


def plain_best_fit(sizes, lengths, least):
    """Best fit by looking at every open bin."""
    room, out = [], []
    for n in sizes:
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
            out.append(min(fits) - n)
        else:
            hold = [x for x in lengths if x >= n]
            r = min(hold, key=lambda x: (packing.cost(x) / x, x)) if least is None else next((x for x in hold if x >= least), hold[-1])
            room.append(r - n)
            out.append(r - n)
    return len(room), out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60), st.sampled_from([None, 10, 20, 40]))
def test_best_fit(sizes, least):
    falling, lengths = sorted(sizes, reverse=True), (10, 20, 40)
    bins, offsets, final, total = packing.best_fit(falling, lengths, least)
    assert len(final) == plain_best_fit(falling, lengths, least)[0] and total == sum(map(packing.cost, final))
    used = [sum(n for n, b in zip(falling, bins) if b == k) for k in range(len(final))]
    assert all(f == min(x for x in lengths if x >= u) for f, u in zip(final, used))
    got = packing.pack_shard(np.array(sizes), lengths)
    best = min(packing.best_fit(falling, lengths, x)[3] for x in (None, *lengths))
    assert sum(packing.cost(int(c)) for _, c in {(b, c) for b, c in zip(got[0], got[2])}) == pytest.approx(best)


def test_packing_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = packing.pack(docs, (16, 64, 1_000), 4).collect()
    assert sum(r["n_words"] for r in got) == sum(len((r[1] or "").encode().split()) for r in rows)
    assert {r["bin"] for r in got if r["doc_id"] in (2, 3, 4)} == {None} and sum(r["doc_id"] == 5 for r in got) == 90
    assert packing.pack(empty(spark)).count() == 0


def test_pipeline(spark, sf):
    p = importlib.import_module("corpus_pipeline")
    assert [n for n, _ in p.STAGES] == ["toxicity", "near_duplicates", "personal_data", "source_mix", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes, at = [docs.count()], docs
    for _, stage in p.STAGES[:-1]:
        at = stage(spark, at, sf).cache()
        sizes.append(at.count())
        assert at.schema.names == docs.schema.names
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    assert at.filter(F.col("text").rlike(r"@example\.com")).count() == 0
    out = p.run(spark, sf)
    assert out.agg(F.sum("n_words")).first()[0] == at.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]


def test_pipeline_stages_take_awkward_rows(spark, sf):
    p = importlib.import_module("corpus_pipeline")
    for docs in (awkward(spark)[0], empty(spark)):
        for _, stage in p.STAGES:
            out = stage(spark, docs, sf)
            out.count()
            docs = out
