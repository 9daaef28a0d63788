"""The pipeline's near-duplicate stage against exact similarities."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm.helpers import awkward, empty
from tracewell.llm import simhash_wide


def grams(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_keepers(rows):
    """Smallest id of each component of rows (id, text) with a similarity of 0.8 or more."""
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[find(i)][0] for i in range(len(rows))}


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.randrange(10**6)}"
    return out


def corpus():
    """Chains of edited copies with similarities on both sides of 0.8, one large group, and texts by themselves."""
    rng, texts = random.Random(7), []
    for _ in range(25):
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        texts += [base, edited(rng, base, 2), edited(rng, base, 3), edited(rng, base, 4), edited(rng, base, 6)]
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts += [edited(rng, base, rng.randrange(5)) for _ in range(80)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("hot,block", [(1_024, 256), (16, 4)])
def test_stage_keeps_one_of_each_group_of_similar_texts(spark, hot, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash_wide.keep_one(docs, hot=hot, block=block)
    assert {r["doc_id"] for r in kept.collect()} == brute_keepers(rows)


def test_stage_drops_a_copy_at_the_threshold(spark, sf):
    words = [f"w{i}" for i in range(94)]
    near = words[:30] + ["x"] + words[31:60] + ["y"] + words[61:]  # 80 of 100 shingles
    far = words[:30] + ["x"] + words[31:60] + ["y"] + words[61:80] + ["z"] + words[81:]
    rows = [(1, " ".join(words)), (2, " ".join(near))]
    assert len(grams(rows[0][1]) & grams(rows[1][1])) * 5 == 4 * len(grams(rows[0][1]) | grams(rows[1][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()] == [1]
    docs = spark.createDataFrame([rows[0], (2, " ".join(far))], "doc_id long, text string")
    assert corpus_pipeline.drop_near_duplicates(spark, docs, sf).count() == 2


def test_awkward_rows(spark):
    docs, _ = awkward(spark)
    kept = simhash_wide.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 7]
    assert simhash_wide.keep_one(empty(spark)).count() == 0


def test_recall_and_precision_on_whole_documents(spark, sf):
    """Every pair of documents with a similarity of 0.8 or more, by brute force over all pairs that share a shingle."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/../sf0.01/documents.parquet").collect()}
    sets, holders = {d: grams(t) for d, t in texts.items()}, {}
    for d, g in sets.items():
        for x in g:
            holders.setdefault(x, []).append(d)
    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[i + 1 :] if sets[a] != sets[b]}
    want = {frozenset(p) for p in pairs if 5 * len(sets[p[0]] & sets[p[1]]) >= 4 * len(sets[p[0]] | sets[p[1]])}
    docs = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet")
    of = {r["doc_id"]: r["component_id"] for r in simhash_wide.near_copies(docs).collect()}
    assert len(want) >= 10 and sum(of[a] == of[b] for a, b in map(tuple, want)) >= 0.9 * len(want)
    root = {d: d for d in texts}  # precision: no component joins documents that exact links don't connect

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in [tuple(p) for p in want] + [(a, b) for h in holders.values() for a, b in zip(h, h[1:]) if sets[a] == sets[b]]:
        root[find(b)] = find(a)
    exact = {}
    for d in texts:
        exact.setdefault(of[d], set()).add(find(d))
    assert all(len(x) == 1 for x in exact.values())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.integers(0, 2**32))
def test_parts_against_brute_force(centres, seed):
    rng = random.Random(seed)
    words = []
    for _ in range(25):
        w = [rng.choice(centres), rng.choice(centres)]
        for _ in range(rng.randint(0, 30)):
            w[rng.randint(0, 1)] ^= 1 << rng.randrange(64)
        words.append(w)
    part, up = simhash_wide.parts_of(*np.array(words, np.uint64).T)
    near = lambda i, j: sum((a ^ b).bit_count() for a, b in zip(words[i], words[j])) <= simhash_wide.NEAR
    root = list(range(25))
    for _ in range(25):
        root = [min(root[j] for j in range(25) if near(i, j)) for i in range(25)]
    assert part.tolist() == root and all(u == i or near(i, u) and part[u] == part[i] for i, u in enumerate(up.tolist()))


def test_tables_bring_pairs_at_the_threshold_together(spark):
    rng = np.random.default_rng(4)
    rows, pairs = [], 400
    for i in range(pairs):
        own = rng.integers(0, 2**63, 200 + 25, dtype=np.uint64)
        for j, h in enumerate((own[:200], own[25:])):  # 175 of 225 in common
            rows.append((2 * i + j, np.unique(h)))
    near = [len(np.intersect1d(rows[2 * i][1], rows[2 * i + 1][1])) / len(np.union1d(rows[2 * i][1], rows[2 * i + 1][1])) for i in range(pairs)]
    assert 0.77 < min(near) <= max(near) < 0.79  # a little below the threshold, so what follows is a lower bound
    df = spark.createDataFrame([(i, len(h), bytearray(simhash_wide.fingerprint(h).tobytes())) for i, h in rows], "fp long, n int, print binary")
    bits, tables = simhash_wide.tables_for(1_000_000)
    cells = {}
    for r in simhash_wide.pivot_tables(df, bits, tables).collect():
        cells.setdefault(r["cell"], set()).add(r["fp"])
    met = {frozenset(x) for c in cells.values() for x in [(a, b) for a in c for b in c if a < b]}
    assert sum(frozenset((2 * i, 2 * i + 1)) in met for i in range(pairs)) >= 0.9 * pairs
    assert len(met) < 0.1 * len(rows) ** 2  # of all 319,600 pairs
