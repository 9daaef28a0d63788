import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import awkward, brute_components, brute_fingerprint, empty
from tracewell.llm import simhash
from tracewell.llm.queries import op6_simhash


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBcÄß \t\n\x0b\x1c é", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_query_equals_brute_force(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {(d, f"{f:016x}", c) for d, f, c in brute_components([(d, brute_fingerprint(t)) for d, t in texts.items()])}
    assert {tuple(r) for r in op6_simhash(spark, sf).select("doc_id", "fingerprint", "component_id").collect()} == want
    assert len({c for _, _, c in want}) < len(want)


def near_prints(n=400, groups=6, seed=1):
    """Fingerprints in tight groups, so that links chain and cells crowd."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(groups)]
    out = set()
    for _ in range(n):
        f = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            f ^= 1 << b
        out.add(f)
    return sorted(out)


@pytest.mark.parametrize("dense", [1_000, 5])
@pytest.mark.parametrize("segments", [5, 6, 8])
def test_links_connect_what_brute_force_connects(spark, dense, segments):
    fps = near_prints()
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), segments=segments, dense=dense)
    found = {(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in edges.collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    if dense > len(fps):
        assert {frozenset(e) for e in found} == {frozenset((a, b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4}
    roots = {r["node"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in simhash.components(edges).collect()}
    want = brute_components(list(enumerate(fps)))
    assert Counter(Counter(roots.get(f, f) for f in fps).values()) == Counter(Counter(c for _, _, c in want).values())


def test_components_of_a_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    assert {(r["node"], r["root"]) for r in simhash.components(chain).collect()} == {(i, 0) for i in range(1, 61)} | {(101, 100), (102, 100)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bad_segments():
    with pytest.raises(ValueError):
        simhash.masks(4, 4)


def test_awkward_rows(spark):
    docs, rows = awkward(spark)
    want = Counter(brute_components([(r[0], brute_fingerprint(r[1])) for r in rows]))
    got = Counter((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 7]  # 3 and 4 go with 2, the copies with 1
    assert simhash.near_duplicates(empty(spark)).count() == simhash.keep_one(empty(spark)).count() == 0


def test_keepers_among_repeated_ids(spark):
    rows = [(3, "k l m n"), (3, "another text of words here"), (None, "q r s t u"), (None, "q r s t u"), (9, "k l m n")]
    kept = [tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(kept, key=str) == sorted([(3, "k l m n"), (3, "another text of words here"), (None, "q r s t u")], key=str)
