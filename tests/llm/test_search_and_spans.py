"""Operators 11 to 13: ranked search, fill-in-the-middle and repeated text, against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import fill_in_middle, ranked_search, suffix_array, suffix_dedup
from tracewell.llm.common import bitmap, marked, materialize, workspace

from .helpers import DOCS, awkward, empty


def brute_terms(text):
    out, word = [], []
    for c in (text or "") + " ":
        if ord(c) >= 0x80 or c.isdigit() and c < "\x80" or "a" <= c.lower() <= "z" and c < "\x80":
            word.append(c.lower() if c < "\x80" else c)
        elif word:
            out.append("".join(word))
            word = []
    return out


def brute_search(docs, items, k=20):
    held = [(d, Counter(t), len(t)) for d, t in ((d, brute_terms(x)) for d, x in docs) if t]
    n, total = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, size in held:
            m = 75 + 25 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in brute_terms(text) if t in c)
            if s > 0 and d is not None:
                found.append((-s, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def searched(docs, items, **options):
    return sorted((tuple(r) for r in ranked_search.search(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_ranked_search_of_awkward_tables(spark):
    docs, rows = awkward(spark)
    asked = [(1, "Plain TEXT words, text"), (1, "Plain TEXT words, text"), (2, None), (3, " -- "), (None, "id ñ"), (5, "nowhere"), (6, "word5 goes " * 40)]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("doc_id", F.lit(0))
    expected = brute_search([(r[0], r[1]) for r in rows], asked)
    assert expected and searched(docs, items) == expected
    assert searched(docs, items, chunk_items=2) == expected
    assert searched(empty(spark), items) == [] == searched(docs, items.limit(0))
    assert searched(docs.filter("text IS NULL"), items) == []


def test_ranked_search_of_many_ties_and_shards(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 8)
    r = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    texts = [(i, " ".join(r.choices(words, k=r.randrange(1, 12)))) for i in range(300)] + [(1000 + i, "w1 w2 w2") for i in range(150)]
    r.shuffle(texts)
    asked = [(i, " ".join(r.choices(words, k=5))) for i in range(12)] + [(50, "w2")]
    docs, items = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(asked, "item_id long, text string")
    assert searched(docs, items) == brute_search(texts, asked)


def test_bisection_lowers_the_cost_and_parts_topics():
    r = np.random.default_rng(3)
    lists = [np.unique(r.integers(0, 20, 6) + 20 * (i % 2)) for i in range(80)]
    right, costs = ranked_search.bisect(lists, 40)
    assert right.sum() == 40 and costs[-1] < costs[0]
    assert len({bool(x) for x in right[::2]}) == 1 == len({bool(x) for x in right[1::2]})
    weights, cuts = ranked_search.fit(lists, 40, depth=2)
    leaf = ranked_search.clusters_of(np.concatenate(lists), np.array([len(x) for x in lists]), weights, cuts)
    assert set(leaf[::2] // 2).isdisjoint(leaf[1::2] // 2) and leaf.min() >= 0 and leaf.max() < 4


def test_ranked_search_leaves_out_shards_below_the_floor(spark):
    """A shard without any of the item's terms, or with less than the floor, is never scored."""
    calls = []
    items = ranked_search._Items(["apple apple pear"])
    items.weigh({0: 1, 1: 2}, 10)
    assert items.bounds(np.array([1]), np.array([7])).tolist() == [7 * math.floor(1000 * math.log(22 / 5))]
    assert items.bounds(np.array([0]), np.array([3])).tolist() == [2 * 3 * math.floor(1000 * math.log(22 / 3))]
    assert items.bounds(np.array([], int), np.array([], int)).tolist() == [0] and not calls


def brute_fim(doc_id, text):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    lo, hi = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = text[:lo], text[lo:hi], text[hi:]
    form = "spm" if d % 100 < 20 else "psm"
    return n, form, lo, hi - lo, f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle(spark, monkeypatch):
    docs, rows = awkward(spark)
    r = random.Random(2)
    more = [(100 + i, "".join(r.choices("ab<>PSM\n\0é👍 ", k=r.randrange(0, 40))), None, None, None) for i in range(300)]
    more += [(500, "<<P<S<M", None, None, None), (501, "x<S>y", None, None, None), (502, "S>P>M>", None, None, None)]
    monkeypatch.setattr(fill_in_middle, "SLICE", 500)
    docs = docs.select(*DOCS.replace(" long", "").replace(" string", "").split(", ")).unionByName(spark.createDataFrame(more, DOCS))
    got = fill_in_middle.transform(docs).collect()
    expected = {(d, t): brute_fim(d, t) for d, t, *_ in rows + more}
    assert len(got) == len(rows) + len(more)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert sorted((str(x.doc_id), x.n, x.form, str(x.prefix_chars), str(x.middle_chars), x.output_sha256, x.restored_sha256) for x in got) == sorted(
        (str(d), n, f, str(a), str(m), sha(o), sha(t or "")) for d, t, *_ in rows + more for n, f, a, m, o in [expected[d, t]]
    )
    assert all(x.restored in {t or "" for _, t, *_ in rows + more} for x in got)
    assert {x.form for x in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(empty(spark)).count() == 0


def brute_repeats(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    met = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if met[r[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((len(r), int(gone.sum()), runs, np.frombuffer(r, np.uint8)[~gone].tobytes()))
    return out


def removed(docs, **options):
    got = suffix_dedup.remove_repeats(docs, **options).collect()
    return sorted(((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got))


def repeats_expected(rows):
    return sorted((str(r[0]), *x) for r, x in zip(rows, brute_repeats([r[1] for r in rows])))


def planted(seed=4, n=60):
    """Random texts with passages around 200 bytes in common, one of them common and among different neighbours."""
    r = random.Random(seed)
    fresh = lambda k: "".join(r.choices("abcdefgh éß", k=k))
    passages, line = [fresh(k) for k in (150, 190, 199, 200, 201, 260, 700)], fresh(140)
    rows = []
    for i in range(n):
        parts = [fresh(r.randrange(0, 300))]
        for _ in range(r.randrange(0, 3)):
            parts += [r.choice(passages), fresh(r.randrange(0, 60))]
        rows.append((i, "".join([*parts, line, fresh(90)])))
    rows += [(900, "ab" * 400), (901, "z" * 900), (902, passages[6]), (902, passages[6]), (903, None), (904, ""), (905, fresh(199)), (906, fresh(200)), (None, passages[5] + "\0" * 250)]
    return rows


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 4])
def test_repeated_text_against_brute_force(spark, crowd):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("key", F.lit(1)).withColumn("a", F.lit("x"))
    assert removed(docs, crowd=crowd) == repeats_expected(rows)


def test_repeated_text_of_awkward_tables_and_long_texts(spark, monkeypatch):
    docs, rows = awkward(spark)
    assert removed(docs) == repeats_expected(rows)
    assert removed(empty(spark)) == []
    r = random.Random(9)
    text = "".join(r.choices("abcdé", k=40_000))
    rows = [(1, text + text[5_000:5_400]), (2, text[20_000:20_230]), (3, text[:250])]
    long_ = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(long_) == repeats_expected(rows)
    spans = suffix_dedup.spans
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "SPAN", 1_000)  # spans of one text overlap so that each window lies in one
    batch = pa.record_batch({"text": pa.array(["", text, None, "short"])})
    seen = [(int(base[0] + w)) for data, row, base, starts, ends in spans(batch) for s, e in zip(starts, ends) if row[0] == 1 for w in range(e - s - 199)]
    assert seen == list(range(len(text.encode()) - 199))


def test_induced_sorting_and_common_prefixes():
    for seed in range(400):
        r = random.Random(seed)
        s = [r.randrange(1, r.choice((2, 3, 5, 30))) for _ in range(r.randrange(1, 70))]
        s = [*(s * 3 if seed % 3 == 0 else s), 0]
        assert suffix_array.order(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    for seed in range(150):
        r = random.Random(seed)
        length = r.choice((2, 3, 5))
        pieces = [bytes(r.choices((0, 97, 98, 99)[: r.choice((2, 3, 4))], k=r.randrange(length, 30))) for _ in range(r.randrange(1, 6))]
        twice = np.array([r.random() < 0.2 for _ in pieces])
        met = Counter()
        for p, t in zip(pieces, twice):
            for i in range(len(p) - length + 1):
                met[p[i : i + length]] += 2 if t else 1
        got = [[i for lo, hi in x for i in range(lo, hi + 1)] for x in suffix_array.repeated(pieces, twice, length)]
        assert got == [[i for i in range(len(p) - length + 1) if met[p[i : i + length]] > 1] for p in pieces]
    with pytest.raises(ValueError):
        suffix_array.order(np.append(np.ones(suffix_array.LIMIT), 0))


def test_halves_hold_every_window_once_with_its_anchor():
    r = random.Random(1)
    for _ in range(200):
        data = bytes(r.choices(range(256), k=r.randrange(200, 337)))
        gram = r.choice((64, 100, 132, 150, 190, 199))
        last = len(data) - 200
        off = r.randrange(last, 200 - gram + 1) if last <= 200 - gram else None
        if off is None:
            continue
        parts = suffix_dedup.halves(off, gram, data)
        assert [w for lo, hi, _, _ in parts for w in range(lo, hi + 1)] == list(range(last + 1))
        for lo, hi, at, size in parts:
            assert gram < size <= 200 and at <= off and at + size >= off + gram and lo <= hi
            assert all(w <= at and at + size <= w + 200 for w in range(lo, hi + 1))


def test_bitmap_marks_all_wanted(spark):
    keys = spark.range(5_000).select(F.xxhash64("id").alias("key"))
    bits = bitmap(F.col("key"), keys, 18).value
    own = np.array([r.key for r in keys.collect()])
    assert marked(bits, own, 18).all()
    assert marked(bits, np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 20_000), 18).mean() < 0.05


def test_workspaces_own_what_they_write(spark):
    kept = materialize(spark.range(5), "kept")
    with workspace(spark):
        outer = materialize(spark.range(7), "outer")
        with pytest.raises(ZeroDivisionError), workspace(spark):
            inner = materialize(spark.range(9), "inner")
            assert inner.count() == 9
            raise ZeroDivisionError
        with pytest.raises(Exception):
            inner.count()
        assert outer.count() == 7
    with pytest.raises(Exception):
        outer.count()
    assert kept.count() == 5
