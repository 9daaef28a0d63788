"""SimHash near-duplicates by pivot distance tables.

Every document gets a 64-bit SimHash of its word shingles. Fingerprints that differ in at most ``radius`` bits
are linked, and a document's component is named by the smallest ``doc_id`` that links reach.

Pairs come from pivot tables, which hold Hamming distances to fixed reference fingerprints:

1. *Masked tables.* The 64 bits are cut into ``segments`` parts. If ``radius`` bits differ, at least
   ``segments - radius`` parts agree, so for some choice of that many parts the two fingerprints have equal
   distances to every reference, each distance taken over those parts alone (a coordinate difference of
   zero). An equi-join on the packed masked distances hence finds each linked pair.
2. *Full table.* A pair whose distances to any of the whole references differ by more than ``radius`` can't be
   linked (triangle inequality) and is discarded.
3. The survivors are verified on the fingerprints themselves.

Only distinct fingerprints are joined, so exact copies cost one row. A cell with over ``dense`` members is cut
into blocks, and pairs of blocks are compared in separate tasks that return a spanning forest, never all pairs.

Edge cases: null and empty texts, and texts of white space, get fingerprint zero and link like any other;
texts of fewer words than a shingle are one shingle; repeated rows keep one row each in ``near_duplicates`` and
one in all in ``keep_one``; a null ``doc_id`` gets a row, takes part in links, but never names a component (a
component of nulls alone has a null name); an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, sieve, small, texts_of, tidy

SHINGLE, RADIUS, SEED = 4, 4, 42
SEGMENTS, DENSE = 6, 1_000
#: References of a masked table (five bits a distance, so twelve fill a long) and of the full table (eight bits).
MASKED_PIVOTS, FULL_PIVOTS = 12, 8
_CHUNK = 65_536


def pivot(k: int) -> int:
    """The k-th reference fingerprint, by the splitmix64 rule."""
    m = (1 << 64) - 1
    z = (k + 1) * 0x9E3779B97F4A7C15 & m
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & m
    z = (z ^ z >> 27) * 0x94D049BB133111EB & m
    return z ^ z >> 31


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        hashes = np.array([digest(b" ".join(words[i : i + shingle]), SEED) for i in range(at, min(n, at + _CHUNK))], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def row_key(docs: DataFrame) -> Column:
    """Two hashes, 128 bits, that name a row by its id and whole text."""
    doc_id, text = docs["doc_id"].cast("long"), docs["text"]
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(F.lit("b"), text, doc_id).alias("b"))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row key and the fingerprint as a (signed) long, one row per row of ``docs``."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            fp = np.array([fingerprint(t, shingle) for t in texts_of(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(fp)], ["doc_id", "key", "fp"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("key"), docs["text"].alias("text")).mapInArrow(run, "doc_id long, key struct<a:long,b:long>, fp long")


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def _distance(fp: Column, k: int, mask: int | None = None) -> Column:
    x = fp.bitwiseXOR(_signed(pivot(k)))
    return F.bit_count(x if mask is None else x.bitwiseAND(_signed(mask))).cast("long")


def _packed(distances: list[Column], bits: int) -> Column:
    out = distances[0]
    for k, d in enumerate(distances[1:], 1):
        out = out.bitwiseOR(F.shiftleft(d, bits * k))
    return out


def masks(radius: int = RADIUS, segments: int = SEGMENTS) -> list[int]:
    """Bit masks of every choice of parts of which one must agree between fingerprints within the radius."""
    if not radius < segments <= 64:
        raise ValueError("segments must exceed the radius and be at most 64")
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(parts, segments - radius)]


def pivot_tables(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """(cell, fp, coords) of distinct fingerprints: ``cell`` names a choice of parts and the masked distances,
    ``coords`` packs the distances to the whole references."""
    fp = F.col("fp")
    chosen = masks(radius, segments)
    bits = max(m.bit_count() for m in chosen).bit_length()
    cells = [F.struct(F.lit(i).alias("mask"), _packed([_distance(fp, k, m) for k in range(min(MASKED_PIVOTS, 63 // bits))], bits).alias("key")) for i, m in enumerate(chosen)]
    full = _packed([_distance(fp, 100 + k) for k in range(FULL_PIVOTS)], 8)
    return prints.select("fp", full.alias("coords"), F.inline(F.array(*cells))).select("mask", "key", "fp", "coords")


def _within(a: Column, b: Column, radius: int) -> Column:
    """No coordinate of two packed tables differs by more than the radius."""
    at = lambda c, k: F.shiftright(c, 8 * k).bitwiseAND(F.lit(255))
    ok = F.lit(True)
    for k in range(FULL_PIVOTS):
        ok &= F.abs(at(a, k) - at(b, k)) <= radius
    return ok


def _forest_of(n: int, left: Iterable[int], near: Callable[[int], Iterable[int]]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links from each of ``left`` to what is near it, among n members."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in left:
        for j in near(i):
            if (a := find(int(i))) != (b := find(int(j))):
                root[max(a, b)] = min(a, b)
                out.append((int(i), int(j)))
    return out


def _forest(fp: np.ndarray, coords: np.ndarray, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between the two sides (within one side if there is no other)."""
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    tables = coords.view(np.uint8).reshape(len(fp), 8).astype(np.int16)

    def near(i: int) -> np.ndarray:
        close = right[np.abs(tables[right] - tables[i]).max(1) <= radius]
        return close[np.bitwise_count(fp[close] ^ fp[i]) <= radius]

    return _forest_of(len(fp), left, near)


def links(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are within the radius. From cells of at
    most ``dense`` members come all links, from larger cells a spanning forest for each pair of blocks."""
    cells = pivot_tables(prints, radius, segments)
    crowded = materialize(cells.groupBy("mask", "key").count().filter(F.col("count") > dense), "simhash-crowded")
    sparse = cells.join(crowded.drop("count"), ["mask", "key"], "left_anti")
    a, b = sparse.alias("a"), sparse.alias("b")
    near = (F.col("a.fp") < F.col("b.fp")) & _within(F.col("a.coords"), F.col("b.coords"), radius) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius)
    plain = a.join(b, (F.col("a.mask") == F.col("b.mask")) & (F.col("a.key") == F.col("b.key")) & near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    blocks = F.ceil(F.col("count") / dense).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    met = (
        cells.join(crowded, ["mask", "key"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("mask", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "coords")
    )

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        fp = g["fp"].to_numpy(np.int64).view(np.uint64)
        if (g["lo"].iat[0] != g["hi"].iat[0]) and g["side"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        pairs = _forest(fp, np.ascontiguousarray(g["coords"].to_numpy(np.int64)), g["side"].to_numpy(), radius)
        signed = fp.view(np.int64)
        return pd.DataFrame({"a": [signed[i] for i, _ in pairs], "b": [signed[j] for _, j in pairs]}, dtype="int64")

    return plain.unionByName(met.groupBy("mask", "key", "lo", "hi").applyInPandas(compare, "a long, b long")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the smallest node that it reaches.

    Alternates the large-star and small-star steps, each a minimum by node (combined before the shuffle) and a
    join that Spark can split where a node has many edges, until the edges are stars and no longer change.
    """

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not larger:
            both = both.filter("b < a")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        met = both.join(least, "a")
        if larger:
            return met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        return met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())

    edges = materialize(edges.select("a", "b").filter("a <> b"), "components")
    before = state(edges)
    for _ in range(most_rounds if before[0] else 0):
        edges = materialize(star(star(edges, True), False), "components")
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components: the stars did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """doc_id, key, fp (long), component_id and keeper_key for every row of ``docs``. The keeper of a component is its
    row with the smallest doc_id (null last) and, of rows with the same id and different texts, the smallest key."""
    prints = materialize(fingerprints(docs, shingle), "simhash-prints")
    return name_components(prints, lambda distinct: links(distinct.select("fp"), radius, segments, dense))


def name_components(prints: DataFrame, linked: Callable[[DataFrame], DataFrame], *same: str) -> DataFrame:
    """What ``near_duplicates`` returns, for rows with doc_id, key and fp. ``linked`` takes the distinct fp, with their
    first row and the columns that are the ``same`` for equal fp, to links (a, b)."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id"), "key")
    distinct = materialize(prints.groupBy("fp").agg(F.min(first).alias("first"), *[F.first(c).alias(c) for c in same]), "simhash-distinct")
    roots = components(linked(distinct))
    mapped = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    mapped = materialize(mapped, "simhash-roots")
    named = mapped.groupBy("root").agg(F.min("first").alias("keeper"))
    of_print = mapped.select("fp", "root").join(named, "root").select("fp", "keeper")
    component = F.when(~F.col("keeper.none"), F.col("keeper.id"))
    return prints.join(of_print, "fp").select("doc_id", "key", "fp", component.alias("component_id"), F.col("keeper.key").alias("keeper_key"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The keeper of each component, with the columns of ``docs``; of equal rows, one.

    Keepers that are the only row of their key pass without a shuffle of their text: a sieve of fixed size tells
    them from the doubtful keys (other rows, and keepers with equal rows). Only what it holds back, the doubtful and
    a few that share their bit, is joined exactly.
    """
    return keep(docs, near_duplicates(docs, **options))


def keep(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are keepers by ``found``."""
    by_key = found.groupBy("key").agg(F.count("*").alias("n"), F.max(F.col("key") == F.col("keeper_key")).alias("keeper"))
    doubtful = materialize(by_key.filter("n > 1 OR NOT keeper"), "simhash-doubtful")
    own = [docs[c] for c in docs.columns]
    rows = sieve(docs.select(F.struct(*own).alias("__row"), row_key(docs).alias("__key")), doubtful, "__key")
    held = rows.filter("__hit").join(doubtful, F.col("__key") == F.col("key"), "left").filter("key IS NULL OR keeper")
    once = held.filter("key IS NULL").select("__row").unionByName(held.filter("keeper").groupBy("__key").agg(F.first("__row").alias("__row")).select("__row"))
    return rows.filter("NOT __hit").select("__row").unionByName(once).select("__row.*")
