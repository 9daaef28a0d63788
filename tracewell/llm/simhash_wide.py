"""SimHash near-duplicates at a wide radius: rows whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The SimHash of a set has ``BITS`` bits; two sets at the threshold differ in 15 % of them on average, too many for a
radius that some choice of parts must leave alone (``simhash``). So the pivot tables here hold distances over random
choices of few bits: a table of b bits, in which a coordinate difference of zero to all references is asked for,
brings a pair at the threshold together with a probability of 0.849^b. The choice of b follows the number of rows, so
that unrelated rows meet ``CELL`` others a table on average, and the number of tables follows from b, so that a pair
at the threshold meets in some table with a probability of ``RECALL``; pairs that are more similar are missed far less.
Of the rows that meet, those whose first 128 bits differ by more than ``NEAR`` are discarded as pairs (of pairs at the
threshold one in 70,000 is), and the survivors are verified: two sets are linked only if their exact similarity, from
their shingle hashes, reaches the threshold.

Rows with equal sets count once. A cell is read as a sorted stream; its members that are near one another, directly or
through others, form a part, and the edges of a spanning forest of each part are verified first. Members that verified
links connect with the part's first member are done; the others are compared with all members of their part, block by
block in separate tasks, by exact similarity, which return a spanning forest. So links connect all that the cells
bring together, and no cell makes rows by the square. Cells of over about ``HOT`` members, as a sample of the rows
tells, are one part with their first member as the root of the forest, so that no task meets a whole one.

Edge cases: words, null, empty and short texts, repeated rows and null ids are as in ``simhash``; empty texts
are copies of one another.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, marked, materialize, sieve, small, texts_of, tidy
from .simhash import _forest_of, components, keep, name_components, pivot, row_key

SHINGLE, SEED = 5, 42
#: Words of 64 bits of a fingerprint, and references of a table (distances of up to 31 take five bits, twelve fill a long).
WORDS, PIVOTS = 8, 12
BITS = 64 * WORDS
#: Mean number of unrelated rows in a cell, chance that a pair at the threshold meets, and bits of the first two words
#: that may differ.
CELL, RECALL, NEAR = 64, 0.985, 36
#: Members of a cell that is split, the share of the rows (one in so many) that tells, and members of a block.
HOT, SAMPLE, BLOCK = 1_024, 16, 256
_CHUNK = 512


def shingles(text: str) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; at least one."""
    words, digest = text.encode("utf-8", "surrogatepass").lower().split(), xxhash.xxh64_intdigest
    n = max(1, len(words) - SHINGLE + 1)
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(n)), np.uint64, n))


def set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The WORDS words of a set's SimHash: each bit is 1 if set in over half of the hashes, mixed anew for each word."""
    factors = np.array([pivot(2_000 + k) | 1 for k in range(WORDS)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        x = hashes[at : at + _CHUNK, None] * factors
        x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        ones += np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def tables_for(rows: int) -> tuple[int, int]:
    """Bits of a table, and number of tables, for so many rows."""
    bits = min(31, max(8, math.ceil(math.log2(max(rows, 2) / CELL))))
    agree = 1 - math.acos(2 * 0.8 / 1.8) / math.pi
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - agree**bits))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row key, fp (the id of the set), n (its size) and print (its fingerprint) of every row."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            sets = [shingles(t) for t in texts_of(b)]
            fps = pa.array(np.array([set_id(h) for h in sets], np.uint64).view(np.int64))
            prints = pa.array([fingerprint(h).tobytes() for h in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), fps, pa.array([len(h) for h in sets], pa.int32()), prints], ["doc_id", "key", "fp", "n", "print"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("key"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, key struct<a:long,b:long>, fp long, n int, print binary")


def pivot_tables(distinct: DataFrame, bits: int, tables: int, crowded: Broadcast | None = None, hot: bool = False) -> DataFrame:
    """(cell, fp, w0, w1) for every set and table: ``cell`` names the table and the distances, over its bits, to the
    references; w0 and w1 are the first two words of the fingerprint. With a bitmap of crowded cells, only the rows in
    cells that it marks (``hot``) or doesn't mark."""
    rng = np.random.default_rng(SEED)
    masks = np.array([rng.permutation(BITS) < bits for _ in range(tables)])  # of each table, the bits it looks at
    refs = rng.random((tables, PIVOTS, BITS)) < 0.5
    # over a mask the distance to a reference r is the sum of r, plus that of (1 - 2r) x
    steep = (np.where(refs, -1.0, 1.0) * masks[:, None, :]).reshape(-1, BITS).T.astype(np.float32)
    base = (refs & masks[:, None, :]).sum(2).reshape(-1).astype(np.float32)
    salt = np.array([pivot(3_000 + t) for t in range(tables)], np.uint64)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 256):
            raw = np.frombuffer(b"".join(b.column("print").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            x = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            far = (x @ steep + base).astype(np.int64).reshape(-1, tables, PIVOTS)
            cells = ((far << (5 * np.arange(PIVOTS))).sum(2).view(np.uint64) ^ salt) * np.uint64(0x9E3779B97F4A7C15)
            cells = (cells ^ cells >> np.uint64(32)).reshape(-1).view(np.int64)
            words = raw.view("<u8")[:, :2].view(np.int64)
            at = np.arange(len(cells)) if crowded is None else np.flatnonzero(marked(crowded.value, cells) == hot)
            if len(at):
                owner = at // tables
                columns = cells[at], b.column("fp").to_numpy()[owner], words[owner, 0], words[owner, 1]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "fp", "w0", "w1"])

    return distinct.select("fp", "print").mapInArrow(run, "cell long, fp long, w0 long, w1 long")


def _far(w0: np.ndarray, w1: np.ndarray, i: int) -> np.ndarray:
    """Bits by which member i differs from all, in two words."""
    return np.bitwise_count(w0 ^ w0[i]).astype(np.int16) + np.bitwise_count(w1 ^ w1[i])


def parts_of(w0: np.ndarray, w1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For members of a cell: the first member of each one's part, and the member from which it was reached (its own
    place for the first)."""
    n = len(w0)
    part, up = np.full(n, -1), np.arange(n)
    if n <= HOT:  # most members of most cells are alone, which one comparison of all with all tells
        far = np.bitwise_count(w0[:, None] ^ w0).astype(np.int16) + np.bitwise_count(w1[:, None] ^ w1)
        alone = (far <= NEAR).sum(1) == 1
        part[alone] = up[alone]
    for first in range(n):
        if part[first] >= 0:
            continue
        part[first], todo = first, deque([first])
        while todo:
            i = todo.popleft()
            new = np.flatnonzero((part < 0) & (_far(w0, w1, i) <= NEAR))
            part[new], up[new] = first, i
            todo.extend(new.tolist())
    return part, up


def met_in_cells(cells: DataFrame) -> DataFrame:
    """(cell, part, fp, w0, w1, up) of the members of parts of two or more: ``part`` is the fp of the first member, ``up``
    that of the one it was reached from (null for the first)."""

    def part(group: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...] | None:
        cell, fp, w0, w1 = (np.concatenate(c) for c in zip(*group))
        if len(fp) < 2:
            return None
        of, up = parts_of(w0.view(np.uint64), w1.view(np.uint64))
        keep = np.bincount(of, minlength=len(of))[of] > 1
        return tuple(c[keep] for c in (cell, fp[of], fp, w0, w1, fp[up]))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple[np.ndarray, ...]] = []

        def batch(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            cell, part_fp, fp, w0, w1, up = (np.concatenate(c) for c in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(part_fp), pa.array(fp), pa.array(w0), pa.array(w1), pa.array(up, mask=up == fp)], ["cell", "part", "fp", "w0", "w1", "up"])

        for b in batches:
            columns = [b.column(n).to_numpy() for n in ("cell", "fp", "w0", "w1")]
            edges = [0, *(np.flatnonzero(np.diff(columns[0])) + 1).tolist(), b.num_rows]
            found = []
            for lo, hi in zip(edges, edges[1:]):
                piece = tuple(c[lo:hi] for c in columns)
                if open_ and hi > lo and open_[0][0][0] != piece[0][0]:
                    found += [x for x in (part(open_),) if x is not None]
                    open_ = []
                if hi > lo:
                    open_.append(piece)
            if found:
                yield batch(found)
        if open_ and (x := part(open_)) is not None:
            yield batch([x])

    return cells.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(run, "cell long, part long, fp long, w0 long, w1 long, up long")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """fp and hashes of the rows with the wanted keys (and of a few that share their bit of the sieve), once a set."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 64):
            sets = [shingles(t) for t in texts_of(b)]
            fps = pa.array(np.array([set_id(h) for h in sets], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([fps, pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))], ["fp", "hashes"])

    rows = sieve(docs.select(docs["text"].alias("text"), row_key(docs).alias("__key")), wanted, "__key").filter("__hit").select("text")
    return rows.mapInArrow(run, "fp long, hashes array<long>").dropDuplicates(["fp"])


def _similar(inter: Column | np.ndarray, a: Column | np.ndarray, b: Column | np.ndarray) -> Column | np.ndarray:
    """Jaccard of at least 4/5, in integers."""
    return 5 * inter >= 4 * (a + b - inter)


def _compare(g: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the links between two blocks, or within one."""
    fp, sizes = g["fp"].to_numpy(np.int64), np.array([len(h) for h in g["hashes"]])
    one = g["lo"].iat[0] == g["hi"].iat[0]
    right = np.arange(len(g)) if one else np.flatnonzero(g["side"].to_numpy() == 1)
    left = right if one else np.flatnonzero(g["side"].to_numpy() == 0)
    pairs: list[tuple[int, int]] = []
    if len(left) and len(right):
        _, ids = np.unique(np.concatenate(g["hashes"].to_list()), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        met = np.concatenate([ids[starts[j] : starts[j] + sizes[j]] for j in right])
        at, mark = np.cumsum(sizes[right]) - sizes[right], np.zeros(len(ids), np.int64)

        def near(i: int) -> np.ndarray:
            own = ids[starts[i] : starts[i] + sizes[i]]
            mark[own] = 1
            inter = np.add.reduceat(mark[met], at)
            mark[own] = 0
            return right[_similar(inter, sizes[i], sizes[right])]

        pairs = _forest_of(len(g), left, near)
    return pd.DataFrame({"a": [fp[i] for i, _ in pairs], "b": [fp[j] for _, j in pairs]}, dtype="int64")


def _meet(g: pd.DataFrame) -> pd.DataFrame:
    """The members of two blocks (or of one) that are near a member of the other."""
    w0, w1 = (g[c].to_numpy(np.int64).view(np.uint64) for c in ("w0", "w1"))
    one = g["lo"].iat[0] == g["hi"].iat[0]
    side = g["side"].to_numpy()
    met = np.zeros(len(g), bool)
    for i in range(len(g)) if one else np.flatnonzero(side == 0):
        near = (_far(w0, w1, i) <= NEAR) & (True if one else side == 1)
        near[i] = False
        met |= near
        met[i] |= near.any()
    return g.loc[met, ["cell", "part", "lo", "hi", "side", "fp"]]


def links(docs: DataFrame, distinct: DataFrame, rows: int, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(a, b): verified links between the sets of ``distinct`` that connect all that meet in cells."""
    bits, tables = tables_for(rows)
    some = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE)) == 0)
    crowded = bitmap(F.col("cell"), pivot_tables(some, bits, tables).groupBy("cell").count().filter(F.col("count") * SAMPLE >= hot))
    usual = met_in_cells(pivot_tables(distinct, bits, tables, crowded))
    held = materialize(pivot_tables(distinct, bits, tables, crowded, True), "wide-hot")
    first = held.groupBy("cell").agg(F.min("fp").alias("part"))
    split = held.join(first, "cell").withColumn("up", F.when(F.col("fp") != F.col("part"), F.col("part"))).select("cell", "part", "fp", "w0", "w1", "up")
    met = materialize(usual.unionByName(split), "wide-met")
    crowded.destroy()

    pairs = materialize(met.filter("up IS NOT NULL").select(F.least("fp", "up").alias("a"), F.greatest("fp", "up").alias("b")).distinct(), "wide-pairs")
    sets = materialize(shingle_sets(docs, distinct.join(met.select("fp").distinct(), "fp").select(F.col("first.key").alias("key"))), "wide-sets")
    x, y = (sets.select(F.col("fp").alias(c), F.col("hashes").alias(f"{c}_set")) for c in "ab")
    inter = F.size(F.array_intersect("a_set", "b_set"))
    found = pairs.join(x, "a").join(y, "b").filter(_similar(inter, F.size("a_set"), F.size("b_set"))).select("a", "b")
    found = materialize(found, "wide-links")

    on = ["cell", "part"]
    roots = materialize(components(found).distinct(), "wide-first-roots")
    own = met.join(roots, met.fp == roots.node, "left").select(*on, "fp", "w0", "w1", F.coalesce("root", "fp").alias("root"))
    of_first = own.filter("fp = part").select(*on, F.col("root").alias("first_root"))
    own = materialize(own.join(of_first, on).select(*on, "fp", "w0", "w1", (F.col("root") != F.col("first_root")).alias("apart")), "wide-apart")
    # a part of two has no pair but the verified one; of parts with the same members in several tables one is enough
    parts = own.groupBy(*on).agg(F.count_if("apart").alias("u"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("fp")).alias("members")).filter("u > 0 AND n > 2")
    parts = parts.groupBy("members", "n").agg(F.min(F.struct(*on, "u")).alias("p"))
    size = lambda x: F.ceil(x / block).cast("int")
    parts = parts.select("p.cell", "p.part", size(F.col("p.u")).alias("u"), size(F.col("n") - F.col("p.u")).alias("k"))
    place = lambda n: F.pmod(F.xxhash64("fp"), n).cast("int")
    blocks = own.join(parts, on).withColumn("own", F.when(F.col("apart"), place(F.col("u"))).otherwise(F.col("u") + place(F.col("k"))))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("apart"), F.col("u") + F.col("k")).otherwise(F.col("u")) - 1)))
    tasks = blocks.select(*on, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "w0", "w1")
    near = tasks.groupBy(*on, "lo", "hi").applyInPandas(_meet, "cell long, part long, lo int, hi int, side int, fp long")
    rest = near.join(sets, "fp").groupBy(*on, "lo", "hi").applyInPandas(_compare, "a long, b long")
    return found.unionByName(rest).distinct()


def near_copies(docs: DataFrame, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """doc_id, key, fp, component_id and keeper_key for every row, as ``simhash.near_duplicates`` gives them."""
    prints = materialize(signatures(docs), "wide-prints")
    return name_components(prints, lambda distinct: links(docs, distinct, prints.count(), hot, block), "n", "print")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The keeper of each component, with the columns of ``docs``; of equal rows, one."""
    return keep(docs, near_copies(docs, **options))
