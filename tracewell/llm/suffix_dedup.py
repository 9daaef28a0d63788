"""Removal of repeated text: every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else goes.

Strings are compared by suffix arrays of shards (``suffix_array``: induced sorting and permuted common prefixes). A shard
must hold all places that a string starts at, and not much else, so places are dealt by content:

1. Of the ``GRAM``-byte strings inside each window of LENGTH bytes, the one with the least hash is the window's anchor;
   equal windows have equal anchors. Anchors are counted (map-side combined); those met once end there.
2. Windows in a row with one anchor make a piece: its bytes, and the place of the anchor. Pieces with repeated
   anchors are written once; a bitmap of fixed size in each task tells them (wrong hits only add pieces).
3. Equal pieces are one row with a mark ``twice``, so a passage with a million copies enters one shard once.
4. An anchor with more than ``CROWD`` different pieces (a common line among different neighbours) doesn't go to one
   shard: its pieces are cut in two, windows that reach further left and windows that reach further right, whose
   anchors grow by half of what every such window must have on that side. An anchor of LENGTH bytes has one piece.
5. Pieces are dealt by anchor and sorted; each task reads them as a stream and builds the arrays of shards of some
   ``SHARD`` bytes. Runs of repeated places return by piece to the texts, each text's runs meet, and bytes are cut.

Texts without a hit are never shuffled. Windows never cross documents, as pieces end with them.

Edge cases: null texts count as empty; texts under LENGTH bytes stay whole; a text with a copy loses all its bytes, and
repeated rows are copies of one another, whatever their ids; null ids are kept; very long texts are cut into overlapping
spans, which changes no result; other columns are not read; empty tables give an empty result. Remaining bytes need not
be valid UTF-8, so ``kept`` is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, marked, materialize, sieve, text_edges, tidy
from .suffix_array import LIMIT, repeated

LENGTH, GRAM = 200, 64
#: Different pieces of an anchor that go to one shard, bytes of a shard, and bytes that are hashed at a time.
CROWD, SHARD, SPAN = 1_536, 1_000_000, 1 << 20
_PLACE = 21  # bits of a place in a span; the others order hashes
PIECE = "a long, b long, start long, rid long, key long, off int, gram int, p long, q long, bytes binary"


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each place on, by doubling."""
    x = np.ndarray((len(text) - 7,), "<u8", text.tobytes(), strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    width = 8
    while width < GRAM:
        x ^= x >> np.uint64(31)
        x = x[:-width] * np.uint64(0xD6E8FEB86659FD93) + x[width:]
        width *= 2
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ x >> np.uint64(29)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row, from prefix and suffix minima of blocks."""
    n = len(x)
    blocks = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    blocks[:n] = x
    blocks = blocks.reshape(-1, width)
    fore = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], fore[width - 1 : n])


def anchored(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, in bytes that hold the given spans: the span's number, the first and last window,
    the anchor's place and its hash."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(text) < LENGTH:
        return none
    hashes = gram_hashes(text)
    low = np.uint64((1 << _PLACE) - 1)
    least = _least(hashes & ~low | np.arange(len(hashes), dtype=np.uint64), LENGTH - GRAM + 1)
    long_ = ends - starts >= LENGTH
    step = np.zeros(len(least) + 1, np.int32)
    np.add.at(step, starts[long_], 1)
    np.add.at(step, ends[long_] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(step[:-1]) > 0)
    if not len(window):
        return none
    anchor = (least[window] & low).astype(np.int64)
    new = np.append(True, anchor[1:] != anchor[:-1])
    first = window[new]
    last = window[np.append(np.flatnonzero(new)[1:], len(window)) - 1]
    anchor = anchor[new]
    return np.searchsorted(starts, first, "right") - 1, first, last, anchor, hashes[anchor].view(np.int64)


def spans(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts of a batch, some SPAN bytes at a time: the bytes, and of each span in them its row, its place in the row's
    text, its start and its end. A text of more bytes is cut into spans that overlap by LENGTH - 1."""
    texts = batch.column("text")
    edges = text_edges(texts)
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + SPAN, "right")) - 1)
        if edges[to] - edges[at] <= SPAN:
            yield whole[edges[at] : edges[to]], np.arange(at, to), np.zeros(to - at, np.int64), edges[at:to] - edges[at], edges[at + 1 : to + 1] - edges[at]
        else:
            for lo in range(edges[at], edges[at + 1] - LENGTH + 1, SPAN - LENGTH + 1):
                hi = min(lo + SPAN, edges[at + 1])
                yield whole[lo:hi], np.array([at]), np.array([lo - edges[at]]), np.array([0]), np.array([hi - lo])
        at = to


def anchors(docs: DataFrame) -> DataFrame:
    """key, n: how often each anchor occurs in a batch."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, _, _, starts, ends in spans(b):
                key, n = np.unique(anchored(text, starts, ends)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int32))], ["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n int")


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (a, b, start, rid, key, off, gram, bytes) with the name of the bytes in two words."""
    names = np.array([divmod(xxhash.xxh3_128_intdigest(r[7]), 1 << 64) for r in rows], np.uint64).view(np.int64).reshape(-1, 2)
    a, b, start, rid, key, off, gram, data = zip(*rows)
    longs = [pa.array(c, pa.int64()) for c in (a, b, start, rid, key)]
    return pa.RecordBatch.from_arrays([*longs, pa.array(off, pa.int32()), pa.array(gram, pa.int32()), pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(data, pa.binary())], [c.split()[0] for c in PIECE.split(", ")])


def pieces(docs: DataFrame, repeats: Broadcast) -> DataFrame:
    """The pieces whose anchor the bitmap marks, of each row's text (named a, b); of a text that a task meets more than
    twice, those of the first two rows."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, met = repeats.value, {}
        for batch in batches:
            a, b, rid = (batch.column(c).to_numpy() for c in ("a", "b", "rid"))
            use = np.ones(len(a), bool)
            for i, name in enumerate(zip(a.tolist(), b.tolist())):
                met[name] = n = met.get(name, 0) + 1
                use[i] = n < 3
            for text, row, base, starts, ends in spans(batch):
                span, first, last, anchor, key = anchored(text, starts, ends)
                keep = np.flatnonzero(use[row[span]] & marked(wanted, key)) if len(span) else span
                if len(keep):
                    span, first, last, anchor, key = (x[keep] for x in (span, first, last, anchor, key))
                    r, raw = row[span], text.tobytes()
                    data = [raw[x : y + LENGTH] for x, y in zip(first.tolist(), last.tolist())]
                    start = base[span] + first - starts[span]
                    yield _piece_batch(list(zip(a[r].tolist(), b[r].tolist(), start.tolist(), rid[r].tolist(), key.tolist(), (anchor - first).tolist(), [GRAM] * len(r), data)))

    return docs.select("a", "b", "rid", "text").mapInArrow(run, PIECE)


def halves(off: int, gram: int, data: bytes) -> list[tuple[int, int, int, int]]:
    """Windows of a piece in two parts by their reach to the left of the anchor: (first window, last window, start of the
    longer anchor in the piece, its length). Every window of a part holds that part's anchor whole."""
    spare = LENGTH - gram
    left = (spare + 1) // 2
    right = spare - left + 1
    last = len(data) - LENGTH
    out = []
    if off - left >= 0:  # windows that start at off - left or before hold ``left`` more bytes before the anchor
        out.append((0, min(last, off - left), off - left, gram + left))
    if off - left + 1 <= last:  # the others hold ``right`` more after it
        out.append((max(0, off - left + 1), last, off, gram + right))
    return out


def halved(rows: DataFrame, crowded: Broadcast) -> DataFrame:
    """The pieces with crowded anchors in two parts each, by longer anchors."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = batch.filter(pa.array(marked(crowded.value, batch.column("key").to_numpy())))
            out = []
            for r in hit.to_pylist():
                for lo, hi, at, gram in halves(r["off"], r["gram"], r["bytes"]):
                    key = xxhash.xxh3_64_intdigest(r["bytes"][at : at + gram], gram)
                    out.append((r["a"], r["b"], r["start"] + lo, r["rid"], key - (key >> 63 << 64), at - lo, gram, r["bytes"][lo : hi + LENGTH]))
            if out:
                yield _piece_batch(out)

    return rows.mapInArrow(run, PIECE)


def without(distinct: DataFrame, crowded: Broadcast) -> DataFrame:
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(~marked(crowded.value, b.column("key").to_numpy())))

    return distinct.mapInArrow(run, distinct.schema)


def different(rows: DataFrame) -> DataFrame:
    """One row a piece: its anchor, its bytes, and whether it stands for two or more places."""
    place = F.struct("rid", "start")
    met = rows.groupBy("key", "p", "q").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.first("bytes").alias("bytes"))
    return met.select("key", "p", "q", (F.col("lo") != F.col("hi")).alias("twice"), "bytes")


def repeated_runs(distinct: DataFrame) -> DataFrame:
    """(p, q, lo, hi): runs of places in each piece whose strings repeat, by the suffix arrays of shards."""

    def shard(rows: list[tuple]) -> pa.RecordBatch | None:
        key, p, q, twice, data = zip(*rows)
        key, twice = np.array(key), np.array(twice)
        new = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(new) - 1
        alone = (np.bincount(group)[group] == 1) & ~twice
        use = np.flatnonzero(~alone)
        if not len(use):
            return None
        runs = repeated([data[i] for i in use], twice[use], LENGTH)
        flat = [(p[i], q[i], lo, hi) for i, found in zip(use, runs) for lo, hi in found]
        if not flat:
            return None
        p, q, lo, hi = zip(*flat)
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(q, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["p", "q", "lo", "hi"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1_024):
                part = batch.slice(at, 1_024)
                new = list(zip(*(part.column(c).to_pylist() for c in ("key", "p", "q", "twice", "bytes"))))
                rows += new
                size += sum(len(r[4]) + 1 for r in new)
                if size >= SHARD:
                    cut = next((i for i in range(len(rows) - 1, 0, -1) if rows[i][0] != rows[i - 1][0]), 0)
                    if cut:
                        if (found := shard(rows[:cut])) is not None:
                            yield found
                        rows = rows[cut:]
                        size = sum(len(r[4]) + 1 for r in rows)
        if rows and (found := shard(rows)) is not None:
            yield found

    dealt = distinct.repartition("key").sortWithinPartitions("key", "p", "q")
    return dealt.mapInArrow(run, "p long, q long, lo long, hi long")


def named(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and its name in two words."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b"))


def removable(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b, runs): for each named text that loses bytes, its [lo, hi) of repeated bytes, in no order and overlapping."""
    often = anchors(docs).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    mask = bitmap(F.col("key"), often)
    rows = materialize(pieces(docs.withColumn("rid", F.monotonically_increasing_id()), mask), "suffix-pieces")
    mask.destroy()
    found, places = [], []
    while True:
        distinct = materialize(different(rows), "suffix-distinct")
        places.append(rows)
        heavy = materialize(distinct.groupBy("key").count().filter(F.col("count") > crowd).select("key"), "suffix-crowded")
        if heavy.isEmpty():
            found.append(distinct)
            break
        mask = bitmap(F.col("key"), heavy)
        found.append(without(distinct, mask))
        rows = materialize(halved(rows, mask), "suffix-pieces")
    runs = repeated_runs(_union(found))
    at = _union([p.select("a", "b", "start", "p", "q") for p in places]).distinct()
    met = at.join(runs, ["p", "q"]).select("a", "b", F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + LENGTH).alias("hi")).alias("run"))
    return materialize(met.groupBy("a", "b").agg(F.collect_list("run").alias("runs")), "suffix-runs")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def merged(runs: np.ndarray) -> np.ndarray:
    """Overlapping or touching [lo, hi) as the fewest ones."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    top = np.maximum.accumulate(runs[:, 1])
    new = np.append(True, runs[1:, 0] > top[:-1])
    return np.column_stack([runs[new, 0], top[np.append(np.flatnonzero(new)[1:], len(runs)) - 1]])


def _cut(rows: DataFrame) -> DataFrame:
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                b = batch.slice(at, 64)
                out = []
                for text, runs in zip(b.column("text").to_pylist(), b.column("runs")):
                    raw = text.encode()
                    if not runs.is_valid:
                        out.append((len(raw), 0, 0, raw))
                        continue
                    ends = merged(np.column_stack([runs.values.field(c).to_numpy() for c in ("lo", "hi")]))
                    keep = np.ones(len(raw), bool)
                    for lo, hi in ends.tolist():
                        keep[lo:hi] = False
                    out.append((len(raw), int(len(raw) - keep.sum()), len(ends), np.frombuffer(raw, np.uint8)[keep].tobytes()))
                n, gone, count, kept = zip(*out)
                longs = [pa.array(c, pa.int64()) for c in (n, gone, count)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *longs, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select("doc_id", "text", "runs").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes, a row a document."""
    if crowd * (2 * LENGTH - GRAM + 1) + SHARD + (1 << 19) >= LIMIT:
        raise ValueError("the pieces of an anchor must fit in a shard")
    rows = named(docs)
    runs = removable(rows, crowd)
    sifted = sieve(rows, runs.select(F.col("a").alias("key")), "a")
    whole = sifted.filter("NOT __hit").select("doc_id", _size(F.col("text")).alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return whole.unionByName(_cut(sifted.filter("__hit").select("doc_id", "text", "a", "b").join(runs, ["a", "b"], "left")))


def _size(text: Column) -> Column:
    return F.octet_length(text).cast("long")
