"""Ranked lexical search: each item's K best documents by an integer relevance score, from a clustered index.

* **Order.** Recursive graph bisection on a sample of at most ``SAMPLE`` documents: a set of documents is halved, and
  documents change sides in pairs while that lowers the estimated cost of the terms' gaps; then each half in turn,
  ``DEPTH`` times. Each bisection leaves a weight a term, by which *every* document finds its side, and so its cluster.
* **Index.** Clusters are cut into shards of at most some ``SHARD_DOCS`` documents (a cluster of any size is many
  shards). A shard keeps its documents by place, with ``doc_id`` to map back, and for each term the places, the impacts
  and the largest impact. It holds the terms of the items at hand: others add nothing to any score.
* **Search.** An item's bound in a shard is its score if one document had each term's largest impact. The shards with
  the highest bounds are visited first; the K-th best score there is the floor from which tasks visit all others, in
  falling order of their bounds a batch, and a shard whose bound is below the item's K-th best score so far is left
  out. A bound equal to it is visited, as ties go to smaller ids; so the result is exact.

Items travel in chunks of at most ``CHUNK_ITEMS``, which bounds all that tasks are sent: vocabulary, weights, floors.

Edge cases: null and empty texts have no terms and are in no count; items without a term, or whose terms no document
holds, have no rows; each row of either table is one of its own, whatever ids repeat; documents with null ids are in
all counts but never returned; an item's null id is kept; very long texts are read in slices; other columns are not
read; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K = 20
SAMPLE, DEPTH, ROUNDS = 8_192, 6, 12
SHARD_DOCS, SHARD_POSTINGS, CHUNK_ITEMS, FIRST = 4_096, 2_000_000, 4_096, 2
_SLICE = 4 << 20
#: Term bytes: digits, letters (A-Z in lower case) and all bytes of further code points; the rest are spaces.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a slice at a time."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while at < len(raw):
        to = raw.find(b" ", at + _SLICE)
        to = len(raw) if to < 0 else to
        yield raw[at:to].split()
        at = to


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), ids and tfs (of the vocabulary's terms, by id) of documents with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                out = []
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                    n, held = 0, Counter()
                    for part in terms(text.as_py()):
                        n += len(part)
                        held.update(map(find, part))
                    held.pop(None, None)
                    if n:
                        ids = sorted(held)
                        out.append((doc, n, ids, [held[i] for i in ids]))
                if out:
                    doc, n, ids, tfs = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "ids", "tfs"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>")


def _degrees(ids: np.ndarray, owner: np.ndarray, side: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(ids[side[owner]], minlength=size)


def bisect(lists: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(right, cost): which of the documents (lists of term ids below ``size``) go right, in halves, and for each round the
    estimated cost of the terms' gaps in both halves."""
    n = len(lists)
    ids, owner = np.concatenate(lists).astype(np.int64), np.repeat(np.arange(n), [len(x) for x in lists])
    right = np.arange(n) >= n // 2
    costs = []
    for _ in range(ROUNDS):
        n_left, n_right = n - right.sum(), right.sum()
        left_deg, right_deg = _degrees(ids, owner, ~right, size), _degrees(ids, owner, right, size)
        cost = lambda a, b: a * np.log2(n_left / (a + 1.0)) + b * np.log2(n_right / (b + 1.0))
        now = cost(left_deg, right_deg)
        costs.append(float(now.sum()))
        to_right = now - cost(np.maximum(left_deg - 1, 0), right_deg + 1)
        to_left = now - cost(left_deg + 1, np.maximum(right_deg - 1, 0))
        gain = np.bincount(owner, np.where(right[owner], to_left[ids], to_right[ids]), n)
        a, b = np.flatnonzero(~right), np.flatnonzero(right)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        swaps = int((gain[a[:m]] + gain[b[:m]] > 1e-9).sum())
        if not swaps:
            break
        right[a[:swaps]], right[b[:swaps]] = True, False
    return right, np.array(costs)


def fit(lists: list[np.ndarray], size: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) of the nodes of a tree of bisections, the root first, a node's halves at 2k + 1 and 2k + 2: a document
    goes right if its terms' weights add up to more than the cut, the middle of the sample's sums."""
    nodes = (1 << depth) - 1
    weights, cuts = np.zeros((nodes, size), np.float32), np.zeros(nodes, np.float64)
    todo = [(0, [x for x in lists if len(x)])]
    while todo:
        node, part = todo.pop()
        if node >= nodes or len(part) < 4:
            continue
        right, _ = bisect(part, size)
        ids, owner = np.concatenate(part).astype(np.int64), np.repeat(np.arange(len(part)), [len(x) for x in part])
        odds = [np.log2((_degrees(ids, owner, side, size) + 0.5) / (side.sum() + 1.0)) for side in (~right, right)]
        weights[node] = odds[1] - odds[0]
        sums = np.bincount(owner, weights[node][ids].astype(np.float64), len(part))
        cuts[node] = np.median(sums)
        goes = sums > cuts[node]
        for half in (0, 1):
            todo.append((2 * node + 1 + half, [x for x, g in zip(part, goes) if g == bool(half)]))
    return weights, cuts


def clusters_of(flat: np.ndarray, sizes: np.ndarray, weights: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The leaf, from 0, that each document (its terms' ids in a row) comes to."""
    owner, node = np.repeat(np.arange(len(sizes)), sizes), np.zeros(len(sizes), np.int64)
    for _ in range((len(cuts) + 1).bit_length() - 1):
        sums = np.bincount(owner, weights[node[owner], flat].astype(np.float64), len(sizes))
        node = 2 * node + 1 + (sums > cuts[node])
    return node - len(cuts)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())


def clustered(rows: DataFrame, weights: np.ndarray, cuts: np.ndarray) -> DataFrame:
    """The rows that hold a term of the vocabulary, with their cluster."""
    shared = rows.sparkSession.sparkContext.broadcast((weights, cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = clusters_of(*_lists(b.column("ids")), *shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf.astype(np.int32))], [*b.schema.names, "cluster"])

    held = rows.filter("size(ids) > 0 AND doc_id IS NOT NULL")
    return held.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>, row long, cluster int")


def shards(rows: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index: one row a shard. ``term`` and ``peak`` go together; term t's places and impacts are those from ``first`` of
    t to the next one's."""

    def pack(shard: int, doc: list, n: list, flat: list, sizes: list, tfs: list) -> dict:
        doc, n, flat, sizes, tf = (np.concatenate(x) for x in (doc, n, flat, sizes, tfs))
        by_id = np.argsort(doc, kind="stable")
        place = np.empty(len(doc), np.int64)
        place[by_id] = np.arange(len(doc))
        norm = 75 + 25 * n * n_docs // n_terms
        owner = np.repeat(np.arange(len(doc)), sizes)
        impact = 1_000_000_000 * tf // (1_000 * tf + 12 * norm[owner])
        to = np.lexsort((place[owner], flat))
        term, first = np.unique(flat[to], return_index=True)
        return {"shard": shard, "doc_id": doc[by_id], "term": term, "first": np.append(first, len(to)).astype(np.int32), "place": place[owner][to].astype(np.int32), "impact": impact[to], "peak": np.maximum.reduceat(impact[to], first)}

    fields = "shard long, doc_id array<long>, term array<int>, first array<int>, place array<int>, impact array<long>, peak array<long>"
    kinds = [pa.int64(), *[pa.list_(k) for k in (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            row = pack(held[0][0], *zip(*[h[1:] for h in held]))
            return pa.RecordBatch.from_arrays([pa.array([row[c.split()[0]]], k) for c, k in zip(fields.split(", "), kinds)], [c.split()[0] for c in fields.split(", ")])

        for b in batches:
            shard = b.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if held and held[0][0] != shard[lo]:
                    yield done()
                    held = []
                part = b.slice(lo, hi - lo)
                flat, sizes = _lists(part.column("ids"))
                held.append((int(shard[lo]), part.column("doc_id").to_numpy(), part.column("n").to_numpy(), flat, sizes, part.column("tfs").flatten().to_numpy()))
        if held:
            yield done()

    sizes = rows.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / SHARD_DOCS), F.ceil(F.sum(F.size("ids")) / SHARD_POSTINGS)).alias("parts"))
    dealt = rows.join(F.broadcast(sizes), "cluster").withColumn("shard", F.col("cluster") + (1 << DEPTH) * F.pmod(F.xxhash64("row"), F.col("parts")))
    return dealt.select("shard", "doc_id", "n", "ids", "tfs").repartition("shard").sortWithinPartitions("shard").mapInArrow(run, fields)


class _Items:
    """The items of a chunk as rows of (item, term, weight of the term times its count)."""

    def __init__(self, texts: list[str | None]):
        self.vocabulary: dict[bytes, int] = {}
        rows = []
        for q, text in enumerate(texts):
            held = Counter(t for part in terms(text) for t in part)
            rows += [(q, self.vocabulary.setdefault(t, len(self.vocabulary)), n) for t, n in held.items()]
        self.item, self.term, self.count = (np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
        self.weight, self.n = self.count, len(texts)

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        of = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(self.vocabulary))], np.int64)
        self.weight = self.count * of[self.term]
        self.edges = np.searchsorted(self.item, np.arange(self.n + 1))

    def bounds(self, term: np.ndarray, peak: np.ndarray) -> np.ndarray:
        """Each item's bound in a shard."""
        dense = np.zeros(len(self.vocabulary), np.int64)
        dense[term] = peak
        sums = np.append(0, np.cumsum(self.weight * dense[self.term]))
        return sums[self.edges[1:]] - sums[self.edges[:-1]]

    def scores(self, q: int, shard: dict, slot: np.ndarray) -> np.ndarray:
        """Item q's score for each document of a shard; ``slot`` finds a term in it (-1: not there)."""
        own = slice(self.edges[q], self.edges[q + 1])
        at, weight = slot[self.term[own]], self.weight[own]
        at, weight = at[at >= 0], weight[at >= 0]
        out = np.zeros(len(shard["doc_id"]), np.int64)
        first = shard["first"]
        for t, w in zip(at.tolist(), weight.tolist()):  # a term's places are distinct
            lo, hi = first[t], first[t + 1]
            out[shard["place"][lo:hi]] += w * shard["impact"][lo:hi]
        return out


def _read(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    for b in batches:
        for i, shard in enumerate(b.column("shard").to_pylist()):
            yield shard, {c: b.column(c)[i].values.to_numpy() for c in names}


def _bounds(index: DataFrame, shared) -> DataFrame:
    """(q, bound, shard): of each item, the shards of a task with the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, _, _ = shared.value
        bound, where = np.zeros((FIRST, items.n), np.int64), np.zeros((FIRST, items.n), np.int64)
        for shard, x in _read(batches, ("term", "peak")):
            both = np.vstack([bound, items.bounds(x["term"], x["peak"])]), np.vstack([where, np.full(items.n, shard)])
            best = np.argsort(-both[0], axis=0, kind="stable")[:FIRST]
            bound, where = (np.take_along_axis(x, best, 0) for x in both)
        q = np.tile(np.arange(items.n), FIRST)
        on = bound.reshape(-1) > 0
        yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in (q, bound.reshape(-1), where.reshape(-1))], ["q", "bound", "shard"])

    return index.select("shard", "term", "peak").mapInArrow(run, "q long, bound long, shard long")


def _visit(index: DataFrame, shared, k: int) -> DataFrame:
    """(q, doc_id, score): of each item, the k best documents of a task's shards, none below its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, floors, only = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(items.n)]
        least = floors.copy()
        for batch in batches:
            held = [(shard, x, items.bounds(x["term"], x["peak"])) for shard, x in _read([batch], ("doc_id", "term", "first", "place", "impact", "peak"))]
            held.sort(key=lambda h: -int(h[2].sum()))
            for shard, x, bound in held:
                slot = np.full(len(items.vocabulary), -1)
                slot[x["term"]] = np.arange(len(x["term"]))
                visited = np.flatnonzero(bound >= least)
                for q in visited.tolist() if only is None else np.intersect1d(visited, only.get(shard, [])).astype(int).tolist():
                    score = items.scores(q, x, slot)
                    at = np.flatnonzero(score >= least[q])
                    if len(at):
                        s, d = np.append(best[q][0], score[at]), np.append(best[q][1], x["doc_id"][at])
                        top = np.lexsort((d, -s))[:k]
                        best[q] = s[top], d[top]
                        if len(top) == k:
                            least[q] = max(least[q], s[top[-1]])
        for q, (s, d) in enumerate(best):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), q)), pa.array(d), pa.array(s)], ["q", "doc_id", "score"])

    return index.mapInArrow(run, "q long, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _chunk(docs: DataFrame, ids: list, texts: list, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    items = _Items(texts)
    if not items.vocabulary:
        return None
    rows = materialize(counted(docs, items.vocabulary).withColumn("row", F.monotonically_increasing_id()), "ranked-terms")
    total = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    df = {r["id"]: r["count"] for r in rows.select(F.explode("ids").alias("id")).groupBy("id").count().collect()}
    items.weigh(df, total["docs"])
    some = rows.filter("size(ids) > 0").select("ids", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE).toArrow()
    weights, cuts = fit([np.array(x, np.int64) for x in some["ids"].to_pylist()], len(items.vocabulary))
    index = materialize(shards(clustered(rows, weights, cuts), total["docs"], total["terms"]), "ranked-index")

    send = spark.sparkContext.broadcast
    floors = np.ones(items.n, np.int64)
    shared = send((items, floors, None))
    w = Window.partitionBy("q").orderBy(F.desc("bound"), "shard")
    first: dict[int, list[int]] = {}
    for r in _bounds(index, shared).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= FIRST).collect():
        first.setdefault(r["shard"], []).append(r["q"])
    early = send((items, floors, first))
    tried = _visit(index.join(F.broadcast(spark.createDataFrame([(s,) for s in first], "shard long")), "shard", "left_semi"), early, k) if first else None
    for r in _top(tried, k).filter(F.col("rank") == k).select("q", "score").collect() if tried is not None else ():
        floors[r["q"]] = r["score"]
    early.destroy()
    shared.destroy()
    names = spark.createDataFrame(list(enumerate(ids)), "q long, item_id long")
    late = send((items, floors, None))
    return materialize(_top(_visit(index, late, k), k).join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"), "ranked-found")


def search(docs: DataFrame, items: DataFrame, k: int = K, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k highest-scoring documents of each item, ties to smaller ids."""
    spark = docs.sparkSession
    asked = materialize(items.select(items["item_id"].cast("long").alias("item_id"), items["text"].alias("text")).withColumn("row", F.monotonically_increasing_id()), "ranked-items")
    chunks = -(-asked.count() // chunk_items)
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for c in range(chunks):
        got = asked.filter(F.pmod(F.xxhash64("row"), F.lit(chunks)) == c).orderBy("item_id", "row").toArrow()
        if (found := _chunk(docs, got["item_id"].to_pylist(), got["text"].to_pylist(), k)) is not None:
            result = result.unionByName(found)
    return result


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
size AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
norm AS (SELECT r, doc_id, 75 + (25 * n * docs) // terms AS m FROM size, total),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
i AS (SELECT row, item_id, term, count(*)::BIGINT AS c FROM (SELECT row, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS row, item_id, {_TERMS} AS terms FROM benchmark)) GROUP BY ALL),
s AS (SELECT row, item_id, r, norm.doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM i JOIN w USING (term) JOIN tf USING (term) JOIN norm USING (r) GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= {K}
"""
