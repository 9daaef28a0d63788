"""Exact top-k inner-product search by columnar branch-and-bound.

Components are quantised to floor(scale * x), x as double, so scores are exact integers. Candidates are laid out
in column blocks: ``block_rows`` vectors stored dimension by dimension. For each query and block, partial scores
grow dimension block by dimension block; after each, a candidate whose partial score plus the largest score that
the remaining mass allows (product of the remaining norms, by Cauchy and Schwarz) falls below the query's k-th
best so far is dropped and the survivors are compacted. Each task keeps k candidates a query; the final k come
from one window over these.

Queries travel in chunks of at most ``CHUNK_QUERIES`` vectors, which bounds what a pass sends to executors and what
the driver holds. A chunk first meets a sample of at most ``SAMPLE_ROWS`` candidates; the k-th best score there is a
floor that all tasks start from. Its result is written before the next chunk is taken up. Every query meets every
candidate.

Edge cases: vectors that are null, empty or hold null or non-finite components take no part, nor do null ids or
components beyond the range of a double when scaled; vectors of other lengths than the query's never match; each row
is a candidate of its own and a query of its own, whatever ids repeat, and only a query's own row is left out; ties go
to the smaller id; rows whose scores may pass 62 bits are scored in unbounded integers: they are ranked exactly, and a
score beyond a long is shown as the nearest long; fewer than k candidates give them all; empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K, SCALE = 10, 1024
BLOCK_ROWS, BLOCK_DIMS, CHUNK_QUERIES, SAMPLE_ROWS = 4_096, 16, 4_096, 4_096
LONG = (1 << 63) - 1


def _floor(x: Column) -> Column:
    """The largest whole double that is not above x; F.floor ends at the range of a long."""
    return F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, a row number and the quantised vector ``v`` (whole doubles) of those that take part, written down."""
    x = F.col("embedding")
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))
    v = F.transform(x, lambda c: _floor(F.lit(float(scale)) * c.cast("double")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, finite)).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return materialize(rows.filter(F.forall("v", finite)).withColumn("row", F.monotonically_increasing_id()), "topk-vectors")


def _remaining(m: np.ndarray) -> np.ndarray:
    """Norms of what follows each dimension block, of vectors in the columns of ``m``; rounded up."""
    squares = np.square(m.astype(np.float64))
    tails = [np.sqrt(squares[at:].sum(0)) for at in range(BLOCK_DIMS, len(m), BLOCK_DIMS)]
    return np.array([*tails, np.zeros(m.shape[1])]) * (1 + 1e-12)


def _offer(best: list, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> list:
    """The k best of (score descending, id ascending) of what there is and what comes."""
    rows, ids, scores = np.concatenate([best[0], rows]), np.concatenate([best[1], ids]), np.concatenate([best[2], scores])
    order = np.lexsort((rows, ids, -scores))[:k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i], rows[i]))[:k]
    return [rows[order], ids[order], scores[order]]


def search_block(query: np.ndarray, query_rest: np.ndarray, columns: np.ndarray, rest: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the block's vectors that can reach the floor."""
    alive = np.arange(columns.shape[1])
    partial = np.zeros(columns.shape[1], np.int64)
    for step, at in enumerate(range(0, len(query), BLOCK_DIMS)):
        part = columns[at : at + BLOCK_DIMS] if len(alive) == columns.shape[1] else columns[at : at + BLOCK_DIMS, alive]
        partial = partial + query[at : at + BLOCK_DIMS] @ part
        keep = partial + query_rest[step] * rest[step][alive] >= floor
        if not keep.all():
            alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
    return alive, partial


def ordered(score: int) -> str:
    """A text that sorts as the score does, whatever its size."""
    digits = str(abs(score))
    key = f"{len(digits):04d}{digits}"
    return f"1{key}" if score >= 0 else "0" + key.translate(str.maketrans("0123456789", "9876543210"))


def _below(score: int) -> float:
    """A double that is not above the score."""
    return float(score) - abs(float(score)) * 1e-15


def _wide(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact scores in unbounded integers, of whole doubles (rows of ``vectors``)."""
    q = [int(x) for x in query]
    out = np.empty(len(vectors), object)
    out[:] = [sum(a * int(b) for a, b in zip(q, v)) for v in vectors]
    return out


def _pass(candidates: DataFrame, shared: Broadcast, dims: int, k: int) -> DataFrame:
    """Each task's k best candidates for each query of one chunk (q: its place in the chunk); ``shared`` has the queries'
    rows, vectors and floors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vectors, floors = shared.value
        peaks, rests = np.abs(vectors).max(1), _remaining(vectors.T)
        best: list = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)] for _ in own]
        narrow = {q: vectors[q].astype(np.int64) for q in range(len(own)) if peaks[q] < 2.0**62}
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                v = part.column("v")
                n = np.diff(v.offsets.to_numpy())
                same = n == dims
                if not same.any():
                    continue
                whole = v.flatten().to_numpy(zero_copy_only=False)[np.repeat(same, n)].reshape(-1, dims)
                row, owner = part.column("row").to_numpy()[same], part.column("vec_id").to_numpy()[same]
                peak = np.abs(whole).max(1)
                usual = peak < 2.0**31
                columns = np.ascontiguousarray(whole[usual].T.astype(np.int64))
                rest, high = _remaining(columns), peak[usual].max(initial=0.0)
                for q in range(len(own)):
                    fast = q in narrow and high * peaks[q] * dims < 2.0**62
                    floor = max(floors[q], _below(best[q][2][-1]) if len(best[q][2]) == k else -np.inf)
                    slow = ~usual if fast else np.ones(len(row), bool)
                    if fast:
                        alive, scores = search_block(narrow[q], rests[:, q], columns, rest, floor)
                        at_row, at_id = row[usual][alive], owner[usual][alive]
                        other = at_row != own[q]
                        if other.any():
                            best[q] = _offer(best[q], at_row[other], at_id[other], scores[other], k)
                    slow &= row != own[q]
                    if slow.any():
                        best[q] = _offer(best[q], row[slow], owner[slow], _wide(vectors[q], whole[slow]), k)
        for q, (r, i, s) in enumerate(best):
            if len(i):
                exact = [int(x) for x in s]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), q)), pa.array(i), pa.array([max(-LONG - 1, min(LONG, x)) for x in exact], pa.int64()), pa.array([ordered(x) for x in exact], pa.string()), pa.array(r)], ["q", "vec_id", "score", "place", "row"])

    return candidates.mapInArrow(run, "q long, vec_id long, score long, place string, row long")


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("place"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = K, scale: int = SCALE, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of each row of ``vectors`` that the
    condition ``queries`` picks against all other rows."""
    rows = quantised(vectors, scale)
    spark = rows.sparkSession
    asked = rows.filter(queries).withColumn("dims", F.size("v"))
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for dims, n in sorted((r["dims"], r["count"]) for r in asked.groupBy("dims").count().collect()):
        chunks = -(-n // chunk_queries)
        chosen = asked.filter(F.col("dims") == dims).withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
        alike = rows.filter(F.size("v") == dims)
        sample = materialize(alike.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).repartition(8), "topk-sample")
        for c in range(chunks):
            got = chosen.filter(F.col("chunk") == c).orderBy("vec_id", "row").select("vec_id", "row", "v").toArrow()
            if not got.num_rows:
                continue
            own, matrix = got["row"].to_numpy(), np.array(got["v"].to_pylist(), np.float64)
            floors = np.full(len(own), -np.inf)
            early = spark.sparkContext.broadcast((own, matrix, floors))
            for r in _first(_pass(sample, early, dims, k), k).filter(F.col("rank") == k).select("q", "score").collect():
                if r["score"] < LONG:
                    floors[r["q"]] = _below(r["score"])
            early.destroy()
            ids = spark.createDataFrame(list(enumerate(got["vec_id"].to_pylist())), "q long, query_id long")
            late = spark.sparkContext.broadcast((own, matrix, floors))
            found = _first(_pass(alike, late, dims, k), k).join(F.broadcast(ids), "q").select("query_id", "rank", "vec_id", "score")
            result = result.unionByName(materialize(found, "topk-found"))
            late.destroy()  # executors hold one chunk of queries at a time
    return result


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r),
r AS (SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {K}
"""
