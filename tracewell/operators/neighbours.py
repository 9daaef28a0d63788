"""Exact k nearest neighbours by the angle between unit vectors, by pivots on the sphere.

The angle is a metric, so for a pivot p, |angle(x, p) - angle(y, p)| <= angle(x, y). Vectors go to the cell of their
nearest pivot; a cell is cut into blocks, rings of angles to its pivot, of about ``BLOCK`` vectors. The k-th neighbour
within a vector's own piece of its block bounds its k-th neighbour overall; the vector is then compared with those
pieces whose ring that bound reaches, and with no others. Equal vectors are one, with the k + 1 least ids, so copies
cost nothing.

Pieces are dealt to ``TILES`` tiles, and every pair of tiles that some bound connects is one group of a shuffle: a vector
is sent once for each tile, not for each block, so what is shuffled grows with the rows even where nothing is pruned.
Only tables of over ``TILES * HELD`` numbers get more tiles, so that a group stays bounded. A group compares two pieces
by one matrix product, for both of them, and keeps what lies within the bounds, which narrow as it goes on. Pivots (at most ``PIVOTS``, farthest
first from a sample of ``SAMPLE`` vectors) and the rings (two numbers a piece) are all that is sent to every task. In
many dimensions angles crowd together and little is pruned: ``compared`` tells.

Edge cases: vectors that are null, hold null or non-finite values or have no length take no part; others are scaled to
unit length; ties go to smaller ids; null ids take no part; repeated ids are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.functions.expr import all_finite, l2_norm

PIVOTS, SAMPLE, BLOCK, PACK = 64, 4_096, 2_048, 1_024
TILES, HELD, HITS, ROWS = 16, 1 << 22, 1 << 18, 512
_SLACK = 1e-9


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Angles between the rows; for small ones from the chord, where the cosine has lost its digits."""
    cos = np.clip(x @ y.T, -1.0, 1.0)
    out = np.arccos(cos)
    i, j = np.nonzero(cos > 0.999)
    if len(i):
        out[i, j] = 2 * np.arcsin(np.minimum(1.0, np.linalg.norm(x[i] - y[j], axis=1) / 2))
    return out


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to n vectors of the sample, each as far as possible from those before."""
    chosen = [0]
    near = angles(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.max() > 1e-6:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, angles(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _unit_rows(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """id and v (unit length, double) of the rows that take part; the norm is worked out once a row."""
    x, v = F.col(vector), F.transform(vector, lambda c: c.cast("double"))
    sound = x.isNotNull() & (F.size(x) > 0) & all_finite(v) & (l2_norm(x) > 0) & F.col(id_col).isNotNull()
    unit = F.element_at(F.transform(F.array(l2_norm(x)), lambda norm: F.transform(v, lambda c: c / norm)), 1)
    return vectors.filter(sound).select(F.col(id_col).cast("long").alias("id"), unit.alias("v"))


def distinct_units(vectors: DataFrame, k: int, id_col: str, vector: str) -> DataFrame:
    """v (unit length, double) and the k + 1 least ids (with repeats) that have it."""
    rows = _unit_rows(vectors, id_col, vector)
    ranked = rows.groupBy("v", "id").agg(F.count("*").alias("n")).withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id")))
    own = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("id", "n"))), lambda p: F.array_repeat(p["id"], F.least(p["n"], F.lit(k + 1)).cast("int"))))
    return ranked.filter(F.col("r") <= k + 1).groupBy("v").agg(F.slice(own, 1, k + 1).alias("ids"))


def _celled(units: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = units.sparkSession.sparkContext.broadcast(pivots)
    dims = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = angles(_matrix(b.column("v"), dims), shared.value)
            cell = far.argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(cell)), cell])], [*b.schema.names, "cell", "far"])

    return units.mapInArrow(run, "row long, v array<double>, ids array<long>, cell int, far double")


def _best(far: np.ndarray, ids: list, own: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """For each row of angles, the k least (angle, id); ``own``: the column that is the vector itself, or -1."""
    out = []
    for q, row in enumerate(far):
        if len(row) > k:
            limit = np.partition(row, k)[k]
            at = np.flatnonzero(row <= limit)
        else:
            at = np.arange(len(row))
        found = []
        for j in at.tolist():
            found += [(float(row[j]), i) for i in ids[j]] if j != own[q] else []
        out.append(sorted(found)[: k + 1])
    return out


class Side:
    """The vectors of one tile, piece after piece, and what was found for them so far: those within ``limit`` (cosine)."""

    def __init__(self, rows: pa.Table, dims: int, pivots: np.ndarray, k: int):
        rows = rows.take(np.argsort(rows["piece"].to_numpy(), kind="stable")).combine_chunks()
        self.k, self.row, self.ids = k, rows["row"].to_numpy(), rows["ids"].combine_chunks()
        self.v = _matrix(rows["v"].combine_chunks(), dims)
        self.single = self.v.astype(np.float32)
        many = self.ids.value_lengths().to_numpy()
        self.least = self.ids.flatten().to_numpy()[np.cumsum(many) - many]
        self.piece, starts = np.unique(rows["piece"].to_numpy(), return_index=True)
        self.at = dict(zip(self.piece.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(rows)])))
        self.far, self.bound = angles(self.v, pivots), rows["bound"].to_numpy()
        self.limit, self.compared = self._cosine(self.bound), np.zeros(len(rows), np.int64)
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_hits = 0

    @staticmethod
    def _cosine(angle: np.ndarray) -> np.ndarray:
        """No greater than a computed cosine of any angle up to this one."""
        return np.cos(np.minimum(angle + _SLACK, np.pi)) - 1e-12

    def reaching(self, piece: int, cell: int, low: float, high: float) -> np.ndarray:
        """Which rows of the piece have a bound that reaches that ring."""
        lo, hi = self.at[piece]
        far = self.far[lo:hi, cell]
        return np.maximum(far - high, low - far) <= self.bound[lo:hi] + _SLACK

    def screen(self, rows: slice) -> np.ndarray:
        """The limits of rows, less what a product in single precision may be off."""
        return np.nextafter((self.limit[rows] - (self.v.shape[1] + 8) * 2.0**-24).astype(np.float32), np.float32(-2))

    def take(self, q: np.ndarray, j: np.ndarray, held: Side) -> None:
        """Keep the pairs of a row q and a row j of held that lie within the limit, by their angle in double precision."""
        cos = np.einsum("ij,ij->i", self.v[q], held.v[j])
        near = np.flatnonzero(cos >= self.limit[q])
        q, j, cos = q[near], j[near], cos[near]
        angle, small = np.arccos(np.clip(cos, -1.0, 1.0)), np.flatnonzero(cos > 0.999)
        angle[small] = 2 * np.arcsin(np.minimum(1.0, np.linalg.norm(self.v[q[small]] - held.v[j[small]], axis=1) / 2))
        self.hits.append((q, angle, j))
        self.n_hits += len(q)
        if self.n_hits > HITS:
            self.narrow(held)

    def narrow(self, held: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k + 1 nearest found for each row, by angle and least id; the k-th is its new limit."""
        q, angle, j = (np.concatenate(c) for c in zip(*self.hits)) if self.hits else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        q, angle, j = _first_of_each(q, (held.least[j], angle), self.k + 1, (q, angle, j))
        last = np.flatnonzero(_places(q) == self.k - 1)
        self.limit[q[last]] = np.maximum(self.limit[q[last]], self._cosine(angle[last]))
        self.hits, self.n_hits = [(q, angle, j)], 0
        return q, angle, j

    def found(self, held: Side, every: bool) -> pa.RecordBatch:
        """Rows with something found (``every``: all rows), each with its k + 1 nearest (angle, id)."""
        q, angle, j = self.narrow(held)
        many = held.ids.value_lengths().to_numpy()[j]
        ids = held.ids.take(pa.array(j)).flatten().to_numpy()
        q, angle = np.repeat(q, many), np.repeat(angle, many)
        q, angle, ids = _first_of_each(q, (ids, angle), self.k + 1, (q, angle, ids))
        count = np.bincount(q, minlength=len(self.row))
        kept = np.flatnonzero(self.compared >= 0 if every else self.compared > 0)
        best = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *count[kept]]).astype(np.int32)), pa.StructArray.from_arrays([pa.array(angle), pa.array(ids)], ["angle", "id"]))
        own = self.ids.take(pa.array(kept)) if every else pa.nulls(len(kept), self.ids.type)
        return pa.RecordBatch.from_arrays([pa.array(self.row[kept]), own, best, pa.array(self.compared[kept])], ["row", "ids", "best", "compared"])


def _places(q: np.ndarray) -> np.ndarray:
    """For sorted q the place of each among its equals, from 0."""
    new = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    return np.arange(len(q)) - np.repeat(new, np.diff([*new, len(q)])) if len(q) else new


def _first_of_each(q: np.ndarray, order: tuple[np.ndarray, ...], n: int, columns: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """The columns sorted by q and the order (last first), the first n of each q."""
    at = np.lexsort((*order, q))
    at = at[_places(q[at]) < n]
    return [c[at] for c in columns]


def compare_tiles(a: Side, b: Side, rings: np.ndarray) -> None:
    """Compare the pieces of two tiles (or of one with itself: a is b), both ways at once. ``rings``: cell, low and high
    of each piece. Products in single precision tell which pairs may lie within a limit."""
    for p in a.piece.tolist():
        for r in b.piece.tolist():
            if a is b and r < p:
                continue
            own = a is b and p == r
            (lo, hi), (low, high) = a.at[p], b.at[r]
            to_b = a.reaching(p, int(rings[r][0]), *rings[r][1:])
            to_a = np.zeros(high - low, bool) if own else b.reaching(r, int(rings[p][0]), *rings[p][1:])
            a.compared[lo:hi] += to_b * (high - low)
            b.compared[low:high] += to_a * (hi - lo)
            for at in range(lo, hi, ROWS):
                end = min(at + ROWS, hi)
                asked = to_b[at - lo : end - lo]
                if not (asked.any() or to_a.any()):
                    continue
                cos = a.single[at:end] @ b.single[low:high].T
                if own:
                    cos[np.arange(end - at), np.arange(at, end) - low] = -2.0
                if asked.any():
                    q, j = divmod(np.flatnonzero(cos >= np.where(asked, a.screen(slice(at, end)), np.float32(2))[:, None]), high - low)
                    a.take(at + q, low + j, b)
                if to_a.any():
                    q, j = divmod(np.flatnonzero(cos >= np.where(to_a, b.screen(slice(low, high)), np.float32(2))), high - low)
                    b.take(low + j, at + q, a)


def nearest(vectors: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding", store: str | None = None) -> DataFrame:
    """id, rank (from 1), neighbour and angle of the k nearest other rows of every row. ``store`` is a folder (a fresh
    one that all executors share) for what is set down on the way."""
    from tracewell.sinks.store import scratch

    spark = vectors.sparkSession
    at = store or scratch(spark, "neighbours")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.schema(df.schema).parquet(f"{at}/{name}")

    units = kept(distinct_units(vectors, k, id_col, vector).withColumn("row", F.monotonically_increasing_id()).select("row", "v", "ids"), "units")
    some = units.select("v", F.xxhash64("row").alias("h")).orderBy("h").limit(SAMPLE).toArrow()["v"].to_pylist()
    empty = spark.createDataFrame([], "id long, rank int, neighbour long, angle double")
    if not some:
        return empty
    dims = len(some[0])
    pivots = farthest_first(np.array([v for v in some if len(v) == dims]), PIVOTS)
    celled = kept(_celled(units.filter(F.size("v") == dims), pivots), "cells")

    # rings: blocks of a cell by angle to its pivot
    sizes = {r["cell"]: r["n"] for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    parts = {c: -(-n // BLOCK) for c, n in sizes.items()}
    cuts: dict[int, list[float]] = {}
    for many in sorted({p for p in parts.values() if p > 1}):
        steps = [i / many for i in range(1, many)]
        for r in celled.filter(F.col("cell").isin([c for c, p in parts.items() if p == many])).groupBy("cell").agg(F.percentile_approx("far", steps, 10_000).alias("q")).collect():
            cuts[r["cell"]] = sorted(set(r["q"]))
    edges = spark.createDataFrame([(c, cuts.get(c, [])) for c in sizes], "cell int, cuts array<double>")
    placed = kept(celled.join(F.broadcast(edges), "cell").withColumn("block", F.size(F.filter("cuts", lambda q: q < F.col("far")))).drop("cuts"), "blocks")
    rings = placed.groupBy("cell", "block").agg(F.min("far").alias("low"), F.max("far").alias("high"), F.count("*").alias("n")).collect()
    ring = {(r["cell"], r["block"]): r for r in rings}

    pack = lambda df: df.groupBy("cell", "block", "part").agg(F.collect_list(F.struct("row", "v", "ids")).alias("p"))
    part = lambda size: F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / size)).cast("int").alias("part")
    counted = placed.join(F.broadcast(spark.createDataFrame([(c, b, r["n"]) for (c, b), r in ring.items()], "cell int, block int, n long")), ["cell", "block"])
    members = pack(counted.select("cell", "block", part(2 * PACK), "row", "v", "ids"))

    # pieces: the packs of a block, numbered from cell to cell and dealt to tiles of about equal size
    total, pieces, before = sum(r["n"] for r in rings), [], 0
    sizes_of = [(c, b, p, r["n"] / many, float(r["low"]), float(r["high"])) for (c, b), r in sorted(ring.items()) for many in [-(-r["n"] // (2 * PACK))] for p in range(many)]
    tiles = max(min(TILES, len(sizes_of)), -(-total * dims // HELD))
    for number, (c, b, p, n, low, high) in enumerate(sizes_of):
        pieces.append((c, b, p, number, min(tiles - 1, int((before + n / 2) / total * tiles)), low, high))
        before += n
    members = members.join(F.broadcast(spark.createDataFrame([r[:5] for r in pieces], "cell int, block int, part int, piece int, tile int")), ["cell", "block", "part"])
    rings_of, tile_of = np.array([(r[0], r[5], r[6]) for r in pieces]), np.array([r[4] for r in pieces])

    found_schema = "row long, ids array<long>, v array<double>, piece int, tile int, bound double, compared long"

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector with the angle of its k-th neighbour within its piece."""
        for b in batches:
            for i in range(b.num_rows):
                held = b.column("p")[i].values
                x, ids = _matrix(held.field("v"), dims), held.field("ids").to_pylist()
                n = len(ids)
                found = []
                for f, own in zip(_best(angles(x, x), ids, np.arange(n), k), ids):
                    copies = len(own) - 1  # a vector's own copies are at no distance
                    found.append(0.0 if copies >= k else f[k - 1 - copies][0] if len(f) >= k - copies else np.pi)
                piece, tile = (pa.array(np.full(n, b.column(c)[i].as_py(), np.int32)) for c in ("piece", "tile"))
                yield pa.RecordBatch.from_arrays([held.field("row"), held.field("ids"), held.field("v"), piece, tile, pa.array(found), pa.array(np.full(n, n))], ["row", "ids", "v", "piece", "tile", "bound", "compared"])

    first = kept(members.select("p", "piece", "tile").mapInArrow(bounds, found_schema), "first")
    shared = spark.sparkContext.broadcast((pivots, rings_of, tile_of))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs of tiles that the bounds of some vectors connect."""
        pivots, rings, tile = shared.value
        cell, low, high = rings[:, 0].astype(int), rings[:, 1], rings[:, 2]
        for b in batches:
            far = angles(_matrix(b.column("v"), dims), pivots)[:, cell]
            q, at = np.nonzero(np.maximum(far - high, low - far) <= b.column("bound").to_numpy()[:, None] + _SLACK)
            both = np.unique(np.stack([b.column("tile").to_numpy()[q], tile[at]]).astype(np.int32), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both.min(0)), pa.array(both.max(0))], ["i", "j"])

    wanted = {(r["i"], r["j"]) for r in first.select("v", "bound", "tile").mapInArrow(reach, "i int, j int").distinct().collect()} | {(t, t) for t in range(tiles)}
    ends = spark.createDataFrame(sorted({(t, i, j) for i, j in wanted for t in (i, j)}), "tile int, i int, j int")
    cells = first.join(F.broadcast(ends), "tile").select("i", "j", "tile", "row", "v", "ids", "piece", "bound").repartition(len(wanted), "i", "j")

    def compare(key: tuple[pa.Scalar, pa.Scalar], cell: pa.Table) -> pa.Table:
        pivots, rings, _ = shared.value
        i, j = (x.as_py() for x in key)
        a = Side(cell.filter(pc.equal(cell["tile"], i)), dims, pivots, k)
        b = a if i == j else Side(cell.filter(pc.equal(cell["tile"], j)), dims, pivots, k)
        compare_tiles(a, b, rings)
        out = [a.found(b, i == j)] + ([] if i == j else [b.found(a, False)])
        return pa.Table.from_batches(out)

    later = cells.groupBy("i", "j").applyInArrow(compare, "row long, ids array<long>, best array<struct<angle:double,id:long>>, compared long")
    every = kept(later.groupBy("row").agg(F.first("ids", ignorenulls=True).alias("ids"), F.array_sort(F.flatten(F.collect_list("best"))).alias("best"), F.sum("compared").alias("compared")), "found")

    # a row's neighbours: copies of its vector at no distance, then the others; each of the ids gets its own list
    copies = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("angle"), i.alias("id")))
    ranked = every.select("row", "ids", F.slice(F.array_sort(F.concat(copies, "best")), 1, k + 1).alias("best"))
    heads = ranked.select("row", "ids", "best")
    rows = distinct_ids(vectors, units, id_col, vector).join(heads, "row")
    # without one entry of the row itself
    me = F.array_position("best", F.struct(F.lit(0.0).alias("angle"), F.col("id").alias("id")))
    others = F.when(me > 0, F.concat(F.slice("best", F.lit(1), (me - 1).cast("int")), F.slice("best", (me + 1).cast("int"), F.lit(k + 1)))).otherwise(F.col("best"))
    out = rows.select("id", F.posexplode(F.slice(others, 1, k)).alias("p", "x"))
    return out.select("id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("neighbour"), F.col("x.angle").alias("angle"))


def distinct_ids(vectors: DataFrame, units: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, row): every row that takes part with the number of its distinct vector."""
    rows = _unit_rows(vectors, id_col, vector)
    return rows.join(units.select("v", "row"), "v").select("id", "row")


def compared(at: str, spark) -> int:
    """Pairs of distinct vectors that a run of ``nearest`` in that folder has compared."""
    first, found = (spark.read.parquet(f"{at}/{n}").agg(F.coalesce(F.sum("compared"), F.lit(0))).first()[0] for n in ("first", "found"))
    return first + found
