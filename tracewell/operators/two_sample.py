"""Two-sample tests by kernel means (maximum mean discrepancy), with a permutation null.

Exact: all pairs of vectors. Rows are dealt to ``TILES`` tiles, every pair of tiles is one group of a shuffle, and its
task multiplies the two tiles ``BLOCK`` rows at a time. A row is sent once for each tile, so what is shuffled grows with
the rows, not with their square; only tables of over ``TILES * LARGEST`` rows get more tiles, so that a group stays
bounded (two tiles). The unbiased statistic needs three sums of kernel values (within x, within y, across). The time is
the square of the number of rows, which is the method's; ``linear`` is for tables too large for it: rows are paired up,
every pair of an x-pair and a y-pair is used once, and the mean comes with its standard error.

The null: ``permutations`` seeded relabellings that keep the group sizes, all in the same pass over the kernel values, as
vectors of partial sums. A relabelling gives x to the rows with the smallest digests of (seed, id); its threshold is
found digit by digit from counts, so nothing is sorted or gathered as a whole.

Rows with null or non-finite vectors, or vectors of another length than the first block's, and null groups or ids take
no part. Ids should be unique: rows of one id go to one side of a relabelling together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.expr import all_finite

BLOCK, TILES, LARGEST, DIGITS = 512, 16, 65_536, 4


def sound_rows(rows: DataFrame, id_col: str, vector: str, group: Column) -> DataFrame:
    """id, v and x (whether the row is of the first group) of the rows that take part."""
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    return rows.select(F.col(id_col).alias("id"), v.alias("v"), group.alias("x")).filter(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("v") > 0) & all_finite(F.col("v")))


def kernel(a: np.ndarray, b: np.ndarray, bandwidth: float) -> np.ndarray:
    """Gaussian kernel of all rows of a with all rows of b."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.exp(-np.maximum(square, 0.0) / (2 * bandwidth * bandwidth))


def pair_sums(u: np.ndarray, x: np.ndarray, w: np.ndarray, y: np.ndarray, same: bool, bandwidth: float, block: int = BLOCK) -> np.ndarray:
    """xx, yy and xy for each labelling (columns of x and y, 1 or 0) over ordered pairs of a row of u and a row of w;
    ``same``: w is u, and a row is not paired with itself."""
    sums = np.zeros((x.shape[1], 3))
    for p in range(0, len(u), block):
        for q in range(p if same else 0, len(w), block):
            values, own = kernel(u[p : p + block], w[q : q + block], bandwidth), same and p == q
            if own:
                np.fill_diagonal(values, 0.0)
            a, b = x[p : p + block], y[q : q + block]
            twice, to_x, to_y = 1.0 if own else 2.0, values @ b, values @ (1 - b)
            sums[:, 0] += twice * (a * to_x).sum(0)
            sums[:, 1] += twice * ((1 - a) * to_y).sum(0)
            sums[:, 2] += (a * to_y).sum(0) + (0.0 if own else ((1 - a) * to_x).sum(0))
    return sums


def _digest(seed: int, row_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def thresholds(rows: DataFrame, seeds: list[int], size: int) -> dict[int, str]:
    """For each seed the digest of the row that is number ``size`` in the order of digests (rows of equal ids together:
    the first at or after that number). Each round finds DIGITS hex digits from counts; a row a seed and digit value
    comes back, no more."""
    found = dict.fromkeys(seeds, "")
    before = dict.fromkeys(seeds, 0)
    digests = F.array(*[F.struct(F.lit(s).alias("seed"), _digest(s, F.col("id")).alias("d")) for s in seeds])
    for at in range(0, 32, DIGITS):
        known = F.create_map(*[F.lit(x) for s in seeds for x in (s, found[s])])
        each = rows.select(F.inline(digests)).filter(F.substring("d", 1, at) == F.element_at(known, F.col("seed"))) if at else rows.select(F.inline(digests))
        counts = each.groupBy("seed", F.substring("d", at + 1, DIGITS).alias("digit")).agg(F.count("*").alias("n"))
        todo = {s: sorted((r["digit"], r["n"]) for r in part) for s, part in _by_seed(counts, seeds).items()}
        for s in seeds:
            for digit, n in todo[s]:
                if before[s] + n >= size:
                    found[s] += digit
                    break
                before[s] += n
    return found


def _by_seed(counts: DataFrame, seeds: list[int]) -> dict[int, list]:
    out: dict[int, list] = {s: [] for s in seeds}
    for r in counts.toLocalIterator():
        out[r["seed"]].append(r)
    return out


def kernel_sums(rows: DataFrame, bandwidth: float, permutations: int = 0, block: int = BLOCK) -> DataFrame:
    """(permutation, xx, yy, xy, m, n): sums of the kernel over ordered pairs of different rows within x, within y, and
    over pairs across; permutation -1 is the labelling as it is. ``rows`` as ``sound_rows`` gives them."""
    total = rows.agg(F.count("*").alias("n"), F.count_if("x").alias("m")).first()
    m, n = total["m"] or 0, (total["n"] or 0) - (total["m"] or 0)
    spark = rows.sparkSession
    schema = "permutation int, xx double, yy double, xy double, m long, n long"
    if m < 2 or n < 2:
        raise ValueError(f"both groups need two rows at least, got {m} and {n}")
    seeds = list(range(permutations))
    limit = thresholds(rows, seeds, m) if seeds else {}
    labels = F.array(F.col("x"), *[_digest(s, F.col("id")) <= F.lit(limit[s]) for s in seeds])
    tiles = max(min(TILES, -(-(m + n) // block)), -(-(m + n) // LARGEST))
    tile, other = F.pmod(F.xxhash64("id", "v"), F.lit(tiles)).cast("int"), F.sequence(F.lit(0), F.lit(tiles - 1))
    dealt = rows.select(tile.alias("tile"), "v", labels.alias("x")).withColumn("other", F.explode(other))
    cells = dealt.select(F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "v", "x").repartition(tiles * (tiles + 1) // 2, "i", "j")
    width = permutations + 1

    def run(key: tuple[pa.Scalar, pa.Scalar], cell: pa.Table) -> pa.Table:
        i, j = (k.as_py() for k in key)
        sides = []
        for t in (i, j):
            held = cell.filter(pc.equal(cell["tile"], t)).combine_chunks()
            sides.append(tuple(held[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(held.num_rows, -1) if held.num_rows else None for c in ("v", "x")))
        (u, x), (w, y) = sides
        sums = np.zeros((width, 3)) if u is None or w is None else pair_sums(u, x, w, y, i == j, bandwidth, block)
        return pa.table([pa.array(np.arange(width, dtype=np.int32) - 1), *(pa.array(sums[:, c]) for c in range(3))], ["permutation", "xx", "yy", "xy"])

    found = cells.groupBy("i", "j").applyInArrow(run, "permutation int, xx double, yy double, xy double")
    out = found.groupBy("permutation").agg(*[F.sum(c).alias(c) for c in ("xx", "yy", "xy")])
    return out.select("permutation", "xx", "yy", "xy", F.lit(m).cast("long").alias("m"), F.lit(n).cast("long").alias("n")).to(spark.createDataFrame([], schema).schema)


def statistic(xx: Column, yy: Column, xy: Column, m: Column, n: Column) -> Column:
    """The unbiased squared discrepancy."""
    return xx / (m * (m - 1)) + yy / (n * (n - 1)) - 2 * xy / (m * n)


def permutation_test(rows: DataFrame, bandwidth: float, permutations: int = 199, block: int = BLOCK) -> tuple[float, float]:
    """The statistic, and the share of relabellings (itself included) whose statistic is as large."""
    sums = kernel_sums(rows, bandwidth, permutations, block).select("permutation", statistic(*[F.col(c) for c in ("xx", "yy", "xy", "m", "n")]).alias("s")).collect()
    own = next(r["s"] for r in sums if r["permutation"] < 0)
    return own, sum(r["s"] >= own - 1e-15 for r in sums) / (permutations + 1)


def linear(rows: DataFrame, bandwidth: float) -> tuple[float, float, int]:
    """The linear-time estimate, its standard error, and the number of pairs of pairs. Rows of each group are paired by
    a hash of their ids within buckets of some hundred; the few left over in a bucket take no part."""
    total = rows.agg(F.count("*").alias("n"), F.count_if("x").alias("m")).first()
    buckets = max(1, (total["n"] or 0) // 256)
    placed = rows.select(F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"), F.xxhash64(F.lit(7), "id").alias("h"), "v", "x")
    packs = placed.groupBy("bucket").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("x") == s, F.struct("h", "v")))), lambda p: p["v"]).alias(c) for c, s in (("xs", True), ("ys", False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for xs, ys in zip(b.column("xs"), b.column("ys")):
                k = min(len(xs.values), len(ys.values)) // 2
                if k:
                    x, y = (s.values[: 2 * k].flatten().to_numpy(zero_copy_only=False).reshape(2 * k, -1) for s in (xs, ys))
                    of = lambda a, c: np.exp(-((a - c) ** 2).sum(1) / (2 * bandwidth * bandwidth))
                    h = of(x[::2], x[1::2]) + of(y[::2], y[1::2]) - of(x[::2], y[1::2]) - of(x[1::2], y[::2])
                    out.append((k, float(h.sum()), float((h * h).sum())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["k", "s", "q"])

    got = packs.mapInArrow(run, "k long, s double, q double").agg(F.sum("k").alias("k"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    if not got["k"] or got["k"] < 2:
        raise ValueError("too few rows to pair")
    mean = got["s"] / got["k"]
    return mean, math.sqrt(max(0.0, got["q"] / got["k"] - mean * mean) / (got["k"] - 1)), got["k"]
