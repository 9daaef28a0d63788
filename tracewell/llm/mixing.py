"""Mixing sources to target weights by entropy balancing.

Each source gets a token target: a share, by weight, of a budget, at most ``most`` times what it has, with the
excess shared again by weight. Document rates (expected copies, between 0 and ``most``) solve the maximum-entropy
problem under one token constraint a source: they are exponential tilts of the documents' prior odds (by default a
longer text has higher odds, see ``length_prior``), and Newton iterations on the convex dual find the tilts. Every
iteration is one aggregate over cells of (source, prior), which are counted once; only two numbers a source come back.

Rates are rounded into whole copies. Of n equal rows, whose rate has the fraction f, floor(n f + u) get the further
copy, u drawn from a hash of the row; so repeated rows are rounded together, to within one copy, and not all alike.
What rounding misses a target by is trimmed: documents in the order of another hash give or take one copy until the
next one would go beyond the target. Where that is, is found digit by digit of the hash: each step is one aggregate
by (source, digit) and a running sum over at most ``2^DIGIT`` digits. At last the document whose size comes nearest
to the rest gives or takes a copy, or two whose sizes differ by it swap one, again while that helps.

Sources are configuration: their table (name, weight, target, tilt) is kept on the driver and must have at most
``max_sources`` rows (else an error). Documents never are. Newton iterations or last changes that do not settle
raise an error.

Edge cases: null texts have size 0; documents of size 0 are never taken; a null source is a source, after all
others; a source without tokens has target 0; of repeated rows (same id, source and text) some may get a copy more
than others, and which ones is not defined; a null doc_id is a value like any other; an empty table gives an empty
result; other columns, whatever their names, are kept by ``mixed`` and not read otherwise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sieve, word_count

WEIGHTS, BUDGET, MOST = (3, 1, 2), 1.5, 2
MAX_SOURCES, NEWTON, LAST = 100_000, 60, 64
#: Share of its target by which a source may be off without an overshoot, and overshoots to try.
CLOSE, KICKS = 0.01, 4
#: Bits of the trimming hash, bits of one digit of it, and rows of equal rows that are numbered together.
HASH_BITS, DIGIT, CHUNK = 60, 12, 4_096


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], budget: float = BUDGET, most: float = MOST) -> dict[str | None, float]:
    """Token targets: the budget's shares by weight, held at ``most`` times the size, the excess shared again."""
    left, open_ = budget * sum(sizes.values()), {s for s, n in sizes.items() if n > 0}
    out: dict[str | None, float] = {s: 0.0 for s in sizes}
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > most * sizes[s]}
        for s in full or open_:
            out[s] = float(most * sizes[s]) if full else unit * weights[s]
        if not full:
            break
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def length_prior(size: Column) -> Column:
    """Log-odds of a text by its size: a quarter for every doubling beyond 128 words, at least -1 and at most 1, in
    whole doublings, so that there are few cells."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 0.25 * (F.floor(F.log2(size + 1)) - 7)))


def _measured(docs: DataFrame, prior: Column | None) -> DataFrame:
    """Rows of ``docs`` as ``whole``, with source, size in words, prior log-odds and a hash of id, source and text."""
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), *([] if prior is None else [prior.cast("double").alias("prior")]))
    doc_id, source, text = F.col("whole.doc_id").cast("long"), F.col("whole.source").cast("string"), F.col("whole.text")
    whole = whole.select("*", source.alias("source"), word_count(text).alias("size"), F.xxhash64(doc_id, source, text).alias("key"))
    return whole if prior is not None else whole.withColumn("prior", length_prior(F.col("size")))


def sized(docs: DataFrame, prior: Column | None = None) -> DataFrame:
    """doc_id, source, size in words, the prior log-odds, a hash that names the document and its text, and a number of
    the row, all written down once."""
    plain = _measured(docs, prior).select(F.col("whole.doc_id").cast("long").alias("doc_id"), "source", "size", "prior", "key")
    return materialize(plain.withColumn("row", F.monotonically_increasing_id()), "mixing-sizes")


def ranked(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` (key, row, ...) with n, the number of rows of their key, and their rank from 0 among these. Only rows
    whose key is ``repeated`` (key, n) are shuffled, and numbered in chunks, so that no task meets a whole key."""
    sifted = sieve(rows, repeated)
    single = sifted.filter("NOT __hit").drop("__hit").withColumn("n", F.lit(1).cast("long")).withColumn("rank", F.lit(0).cast("long"))
    held = sifted.filter("__hit").drop("__hit").join(repeated, "key", "left").withColumn("n", F.coalesce("n", F.lit(1).cast("long")))
    held = held.withColumn("chunk", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / CHUNK)))
    before = F.sum("here").over(Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.groupBy("key", "chunk").agg(F.count("*").alias("here")).select("key", "chunk", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("key", "chunk").orderBy("row"))
    counted = held.withColumn("rank", place - 1).join(starts, ["key", "chunk"]).withColumn("rank", F.col("rank") + F.col("start"))
    return single.unionByName(counted.drop("chunk", "start"))


_STATE = "named string, target double, source_size long, tilt double, full double, way int, edge long"


@dataclass(frozen=True)
class Mix:
    """What a mix decides: by source, and by (key, rank) for the last changes, a few for each source at most."""

    target: dict[str | None, float]
    size: dict[str | None, int]
    tilt: dict[str | None, float]
    full: dict[str | None, float]
    most: int
    way: dict[str | None, int] = field(default_factory=dict)
    edge: dict[str | None, int] = field(default_factory=dict)
    extra: dict[tuple[int, int], int] = field(default_factory=dict)

    def state(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns of their source and their rate."""
        of = [(s, self.target[s], self.size[s], self.tilt[s], self.full.get(s), self.way.get(s, 0), self.edge.get(s, 0)) for s in self.target]
        out = rows.join(F.broadcast(rows.sparkSession.createDataFrame(of, _STATE)), F.col("source").eqNullSafe(F.col("named")), "left")
        return out.withColumn("rate", F.coalesce(F.col("full"), F.lit(float(self.most)) / (1 + F.exp(-(F.col("prior") + F.col("tilt"))))))

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` (source, size, prior, key, n and rank) with source_size, target, rate, copies, and ``turn``: the
        place in the order of trimming, null where a copy more (or less, by ``way``) is impossible."""
        u = F.shiftrightunsigned(F.xxhash64("key"), 11) / float(1 << 53)
        whole = F.floor("rate")
        copies = F.least(F.lit(self.most), whole + (F.col("rank") < F.floor(F.col("n") * (F.col("rate") - whole) + u)).cast("int"))
        out = self.state(rows).withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
        room = (F.col("size") > 0) & (F.col("copies") + F.col("way")).between(0, self.most) & F.col("full").isNull()
        out = out.withColumn("turn", F.when(room, F.shiftrightunsigned(F.xxhash64("key", "rank", F.lit("turn")), 64 - HASH_BITS)))
        out = out.withColumn("copies", F.col("copies") + F.when(F.col("turn") < F.col("edge"), F.col("way")).otherwise(0))
        given = rows.sparkSession.createDataFrame([(k, r, m) for (k, r), m in sorted(self.extra.items())], "given long, at long, more long")
        out = out.join(F.broadcast(given), (F.col("key") == F.col("given")) & (F.col("rank") == F.col("at")), "left")
        return out.withColumn("copies", F.greatest(F.lit(0), F.least(F.lit(self.most), F.col("copies") + F.coalesce("more", F.lit(0)))).cast("long"))


def solve(cells: DataFrame, goal: dict[str | None, float], sizes: dict[str | None, int], most: float = MOST, rounds: int = NEWTON) -> Mix:
    """The tilt of each source, or its fixed rate where the target is nothing or all. The dual falls apart by source,
    so its Hessian is diagonal; steps are damped to 2 and end when every constraint is met to one part in 10^9."""
    fixed = {s: 0.0 if goal[s] <= 0 else float(most) for s in goal if goal[s] <= 0 or goal[s] >= most * sizes[s]}
    tilt = {s: 0.0 if s in fixed else math.log(goal[s] / (most * sizes[s] - goal[s])) for s in goal}
    for _ in range(rounds):
        mix = Mix(goal, sizes, tilt, fixed, int(most))
        if len(fixed) == len(goal):
            return mix
        r = F.col("rate")
        sums = mix.state(cells).filter("full IS NULL").groupBy("source").agg(F.sum(F.col("tokens") * r).alias("g"), F.sum(F.col("tokens") * r * (1 - r / most)).alias("h"))
        found, off = sums.collect(), 0.0
        for x in found:
            miss = goal[x["source"]] - x["g"]
            off = max(off, abs(miss) / max(goal[x["source"]], 1.0))
        if off < 1e-9:  # rounded, so that the order of sums does not show
            return replace(mix, tilt={s: round(t, 10) for s, t in tilt.items()})
        tilt = tilt | {x["source"]: tilt[x["source"]] + max(-2.0, min(2.0, (goal[x["source"]] - x["g"]) / max(x["h"], 1e-12))) for x in found}
    raise RuntimeError(f"Newton iterations did not meet the targets: {off:.1e} of a target is missing")


def _missing(rows: DataFrame, mix: Mix) -> dict[str | None, float]:
    """Tokens that each open source still lacks (or has too many, if negative)."""
    sums = mix.apply(rows).filter("full IS NULL").groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    return {r["source"]: mix.target[r["source"]] - r["taken"] for r in sums}


def trimmed(rows: DataFrame, mix: Mix) -> Mix:
    """The mix with the edges that bring each source to its target, as near as the order of turns allows."""
    spark, miss = rows.sparkSession, _missing(rows, mix)
    mix = replace(mix, way={s: 1 if m > 0 else -1 for s, m in miss.items()})
    # state of the search: digits found so far, and what documents before them sum up to
    at, done = {s: (0, 0.0) for s in miss}, {}
    for low in range(HASH_BITS - DIGIT, -1, -DIGIT):
        if not at:
            break
        state = F.broadcast(spark.createDataFrame([(s, float(abs(miss[s])), p, b) for s, (p, b) in at.items()], "of string, want double, prefix long, before double"))
        turns = mix.apply(rows).filter("turn IS NOT NULL").select("source", "size", "turn").join(state, F.col("source").eqNullSafe(F.col("of")))
        inside = turns.filter(F.shiftright("turn", low + DIGIT) == F.col("prefix")).withColumn("digit", F.shiftright("turn", low))
        sums = inside.groupBy("source", "want", "before", "digit").agg(F.sum("size").alias("tokens"), F.count("*").alias("rows"))
        by = Window.partitionBy("source").orderBy("digit")
        run = sums.withColumn("upto", F.col("before") + F.sum("tokens").over(by)).filter("upto > want")
        first = run.withColumn("k", F.row_number().over(by)).filter("k = 1").select("source", "digit", "rows", (F.col("upto") - F.col("tokens")).alias("before"))
        found = {r["source"]: r for r in first.collect()}
        for s in list(at):
            r = found.get(s)
            if r is None:  # all that is left of the order fits
                done[s] = (at[s][0] + 1) << (low + DIGIT)
                del at[s]
            elif r["rows"] == 1 or low == 0:
                done[s] = r["digit"] << low
                del at[s]
            else:
                at[s] = (r["digit"], r["before"])
    return replace(mix, edge=done)


def _single(now: DataFrame, most: int) -> dict[str | None, list[tuple[int, int, int]]]:
    """By source the (key, rank, change) of the row whose size is nearest to what the source misses."""
    room = F.when(F.col("miss") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
    fits = now.filter(room & (F.col("size") < 2 * F.abs("miss")))
    nearest = F.min(F.struct(F.abs(F.abs("miss") - F.col("size")).alias("left"), "key", "rank")).alias("x")
    return {r["source"]: [(r["x"]["key"], r["x"]["rank"], 1 if r["miss"] > 0 else -1)] for r in fits.groupBy("source", "miss").agg(nearest).collect()}


def _swap(now: DataFrame, most: int) -> dict[str | None, list[tuple[int, int, int]]]:
    """By source the two rows, one to give and one to take a copy, whose sizes differ by what is nearest to the miss.
    Rows are reduced to one for each size first; then neighbours in a sorted order are the candidates."""
    of_size = lambda rows, value, kind: rows.groupBy("source", "miss", "size").agg(F.min(F.struct("key", "rank")).alias("x")).select("source", "miss", value.alias("v"), F.struct(F.lit(kind).alias("change"), "x.key", "x.rank").alias("x"))
    both = of_size(now.filter(F.col("copies") < most), F.col("size").cast("double"), 1).unionByName(of_size(now.filter("copies > 0"), F.col("size") + F.col("miss"), -1))
    by = Window.partitionBy("source").orderBy("v", "x")
    pairs = both.select("*", F.lag("v").over(by).alias("v0"), F.lag("x").over(by).alias("x0")).filter(F.col("x.change") != F.col("x0.change"))
    better = pairs.withColumn("left", F.col("v") - F.col("v0")).filter(F.col("left") + 0.5 < F.abs("miss"))
    found = better.groupBy("source").agg(F.min(F.struct("left", "x0", "x")).alias("p")).collect()
    return {r["source"]: [(x["key"], x["rank"], x["change"]) for x in (r["p"]["x0"], r["p"]["x"])] for r in found}


def _kick(now: DataFrame, most: int) -> dict[str | None, list[tuple[int, int, int]]]:
    """By source the row of the size nearest to the miss, though it overshoots."""
    room = F.when(F.col("miss") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
    nearest = F.min(F.struct(F.abs(F.abs("miss") - F.col("size")).alias("left"), "key", "rank")).alias("x")
    return {r["source"]: [(r["x"]["key"], r["x"]["rank"], 1 if r["miss"] > 0 else -1)] for r in now.filter(room).groupBy("source", "miss").agg(nearest).collect()}


def finished(rows: DataFrame, mix: Mix, rounds: int = LAST) -> Mix:
    """The mix with copies given or taken, of a row whose size is nearest to what a source misses or of two whose sizes
    differ by that, until no such change brings any source nearer. A source that is still off by more than ``CLOSE`` of
    its target, as one of few documents may be, then overshoots by one row and tries again, ``KICKS`` times; the nearest
    of what was found is taken."""
    spark = rows.sparkSession
    changes: dict[str | None, dict[tuple[int, int], int]] = {s: {} for s in mix.target}
    best: dict[str | None, tuple[float, dict]] = {}
    kicks = dict.fromkeys(mix.target, 0)
    for _ in range(rounds):
        miss = _missing(rows, mix)
        for s, m in miss.items():
            if s not in best or abs(m) < best[s][0]:
                best[s] = (abs(m), dict(changes[s]))
        left = {s: m for s, m in miss.items() if abs(m) >= 1 and best[s][0] >= 1}
        moved = False
        for change in (_single, _swap, _kick):
            if change is _kick:
                left = {s: m for s, m in left.items() if best[s][0] > CLOSE * mix.target[s] and kicks[s] < KICKS}
            if not left:
                break
            wanted = F.broadcast(spark.createDataFrame(list(left.items()), "of string, miss double"))
            found = change(mix.apply(rows).filter("size > 0 AND more IS NULL").join(wanted, F.col("source").eqNullSafe(F.col("of"))), mix.most)
            for s, made in found.items():
                moved = True
                changes[s] |= {(k, r): c for k, r, c in made}
                kicks[s] += change is _kick
            left = {s: m for s, m in left.items() if s not in found}
        mix = replace(mix, extra={at: c for of in changes.values() for at, c in of.items()})
        if not moved:
            return replace(mix, extra={at: c for _, of in best.values() for at, c in of.items()})
    raise RuntimeError("the last changes of the mix did not settle")


def decide(rows: DataFrame, repeated: DataFrame, weights: tuple[float, ...], budget: float, most: int, max_sources: int) -> tuple[Mix, DataFrame]:
    """The mix of sized rows, and these with n and rank; ``weights`` repeat along the sources by code points, null last."""
    cells = materialize(rows.groupBy("source", "prior").agg(F.sum("size").alias("tokens")), "mixing-cells")
    found = cells.groupBy("source").agg(F.sum("tokens").alias("tokens")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sizes = {r["source"]: int(r["tokens"]) for r in found}
    names = sorted((s for s in sizes if s is not None), key=lambda s: [*map(ord, s)]) + [None] * (None in sizes)
    goal = targets(sizes, {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}, budget, most)
    numbered = materialize(ranked(rows, repeated), "mixing-ranked")
    return finished(numbered, trimmed(numbered, solve(cells, goal, sizes, most))), numbered


def _repeated(rows: DataFrame) -> DataFrame:
    return materialize(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "mixing-repeated")


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST, prior: Column | None = None, max_sources: int = MAX_SOURCES) -> DataFrame:
    """doc_id, source, key, size, source_size, target (of the source), rate and copies for every row of ``docs``."""
    rows = sized(docs, prior)
    mix, numbered = decide(rows, _repeated(rows), weights, budget, most, max_sources)
    return mix.apply(numbered).select("doc_id", "source", "key", "size", "source_size", "target", "rate", "copies")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST, prior: Column | None = None, max_sources: int = MAX_SOURCES) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns. Only texts of repeated rows (and
    of a few that share their bit of the sieve) are shuffled."""
    rows = sized(docs, prior)
    repeated = _repeated(rows)
    mix, _ = decide(rows, repeated, weights, budget, most, max_sources)
    sifted = sieve(_measured(docs, prior), repeated)
    single = sifted.filter("NOT __hit").drop("__hit").withColumn("n", F.lit(1).cast("long")).withColumn("rank", F.lit(0).cast("long"))
    held = materialize(sifted.filter("__hit").drop("__hit").withColumn("row", F.monotonically_increasing_id()), "mixing-held")
    both = single.unionByName(ranked(held, repeated).drop("row"))
    copies = mix.apply(both).filter("copies > 0").select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("again"))
    return copies.select("whole.*")
