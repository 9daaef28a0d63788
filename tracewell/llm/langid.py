"""Language identification by hierarchical discrimination.

Texts become hashed counts of letter 1-, 2- and 3-grams (square roots, unit length). A first level of linear
support vector machines tells language families apart; within the family, one-versus-one machines separate the
languages, by votes and then by margins. Languages without a listed family are put into families of at most
``FAMILY_SIZE`` that lie near each other. All machines are squared-hinge SVMs, each trained in a task by accelerated
gradient steps on a bounded sample that all tasks share: an equal share of ``max_rows`` labelled texts for each language,
but ``MIN_EACH`` at least, chosen by a hash of the id and never from the held-out fold. Only ``text`` is an input of a
prediction.

Every value of ``lang`` that marks ``MIN_EACH`` labelled rows or more is a language, however rare; rarer values are taken
for dirt. ``MAX_LANGUAGES``, more than there are living languages, bounds what dirty tables could add: beyond it the
most frequent values are learned. So the sample has at most max_rows or MIN_EACH * MAX_LANGUAGES texts.

Edge cases: null and empty texts and texts without a letter are ``und`` with score 0; with one learned language
all others get it with score 1; without any, all are ``und``; texts of any length are read whole; repeated rows give a row each; rows with null ids or null
languages teach nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, small, texts_of

MAX_ROWS, BITS, RIDGE, STEPS, SALTS = 2_400, 12, 1e-4, 300, 8
#: Least rows of a language, most languages, and languages of an unlisted family.
MIN_EACH, MAX_LANGUAGES, FAMILY_SIZE = 4, 8_192, 12
# Families of common languages.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz".split(),
    "indic": "hi bn mr gu pa ur ne".split(),
    "semitic": "ar he mt am".split(),
}
UNKNOWN = "und"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def features(text: str, is_letter: np.ndarray, bits: int = BITS) -> np.ndarray | None:
    """The unit vector of a text, None if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = is_letter[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each run of letters
    x = np.where(letter, points, 32)[keep].astype(np.uint64)
    shift = np.uint64(64 - bits)
    grams = [x * _ODD[0]]
    if len(x) > 1:
        grams.append(grams[0][:-1] + x[1:] * _ODD[1])
    if len(x) > 2:
        grams.append(grams[1][:-1] + x[2:] * _ODD[2])
    counts = np.sqrt(np.bincount(np.concatenate([(g * _ODD[3]) >> shift for g in grams]).astype(np.int64), minlength=1 << bits))
    return (counts / np.linalg.norm(counts)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> np.ndarray:
    """Weights (the last one is the bias) of a squared-hinge SVM; y is -1 or 1 and both sides weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    side = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    w = v = np.zeros(x.shape[1], x.dtype)
    rate = 1 / (4 + ridge)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        fresh = v - rate * (ridge * v - 2 * x.T @ (side * y * slack))
        v = fresh + t / (t + 3) * (fresh - w)
        w = fresh
    return w


@dataclass(frozen=True)
class Model:
    """Families (each a sorted list of languages), the machines between families and those within each."""

    families: list[list[str]]
    between: tuple[list[tuple[int, int]], np.ndarray]
    within: list[tuple[list[tuple[int, int]], np.ndarray]]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        family, sure = _elect(*self.between, x, len(self.families))
        language, more = _elect(*self.within[family], x, len(self.families[family]))
        return self.families[family][language], min(sure, more)


def _elect(pairs: list[tuple[int, int]], weights: np.ndarray, x: np.ndarray, n: int) -> tuple[int, float]:
    """The class with most votes (then margin, then the first), and the chance of its closest contest."""
    if n == 1:
        return 0, 1.0
    margins = weights[:, :-1] @ x + weights[:, -1]
    votes, total = np.zeros(n), np.zeros(n)
    for (a, b), m in zip(pairs, margins):
        votes[a if m >= 0 else b] += 1
        total[a] += m
        total[b] -= m
    best = int(np.lexsort((np.arange(n), -total, -votes))[0])
    closest = min(m if a == best else -m for (a, b), m in zip(pairs, margins) if best in (a, b))
    return best, float(1 / (1 + np.exp(-3.0 * closest)))


def grouped(langs: list[str], centroids: dict[str, np.ndarray]) -> list[list[str]]:
    """Families: the listed ones, and of the other languages the first by name with those nearest to it, again and again."""
    family_of = {la: f for f, members in FAMILIES.items() for la in members}
    listed: dict[str, list[str]] = {}
    rest = []
    for la in sorted(langs):
        family = family_of.get(la.split("-")[0].lower())
        if family is None:
            rest.append(la)
        else:
            listed.setdefault(family, []).append(la)
    out = [listed[f] for f in sorted(listed)]
    while rest:
        near = sorted(rest[1:], key=lambda la: (-round(float(centroids[la] @ centroids[rest[0]]), 6), la))
        # a pair of very unlike languages is better told apart between families
        own = [rest[0], *[la for la in near[: FAMILY_SIZE - 1] if len(rest) > FAMILY_SIZE]]
        out.append(sorted(own))
        rest = [la for la in rest if la not in own]
    return out


def _machines(spark: SparkSession, x: np.ndarray, levels: list[np.ndarray]) -> list[tuple[list[tuple[int, int]], np.ndarray]]:
    """For each level (classes of the rows, -1 for none) all pairs of its classes and their machines. The sample is
    broadcast, its size is bounded; each machine is trained in a task."""
    pairs = [(k, a, b) for k, classes in enumerate(levels) for a, b in combinations(range(int(classes.max(initial=-1)) + 1), 2)]
    shared = spark.sparkContext.broadcast((x, levels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, levels = shared.value
        for batch in batches:
            rows = batch.to_pylist()
            made = []
            for r in rows:
                classes = levels[r["level"]]
                own = (classes == r["a"]) | (classes == r["b"])
                made.append(svm(x[own], np.where(classes[own] == r["a"], 1, -1).astype(x.dtype)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "w": pa.array(made, pa.binary())})

    weights: dict[int, bytes] = {}
    if pairs:
        todo = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id int, level int, a int, b int").repartition(min(len(pairs), 256), "id")
        weights = {r["id"]: r["w"] for r in todo.mapInArrow(run, "id int, w binary").collect()}
    out = []
    for k in range(len(levels)):
        of = [(i, p[1:]) for i, p in enumerate(pairs) if p[0] == k]
        out.append(([p for _, p in of], np.array([np.frombuffer(weights[i], np.float32) for i, _ in of])))
    shared.destroy()
    return out


def training_rows(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """text and lang of max_rows documents at most (or MIN_EACH a language), evenly by language, first by a hash of the
    id. A language is ranked in salted parts first, so that no task meets more than SALTS shares of it."""
    known = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"))).select("doc_id", "lang")
    sizes = known.groupBy("lang").agg(F.count("*").alias("rows"))
    langs = [r["lang"] for r in sizes.filter(F.col("rows") >= MIN_EACH).orderBy(F.desc("rows"), "lang").limit(MAX_LANGUAGES).collect()]
    share = max(MIN_EACH, max_rows // max(1, len(langs)))
    known = known.join(F.broadcast(docs.sparkSession.createDataFrame([(la,) for la in langs], "lang string")), "lang")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    salted = known.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("salt")), F.lit(SALTS)))
    first = salted.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("r") <= share)
    last = first.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("r") <= share)
    ids = last.select("doc_id", F.col("lang").alias("l")).distinct()
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").filter("lang = l").select("doc_id", "text", "lang")
    return rows.orderBy(*order, F.xxhash64("text")).limit(max(max_rows, share * len(langs)))  # ids that repeat with other texts must not pass the bound


def learn(docs: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    """The machines, or None where nothing can be learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for b in small(batches):
            rows = [(i, la, f.tobytes()) for i, la, t in zip(b.column("doc_id").to_pylist(), b.column("lang").to_pylist(), texts_of(b)) if (f := features(t, is_letter)) is not None]
            ids, langs, vectors = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "lang": pa.array(langs, pa.string()), "x": pa.array(vectors, pa.binary())})

    rows = training_rows(docs, max_rows).withColumn("doc_id", F.col("doc_id").cast("long"))
    got = rows.mapInArrow(run, "doc_id long, lang string, x binary").toArrow()
    if not got.num_rows:
        return None
    raw = sorted(zip(got["doc_id"].to_pylist(), got["lang"].to_pylist(), got["x"].to_pylist()))
    x = np.frombuffer(b"".join(r[2] for r in raw), np.float32).reshape(len(raw), -1)
    langs = [r[1] for r in raw]
    centroids = {la: x[[i for i, own in enumerate(langs) if own == la]].mean(0) for la in set(langs)}
    families = grouped(sorted(set(langs)), centroids)
    place = {la: (i, j) for i, members in enumerate(families) for j, la in enumerate(members)}
    at = np.array([place[la] for la in langs])
    levels = [at[:, 0], *[np.where(at[:, 0] == i, at[:, 1], -1) for i in range(len(families))]]
    between, *within = _machines(docs.sparkSession, x, levels)
    return Model(families, between, within)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs``. The model is broadcast; its size is bounded by the number
    of learned languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, model = letters(), shared.value
        for b in small(batches):
            found = [(UNKNOWN, 0.0) if model is None or (f := features(t, is_letter)) is None else model.predict(f) for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
