"""Personal data by weak supervision.

Base patterns find e-mail addresses, IPv4 addresses, card numbers and phone numbers. Broader patterns propose
further spans (account numbers, IBANs, national phone numbers, secrets, and what is assigned to a private word). Labelers of three sorts vote on every
span, base or proposed: *regex* (strict shape, length, check digits, character mix), *gazetteer* (words that
name private fields, words that name harmless numbers) and *context* (assignment or quotes before the span,
units after it). The votes of the whole corpus are counted by pattern; expectation-maximisation over these
counts estimates each labeler's reliability and each pattern's posterior. A logistic span classifier, which sees
the span and its surroundings but no votes (kind, length, classes and variety of characters, words and marks on both
sides, hashed), is trained with the posteriors as soft labels and decides on the proposed spans, those on which all
labelers abstain included. Base spans stay.

The table of vote patterns is bounded by kinds x 3^labelers whatever the corpus, so it is fitted on the driver. The
classifier is fitted on at most ``MAX_SPANS`` spans, a like number of each kind, chosen by a hash.

Edge cases: a null text counts as empty and has no spans; an empty table or one without any span gives a
result without added spans; texts of any length are scanned whole; repeated rows give a row each; a null doc_id
stays null; other columns are not read (``redact`` keeps them as they are).
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small, texts_of, tidy

BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "iban", "national_phone", "secret")
KINDS = BASE + ADDED
THRESHOLD = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match always starts a run of digits; saying so keeps long runs from being tried from each of their digits.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_PROPOSED = {
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "national_phone": re.compile(r"(?<![\w+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?!\w)"),
    "secret": re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*[0-9])(?=[0-9_+/=-]*[A-Za-z])[A-Za-z0-9_+/-]{12,}={0,2}"),
    "account": re.compile(r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){7,}(?!\w)(?!\.[0-9])"),
}
#: What is assigned, without the marks that end a sentence.
_ASSIGNED = re.compile(r"[=:]+\s*[\"']?([^\s\"'`<>,;=:]{3,256}[^\s\"'`<>,;=:.!?)\]}])")
_ASSIGNED_TO = re.compile(r"([A-Za-z]+)[\"']?\s*$")

# Words that name a private field, and words that name a harmless number.
PRIVATE_WORDS = frozenset("token password passwd pwd secret key apikey api auth bearer credential tel telephone phone call mobile fax cell whatsapp iban account konto cuenta compte card visa ssn passport license email mail contact login".split())
#: Private words whose values may be of letters alone; values of the others have a digit.
SECRET_WORDS = frozenset("token password passwd pwd secret key apikey api auth bearer credential login".split())
HARMLESS_WORDS = frozenset("version v page pages isbn issn doi fig figure chapter section table year vol volume no nr issue build commit revision rfc http https www".split())
_BEFORE_WORDS = re.compile(r"[A-Za-z]+")
_UNIT = re.compile(r"\s?(?:%|€|\$|£|km|kg|m\b|cm|mm|px|ms\b|°)")
LABELERS = ("shape", "check", "mix", "private_word", "harmless_word", "assigned", "unit")
SCHEMA = "doc_id long, base array<struct<kind:int,at:int,upto:int>>, proposed array<struct<kind:int,at:int,upto:int,feats:array<int>>>, seen array<struct<kind:int,votes:string,feats:array<int>>>"
#: Spans that the classifier is fitted on at most, and hashed features.
MAX_SPANS, DIMS = 8_000, 1_024
_WORD = re.compile(r"[^\W\d_]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start, in code points."""
    out = [(0, a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def assigned_spans(text: str) -> Iterator[tuple[int, int]]:
    """Values that are assigned to a private word."""
    for m in _ASSIGNED.finditer(text):
        word = _ASSIGNED_TO.search(text[max(0, m.start() - 24) : m.start()])
        if word and ((w := word.group(1).lower()) in SECRET_WORDS or w in PRIVATE_WORDS and len(m.group(1)) > 4 and _DIGIT.search(m.group(1))):
            yield m.span(1)


def proposed_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the broader patterns that meet no base span and no earlier proposal."""
    digits = _DIGIT.search(text) is not None
    used, out = sorted((a, b) for _, a, b in taken), []
    proposals = [(name, (m.span() for m in pattern.finditer(text))) for name, pattern in _PROPOSED.items() if digits]
    for name, spans in [*proposals, ("secret", assigned_spans(text))]:
        found = list(spans)
        fresh, k, used = [], 0, sorted(used)
        reach = -1  # the furthest end of the spans that start before a
        for a, b in found:
            while k < len(used) and used[k][0] < b:
                reach = max(reach, used[k][1])
                k += 1
            if reach <= a:
                fresh.append((a, b))
        used += fresh
        out += [(KINDS.index(name), a, b) for a, b in fresh]
    return sorted(out)


def votes(text: str, kind: int, a: int, b: int) -> str:
    """One character a labeler: + for private, - for harmless, 0 for no opinion."""
    span, name, digits = text[a:b], KINDS[kind], _digits(text[a:b])
    before = text[max(0, a - 24) : a]
    words = [w.lower() for w in _BEFORE_WORDS.findall(before)][-3:]
    shape = name in BASE or name in ("iban", "national_phone") or name == "secret" and len(span) >= 20
    check = "0"
    if name == "iban":
        rolled = span.replace(" ", "")
        rolled = rolled[4:] + rolled[:4]
        check = "+" if int("".join(str(int(c, 36)) for c in rolled)) % 97 == 1 else "-"
    elif name in ("card", "account") and 13 <= len(digits) <= 19:
        check = "+" if luhn(digits) else "-"
    kinds_of = len(set(span))
    mix = "+" if name == "secret" and kinds_of >= 9 or name in BASE else "-" if kinds_of <= 3 else "0"
    return "".join((
        "+" if shape else "0",
        check,
        mix,
        "+" if PRIVATE_WORDS.intersection(words) else "0",
        "-" if HARMLESS_WORDS.intersection(words[-2:]) else "0",
        "+" if before.rstrip(" \"'").endswith(("=", ":")) else "0",
        "-" if _UNIT.match(text, b) else "0",
    ))


def _shape(span: str) -> str:
    """Classes of the characters, each run once, the first eight: 9 digit, A and a letters, marks as they are."""
    out = ""
    for c in span:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if out[-1:] != k:
            out += k
            if len(out) == 8:
                break
    return out


def features(text: str, kind: int, a: int, b: int) -> list[int]:
    """Places of the features of a span and its surroundings."""
    span, name = text[a:b], KINDS[kind]
    before, after = text[max(0, a - 40) : a], text[b : b + 24]
    if a > 40:  # the first word may be cut
        before = before[before.find(" ") + 1 :]
    words = [w.lower() for w in _WORD.findall(before)][-3:][::-1]
    following = [w.lower() for w in _WORD.findall(after)][:1]
    n, letters = len(span), Counter(span)
    entropy = -sum(c / n * math.log2(c / n) for c in letters.values())
    share = lambda test: int(4 * sum(c for x, c in letters.items() if test(x)) / n)
    found = [
        f"kind {name}",
        f"length {name} {min(n, 64) // 4}",
        f"shape {name} {_shape(span)}",
        f"digits {name} {share(str.isdigit)}",
        f"upper {share(str.isupper)}",
        f"entropy {name} {int(2 * entropy)}",
        f"left {before.rstrip()[-1:]}",
        f"right {after.lstrip()[:1]}",
        *(f"before{i} {w}" for i, w in enumerate(words)),
        *(f"near {w}" for w in words),
        *(f"after {w}" for w in following),
    ]
    return sorted({zlib.crc32(f.encode()) % DIMS for f in found})


def scan(docs: DataFrame) -> DataFrame:
    """A row of SCHEMA for each row: base spans, proposed spans with their features, and votes and features of all."""
    span = pa.struct([("kind", pa.int32()), ("at", pa.int32()), ("upto", pa.int32())])
    places = ("feats", pa.list_(pa.int32()))
    voted = pa.struct([*span, places])
    seen = pa.struct([("kind", pa.int32()), ("votes", pa.string()), places])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            columns: tuple[list, list, list] = ([], [], [])
            for t in texts_of(b):
                base = base_spans(t)
                more = proposed_spans(t, base)
                feats = [features(t, *s) for s in more]
                columns[0].append([dict(kind=k, at=x, upto=y) for k, x, y in base])
                columns[1].append([dict(kind=k, at=x, upto=y, feats=f) for (k, x, y), f in zip(more, feats)])
                columns[2].append([dict(kind=s[0], votes=votes(t, *s), feats=f) for s, f in zip(base + more, [features(t, *s) for s in base] + feats)])
            types = (pa.list_(span), pa.list_(voted), pa.list_(seen))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], ["doc_id", "base", "proposed", "seen"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def reliabilities(counts: np.ndarray, patterns: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over counted vote patterns (columns: labelers; values 0, 1, 2 for -, 0, +).

    Returns each pattern's posterior of being private and the labelers' vote probabilities [class, labeler, vote].
    It starts from the majority of the votes, and small counts are smoothed towards labelers better than chance.
    """
    lead = (patterns - 1).sum(1)
    post = 1 / (1 + np.exp(-1.5 * lead))
    prior_votes = np.array([[2.0, 2.0, 1.0], [1.0, 2.0, 2.0]])
    for _ in range(rounds):
        table = np.empty((2, patterns.shape[1], 3))
        for c, weight in enumerate((counts * (1 - post), counts * post)):
            for k in range(patterns.shape[1]):
                table[c, k] = np.bincount(patterns[:, k], weight, 3) + prior_votes[c]
        table /= table.sum(2, keepdims=True)
        share = np.clip((counts * post).sum() / counts.sum(), 0.01, 0.99)
        odds = np.log(share / (1 - share)) + sum(np.log(table[1, k, patterns[:, k]] / table[0, k, patterns[:, k]]) for k in range(patterns.shape[1]))
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, table


def span_classifier(feats: list[list[int]], counts: np.ndarray, post: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weights (the last is the bias) of a ridge-penalised logistic regression on soft labels, by Newton steps."""
    x, w = np.zeros((len(feats), DIMS + 1)), np.zeros(DIMS + 1)
    for row, places in zip(x, feats):
        row[places] = 1
    x[:, -1] = 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (p - post)) + w
        hess = (x * (counts * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.round(w, 9)


def fit(scanned: DataFrame, max_spans: int = MAX_SPANS) -> np.ndarray | None:
    """Weights of the span classifier, None where there is nothing to learn from. Votes are counted over all spans; the
    spans on which all labelers abstain say nothing and are left out of the classifier's sample."""
    spans = scanned.select(F.explode("seen").alias("s")).select("s.*")
    rows = sorted((r["kind"], r["votes"], r["count"]) for r in spans.groupBy("kind", "votes").count().collect())
    if not rows:
        return None
    counts = np.array([r[2] for r in rows], float)
    patterns = np.array([["-0+".index(v) for v in r[1]] for r in rows])
    post, _ = reliabilities(counts, patterns)
    of = {(r[0], r[1]): float(p) for r, p in zip(rows, post)}
    silent = "0" * len(LABELERS)
    each = {k: sum(n for kind, v, n in rows if kind == k and v != silent) for k in range(len(KINDS))}
    share = max(1, max_spans // len(KINDS))
    # like spans count together before the sample, whose bound is the number of different ones
    like = spans.filter(F.col("votes") != silent).groupBy("kind", "votes", "feats").agg(F.count("*").alias("n"))
    h = F.xxhash64("kind", "votes", "feats")
    rate = F.element_at(F.create_map(*[F.lit(x) for k, n in each.items() for x in (k, min(1.0, share / max(n, 1)))]), F.col("kind"))
    chosen = like.filter(F.shiftrightunsigned(h, 11) / float(1 << 53) < F.greatest(rate, F.lit(0.0))).orderBy(h, "kind", "votes", "feats").limit(max_spans).collect()
    if not chosen:
        return None
    weights = np.array([min(r["n"], share) for r in chosen], float)
    return span_classifier([r["feats"] for r in chosen], weights / weights.sum() * min(weights.sum(), 10_000), np.array([of[r["kind"], r["votes"]] for r in chosen]))


def private(weights: np.ndarray | None, feats: list[int], threshold: float = THRESHOLD) -> bool:
    """Whether the classifier takes a span for personal data."""
    return weights is not None and 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[feats].sum() + weights[-1]))))) >= threshold


def _rendered(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans ("kind:start:end", by kind and start)."""
    scanned = materialize(scan(docs), "pii-scan")
    weights = fit(scanned)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            rows = []
            for base, more in zip(b.column("base").to_pylist(), b.column("proposed").to_pylist()):
                spans = [(s["kind"], s["at"], s["upto"]) for s in base]
                added = [(s["kind"], s["at"], s["upto"]) for s in more if private(weights, s["feats"], threshold)]
                n = [sum(k == i for k, _, _ in spans) for i in range(len(BASE))]
                rows.append((*n, hashlib.sha256(_rendered(spans).encode()).hexdigest(), _rendered(spans + added)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], NAMES)

    return scanned.select("doc_id", "base", "proposed").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the union by its first kind."""
    out, done = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= done:
            out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (and ``n_chars`` set anew where there is one)."""
    scanned = materialize(scan(docs).select("doc_id", "seen"), "pii-seen")
    weights = fit(scanned)

    def clean(t: str) -> str:
        base = base_spans(t)
        more = [s for s in proposed_spans(t, base) if private(weights, features(t, *s), threshold)]
        return redacted(t, base + more) if base or more else t

    return map_text(docs, clean)


def map_text(docs: DataFrame, change: Callable[[str], str]) -> DataFrame:
    at, size = docs.columns.index("text"), next((i for i, c in enumerate(docs.columns) if c == "n_chars"), None)
    long_type = docs.schema["n_chars"].dataType.simpleString() if size is not None else ""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            texts = [None if t is None else change(t) for t in b.column(at).to_pylist()]
            columns = list(b.columns)
            columns[at] = pa.array(texts, pa.string())
            if size is not None:
                fresh = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                columns[size] = fresh.cast(pa.int32() if long_type == "int" else pa.int64())
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return docs.mapInArrow(run, docs.schema)
