"""Toxicity by a weighted finite-state pattern grammar.

A text is read as clauses of lower-case words. Each word is a terminal of the grammar: an *insult* (a whole word or a
word beginning) of one of three strengths, a *threat*, an everyday word that can be either (trash, to beat), a *target*,
a *link* (are, such a), a *negation* or a *report* (said, quoted ...); all else is a filler. Four sequential
transducers, each a table of (state, symbol) to (state, symbols out), are composed into one by the product of their
states:

* *report* marks insults and threats that follow a report word, or stand in a quotation that one opened;
* *negation* marks those after a negation;
* *target* marks as addressed: insults near a target, before or after; threats with a target soon after; everyday
  insults that links join to a target, and everyday insults and verbs right before one. Other insults are bare;
* *pile* passes on a bare insult that follows another insult in its clause (piled), and drops the first of a clause,
  unless ``SPREAD`` clauses before it had a bare insult too, and ``SPREAD`` of these clauses and its own one that is
  no everyday word (spread: the text goes on insulting).

The composed machine turns a text into weighted matches: addressed, piled, spread, negated and reported ones. A clause
ends all marks, quotations included. So one or two lone insults without a target match nothing, however strong.

The insult terminals and the weights of the outputs are learned from labelled rows: at most ``max_rows`` of them
(chosen by a hash, whatever the size of the corpus) and never from the held-out fold. Terminals are words and word
beginnings whose log-odds of standing in a toxic text are certain enough; the output weights are a logistic
regression on the matches of a text, with ``PRIOR`` clauses as further rows, so that kinds of match that the labels
never show keep their sense. Only ``text`` is an input of a score.

Edge cases: null and empty texts have no clause and get the score of a text without a match; without labelled
rows (or with one label only) the listed terminals and default output weights hold; texts of any length are read
whole; repeated rows give a row each; a null doc_id counts as held out; label rows of the same document count
once, toxic if any says so; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, small, texts_of, tidy

MAX_ROWS, THRESHOLD = 8_000, 0.3
#: A learned terminal's least count and share of toxic texts, least log-odds, and least log-odds over their error.
MIN_TOXIC, MIN_SHARE, MIN_ODDS, MIN_SURE = 4, 0.015, 3.0, 3.2
STEMS = range(3, 9)
#: Words of a clause after a negation, on either side of a target, after a report.
REACH_NEGATION, REACH_TARGET, REACH_REPORT = 3, 4, 8
#: Words between an attack that needs a target after it and that target, and clauses with a bare insult that don't match.
REACH_AFTER, SPREAD = {"h": 1, "g": 1, "k": 3}, 2
#: Weights of the insult terminals i0, i1 and i2, with the least log-odds of each, and of a threat.
STRENGTHS, LEAST_ODDS, THREAT = (3.0, 5.0, 8.0), (0.0, 4.0, 6.5), 8.0

# Terminals known without labels.
INSULTS = "idiot moron stupid worthless pathetic disgusting scum loser imbecile dumbass scumbag".split()
THREATS = "kill destroy stab strangle murder umbringen töten tuer matar".split()
EVERYDAY_INSULTS, EVERYDAY_VERBS = "trash clown garbage pig joke".split(), "hurt beat shoot burn frapper golpear".split()
LINKS = "are is am be was were a an such another piece of bist ist seid sind ein eine es eres est un una une son".split()
TARGETS = "you you're your yours u he she they him her them these those du dich dir ihr euch sie tu toi te vous vos usted ustedes ellos ti".split()
NEGATIONS = "not never no isn't aren't wasn't don't nicht kein keine nie pas jamais ne nunca jamás ni".split()
REPORTS = "said says say called calls wrote reported quoted claimed alleged sagte nannte dit écrit dijo llamó".split()
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;\n…\"„“”«»]")
_END = frozenset(".!?;\n…")
QUOTES = '"„“”«»'
ATTACKS = ("h", "g", "i0", "i1", "i2", "k")
#: What the grammar reads: filler, link, target, negation, report, end of a clause, quotation marks, everyday insults and
#: verbs, insults and a threat.
TERMINALS = ("x", "l", "t", "n", "r", ".", *QUOTES, *ATTACKS)
OUTPUTS = ("addressed", "piled", "spread", "negated", "reported", "rate", "one")
MATCHES = OUTPUTS[:5]
DEFAULT_WEIGHTS = np.array([2.4, 1.5, 1.0, 0.1, 0.2, 0.3, -3.0])
#: Clauses of known sense that stand beside the labelled rows, each with this share of their weight.
PRIOR = (("you idiot", 1), ("we will kill you", 1), ("idiot idiot", 1), ("idiot. idiot", 0), ("not you idiot", 0), ("said you idiot", 0), ("said we will kill you", 0), ("never kill you", 0), ("", 0))
PRIOR_SHARE = 0.02

State, Symbol = object, str
Step = Callable[[State, Symbol], tuple[State, tuple[Symbol, ...]]]


@dataclass(frozen=True)
class Transducer:
    """A sequential transducer as a table; it starts in state 0."""

    arcs: dict[tuple[int, Symbol], tuple[int, tuple[Symbol, ...]]]

    @classmethod
    def build(cls, start: State, step: Step, symbols: Iterable[Symbol]) -> Transducer:
        """The table of a step rule over all states that ``symbols`` reach."""
        symbols, number, todo, arcs = tuple(symbols), {start: 0}, [start], {}
        while todo:
            state = todo.pop()
            for a in symbols:
                after, out = step(state, a)
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                arcs[number[state], a] = (number[after], out)
        return cls(arcs)

    def symbols(self) -> list[Symbol]:
        return sorted({a for _, a in self.arcs})

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one puts out, the other reads."""

        def step(state: tuple[int, int], a: Symbol) -> tuple[tuple[int, int], tuple[Symbol, ...]]:
            first, passed = self.arcs[state[0], a]
            second, out = state[1], ()
            for b in passed:
                second, more = other.arcs[second, b]
                out += more
            return (first, second), out

        return Transducer.build((0, 0), step, self.symbols())

    def read(self, text: Iterable[Symbol]) -> list[Symbol]:
        state, out = 0, []
        for a in text:
            state, more = self.arcs[state, a]
            out += more
        return out


def _report(state: tuple[int, str], a: Symbol) -> tuple[tuple[int, str], tuple[Symbol, ...]]:
    """State: words for which a report still holds, and the mark that opened a quotation. Puts out r + attack."""
    reach, opened = state
    if a == ".":
        return (0, ""), (a,)
    if a in QUOTES:
        if opened:
            closes = a == "“" if opened == "„" else a not in "„“«"
            return ((0, "") if closes else state), ()
        return ((0, "„" if a == "„" else '"') if reach and a not in "”»" else state), ()
    held = bool(reach or opened)
    after = (0 if opened else max(reach - 1, 0), opened)
    if a == "r":
        return (after if opened else (REACH_REPORT, "")), ("x",)
    return after, ("r" + a if held and a in ATTACKS else a,)


def _negation(reach: int, a: Symbol) -> tuple[int, tuple[Symbol, ...]]:
    """State: words for which a negation still holds. Puts out n + attack."""
    if a == ".":
        return 0, (a,)
    if a == "n":
        return REACH_NEGATION, ("x",)
    return max(reach - 1, 0), ("n" + a if reach and a in ATTACKS else a,)


def _target(state: tuple[int, str, bool], a: Symbol) -> tuple[tuple[int, str, bool], tuple[Symbol, ...]]:
    """State: words for which a target or a waiting attack still holds, that attack, and whether only links stand since
    the target. Puts out a + attack where it is addressed, b + insult where it is bare; an attack that waits ends the
    reach of the target before it."""
    reach, waiting, linked = state
    lapsed = ("b" + waiting,) if waiting[:1] in ("i", "h") else ()
    if a == ".":
        return (0, "", False), (*lapsed, a)
    if a == "t":
        return (REACH_TARGET, "", True), ("a" + waiting,) if waiting else ()
    if a in ATTACKS:
        if reach and not waiting and (a[0] == "i" or a == "h" and linked):
            return (reach - 1, "", False), ("a" + a,)
        return (REACH_AFTER.get(a, REACH_TARGET), a, False), lapsed
    out = () if a in ("x", "l") else (a,)
    if reach > 1:
        return (reach - 1, waiting, linked and a == "l"), out
    return (0, "", False), (*(lapsed if reach else ()), *out)


def _pile(state: tuple[bool, int, int], a: Symbol) -> tuple[tuple[bool, int, int], tuple[Symbol, ...]]:
    """State: whether the clause had an insult that is neither negated nor reported, and in how many clauses (up to
    SPREAD each) the first one was bare, and bare and no everyday word. Puts out p + insult or s + insult."""
    had, clauses, hard = state
    if a == ".":
        return (False, clauses, hard), (a,)
    if a[0] == "b":
        if had:
            return state, ("p" + a[1:],)
        strong = min(SPREAD, hard + (a != "bh"))
        return (True, min(SPREAD, clauses + 1), strong), ("s" + a[1:],) if clauses == SPREAD and strong == SPREAD else ()
    return (had or a[:2] in ("ai", "ah"), clauses, hard), (a,)


def grammar_machine() -> Transducer:
    """The four transducers composed."""
    machine = Transducer.build((0, ""), _report, TERMINALS)
    marked = [*TERMINALS, *["r" + a for a in ATTACKS]]
    for start, step in ((0, _negation), ((0, "", False), _target), ((False, 0, 0), _pile)):
        machine = machine.then(Transducer.build(start, step, marked))
        marked += [c + a for a in ATTACKS for c in "nab" if c + a not in marked]
    return machine


def _tables() -> tuple[list[int], list[tuple]]:
    """The composed machine by state * symbols + symbol: next state (times symbols), and (output, weight) pairs. A few
    thousand entries, which travel to the tasks with a reader's grammar."""
    machine, width = grammar_machine(), len(TERMINALS)
    weight = dict(zip(ATTACKS, (STRENGTHS[0], THREAT, *STRENGTHS, THREAT)))
    output = {m[0]: k for k, m in enumerate(MATCHES)}
    size = width * (1 + max(s for s, _ in machine.arcs))
    after, put = [0] * size, [()] * size
    for (state, a), (to, out) in machine.arcs.items():
        at = state * width + TERMINALS.index(a)
        after[at], put[at] = to * width, tuple((output[b[0]], weight[b[1:]]) for b in out if b[1:] in weight)
    return after, put


def strength(odds: float) -> int:
    """The insult terminal of a word with these log-odds."""
    return max(k for k, least in enumerate(LEAST_ODDS) if odds >= least)


@dataclass(frozen=True)
class Grammar:
    """Insult terminals (words, and beginnings that end in *) with log-odds, and the weights of the outputs."""

    insults: dict[str, float]
    weights: np.ndarray
    tables: tuple[list[int], list[tuple]] = field(default_factory=_tables, repr=False)

    def reader(self) -> Reader:
        return Reader(self)


class Reader(dict):
    """Words to places in TERMINALS. Remembers what it has seen, up to a bound."""

    def __init__(self, grammar: Grammar):
        super().__init__()
        self.words = {w: v for w, v in grammar.insults.items() if not w.endswith("*")}
        self.stems = {w[:-1]: v for w, v in grammar.insults.items() if w.endswith("*")}
        self.sizes = sorted({len(s) for s in self.stems})
        self.everyday = {w: TERMINALS.index(a) for a, words in (("h", EVERYDAY_INSULTS), ("g", EVERYDAY_VERBS)) for w in words}
        listed = {"l": LINKS, "n": NEGATIONS, "t": TARGETS, "r": REPORTS, "k": THREATS, ".": _END}
        self.fixed = {w: TERMINALS.index(a) for a, words in listed.items() for w in words} | {c: TERMINALS.index(c) for c in QUOTES}
        self.weights = grammar.weights
        self.first_attack, self.end = TERMINALS.index(ATTACKS[0]), TERMINALS.index(".")
        self.after, self.put = grammar.tables

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        if word in self.everyday:  # whatever has been learned about it
            self[word] = self.everyday[word]
            return self[word]
        best = max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in self.sizes if len(word) > n)])
        found = TERMINALS.index(f"i{strength(best)}") if best else self.fixed.get(word.replace("’", "'"), 0)
        self[word] = found
        return found

    def matches(self, text: str) -> tuple[list[float], int, int]:
        """Weight of the matches by MATCHES, number of addressed, piled and spread ones, and number of clauses."""
        marks = [self[w] for w in _TOKEN.findall(text.lower())]
        sums, hits = [0.0] * len(MATCHES), 0
        if max(marks, default=0) < self.first_attack:
            return sums, 0, 1
        after, put, at = self.after, self.put, 0
        marks.append(self.end)
        for m in marks:
            m += at
            at = after[m]
            if put[m]:
                for k, w in put[m]:
                    sums[k] += w
                    hits += k < 3
        return sums, hits, marks.count(self.end)

    def outputs(self, text: str) -> np.ndarray:
        """By OUTPUTS: the logarithms of the weights of matches and of the matches a clause, and one."""
        sums, hits, clauses = self.matches(text)
        return np.array([*map(math.log1p, sums), math.log1p(20 * hits / clauses), 1.0])

    def score(self, text: str) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.outputs(text) @ self.weights))))))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """text and toxic of at most ``max_rows`` labelled rows outside the held-out fold, first by a hash of their ids and
    texts; exact copies of a text count once."""
    marked = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    # ids that repeat with other texts must not pass the bound: a second limit, by digests, which combine before the shuffle
    once = rows.groupBy(F.sha2("text", 256).alias("h")).agg(F.max(F.struct("toxic", "text")).alias("x"))
    return once.orderBy("h").limit(max_rows).repartition(16).select("x.toxic", "x.text")


def learned_terms(rows: DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Words and beginnings that stand in toxic texts for certain more often than in others, with their log-odds. What
    is collected is bounded by the rows: each term stands in ``MIN_SHARE`` of the toxic texts at least."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
        found = (Counter(), Counter())
        for b in small(batches):
            for t, toxic in zip(texts_of(b), b.column("toxic").to_pylist()):
                words = set(word.findall(t.lower()))
                terms = {w for w in words if len(w) > 2}
                terms.update(w[:n] + "*" for w in words for n in STEMS if len(w) > n)
                found[toxic].update(terms)
        names = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), "toxic": pa.array([found[1][w] for w in names], pa.int64()), "clean": pa.array([found[0][w] for w in names], pa.int64())})

    counts = rows.mapInArrow(run, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).filter(F.col("a") >= max(MIN_TOXIC, MIN_SHARE * n_toxic))
    odds = F.log((F.col("a") + 0.5) / (n_toxic - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n_clean - F.col("b") + 0.5))
    sure = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    found = counts.select("term", "a", "b", odds.alias("odds"), sure.alias("sure")).filter((F.col("sure") >= MIN_SURE) & (F.col("odds") >= MIN_ODDS)).orderBy(F.desc("sure"), "term").collect()
    by = {r["term"]: r for r in found}
    dropped = set()
    for r in found:  # of nested terms with nearly the same toxic texts the longer stays, else the longer goes unless it is clearly surer
        stem = r["term"].rstrip("*")
        shorter = [by[t] for n in STEMS if n < len(stem) and (t := stem[:n] + "*") in by]
        if r["term"] == stem and stem + "*" in by:
            shorter.append(by[stem + "*"])
        for s in shorter:
            if r["a"] >= 0.95 * s["a"]:
                dropped.add(s["term"])
            elif s["odds"] >= r["odds"] - 0.7:
                dropped.add(r["term"])
    surest = [r for r in found if r["term"] not in dropped]
    for s in surest:  # what a beginning matches besides its surer continuations must be sure enough by itself
        stem = s["term"].rstrip("*")
        inner = [r for r in surest if s["term"] != stem and r["term"].startswith(stem) and r["term"] != s["term"] and r["odds"] > s["odds"] + 0.7]
        a, b = (max(0, s[k] - sum(r[k] for r in inner)) + 0.5 for k in "ab")
        rest = math.log(a / (n_toxic - a + 1)) - math.log(b / (n_clean - b + 1))
        if inner and (rest < MIN_ODDS or rest / math.sqrt(1 / a + 1 / b) < MIN_SURE):
            dropped.add(s["term"])
    kept = [r for r in found if r["term"] not in dropped]
    return {r["term"]: round(min(float(r["odds"]), 8.0), 4) for r in kept}


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Grammar:
    rows = training_rows(docs, labels, max_rows).cache()
    try:
        n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        listed = dict.fromkeys(INSULTS, 5.0)
        if not n.get(0) or not n.get(1):
            return Grammar(listed, DEFAULT_WEIGHTS)
        insults = listed | learned_terms(rows, n[1], n[0])
        return Grammar(insults, output_weights(rows, insults))
    finally:
        rows.unpersist()


def output_weights(rows: DataFrame, insults: dict[str, float]) -> np.ndarray:
    """Ridge-penalised logistic regression on the matches of the rows and of the PRIOR clauses, shrunk towards the
    default weights; each text counts once, so a third of the probability marks the point where a toxic label is half
    as likely as a clean one."""
    grammar = Grammar(insults, DEFAULT_WEIGHTS)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = grammar.reader()
        for b in small(batches):
            x = np.array([reader.outputs(t) for t in texts_of(b)]).reshape(-1, len(OUTPUTS))
            yield pa.RecordBatch.from_pydict({"toxic": b.column("toxic").cast(pa.int32()), "x": pa.array(x.tolist(), pa.list_(pa.float64()))})

    got = rows.mapInArrow(run, "toxic int, x array<double>").groupBy("toxic", "x").count().toArrow()
    reader = Grammar(dict.fromkeys(INSULTS, 5.0), DEFAULT_WEIGHTS).reader()
    x = np.array([*got["x"].to_pylist(), *(reader.outputs(t) for t, _ in PRIOR)])
    y = np.array([*got["toxic"].to_pylist(), *(label for _, label in PRIOR)], float)
    counts = np.array(got["count"].to_pylist(), float)
    counts = np.concatenate([counts, np.full(len(PRIOR), max(1.0, PRIOR_SHARE * counts.sum()))])
    order = np.lexsort((*x.T, y))
    x, y, counts = x[order], y[order], counts[order]
    w, ridge = DEFAULT_WEIGHTS.copy(), np.full(x.shape[1], 1.0)
    ridge[-1] = 0.01
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (counts * (p - y)) + ridge * (w - DEFAULT_WEIGHTS))
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return np.round(w, 9)


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id and score (0 to 1) for every row of ``docs``."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = grammar.reader()
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([reader.score(t) for t in texts_of(b)], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    at = docs.columns.index("text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = grammar.reader()
        for b in small(batches):
            yield b.filter(pa.array([reader.score("" if t is None else t) < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
