"""Toxicity, language identification and personal data: held-out accuracy, exact base rules, small cases."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from tests.llm.helpers import awkward, empty, out_of_fold
from tracewell.llm import langid, pii, queries, toxicity

TOXIC = "doc_id long, quality int, toxic int"


def auc(labels, scores):
    ranks = {}
    for s in sorted(set(scores)):
        below = sum(x < s for x in scores)
        ranks[s] = below + (sum(x == s for x in scores) + 1) / 2
    p = sum(labels)
    return (sum(ranks[s] for la, s in zip(labels, scores) if la) - p * (p + 1) / 2) / (p * (len(labels) - p))


def test_toxicity_on_the_held_out_fold(spark):
    sf = f"{TESTDATA}/sf0.01"
    got = {r["doc_id"]: r for r in queries.op3_toxicity(spark, sf).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == out_of_fold(d) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for d, r in got.items())
    held = [(labels[d], r["score"]) for d, r in got.items() if r["held_out"] and d in labels]
    assert auc([x for x, _ in held], [s for _, s in held]) > 0.8


def grammar():
    return toxicity.Grammar({"idiot": 8.0, "loser": 5.0, "vequ*": 7.0}, toxicity.DEFAULT_WEIGHTS)


def outputs(text):
    return dict(zip(toxicity.MATCHES, grammar().reader().matches(text)[0]))


@pytest.mark.parametrize(
    "text, kind, weight",
    [
        ("You are an idiot.", "addressed", 8),
        ("an idiot, you", "addressed", 8),
        ("vequette, you", "addressed", 8),
        ("i will kill you", "addressed", 8),
        ("kill all of you", "addressed", 8),
        ("we will burn you", "addressed", 8),
        ("such a loser, an idiot", "piled", 8),
        ("what a clown and an idiot", "piled", 8),
        ("an idiot and a clown", "piled", 3),
        ("you are such a clown", "addressed", 3),
        ("clown you", "addressed", 3),
        ("an idiot. a fine day. a loser. well. the idiot.", "spread", 8),
        ("an idiot. a fine day. the trash. well. the idiot.", "spread", 8),
        ("you are not an idiot", "negated", 8),
        ("i will not kill you", "negated", 8),
        ("not today. you idiot", "addressed", 8),
        ("they called him idiot", "reported", 8),
        ("He said he will kill you.", "reported", 8),
        ('He said "well, now this, all of it, goes to you idiot" and left', "reported", 8),
        ("He said “well, now this, all of it, goes to you idiot” and left", "reported", 8),
        ("Er sagte „well, now this, all of it, goes to you idiot“ and left", "reported", 8),
        ('He said " hello. You idiot.', "addressed", 8),
        ('He said 5" pipe\nyou idiot', "addressed", 8),
        ("He said „well“ and then left" + " word" * 9 + " you idiot", "addressed", 8),
        ("He said “well” and” left" + " word" * 9 + " you idiot", "addressed", 8),
    ],
)
def test_matches(text, kind, weight):
    assert outputs(text) == dict.fromkeys(toxicity.MATCHES, 0) | {kind: weight}
    assert (grammar().reader().score(text) >= 0.3) == (kind in ("addressed", "piled", "spread"))


@pytest.mark.parametrize("text", ["", "idiot", "The idiot board game is fun.", "vequ, you", "kill the process", "he left. an idiot", "an idiot. a loser.",
    "The idiot board game is fun. The loser card game is good.", "An idiot bug. The trash folder is full. The clown fish swims. A pig.",
    "Can you open the trash folder?", "you can kill the process", "you beat the game", "shoot the photo for you", "the trash folder. the clown"])
def test_isolated_words_do_not_match(text):
    assert not any(outputs(text).values()) and grammar().reader().score(text) < 0.3


def test_everyday_insults_continue_a_spread_but_do_not_make_one():
    assert outputs("an idiot. a loser. the trash.")["spread"] == outputs("an idiot. the trash. a loser. the trash")["spread"] - 5 == 3
    assert not any(outputs("an idiot. the trash. a clown. a pig.").values())


def enumerated(symbols):
    """Matches of a text by looking at the surroundings of every attack, without any transducer."""
    out, clauses, bare = [], [[]], []  # bare: the first bare insult of each clause that had no other before
    for a in symbols:
        if a == ".":
            clauses.append([])
        else:
            clauses[-1].append(a)
    for c in clauses:
        words, opened, reach = [], "", 0  # (symbol, reported) of the words; quotation marks are no words
        for a in c:
            if a in toxicity.QUOTES:
                if opened and (a == "“" if opened == "„" else a in '"”»'):
                    opened, reach = "", 0
                elif not opened and reach and a in '"„“«':
                    opened, reach = a, 0
                continue
            words.append((a, bool(opened or reach)))
            reach = 0 if opened else toxicity.REACH_REPORT if a == "r" else max(reach - 1, 0)
        near = lambda k, n, a: any(x == a for x, _ in words[max(0, k - n) : k])
        attacks = [k for k, (a, _) in enumerate(words) if a in toxicity.ATTACKS]
        kind = {k: "r" if words[k][1] else "n" if near(k, toxicity.REACH_NEGATION, "n") else "b" for k in attacks}
        plain = [k for k in attacks if kind[k] == "b"]
        for k in plain:
            a = words[k][0]
            coming = [i for i in range(k + 1, min(len(words), k + toxicity.REACH_AFTER.get(a, toxicity.REACH_TARGET) + 1)) if words[i][0] == "t" or i in plain]
            if coming and words[coming[0]][0] == "t":
                kind[k] = "a"
            before = [i for i in range(max(0, k - toxicity.REACH_TARGET), k) if words[i][0] == "t"]
            between = words[before[-1] + 1 : k] if before else []
            if a == "h" and before and all(x == "l" for x, _ in between):
                kind[k] = "a"
            ended = [i for i in plain if before and before[-1] < i < k and words[i][0] in ("h", "g", "k") and not (words[i][0] == "h" and all(x == "l" for x, _ in words[before[-1] + 1 : i]))]
            if a[0] == "i" and before and not ended:
                kind[k] = "a"
        had = False
        for k in attacks:
            a = words[k][0]
            if kind[k] != "b":
                out.append(kind[k] + a)
                had |= kind[k] == "a" and a[0] in "ih"
            elif a[0] in "ih":
                if had:
                    out.append("p" + a)
                else:
                    bare.append(a)
                    if len(bare) > toxicity.SPREAD and sum(b != "h" for b in bare) >= toxicity.SPREAD:
                        out.append("s" + a)
                had = True
    return sorted(out)


@settings(max_examples=1_000, deadline=None)
@given(st.lists(st.sampled_from([*"xxxllttnr..", '"', "“", "”", "„", "i0", "i1", "i1", "k", "h", "g"]), max_size=24))
def test_composed_transducers_against_enumeration_and_cascade(symbols):
    got = MACHINE.read([*symbols, "."])
    assert sorted(x for x in got if x[1:] in toxicity.ATTACKS) == enumerated(symbols)
    stream = [*symbols, "."]
    for machine in CASCADE:
        stream = machine.read(stream)
    assert stream == got


MACHINE = toxicity.grammar_machine()
_ALL = [*toxicity.TERMINALS, *(c + a for c in "rnab" for a in toxicity.ATTACKS)]
CASCADE = [toxicity.Transducer.build(s, f, _ALL) for s, f in (((0, ""), toxicity._report), (0, toxicity._negation), ((0, "", False), toxicity._target), ((False, 0, 0), toxicity._pile))]


def test_toxicity_without_labels_and_on_awkward_rows(spark):
    docs, rows = awkward(spark)
    for labels in (spark.createDataFrame([], TOXIC), spark.createDataFrame([(1, None, None), (None, 0, 1), (1, 1, 0), (1, 1, 0)], TOXIC)):
        scores = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
        assert len(scores) == len(rows) and all(0 <= r["score"] < 0.3 for r in scores)
    assert toxicity.score(empty(spark), grammar()).count() == 0
    kept = toxicity.keep_clean(docs, grammar())
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert toxicity.keep_clean(docs.withColumn("text", F.lit("you idiot, you idiot")), grammar()).count() == 0


def test_toxicity_learns_terms_from_labels(spark):
    rng = np.random.default_rng(3)
    words = [f"w{a}{b}x" for a in "bcdfghjklm" for b in "aeiou"]
    rows = []
    for i in range(400):
        text = [words[j] for j in rng.integers(0, len(words), 30)]
        if i % 8 == 0:
            text[5:8] = ["zorblat", "zorbling", "grumix"]
        rows.append((i, " ".join(text) + ".", int(i % 8 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], TOXIC)
    found = toxicity.learn(docs, labels)
    learned = set(found.insults) - set(toxicity.INSULTS)
    assert any(t.startswith("zorb") for t in learned) and "grumix" in learned and not any(t.rstrip("*") in words for t in learned)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, found).collect()}
    assert all((scores[i] >= 0.3) == bool(x) for i, _, x in rows)
    again = toxicity.learn(docs.repartition(7), labels.repartition(3))
    assert again.insults == found.insults and np.allclose(again.weights, found.weights)


def test_language_on_the_held_out_fold(spark):
    sf = f"{TESTDATA}/sf0.01"
    got = queries.op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r["lang_pred"] == r["lang"] for r in got if r["held_out"]]
    assert sum(held) / len(held) > 0.97 and all(r["held_out"] == out_of_fold(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    model = langid.learn(docs)
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()]
    assert len(got) == len(rows) and {r[1:] for r in got if r[0] in (2, 3, 4)} == {("und", 0.0)}
    assert {r[1] for r in got} <= {"und", "en", "de", "fr", "es"}
    for none in (langid.learn(empty(spark)), langid.learn(docs.withColumn("lang", F.lit(None).cast("string")))):
        assert none is None and {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0
    one = langid.learn(docs.withColumn("lang", F.lit("xx")))
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(docs, one).collect()} == {("und", 0.0), ("xx", 1.0)}


def test_families_then_languages(spark):
    texts = {"en": "the house and the street with this", "de": "das haus und die strasse mit dieser", "fr": "la maison et la rue avec cette", "es": "la casa y la calle con esta", "zz": "qaxo wizu kexi qawo zuxi"}
    rows = [(100 * k + i, f"{t} {i % 7} {t[: 5 + i % 9]}", la) for k, (la, t) in enumerate(texts.items()) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs, max_rows=100)
    assert sorted(model.families) == [["de", "en"], ["es", "fr"], ["zz"]]
    assert {(r["text"].split()[0], r["lang_pred"]) for r in langid.predict(docs, model).join(docs, "doc_id").collect()} == {(t.split()[0], la) for la, t in texts.items() if la not in ("fr", "es")} | {("la", "fr"), ("la", "es")}
    assert langid.training_rows(docs, 100).groupBy("lang").count().agg(F.max("count")).first()[0] <= 20


def test_many_and_dirty_languages(spark):
    rng = np.random.default_rng(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, n = [], 300
    for k in range(n):
        stems = ["".join(rng.choice(list(letters), 5)) for _ in range(6)]
        rows += [(100 * k + i, " ".join(rng.choice(stems, 12)), f"x{k:03d}") for i in range(12)]
    rows += [(10**6 + i, "seldom text", f"dirty{i}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.learn(docs, max_rows=1_200)
    assert langid.training_rows(docs, 1_200).count() <= 1_200 and langid.training_rows(docs, 40).count() == n * langid.MIN_EACH
    assert max(map(len, model.families)) <= langid.FAMILY_SIZE and sum(map(len, model.families)) <= n and len(model.families) <= n / langid.FAMILY_SIZE + langid.FAMILY_SIZE
    got = langid.predict(docs, model).join(docs, "doc_id").filter("lang NOT LIKE 'dirty%'").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert got > 0.9


def test_a_rare_language_is_learned(spark):
    """Eight rows of 100,000, less than one in 10,000."""
    texts = {"aa": "the house and the street with this", "cc": "das haus und die strasse mit dieser"}
    often = spark.range(100_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit(texts["aa"])).otherwise(F.lit(texts["cc"])).alias("text"), F.when(F.col("id") % 2 == 0, "aa").otherwise("cc").alias("lang"))
    few = [10**6 + i for i in range(40) if not out_of_fold(10**6 + i)][:8]
    rare = spark.createDataFrame([(i, f"qaxo wizu kexi qawo zuxi {'zuxo' * (i % 3)}", "zz") for i in few], "doc_id long, text string, lang string")
    model = langid.learn(often.unionByName(rare))
    asked = spark.createDataFrame([(1, "wizu qaxo qawo kexi"), (2, "the street and the house"), (3, "die strasse und das haus")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(asked, model).collect()} == {1: "zz", 2: "aa", 3: "cc"}


def brute_elect(pairs, margins, n):
    """The class with most wins; of these the one with the largest sum of margins; of these the first."""
    wins = [sum((m >= 0) == (a == c) for (a, b), m in zip(pairs, margins) if c in (a, b)) for c in range(n)]
    total = [sum(m if a == c else -m for (a, b), m in zip(pairs, margins) if c in (a, b)) for c in range(n)]
    return max(range(n), key=lambda c: (wins[c], total[c], -c))


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 6), st.data())
def test_election_against_brute_force(n, data):
    pairs = [(a, b) for a in range(n) for b in range(a + 1, n)]
    margins = data.draw(st.lists(st.sampled_from([-2.0, -1.0, 0.0, 1.0, 2.0]), min_size=len(pairs), max_size=len(pairs)))
    weights = np.array([[0.0, m] for m in margins])
    best, sure = langid._elect(pairs, weights, np.zeros(1), n)
    assert best == brute_elect(pairs, margins, n) and 0 < sure < 1


def test_machines_come_to_the_optimum():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((80, 5))
    y = np.where(x[:, 0] + 0.3 * rng.standard_normal(80) > 0, 1.0, -1.0)
    w = langid.svm(x, y, ridge=0.1, steps=20_000)
    full = np.hstack([x, np.ones((80, 1))])
    side = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    loss = lambda v: 0.05 * v @ v + (side * np.maximum(0, 1 - y * (full @ v)) ** 2).sum()
    assert all(loss(w) <= loss(w + s * 1e-3 * d) + 1e-9 for d in np.eye(6) for s in (-1, 1))


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, ok in (("card", CARD, lambda d: 16 <= len(d) <= 19 and plain_luhn(d)), ("phone", PHONE, lambda d: 8 <= len(d) <= 15)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if ok(re.sub("[^0-9]", "", m.group()))]
    return out


PIECES = ["a.b@c.de", "@", "x@y", "a@b.c@d.e", "..@q.r.", "1.2.3.4", "1.2.3.4.5", "300.1.1.1", "001.002.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100", "+49.", "+", "12345678901234567890", " ", "é", "👍", "\n", "-", "(", "5", "٣"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_base_spans(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain_base(text)


def test_pii_query(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op9_pii(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        base = [f"{k}:{a}:{b}" for k, a, b in plain_base(texts[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(x.startswith(k + ":") for x in base) for k in pii.BASE]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(base) <= set(spans) and len(set(spans)) == len(spans)
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])))


def test_proposals_by_labels_that_agree(spark):
    lines = [f'their token = "{hashlib.sha1(bytes([i])).hexdigest()}" here, mail m{i}@example.com too' for i in range(40)]
    lines += [f"see version {10**9 + i} of page {2 * 10**8 + i} and 31{i:02d}999999 km away" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    assert all("secret:" in found[i] and "email:" in found[i] for i in range(40))
    assert not any(found[i] for i in range(40, 80))
    red = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert red[0] == 'their token = "[SECRET]" here, mail [EMAIL] too' and red[40] == lines[40]


def test_classifier_decides_where_all_labelers_abstain(spark):
    """Account numbers after "membership" get no votes there; their surroundings are learned from rows with votes."""
    say = lambda i, lead: f"for membership my {lead} {10**9 + 7919 * i} belongs to me"
    rows = [say(i, "account") for i in range(30)] + [f"see page of version {10**9 + 31 * i} there in print" for i in range(30)]
    silent = say(77, "thing").replace("my thing", "my own")
    rows += [silent, f"all in print {10**9 + 77} there"]
    (kind, a, b), = pii.proposed_spans(silent, [])
    assert pii.votes(silent, kind, a, b) == "0" * len(pii.LABELERS)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
    assert all(found[i] for i in range(30)) and not any(found[i] for i in range(30, 60)) and found[60] and not found[61]


def test_classifier_of_counted_spans_equals_that_of_repeated_ones():
    feats, post = [[1, 5], [2, 5], [3]], np.array([0.9, 0.2, 0.6])
    once = pii.span_classifier(feats, np.array([3.0, 1.0, 2.0]), post)
    twice = pii.span_classifier([feats[0]] * 3 + [feats[1]] + [feats[2]] * 2, np.ones(6), post[[0, 0, 0, 1, 2, 2]])
    assert np.allclose(once, twice, atol=1e-6) and once[[1, 5]].sum() > once[[2, 5]].sum()


def test_reliabilities_tell_good_labelers_from_bad():
    rng = np.random.default_rng(0)
    truth = rng.random(4_000) < 0.3
    right = np.array([0.95, 0.9, 0.55])
    votes = np.where(rng.random((4_000, 3)) < right, truth[:, None], ~truth[:, None]) * 2
    patterns, counts = np.unique(votes.astype(int), axis=0, return_counts=True)
    post, table = pii.reliabilities(counts.astype(float), patterns)
    assert min(table[1, 0, 2], table[1, 1, 2]) > 0.8 and 0.4 < table[1, 2, 2] < 0.65
    place = {tuple(p): i for i, p in enumerate(patterns.tolist())}
    guess = np.array([post[place[tuple(v)]] > 0.5 for v in votes.astype(int).tolist()])
    assert (guess == truth).mean() > 0.9


def test_pii_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    assert pii.find(docs).count() == len(rows) and {r["spans"] for r in pii.find(docs).collect()} == {""}
    red = pii.redact(docs)
    assert red.schema == docs.schema and red.count() == len(rows) and red.filter("doc_id = 2").first()["text"] is None
    assert pii.find(empty(spark)).count() == pii.redact(empty(spark)).count() == 0


def test_overlapping_spans_are_redacted_once():
    assert pii.redacted("abcdefgh", [(0, 1, 3), (2, 2, 5), (1, 6, 7)]) == "a[EMAIL]f[IP]h"


@pytest.mark.parametrize("text", ["x" * 200_000 + "@", "1 " * 100_000, "1." * 50_000])
def test_very_long_texts(text):
    pii.base_spans(text)


def test_addresses_with_long_runs_of_digits():
    zeros = "0" * 5_000
    assert pii.base_spans(f"{zeros}1.2.3.{zeros}") == [(1, 0, 10_006)]
    assert [s for s in pii.base_spans("7" * 200_000 + ".1.1.1") if s[0] == 1] == []


def test_numbers_at_the_end_of_a_sentence_are_proposed():
    spans = lambda t: [(pii.KINDS[k], t[a:b]) for k, a, b in pii.proposed_spans(t, [])]
    assert spans("my account 1234567890.") == spans("my account 1234567890 is") == spans("my account 1234567890. It is") == [("account", "1234567890")]
    assert spans("the ratio 1234567890.5 is") == []
    assert spans("password=hunter2") == [("secret", "hunter2")] and spans('"password": "swordfish".') == [("secret", "swordfish")]
    assert spans("passport: C01X00T4.") == [("secret", "C01X00T4")]
    assert spans("A note: nothing") == spans("Contact: Monday") == spans("https://example.org") == []


def test_assigned_values_and_last_numbers_are_redacted(spark):
    rows = [(i, f"My account {1234567890 + 7919 * i}. The password={w} here, and page 2{i:08d} km.") for i, w in enumerate(["hunter2", "swordfish", "letmein", "qwerty"] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    red = [r["text"] for r in pii.redact(docs).collect()]
    assert all("account [ACCOUNT]. The password=[SECRET] here" in t and " km" in t for t in red)


def test_matches_without_cases_keep_their_sense(spark):
    rows = spark.createDataFrame([(1, "you idiot")] * 20 + [(0, "a fine day")] * 200, "toxic int, text string")
    insults = dict.fromkeys(toxicity.INSULTS, 5.0)
    read = toxicity.Grammar(insults, toxicity.output_weights(rows, insults)).reader()
    high, low = ("You idiot.", "I will kill you.", "what a stupid idiot"), ("idiot", "an idiot. a moron", "not you idiot", "he said you idiot", "he said he will kill you")
    assert all(read.score(t) >= 0.3 for t in high) and all(read.score(t) < 0.3 for t in low)


def test_training_rows_are_bounded_where_ids_repeat(spark):
    docs = spark.range(300).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    assert not out_of_fold(4)
    assert toxicity.training_rows(docs, spark.createDataFrame([(4, 1, 1)], TOXIC), max_rows=50).count() == 50
