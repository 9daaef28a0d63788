"""Quality rules, licences and URL filters against SQL and small cases."""

import os
import random
import textwrap

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.llm.helpers import awkward, empty
from tracewell.llm import license_scan, quality_rules, queries, url_filter


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, sf, duck, name):
    got, want = queries.queries()[name](spark, sf).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want) and len(got)


def test_repeated_words_by_brute_force():
    words = b"a b c d e x a b c d e y a b c d e a b c d e".split()
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    marked = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    assert quality_rules.repeated_words(words) == len(marked)
    assert quality_rules.repeated_words(b"a a a a a a".split()) == 6
    assert quality_rules.repeated_words(b"a b c d e".split()) == quality_rules.repeated_words([]) == 0


@pytest.mark.parametrize(
    "line,fails",
    [("A sentence that ends well.", False), ("No end in this line at all", True), ("It stops here. and then goes on", False), ("Home | News | Sport | Mail.", True), ("#### %%%% $$$$ a.", True), ("All rights reserved.", True), ("Alle Rechte vorbehalten.", True), ("Tous droits réservés.", True), ("Lea el aviso legal.", True), ("He said “stop!”", False)],
)
def test_line_rules(line, fails):
    assert quality_rules.line_fails(line, quality_rules.chars(line)) is fails


def test_quality_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    got = {(r["doc_id"], r["n_words"], r["kept"], r["clean_text"][:10]) for r in quality_rules.clean_lines(docs).collect()}
    assert (2, 0, False, "") in got and (3, 0, False, "") in got and (4, 0, False, "") in got and (5, 90_000, False, "word0 goes") in got
    assert quality_rules.clean_lines(docs).count() == len(rows) and quality_rules.clean_lines(empty(spark)).count() == 0


def test_documents_that_lose_too_much(spark):
    text = "This is a sentence of quite some words, all of them good. \nmenu entry without end\nAnd here another one follows, which says something else at length."
    assert quality_rules.judge(text)[7] is True
    assert quality_rules.judge(text + "\n" + "one more long line that never comes to any end " * 5)[7] is False


def test_licences_whatever_their_form(spark):
    mit = license_scan.MIT
    texts = {
        1: mit,
        2: "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ;"),
        3: mit.replace("sublicense", "sub-license").replace("NONINFRINGEMENT", "NON-INFRINGEMENT").replace("AUTHORS OR COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"),
        4: mit + " And more.",
        5: "Some text.\nlicenced under the apache licence, version 2.0!\nMore text.\nReleased under the MIT License.",
        6: None,
        7: "",
        8: license_scan.BSD_HEAD + license_scan.BSD_NAME + license_scan.BSD_TAIL,
    }
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in license_scan.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert [got[k][0] for k in range(1, 9)] == ["MIT", "MIT", "MIT", None, None, None, None, "BSD-3-Clause"]
    assert got[5][1] == ["Apache-2.0", "MIT"] and got[6][1] == []


def test_licence_digests_are_distinct(spark):
    d = license_scan.digests(spark).collect()
    assert len({r["digest"] for r in d}) == len(d) and {r["license"] for r in d} == set(license_scan.NAMES) | set(license_scan.TEXTS) | set(license_scan.DIGESTS)
    known = [r["known"].lower() for r in license_scan.registry(spark).collect() if "\n" not in r["known"]]
    assert all(any(c in k for c in license_scan.CUES) for k in known)


@pytest.mark.parametrize("width", [50, 72, 80])
def test_wrapped_licences(spark, width):
    wrap = lambda t: "\n\n".join(textwrap.fill(p, width) for p in t.split("\n\n"))
    bsd = license_scan.BSD_HEAD + license_scan.BSD_NAME + license_scan.BSD_TAIL
    texts = {
        "MIT": "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + wrap(license_scan.MIT),
        "BSD-3-Clause": "Copyright 2019, The Authors.\nAll rights reserved.\n\n" + wrap(bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")),
        "ISC": "Copyright (C) 2001 by Someone\n\n" + wrap(license_scan.TEXTS["ISC"][0]),
    }
    rows = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    assert [r["license"] for r in license_scan.scan(rows).orderBy("doc_id").collect()] == list(texts)


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="no licence texts on this machine")
def test_long_licences(spark):
    at = {"Apache-2.0": "Apache-2.0", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    rows = [(i, open(f"/usr/share/common-licenses/{f}").read()) for i, f in enumerate(at.values())]
    assert [r["license"] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()] == list(at)


def test_licences_of_awkward_rows(spark):
    docs, rows = awkward(spark)
    found = license_scan.scan(docs)
    assert found.count() == len(rows) and found.filter("license IS NOT NULL").count() == 0
    assert license_scan.scan(empty(spark)).count() == 0


def test_licence_path_has_no_python(spark, sf):
    plan = queries.op1_license_scan(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


ENTRIES = "list string, kind string, key string, action string, at timestamp"


def decided(spark, captures, entries):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at string").withColumn("fetched_at", F.to_timestamp("fetched_at"))
    e = spark.createDataFrame(entries, ENTRIES.replace("timestamp", "string")).withColumn("at", F.to_timestamp("at"))
    return {(r["page_id"], r["verdict"], r["list"], r["key"]) for r in url_filter.decide(c, e).collect()}


def test_entries_hold_for_their_time_only(spark):
    entries = [("l", "block", "Bad.example.", "add", "2024-01-10"), ("l", "block", "bad.example", "remove", "2024-02-10"), ("l", "block", "bad.example", "add", "2024-03-10"), ("x", "block", "both.example", "add", "2024-01-01"), ("x", "block", "both.example", "remove", "2024-01-01")]
    captures = [(i, "https://u:p@WWW.bad.example:80/a", t) for i, t in enumerate(["2024-01-09 23:59:59", "2024-01-10", "2024-02-09", "2024-02-10", "2024-03-10", None])] + [(6, "http://both.example/", "2024-05-01"), (7, None, "2024-05-01"), (8, "nonsense", "2024-05-01"), (8, "nonsense", "2024-05-01"), (9, "http://notbad.example", "2024-01-11")]
    blocked = {r[0] for r in decided(spark, captures, entries) if r[1] == "block"}
    assert blocked == {1, 2, 4}


def test_longest_key_decides_and_block_wins_ties(spark):
    entries = [("a", "allow", "ok.big.example", "add", "2024-01-01"), ("b", "block", "big.example", "add", "2024-01-01"), ("c", "allow", "tie.example", "add", "2024-01-01"), ("d", "block", "tie.example", "add", "2024-01-01"), ("e", "block", None, "add", "2024-01-01")]
    captures = [(1, "http://x.ok.big.example/", "2024-06-01"), (2, "http://big.example/", "2024-06-01"), (3, "http://tie.example", "2024-06-01")]
    assert decided(spark, captures, entries) == {(1, "allow", "a", "ok.big.example"), (2, "block", "b", "big.example"), (3, "block", "d", "tie.example")}


@pytest.mark.parametrize("per_task", [3, 65_536])
def test_url_filter_against_brute_force(spark, per_task):
    rng = random.Random(6)
    hosts = ["a.example", "w.a.example", "b.w.a.example", "example", "[2001:db8::1]", "10.0.0.1", "0.0.1", "other.org"]
    day = lambda n: f"2024-01-{n:02d}"
    entries = [(rng.choice("xyz"), rng.choice(["block", "allow"]), rng.choice(hosts), rng.choice(["add", "add", "remove"]), day(rng.randint(1, 20))) for _ in range(60)]
    captures = [(i, f"http://{rng.choice(hosts)}/p", day(rng.randint(1, 22))) for i in range(150)] + [(7, "http://a.example/" + "x" * 100_000, day(5)), (None, "http://[2001:db8::1]:80/", day(9))]
    want = []
    for page, url, at in captures:
        name, best = url.split("://")[1].split("/")[0].replace(":80", ""), None
        for li, kind, key in {e[:3] for e in entries}:
            own = sorted({(e[4], e[3]) for e in entries if e[:3] == (li, kind, key) and e[4] <= at}, key=lambda e: (e[0], e[1]))
            by_suffix = name == key or not name.replace(".", "").isdigit() and name.endswith("." + key)
            if own and own[-1][1] == "add" and by_suffix:
                best = max(best or (0,), (len(key), kind == "block", li, key, own[-1][0]))
        want.append((page, "block" if best and best[1] else "allow", best and best[2], best and best[3]))
    c = spark.createDataFrame([(*x, "clash", 1) for x in captures], "page_id long, url string, fetched_at string, key string, row int").withColumn("fetched_at", F.to_timestamp("fetched_at"))
    e = spark.createDataFrame(entries, ENTRIES.replace("timestamp", "string")).withColumn("at", F.to_timestamp("at"))
    got = [(r["page_id"], r["verdict"], r["list"], r["key"]) for r in url_filter.decide(c, e, per_task).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len({x[1:] for x in want}) > 5


def test_a_key_with_many_entries(spark):
    """20,000 entries of one host on three lists: a timeline of as many rows, made by one sweep."""
    start = 1_700_000_000
    rows = spark.range(20_000).select(F.element_at(F.array(*map(F.lit, ("p", "q", "r"))), (F.col("id") % 3 + 1).cast("int")).alias("list"), F.when(F.col("id") % 3 == 1, "allow").otherwise("block").alias("kind"), F.lit("hot.example").alias("key"), F.when(F.floor(F.col("id") / 3) % 2 == 0, "add").otherwise("remove").alias("action"), F.timestamp_seconds(F.col("id") * 60 + start).alias("at"))
    line = url_filter.timelines(rows).orderBy("at").collect()
    assert len(line) == 20_000
    last = {}
    for i, r in enumerate(line):
        last[i % 3] = i if (i // 3) % 2 == 0 else None
        active = [(j % 3 != 1, "pqr"[j % 3], start + 60 * j) for j in last.values() if j is not None]
        assert (r["entry"] and (r["entry"]["block"], r["entry"]["list"], int(r["entry"]["valid_from"].timestamp()))) == (max(active) if active else None)


def test_url_filter_empty_sides(spark):
    one = [(1, "http://a.example", "2024-01-01"), (1, "http://a.example", "2024-01-01")]
    assert decided(spark, one, []) == {(1, "allow", None, None)} and decided(spark, [], [("a", "block", "a.example", "add", "2024-01-01")]) == set()
    c = spark.createDataFrame(one, "page_id long, url string, fetched_at string").withColumn("fetched_at", F.to_timestamp("fetched_at"))
    assert url_filter.decide(c, spark.createDataFrame([], ENTRIES)).count() == 2
