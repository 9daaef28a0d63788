"""Line-first quality rules.

Each line with a word is judged by itself: it fails by *symbols* (over a tenth of its word characters), by
*navigation* (three or more menu separators), by *punctuation* (no sentence end anywhere in it), by
*boilerplate* (a short line with a stock phrase) or by *repetition* (equal to an earlier line). Failing lines
are removed; a document that loses more than ``max_lost`` percent of its word characters is rejected. Base
rules on the whole text (too few words, too many repeated word windows) reject regardless of the lines.

Edge cases: null, empty and white-space texts have no words, so they fail the base rules and are not kept;
their clean text is empty. Texts of any length are judged whole. Repeated rows give a row each, a null doc_id
stays null, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, texts_of

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED, WINDOW, MAX_LOST = 10, 20, 5, 30
SYMBOL_SHARE, MENU_MARKS, SHORT = 10, 3, 200
MENU = r"[|»›•·]"
SENTENCE_END = r"[.!?…:;。！？][\x22'”’)\]]*([\x20\x09-\x0D]|$)"
#: Stock phrases in English, German, French and Spanish.
BOILERPLATE = (
    r"(all rights reserved|cookie|javascript|privacy policy|terms of (use|service)|subscribe|sign (in|up)|log in|click here|read more|skip to (main )?content|powered by|lorem ipsum|newsletter"
    r"|alle rechte vorbehalten|datenschutzerkl|nutzungsbedingungen|impressum|weiterlesen|jetzt anmelden|zum inhalt springen"
    r"|tous droits r[ée]serv|politique de confidentialit|conditions d.utilisation|mentions l[ée]gales|lire la suite|se connecter|abonnez-vous"
    r"|todos los derechos reservados|pol[íi]tica de privacidad|condiciones de uso|aviso legal|leer m[áa]s|iniciar sesi[óo]n|suscr[íi]bete)"
)

_MENU, _END, _STOCK = re.compile(MENU), re.compile(SENTENCE_END), re.compile(BOILERPLATE)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, lost_chars long, kept boolean, clean_text string"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found at least twice in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[k:] for k in range(window))))
    found = Counter(grams)
    if len(found) == n:
        return 0
    total = upto = 0
    for i, g in enumerate(grams):
        if found[g] > 1:
            total += i + window - max(upto, i)
            upto = i + window
    return total


def chars(text: str) -> int:
    """Code points in words."""
    return len(text) - sum(map(text.count, SPACE))


def line_fails(line: str, size: int) -> bool:
    """Whether a line with ``size`` word characters breaks a rule that needs no other line."""
    if SYMBOL_SHARE * sum(map(line.count, SYMBOLS)) > size or len(_MENU.findall(line)) >= MENU_MARKS:
        return True
    return not _END.search(line) or size <= SHORT and bool(_STOCK.search(line.translate(_LOWER)))


def judge(text: str, max_lost: int = MAX_LOST) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()
    total, n, repeated = chars(text), len(words), repeated_words(words)
    seen, good, lost, again = set(), [], 0, 0
    for line in text.split("\n"):
        size = chars(line)
        if not size:
            continue
        if line in seen:
            again, lost = again + 1, lost + size
            continue
        seen.add(line)
        if line_fails(line, size):
            lost += size
        else:
            good.append(line)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED * n
    return n, total, sum(map(text.count, SYMBOLS)), again, repeated, failed, lost, not failed and 100 * lost <= max_lost * total, "\n".join(good)


def clean_lines(docs: DataFrame, max_lost: int = MAX_LOST) -> DataFrame:
    """A row of SCHEMA for each row of ``docs``: the counts, the verdict and the text without failing lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [{"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[x.split()[1]] for x in SCHEMA.split(", ")]
        for b in small(batches):
            rows = [judge(t, max_lost) for t in texts_of(b)]
            columns = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l0 AS (SELECT r, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
l1 AS (SELECT r, l, length(regexp_replace(l, '[\\x20\\x09-\\x0D]', '', 'g')) AS c, min(i) OVER (PARTITION BY r, l) < i AS again FROM l0),
l2 AS (SELECT r, c, again, again
    OR {SYMBOL_SHARE} * length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) > c
    OR length(regexp_replace(l, '{MENU.replace("[", "[^", 1)}', '', 'g')) >= {MENU_MARKS}
    OR NOT regexp_matches(l, '{SENTENCE_END.replace("'", "''")}')
    OR (c <= {SHORT} AND regexp_matches(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{BOILERPLATE}')) AS bad
    FROM l1 WHERE c > 0),
lines AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(c) FILTER (bad), 0) AS lost FROM l2 GROUP BY r),
w0 AS (SELECT r, unnest(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS w, generate_subscripts(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'), 1) AS i FROM d),
w1 AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g FROM w0 WINDOW o AS (PARTITION BY r ORDER BY i)),
w2 AS (SELECT r, i, g IS NOT NULL AND count(*) OVER (PARTITION BY r, g) > 1 AS hit FROM w1),
w3 AS (SELECT r, max(hit::int) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM w2),
words AS (SELECT r, count(*) AS n_words, sum(hit) AS n_repeat_words FROM w3 GROUP BY r),
j AS (SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
    FROM d LEFT JOIN lines USING (r) LEFT JOIN words USING (r)),
k AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM j)
SELECT *, NOT base_failed AND 100 * lost_chars <= {MAX_LOST} * word_chars AS kept FROM k
"""
