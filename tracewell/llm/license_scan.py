"""License scans by canonical digests.

A text is made canonical: ASCII letters in lower case, copyright lines and the marks of lists dropped, white space (line breaks included)
made single blanks, equivalent spellings made one, punctuation dropped. The SHA-256 digest of the whole canonical text
is looked up, by a hash join, among the digests of known licence texts and notices: short ones stand in ``TEXTS``, of
long ones ``DIGESTS`` has the digest alone. A line of a text is a text too: the digests of a document's lines are met
with the known ones by a second hash join, so notices within longer documents are found by their whole line. A line
that holds none of ``CUES``, one of which every known line has, can't be known and isn't made canonical.

All of it is DataFrame expressions. The registry is a table of this module (a few hundred rows), so it is broadcast.

Edge cases: null texts have no digest and no licence; texts that are empty when made canonical have the digest of
the empty text and no licence; texts of any length are scanned whole; repeated rows give a row each; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, sieve

# The texts of short public licences, and names by which licences are granted.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_HEAD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEXTS = {
    "MIT": (MIT, "MIT License\n\n" + MIT, "The MIT License (MIT)\n\n" + MIT),
    "ISC": (f"{ISC_HEAD}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{ISC_TAIL}",),
    "0BSD": (f"{ISC_HEAD}.\n\n{ISC_TAIL}",),
    "BSD-2-Clause": (BSD_HEAD + BSD_TAIL, "BSD 2-Clause License\n\n" + BSD_HEAD + BSD_TAIL),
    "BSD-3-Clause": (BSD_HEAD + BSD_NAME + BSD_TAIL, "BSD 3-Clause License\n\n" + BSD_HEAD + BSD_NAME + BSD_TAIL),
}
#: Canonical digests of the texts of longer licences, as they are commonly distributed.
DIGESTS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("1cd2c39ecc1d5c9b27853936354962be7fee5493e63b6fa5c6894d4676e4d1ae",),
    "Artistic-1.0": ("1cce0c8a0a6d1ad259c5b4d318b2b803968c0fa70326afb130fee17a60057e57",),
    "CC0-1.0": ("7ab883ed738089b86f7b9cbf5983e455c510b237b3ce5869b71d94cf8ae90f55",),
    "GFDL-1.2": ("7bf6a9fa6c488668200e186a3a1b17617681afeb9f4b4ccff34920cc9792aabf",),
    "GFDL-1.3": ("541046d4e9b343afea0227be7e3f03484f628aa9957f130ae5375518099db7c3",),
    "GPL-1.0": ("3a69fe927848b8d56a9820e633f99c5df33315c09631713a193df53a520e2386",),
    "GPL-2.0": ("ad39f506fa44afd372f792e9ff5c08072b2754940ad198e3bf2395e76c660b78",),
    "GPL-3.0": ("7db779754dbeec58826e2c0b4c39357bb32a33122e9a98d6e9e69354462900e3",),
    "LGPL-2.0": ("c1ff461db3c6c811868d44902cd2900c66fcbeec835cf547b41e3141db13f197",),
    "LGPL-2.1": ("a1dc544f3f5964a4fb5141a61f0b8bd8032390cbacfeed71da29d90f40ce1459",),
    "LGPL-3.0": ("34e47a7000fc8f60cbec5bb3531cf04801cb63fdea486bd14d2ffa0a0e357642",),
    "MPL-1.1": ("8e6967309b2e5652d03567736a23ab654695ba9405c757c96fe3e434edde6747",),
    "MPL-2.0": ("6730d16b2f2620bc9c03eac924a43787554bf2f25260a33d09401a9a29024818",),
}
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache-2.0", "Apache 2.0 License"),
    "MIT": ("MIT License", "MIT"),
    "GPL-1.0": ("GNU General Public License, version 1", "GPL v1", "GPL-1.0", "GPL-1.0-only", "GPL-1.0-or-later"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL v2", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL v3", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPL v2.1", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL v3", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL v3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"),
    "EPL-2.0": ("Eclipse Public License, version 2.0", "EPL 2.0", "EPL-2.0"),
    "Artistic-2.0": ("Artistic License 2.0", "Artistic-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD License", "BSD-3-Clause"),
    "ISC": ("ISC License", "ISC"),
    "0BSD": ("0BSD",),
    "CC0-1.0": ("CC0 1.0", "CC0", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "Unlicense": ("Unlicense",),
}
GRANTS = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under", "This software is licensed under", "License:", "SPDX-License-Identifier:")

#: Rules of the canonical form, in order: pattern and replacement (\1 for the group), by RE2 and Java alike.
SPELLINGS = (
    (r"(licen)c(e|es|ed|ing)\b", r"\1s\2"),
    (r"\bsub-licens", "sublicens"),
    (r"\b(non)-(infringement|commercial)", r"\1\2"),
    (r"\bthe (author|copyright holder)s? (or|and) (copyright holder|contributor)s?\b", r"the holders"),
    (r"\bthe (author|copyright holder)s?\b", r"the holders"),
    (r"(organi|recogni|authori)s(e|ed|ation)\b", r"\1z\2"),
    (r"\b(fav|behavi|col)our", r"\1or"),
    (r"\bversion[ ]?([0-9])", r"v\1"),
    (r"\bv\.? ([0-9])", r"v\1"),
    (r"\b([0-9]+)\.0\b", r"\1"),
    (r"https://", "http://"),
)
#: A line that says whose the copyright is: a year, a (c) sign, or "all rights reserved"; a wrapped line that merely
#: begins with the word is none.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;]*((copyright|copr\.?)[ \t]*(\(c\)|©|[0-9]{4}|by\b|<|\[|:)[^\n]*|(\(c\)|©)[^\n]*|all rights reserved\.?[ \t]*(\n|$))"
#: The number or mark of a list's item at the start of a line.
ITEM = r"(^|\n)[ \t]*(\(?[0-9a-z]{1,2}[.)]|[*•-])[ \t]+"
PUNCTUATION = r"[^\p{L}\p{N}]+"
#: What every known notice of one line holds, in lower case.
CUES = ("under", "licen")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def registry(spark: SparkSession) -> DataFrame:
    """license and raw text of every known text and notice."""
    rows = [(k, t) for k, texts in TEXTS.items() for t in texts]
    rows += [(k, f"{g} {the}{n}") for k, names in NAMES.items() for n in names for g in GRANTS for the in ("", "the ")]
    return spark.createDataFrame(rows, "license string, known string")


def canonical(text: Column) -> Column:
    """The canonical text, on one line."""
    t = F.regexp_replace(F.translate(text, UPPER, LOWER), COPYRIGHT_LINE, "\n")
    t = F.regexp_replace(t, ITEM, "\n")
    t = F.regexp_replace(t, r"\s+", " ")
    for pattern, by in SPELLINGS:
        t = F.regexp_replace(t, pattern, by.replace("\\", "$"))
    return F.trim(F.regexp_replace(t, PUNCTUATION, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def candidate_lines(text: Column) -> Column:
    """The lines of a text that may be known."""
    lower = lambda x: F.translate(x, UPPER, LOWER)
    cue = lambda x: F.contains(lower(x), F.lit(CUES[0])) | F.contains(lower(x), F.lit(CUES[1]))
    return F.array_distinct(F.filter(F.split(text, "\n"), cue))


def digests(spark: SparkSession) -> DataFrame:
    """digest and license of the registry; of equal canonical texts the first licence by name."""
    known = registry(spark).select("license", digest(F.col("known")).alias("digest"))
    known = known.unionByName(spark.createDataFrame([(k, d) for k, ds in DIGESTS.items() for d in ds], "license string, digest string"))
    return known.groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, digest and license of the whole text (null if unknown), and notices: the licences of known lines, sorted."""
    known = F.broadcast(digests(docs.sparkSession))
    text = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit("b"), F.col("text")).alias("b")).alias("key")
    lines = docs.select(text, F.explode(candidate_lines(F.col("text"))).alias("line")).select("key", digest(F.col("line")).alias("digest"))
    found = lines.join(known, "digest").groupBy("key").agg(F.array_sort(F.collect_set("license")).alias("notices"))
    found = materialize(found, "license-notices")
    # split before the digest of the whole text, so that each text is made canonical once
    sifted = sieve(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text), found)
    whole, none = digest(F.col("text")).alias("digest"), F.array().cast("array<string>")
    plain = sifted.filter("NOT __hit").select("doc_id", whole, none.alias("notices"))
    held = sifted.filter("__hit").select("doc_id", "key", whole).join(found, "key", "left").select("doc_id", "digest", F.coalesce("notices", none).alias("notices"))
    return plain.unionByName(held).join(known, "digest", "left").select("doc_id", "digest", "license", "notices")


def _sql_canonical(text: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), {quote(COPYRIGHT_LINE)}, chr(10), 'g')"
    out = f"regexp_replace(regexp_replace({out}, {quote(ITEM)}, chr(10), 'g'), '\\s+', ' ', 'g')"
    for pattern, by in SPELLINGS:
        out = f"regexp_replace({out}, {quote(pattern)}, {quote(by)}, 'g')"
    return f"trim(regexp_replace({out}, '{PUNCTUATION}', ' ', 'g'))"


def sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = [(k, t) for k, texts in TEXTS.items() for t in texts]
    values = ", ".join(f"({quote(k)}, {quote(t)})" for k, t in rows)
    names = ", ".join(f"({quote(k)}, {quote(n)})" for k, ns in NAMES.items() for n in ns)
    grants = ", ".join(f"({quote(g)})" for g in GRANTS)
    long = ", ".join(f"({quote(k)}, '{d}')" for k, ds in DIGESTS.items() for d in ds)
    return f"""
WITH known AS (SELECT * FROM (VALUES {values}) v(license, known)
    UNION ALL SELECT license, g || ' ' || the || n FROM (VALUES {names}) n(license, n), (VALUES {grants}) g(g), (VALUES (''), ('the ')) t(the)),
dig AS (SELECT digest, min(license) AS license FROM (SELECT sha256({_sql_canonical('known')}) AS digest, license FROM known UNION ALL SELECT digest, license FROM (VALUES {long}) l(license, digest)) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM (SELECT r, sha256({_sql_canonical('line')}) AS digest FROM l) JOIN dig USING (digest) GROUP BY r),
w AS (SELECT r, doc_id, sha256({_sql_canonical('text')}) AS digest FROM d)
SELECT doc_id, w.digest, license, coalesce(notices, '') AS notices FROM w LEFT JOIN dig USING (digest) LEFT JOIN n USING (r)
"""
