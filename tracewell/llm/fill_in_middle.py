"""Fill-in-the-middle: each text is cut into prefix, middle and suffix, which change places behind marks.

A batch of documents is registered with a DuckDB connection of its task, and one SQL statement does the rest: code
points by ``regexp_extract_all``, cuts from a SHA-256 of the id, parts by ``list_slice`` and ``array_to_string``, and
the text rebuilt from the output alone. Arrow goes in and comes out; no row becomes a Python object. A batch is handed
over in slices of at most ``SLICE`` bytes of text (or one text), which bounds the lists of code points; the plan has no
shuffle. Cuts depend on the id alone, so reruns and retried tasks agree.

Edge cases: null texts count as empty and empty ones stay plain, as do texts that hold a mark; a null id counts as an
id without digits; repeated rows give equal results; very long texts are handled whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_edges

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Per cent of the texts that are transformed, and of these the ones whose suffix comes first.
RATE, SPM = 90, 20
SLICE = 4 << 20
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string, output_sha256 string, restored_sha256 string"
_ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in SCHEMA.split(", ")])


def statement(rate: int = RATE, spm: int = SPM) -> str:
    """SQL over the registered ``batch``."""
    part = lambda lo, hi: f"coalesce(array_to_string(list_slice(c, {lo}, {hi}), ''), '')"
    draw = ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    held = " OR ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM batch),
units AS (SELECT doc_id, t, regexp_extract_all(t, '(?s).') AS c, {draw} FROM texts),
cuts AS (SELECT doc_id, t, c, len(c) AS n, h4, least(h1 % (len(c) + 1), h2 % (len(c) + 1)) AS a, greatest(h1 % (len(c) + 1), h2 % (len(c) + 1)) AS z,
    CASE WHEN t = '' OR {held} OR h3 % 100 >= {rate} THEN 'plain' WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM units),
done AS (SELECT doc_id, n, form, a, z, CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '{PREFIX}' || {part(1, 'a')} || '{SUFFIX}' || {part('z + 1', 'n')} || '{MIDDLE}' || {part('a + 1', 'z')}
    ELSE '{SUFFIX}' || {part('z + 1', 'n')} || '{PREFIX}' || {part(1, 'a')} || '{MIDDLE}' || {part('a + 1', 'z')} END AS output FROM cuts),
back AS (SELECT *, CASE form WHEN 'plain' THEN output WHEN 'psm' THEN regexp_replace(output, '(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)$', '\\1\\3\\2')
    ELSE regexp_replace(output, '(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)$', '\\2\\3\\1') END AS restored FROM done)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(z - a AS BIGINT) END AS middle_chars, output, restored, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM back"""


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most so many bytes of a text column, or of one row."""
    ends = text_edges(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def transform(docs: DataFrame, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, restored and the digests of the last two, a row a document."""
    sql = statement(rate, spm)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as con:
            for b in batches:
                for part in slices(b, "text"):
                    con.register("batch", pa.Table.from_batches([part]))
                    yield from con.sql(sql).to_arrow_table().cast(_ARROW).to_batches()
                    con.unregister("batch")

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, SCHEMA)


SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
d AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y, ('0x' || h[17:24])::BIGINT % 100 AS r, ('0x' || h[25:32])::BIGINT % 100 AS o FROM t),
f AS (SELECT *, least(x, y) AS a, greatest(x, y) AS z, CASE WHEN n = 0 OR regexp_matches(t, '<[PSM]>') OR r >= {RATE} THEN 'plain' WHEN o < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, z - a) AS mid, substring(t, z + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid) ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
"""
