"""What a shard says about its content, so that shards can be checked and pooled without reading them again.

* ``content_digest``: a digest of the rows as a multiset: per row, two halves of an MD5 of all columns (by name), summed
  exactly. It doesn't depend on the order of rows, columns or files, and a row that is changed, lost or doubled shows.
* ``axis_summary``: per axis the count, least and greatest value, number outside its box, mean and sum of squared
  deviations. Summaries of shards merge to that of their union; pooled A4 and A5 checks read descriptions alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a half that are summed: 60 bits, so that 10^18 rows fit in a decimal of 38 digits.
HALF = 15
AXES = "array<struct<axis:string,n:bigint,lo:double,hi:double,n_outside:bigint,mean:double,m2:double>>"


def row_text(columns: list[str]) -> Column:
    """A row as text, columns by name; lengths before values keep neighbours apart."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))
    return F.concat(*[F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)) for c in sorted(columns)])


def content_columns(columns: list[str]) -> list[Column]:
    digest = F.md5(row_text(columns))
    half = lambda at: F.sum(F.conv(F.substring(digest, at, HALF), 16, 10).cast("decimal(20,0)"))
    return [F.count("*").alias("n_rows"), *[F.coalesce(half(at), F.lit(0)).cast("decimal(38,0)").alias(c) for c, at in (("sum_a", 1), ("sum_b", 1 + HALF))]]


def content_digest(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """n_rows, sum_a and sum_b, of the whole table or of each group; the grouping columns are not part of the rows."""
    by = by or []
    return rows.groupBy(*by).agg(*content_columns([c for c in rows.columns if c not in by]))


def axis_summary(rows: DataFrame, boxes: Mapping[str, tuple[float, float]], by: list[str] | None = None) -> DataFrame:
    """axis, n, lo, hi, n_outside, mean and m2 of each axis (of each group), in one pass."""
    of = []
    for name, (lo, hi) in boxes.items():
        v = F.col(f"`{name}`").cast("double")
        n = F.count(v)
        of.append(F.struct(F.lit(name).alias("axis"), n.alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.count_if((v < lo) | (v > hi)).alias("n_outside"), F.avg(v).alias("mean"), (F.var_pop(v) * n).alias("m2")))
    return rows.groupBy(*(by or [])).agg(F.array(*of).alias("axes")).select(*(by or []), F.inline("axes"))


def merged(summaries: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Summaries (axis, n, ...) of parts as those of their unions, by axis (and group)."""
    n = F.sum("n")
    mean = F.sum(F.col("mean") * F.col("n")) / n
    m2 = F.sum("m2") + F.sum(F.col("mean") * F.col("mean") * F.col("n")) - n * mean * mean
    return summaries.filter("n > 0").groupBy(*(by or []), "axis").agg(n.alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n_outside").alias("n_outside"), mean.alias("mean"), F.greatest(m2, F.lit(0.0)).alias("m2"))


def described_axes(described: DataFrame) -> DataFrame:
    """path and summaries from descriptions (path, text)."""
    return described.select("path", F.inline(F.from_json(F.get_json_object("text", "$.axis_summary"), AXES)))


def pooled_violations(described: DataFrame) -> DataFrame:
    """A4 and A5 over the union of shards, from their descriptions: axis and what is broken."""
    pooled = merged(described_axes(described))
    rule = F.when(F.col("lo") == F.col("hi"), "A4").when(F.col("n_outside") > 0, "A5")
    return pooled.withColumn("rule", rule).filter("rule IS NOT NULL").select("axis", "rule", "n", "n_outside")
