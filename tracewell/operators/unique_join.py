"""A join on a key that must be unique on both sides and present on the right.

The reference semantics is one match a row, never a surrogate. Each side is read once: the right side becomes one row
a key with its count, the count of the left keys rides along as a window over the key that the join shuffles by
anyway (or comes from a listing of the keys, where there is one), and a row whose key breaks the rule stops the job
with the key in the message.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_violations(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that ``unique_join`` refuses: twice or more on either side, or on the left without a match. A key that only
    the right side holds breaks nothing."""
    a = left.groupBy(*on).agg(F.count("*").alias("n_left"))
    b = right.groupBy(*on).agg(F.count("*").alias("n_right"))
    met = a.join(b, list(on), "full_outer").select(*on, *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_left", "n_right")])
    return met.filter("n_left > 1 OR n_right > 1 OR (n_left = 1 AND n_right = 0)")


def unique_join(left: DataFrame, right: DataFrame, on: Sequence[str], unique_left: bool = True, left_keys: DataFrame | None = None) -> DataFrame:
    """Every left row with its one right row; anything else raises when the result is computed. ``left_keys`` are the
    keys of the left rows from a source that is cheaper than the rows, such as a listing of files."""
    on = list(on)
    others = [c for c in right.columns if c not in on]
    once = right.groupBy(*on).agg(F.count("*").alias("__n_right"), F.any_value(F.struct(*[F.col(c) for c in others])).alias("__right")) if others else right.groupBy(*on).agg(F.count("*").alias("__n_right"))
    sound = F.coalesce(F.col("__n_right"), F.lit(0)) == 1
    if not unique_left:
        met = left.join(once, on, "left")
    elif left_keys is not None:
        met = left.join(once, on, "left").join(left_keys.groupBy(*on).agg(F.count("*").alias("__n_left")), on, "left")
    else:
        met = left.withColumn("__n_left", F.count("*").over(Window.partitionBy(*on))).join(once, on, "left")
    if unique_left:
        sound &= F.coalesce(F.col("__n_left"), F.lit(0)) == 1
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in on])
    met = met.filter(F.when(sound, True).otherwise(F.raise_error(F.concat(F.lit("the join key is not unique or has no match: "), shown)).cast("boolean")))
    return met.select(*left.columns, *[F.col("__right")[c].alias(c) for c in others])
