"""The parameter registry: a small table of axes, given by the user, and the rules on it.

Table columns: axis int, name, unit, lo, hi (natural units), lo_theta, hi_theta (inference coordinates). Whether an
axis is logarithmic follows from its bounds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.expr import to_natural, to_theta

SCHEMA = "axis int, name string, unit string, lo double, hi double, lo_theta double, hi_theta double"
#: Names, in their order, of the four connectivity axes that close every label; always in natural units, never logarithmic.
TOPOLOGY_AXES = ("conn_prob", "p0_conn", "d0_conn", "beta_conn")
TOPOLOGY_UNITS = ("(dimensionless)", "(dimensionless)", "um", "(dimensionless)")


def is_log_axis(lo: Column, hi: Column) -> Column:
    """Positive bounds that span a decade or more."""
    return F.coalesce((lo > 0) & (hi > 0) & (F.when((lo > 0) & (hi > 0), F.log10(hi / lo)) >= 1), F.lit(False))


def is_frozen_axis(lo: Column, hi: Column) -> Column:
    return lo == hi


def with_rules(registry: DataFrame) -> DataFrame:
    lo, hi = F.col("lo"), F.col("hi")
    return registry.withColumn("is_log", is_log_axis(lo, hi)).withColumn("is_frozen", is_frozen_axis(lo, hi))


def log_set_drift(registry: DataFrame, stored: DataFrame) -> DataFrame:
    """Axes on which the derived and a stored (axis) log set disagree, with the side that has them."""
    derived = with_rules(registry).filter("is_log").select("axis")
    stored = stored.select("axis").distinct()
    only = lambda a, b, side: a.join(b, "axis", "left_anti").withColumn("only_in", F.lit(side))
    return only(derived, stored, "derived").unionByName(only(stored, derived, "stored"))


def roundtrip(registry: DataFrame) -> DataFrame:
    """Both bounds of every axis: the value, what comes back through theta, and their difference."""
    edges = F.array(F.struct(F.lit("lo").alias("edge"), F.col("lo").alias("v")), F.struct(F.lit("hi").alias("edge"), F.col("hi").alias("v")))
    rows = with_rules(registry).select("axis", "name", "is_log", F.inline(edges))
    back = to_natural(to_theta(F.col("v"), F.col("is_log")), F.col("is_log"))
    return rows.withColumn("back", back).withColumn("off", F.abs(F.col("back") - F.col("v")))


def assert_roundtrip(registry: DataFrame, rtol: float = 1e-9) -> None:
    """A1: natural units survive the way to theta and back at both bounds of every axis."""
    bad = F.coalesce(F.col("off") > rtol * F.abs("v"), F.lit(True))
    worst = roundtrip(registry).filter(bad).agg(F.count("*").alias("n"), F.max_by(F.struct("name", "edge", "v", "back"), F.coalesce("off", F.lit(float("inf")))).alias("w")).first()
    if worst["n"]:
        w = worst["w"]
        raise AssertionError(f"A1: {worst['n']} bounds do not survive the round trip, the worst is {w['edge']} of {w['name']}: {w['v']!r} -> {w['back']!r}")


@dataclass(frozen=True)
class Registry:
    """The registry as the driver holds it; a few dozen axes."""

    names: list[str]
    units: list[str]
    bounds: list[tuple[float, float]]
    bounds_theta: list[tuple[float, float]]
    kernel_bounds: list[tuple[float, float]]
    sweep_groups: dict[str, list[int]] = field(default_factory=dict)
    log_base: str = "natural"

    @property
    def log_axes(self) -> list[int]:
        return [k for k, (lo, hi) in enumerate(self.bounds) if lo > 0 and hi > 0 and math.log10(hi / lo) >= 1]

    @property
    def frozen(self) -> list[str]:
        return [n for n, (lo, hi) in zip(self.names, self.bounds) if lo == hi]

    @classmethod
    def read(cls, table: DataFrame, kernel_bounds: Sequence[Sequence[float]], sweep_groups: Mapping[str, Sequence[int]] | None = None, stored_log_axes: Sequence[int] | None = None, log_base: str = "natural") -> Registry:
        """From a registry table. A stored log set or base that differs from the rules stops here."""
        if log_base != "natural":
            raise RuntimeError(f"log base {log_base!r}; every log coordinate is a natural logarithm")
        rows = table.select(*[c.split()[0] for c in SCHEMA.split(", ")]).orderBy("axis").collect()
        out = cls([r["name"] for r in rows], [r["unit"] for r in rows], [(r["lo"], r["hi"]) for r in rows], [(r["lo_theta"], r["hi_theta"]) for r in rows], [tuple(map(float, b)) for b in kernel_bounds], {k: sorted(map(int, v)) for k, v in (sweep_groups or {}).items()}, log_base)
        if [r["axis"] for r in rows] != list(range(len(rows))):
            raise ValueError("registry axes must be 0, 1, 2 ... without gaps")
        if stored_log_axes is not None and sorted(stored_log_axes) != out.log_axes:
            raise RuntimeError(f"the bounds give the log axes {out.log_axes}, the stored set is {sorted(stored_log_axes)}")
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(k, n, u, *map(float, b), *map(float, t)) for k, (n, u, b, t) in enumerate(zip(self.names, self.units, self.bounds, self.bounds_theta))]
        return spark.createDataFrame(rows, SCHEMA)
