"""Shard constraints, as one aggregate over the shard and a verdict on the driver. Nothing is clipped or repaired.

Order of the verdict: A9 (z, zraw), A7, A9 (theta), A2, A3, A4, A5; the first that fails is raised.

Constant columns are found by equal minimum and maximum, not by variance: the variance of equal numbers need not
be exactly zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tracewell.functions.expr import all_finite, l2_norm
from tracewell.operators.labels import LabelSpec

UNIT_TOLERANCE = 1e-5


def unit_norm(z: Column) -> Column:
    """Largest distance of a vector's norm from one."""
    return F.max(F.abs(l2_norm(z) - 1.0))


def out_of_box(value: Column, lo: Column | float, hi: Column | float) -> Column:
    return F.count_if((value < lo) | (value > hi))


def metric_columns(shard: DataFrame, p: int = 0, box: list[tuple[Column, Column]] | None = None, theta: str = "theta_a") -> list[Column]:
    """The aggregates that the verdict needs, for a whole table or a group; ``box`` has the bounds of the p axes."""
    out = [F.count("*").alias("n_rows"), F.count_if(~all_finite(F.col("z"))).alias("bad_z"), unit_norm(F.col("z")).alias("off_unit")]
    if "zraw" in shard.columns:
        out.append(F.count_if(~all_finite(F.col("zraw"))).alias("bad_zraw"))
    if box is not None:
        out.append(F.count_if(~all_finite(F.col(theta))).alias("bad_theta"))
        out.append(F.count_if(F.coalesce(F.size(theta), F.lit(-1)) != p).alias("bad_width"))
        for j, (lo, hi) in enumerate(box):
            v = F.get(F.col(theta), F.lit(j))
            out += [F.min(v).alias(f"min_{j}"), F.max(v).alias(f"max_{j}"), out_of_box(v, lo, hi).alias(f"out_{j}")]
    return out


def metrics(shard: DataFrame, spec: LabelSpec | None = None, theta: str = "theta_a") -> Row:
    """Everything the verdict needs, in one pass with a few numbers to the driver."""
    box = None if spec is None else [(F.lit(lo), F.lit(hi)) for lo, hi in spec.bounds_theta]
    return shard.agg(*metric_columns(shard, 0 if spec is None else spec.p, box, theta)).first()


def by_axis(m: Row, spec: LabelSpec) -> list[tuple[str, bool, int]]:
    """Name, whether the column is constant, and number of values outside the box, of every label column."""
    return [(n, m[f"min_{j}"] == m[f"max_{j}"], m[f"out_{j}"]) for j, n in enumerate(spec.param_names)]


def verdict(m: Row, spec: LabelSpec | None, l2_normalize: bool = True, strict_in_box: bool = True) -> tuple[list[str], list[str]]:
    """Names of the constraints that hold, and warnings; raises on the first that does not."""
    held, notes = [], []
    if m["n_rows"] == 0:
        raise ValueError("no window came out of any trace; all are shorter than the window")
    for c in ("z", "zraw"):
        if f"bad_{c}" in m and m[f"bad_{c}"]:
            raise AssertionError(f"A9: {m[f'bad_{c}']} rows of {c} are not finite")
    if l2_normalize:
        if not m["off_unit"] < UNIT_TOLERANCE:
            raise AssertionError(f"A7: a norm is {m['off_unit']:.3e} from one")
        held.append("A7")
    else:
        notes.append("A7 skipped: the encoder does not normalise")
    if spec is None:
        return [*held, "A9"], notes
    if m["bad_width"]:
        raise ValueError(f"{m['bad_width']} labels are missing or do not have {spec.p} entries; labelled and unlabelled rows do not mix")
    if m["bad_theta"]:
        raise AssertionError(f"A9: {m['bad_theta']} labels are not finite")
    held.append("A9")
    if not len(spec.param_names) == len(spec.coord) == len(spec.bounds_theta) == spec.p:
        raise AssertionError("A2: names, coordinates and bounds differ in length")
    held.append("A2")
    if flat := [n for n, (lo, hi) in zip(spec.param_names, spec.bounds_theta) if not hi - lo > 0]:
        raise AssertionError(f"A3: bounds without width on {flat}")
    held.append("A3")
    if constant := [n for n, same, _ in by_axis(m, spec) if same]:
        raise AssertionError(f"A4: constant label columns {constant}")
    held.append("A4")
    if outside := {n: off for n, _, off in by_axis(m, spec) if off}:
        note = f"A5: {sum(outside.values())} label entries lie outside their bounds, by axis {outside}"
        if strict_in_box:
            raise AssertionError(note)
        notes.append(note)
    else:
        held.append("A5")
    return held, notes
