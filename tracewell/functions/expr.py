"""Column expressions that the operators share. All of them stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    """The name of the directory that holds a file."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def trailing_index(path: Column) -> Column:
    """The last run of digits in a file's name, null if there is none."""
    runs = F.regexp_extract_all(basename(path), F.lit(r"(\d+)"), F.lit(1))
    return F.when(F.size(runs) > 0, F.element_at(runs, -1)).cast("long")


def to_theta(value: Column, is_log: Column) -> Column:
    """Natural units to inference coordinates. Values that have no logarithm become null, not an error."""
    return F.when(is_log, F.when(value > 0, F.ln(value))).otherwise(value)


def to_natural(theta: Column, is_log: Column) -> Column:
    return F.when(is_log, F.exp(theta)).otherwise(theta)


def finite(x: Column) -> Column:
    """False for null, NaN and infinities."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def all_finite(xs: Column) -> Column:
    return F.coalesce(F.forall(xs, finite), F.lit(False))


def close_to(got: Column, want: Column, rtol: float, atol: float) -> Column:
    """|got - want| <= atol + rtol |want|, and both finite."""
    return finite(got) & finite(want) & (F.abs(got - want) <= atol + rtol * F.abs(want))


def l2_norm(xs: Column) -> Column:
    """Norm of a vector, summed in double."""
    return F.sqrt(F.aggregate(xs, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))


def edge_bin(t: Column, dt: float) -> Column:
    """The k with k * dt <= t < (k + 1) * dt as doubles compute it; floor(t / dt) alone is off by one on some edges."""
    k = F.floor(t / dt)
    up = F.when((k + 1) * F.lit(dt) <= t, 1).otherwise(0)
    down = F.when(k * F.lit(dt) > t, 1).otherwise(0)
    return (k + up - down).cast("long")


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    """Weights of a sampled Gaussian at -r..r with r = int(truncate * sigma + 0.5); they sum to one."""
    if sigma < 0:
        raise ValueError(f"sigma must not be negative, got {sigma}")
    if sigma == 0:
        return [1.0]
    r = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (j / sigma) ** 2) for j in range(-r, r + 1)]
    total = sum(raw)
    return [w / total for w in raw]


def doubles(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def flattened(vector: str, stem: str, width: int, kind: str = "float") -> list[Column]:
    """Columns stem_000, stem_001 ... of a vector."""
    return [F.get(F.col(vector), F.lit(j)).cast(kind).alias(f"{stem}_{j:03d}") for j in range(width)]


def reassembled(stem: str, width: int) -> Column:
    return F.array(*[F.col(f"{stem}_{j:03d}") for j in range(width)])
