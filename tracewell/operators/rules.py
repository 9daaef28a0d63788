"""The validation rules as columns, so that what would stop a job is found for all campaigns, records or windows at once.

Each function gives rules by name as conditions that are true where a rule holds and null or false where it is broken.
``broken`` names the rules that a row breaks, ``rule_counts`` counts them in one aggregate without a shuffle of rows.

* ``setting_rules``: a table with a row a campaign, checked before any job starts: duration, dt, n_electrodes, sigma_s,
  window_s, stride (null: the window), active_indices, n_axes and kernel_bounds;
* ``record_rules``: detection records with their label: det_t, theta, params and connectivity;
* ``window_rules``: windows with an encoder's outputs: xw, z, zraw and theta_a.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.expr import all_finite, finite
from tracewell.operators.encoder import EncoderSpec
from tracewell.operators.labels import LabelSpec, label_rules


def setting_rules() -> dict[str, Column]:
    """V1 a grid of at least one bin, V2 electrodes and smoothing, V3 window and stride, V5 active axes that are in the
    registry once, V6 three pairs of kernel bounds, V10 a duration of at least a window, V13 smoothing of at least a
    bin (a warning)."""
    duration, dt, sigma = (F.col(c).cast("double") for c in ("duration", "dt", "sigma_s"))
    bins = F.floor(F.when(dt > 0, F.try_divide(duration, dt)))
    length = F.rint(F.when(dt > 0, F.try_divide(F.col("window_s").cast("double"), dt)))
    active, n = F.col("active_indices"), F.size("active_indices")
    return {
        "V1": finite(duration) & finite(dt) & (dt > 0) & (bins >= 1),
        "V2": (F.col("n_electrodes") >= 1) & finite(sigma) & (sigma >= 0),
        "V3": finite(length) & (length >= 1) & F.coalesce(F.col("stride") >= 1, F.lit(True)),
        "V5": (n > 0) & (F.size(F.array_distinct(active)) == n) & F.forall(active, lambda k: (k >= 0) & (k < F.col("n_axes"))),
        "V6": (F.size("kernel_bounds") == 3) & F.forall("kernel_bounds", lambda b: F.size(b) == 2),
        "V10": finite(duration) & finite(length) & (bins >= length),
        "V13": finite(sigma) & ((sigma == 0) | (dt > 0) & (sigma >= dt)),
    }


def record_rules(spec: LabelSpec, verify_coords: bool = True) -> dict[str, Column]:
    """V4 finite spike times, and the rules of the label: V7 widths, V8 connectivity, A6 coordinates."""
    return {"V4": all_finite(F.col("det_t")), **{name: ok for name, (ok, _) in label_rules(spec, verify_coords).items()}}


def window_rules(encoder: EncoderSpec, p: int) -> dict[str, Column]:
    """V9 a label of p entries, V11 a window as the encoder takes it, V12 outputs of its dimension."""
    x, dim = F.col("xw"), encoder.embedding_dim
    return {
        "V9": F.size("theta_a") == p,
        "V11": (F.size(x) == encoder.window_length) & all_finite(x),
        "V12": F.col("z").isNotNull() & F.col("zraw").isNotNull() & (F.size("z") == dim) & (F.size("zraw") == dim),
    }


def broken(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that a row breaks, in the order of the rules."""
    return F.array_compact(F.array(*[F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(name)) for name, ok in rules.items()]))


def rule_counts(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule, n_broken and n_rows; one pass, counts combine before the shuffle."""
    counts = rows.agg(F.count("*").alias("n_rows"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("n_broken")) for name in rules])
    return counts.select(F.inline(pairs), "n_rows")
