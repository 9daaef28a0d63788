"""Labels: the active registry axes of a stored theta vector, then the four connectivity axes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.expr import close_to, finite, to_theta
from tracewell.operators.registry import TOPOLOGY_AXES, TOPOLOGY_UNITS, Registry

#: How near a stored theta must be to the coordinate rule (A6).
RTOL, ATOL = 1e-8, 1e-10


@dataclass(frozen=True)
class LabelSpec:
    """Names, coordinates ("ln" or "linear"), theta bounds and units of the label columns, in their order."""

    param_names: list[str]
    coord: list[str]
    bounds_theta: list[tuple[float, float]]
    units: list[str]
    active_indices: list[int]
    registry: Registry
    sweep_group: str = ""

    @property
    def p(self) -> int:
        return len(self.param_names)

    @property
    def column_names(self) -> list[str]:
        return [f"th_{n}" for n in self.param_names]

    def table(self, spark: SparkSession) -> DataFrame:
        """One row a label column: pos, name, coord, lo, hi, unit and the registry axis (null for connectivity)."""
        axes: list[int | None] = [*self.active_indices, *[None] * len(TOPOLOGY_AXES)]
        rows = [(i, n, c, float(b[0]), float(b[1]), u, a) for i, (n, c, b, u, a) in enumerate(zip(self.param_names, self.coord, self.bounds_theta, self.units, axes))]
        return spark.createDataFrame(rows, "pos int, name string, coord string, lo double, hi double, unit string, registry_axis int")

    def registry_block(self) -> dict:
        """The description's registry part. Its key names are a fixed format."""
        r = self.registry
        return {
            f"param_names_{len(r.names)}": r.names,
            f"param_units_{len(r.names)}": r.units,
            "log_param_indices": r.log_axes,
            "n_log_axes": len(r.log_axes),
            "log_transform": r.log_base,
            "active_indices": self.active_indices,
            "frozen_excluded": r.frozen,
            "sweep_group": self.sweep_group,
            "topology_axes": list(TOPOLOGY_AXES),
            "topology_coord": "linear",
            "kernel_bounds_p0_d0_beta": [list(b) for b in r.kernel_bounds],
        }


def build_label_spec(registry: Registry, active_indices: Sequence[int], sweep_group: str = "neuron_synapse", conn_prob_bounds: tuple[float, float] = (0.1, 0.6), kernel_bounds: Sequence[Sequence[float]] | None = None) -> LabelSpec:
    """The label of the active axes. Connectivity axes stay linear whatever their bounds span; a box without width on
    any axis is refused (A3)."""
    active = [int(k) for k in active_indices]
    if not active:
        raise ValueError("no active axis")
    if len(set(active)) < len(active):
        raise ValueError(f"active axes repeat: {active}")
    if outside := [k for k in active if not 0 <= k < len(registry.names)]:
        raise ValueError(f"active axes outside the registry of {len(registry.names)}: {outside}")
    kernel = registry.kernel_bounds if kernel_bounds is None else kernel_bounds
    if len(kernel) != 3 or any(len(b) != 2 for b in kernel):
        raise ValueError("kernel bounds must be three pairs: p0, d0, beta")
    logs = set(registry.log_axes)
    names = [registry.names[k] for k in active] + list(TOPOLOGY_AXES)
    bounds = [tuple(map(float, b)) for b in [*(registry.bounds_theta[k] for k in active), conn_prob_bounds, *kernel]]
    if flat := [n for n, (lo, hi) in zip(names, bounds) if not hi - lo > 0]:
        raise ValueError(f"A3: bounds without width on {flat}")
    if len(set(names)) < len(names):
        raise ValueError(f"label names repeat: {names}")
    return LabelSpec(names, ["ln" if k in logs else "linear" for k in active] + ["linear"] * 4, bounds, [registry.units[k] for k in active] + list(TOPOLOGY_UNITS), active, registry, sweep_group)


def coord_violations(spec: LabelSpec, theta: Column, params: Column, rtol: float = RTOL, atol: float = ATOL) -> Column:
    """A6: names of the active axes on which stored theta is not the coordinate rule applied to the natural value;
    empty where there are no params."""
    logs = set(spec.registry.log_axes)
    off = []
    for name, k in zip(spec.param_names, spec.active_indices):
        want = to_theta(F.get(params, F.lit(k)), F.lit(k in logs))
        off.append(F.when(params.isNotNull() & ~close_to(F.get(theta, F.lit(k)), want, rtol, atol), F.lit(name)))
    return F.filter(F.array(*off), lambda x: x.isNotNull())


def label_rules(spec: LabelSpec, verify_coords: bool = True) -> dict[str, tuple[Column, Column]]:
    """What a record's label must meet, in the order in which it is judged: whether the rule holds (never null), and
    what to say where it doesn't. ``verify_coords`` needs a column of params; without a sound width A6 isn't judged.
    The conditions name the axes one by one, so that they stay in generated code."""
    width = len(spec.registry.names)
    theta, params = F.col("theta"), F.col("params")
    sized = lambda v: F.coalesce(F.size(v) == width, F.lit(False))
    wide = lambda v: F.lit(f"{v} must have {width} entries, the width of the registry")
    present = reduce(and_, [finite(F.col(a).cast("double")) for a in TOPOLOGY_AXES])
    out = {"V7": (sized(theta), wide("theta")), "V8": (present, F.lit("a connectivity value is missing or not finite; a campaign with the flat rule has none"))}
    if verify_coords:
        logs = set(spec.registry.log_axes)
        near = reduce(and_, [close_to(F.get(theta, F.lit(k)), to_theta(F.get(params, F.lit(k)), F.lit(k in logs)), RTOL, ATOL) for k in spec.active_indices])
        both = sized(theta) & (params.isNull() | sized(params))
        out["V7"] = (both, F.when(sized(theta), wide("params")).otherwise(wide("theta")))
        off = F.array_join(coord_violations(spec, theta, params), ", ")
        out["A6"] = (~both | params.isNull() | near, F.concat(F.lit("A6: stored theta breaks the coordinate rule on "), off))
    return out


def label_problem(spec: LabelSpec, verify_coords: bool = True) -> Column:
    """What is wrong with a record's label, by the first rule that it breaks, or null."""
    return F.coalesce(*[F.when(~ok, why) for ok, why in label_rules(spec, verify_coords).values()])


def label_vector(spec: LabelSpec) -> Column:
    """The active axes of theta, then connectivity."""
    return F.array(*[F.get("theta", F.lit(k)) for k in spec.active_indices], *[F.col(a).cast("double") for a in TOPOLOGY_AXES])


def assemble_labels(rows: DataFrame, spec: LabelSpec, verify_coords: bool = True, out: str = "theta_a") -> DataFrame:
    """``rows`` (theta, params or none, and the four connectivity columns) with the label vector.

    The stored theta is taken as it is. A vector of the wrong width, a missing or non-finite connectivity value and,
    where params are there, a broken coordinate rule stop the job.
    """
    missing = [a for a in TOPOLOGY_AXES if a not in rows.columns]
    if missing:
        raise KeyError(f"connectivity columns are missing: {missing}")
    rules = label_rules(spec, verify_coords and "params" in rows.columns)
    holds = reduce(and_, [ok for ok, _ in rules.values()])
    why = F.coalesce(*[F.when(~ok, why) for ok, why in rules.values()])
    return rows.filter(F.when(holds, True).otherwise(F.raise_error(why).cast("boolean"))).withColumn(out, label_vector(spec))
