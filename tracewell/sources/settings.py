"""The two optional JSON documents of a campaign, and what a run takes from them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import SparkSession

from tracewell.operators.registry import Registry
from tracewell.sinks.store import Store


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    """The document, or an empty one where there is no file."""
    store = Store(spark)
    return json.loads(store.read_text(path)) if store.exists(path) else {}


def active_axes(manifest: Mapping[str, Any], registry: Registry, sweep_group: str) -> tuple[list[int], str]:
    """The manifest's axes and group; without axes there, those of the registry's group."""
    group = manifest.get("sweep_group", sweep_group)
    axes = manifest.get("active_indices")
    return (list(axes), group) if axes is not None else (list(registry.sweep_groups[sweep_group]), group)


def conn_prob_bounds(job_args: Mapping[str, Any], lo: float | None = None, hi: float | None = None) -> tuple[float, float]:
    """A flag wins over the job's value, which wins over the default."""
    return (float(job_args.get("conn_prob_lo", 0.1)) if lo is None else lo, float(job_args.get("conn_prob_hi", 0.6)) if hi is None else hi)


def kernel_bounds(job_args: Mapping[str, Any], default: Sequence[Sequence[float]]) -> list[tuple[float, float]]:
    """The registry's kernel bounds with the job's overrides, bound by bound."""
    keys = ("p0", "d0", "beta")
    return [(float(job_args.get(f"{k}_lo", lo)), float(job_args.get(f"{k}_hi", hi))) for k, (lo, hi) in zip(keys, default)]


def duration(job_args: Mapping[str, Any], flag: float | None = None, default: float = 180.0) -> float:
    return float(job_args.get("simtime", default)) if flag is None else flag
