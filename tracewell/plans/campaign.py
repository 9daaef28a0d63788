"""Campaigns: detections joined to their connectivity, labelled and turned into traces; many campaigns in one table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators.encoder import EncoderSpec
from tracewell.operators.labels import LabelSpec, assemble_labels, build_label_spec
from tracewell.operators.registry import Registry
from tracewell.operators.traces import build_traces
from tracewell.operators.unique_join import unique_join
from tracewell.plans.export import ExportResult, export_embeddings
from tracewell.sinks.shard import is_complete, restore_previous
from tracewell.sources import settings
from tracewell.sources.npz import first_files, listed, read_detections, read_topology

IDENT = ("campaign_id", "topo_idx", "iter_idx", "seed_run")


def labelled_detections(detections: DataFrame, topology: DataFrame, spec: LabelSpec, verify_coords: bool = True, keys: DataFrame | None = None) -> DataFrame:
    """Each detection record with its one sweep record (by folder and file number, unique on both sides) and label.
    ``keys`` (topo_dir, iter_idx) of the detections, from their listing, spare the shuffle of the records for the count."""
    return assemble_labels(unique_join(detections, topology, ["topo_dir", "iter_idx"], left_keys=keys), spec, verify_coords)


def campaign_records(spark: SparkSession, campaign_dirs: str | list[str], mea_out_dirs: str | list[str], spec: LabelSpec, duration: float, campaign_id: str, n_electrodes: int | None = None, dt: float = 0.02, sigma_s: float = 0.04, verify_coords: bool = True, max_records: int | None = None) -> DataFrame:
    """Records ready for export. All sweep folders of a campaign may be given at once. ``path`` is their order. Every
    archive is opened once: that keys are unique is checked on the listing."""
    detections, found = read_detections(spark, mea_out_dirs, n_electrodes, max_records), listed(spark, mea_out_dirs)
    keys = (found if max_records is None else first_files(found, max_records)).select("topo_dir", "iter_idx")
    rows = labelled_detections(detections, read_topology(spark, campaign_dirs), spec, verify_coords, keys)
    kept = rows.select(F.lit(campaign_id).alias("campaign_id"), "path", "topo_idx", "iter_idx", "seed_run", "n_electrodes", "theta_a", "det_t", "det_ch")
    return build_traces(kept, duration, dt, sigma_s)


def launch_plan(detections: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Campaigns of an inventory of detections against an inventory of sweeps (which may be the same): what to run
    and why not. Columns campaign, status (RUN or SKIP), reason, and the trees of both sides, all of them."""
    a = detections.select("campaign", "n_detections", "detection_trees")
    b = sweeps.select(F.col("campaign").alias("other"), "n_topology", "topology_trees")
    met = a.join(b, F.col("campaign") == F.col("other"), "left")
    reason = F.when(F.col("n_detections") == 0, "no detections").when(F.col("other").isNull(), "no sweep tree of that name").when(F.col("n_topology") == 0, "no sweep output")
    return met.select("campaign", F.when(reason.isNull(), "RUN").otherwise("SKIP").alias("status"), reason.alias("reason"), "detection_trees", "topology_trees")


def pending(spark: SparkSession, plan: DataFrame, out_root: str) -> list[str]:
    """Campaigns to run whose shard is not complete yet. A publication that broke off is undone first."""
    names = [r["campaign"] for r in plan.filter("status = 'RUN'").select("campaign").orderBy("campaign").collect()]
    stems = {n: f"{out_root.rstrip('/')}/{n}" for n in names}
    for stem in stems.values():
        restore_previous(spark, stem)
    return [n for n in names if not is_complete(spark, stems[n])]


def description_extra(campaign_id: str, duration: float, sweep_group: str, n_electrodes: int | None, manifest: Mapping[str, Any], job_args: Mapping[str, Any]) -> dict[str, Any]:
    """Parts of the description that come from the campaign. Key names are a fixed format."""
    return {
        "campaign_id": campaign_id,
        "simulation": {"simtime_s": duration, "sweep_group": sweep_group, **{k: job_args.get(k) for k in ("mode", "conn_rule", "Nn")}},
        "observable": {"n_electrodes": n_electrodes, "electrode_forward_model": True},
        "provenance": {
            "n_attempted": manifest.get("n_total_runs"),
            "n_failed_discarded": manifest.get("n_total_failures_discarded"),
            "n_topologies": manifest.get("n_topologies_completed_or_partial"),
            "manifest_version": manifest.get("manifest_version"),
            "launch_flags": dict(job_args),
        },
    }


@dataclass(frozen=True)
class CampaignRun:
    """One campaign as it is to be exported."""

    name: str
    topology_trees: list[str]
    detection_trees: list[str]
    spec: LabelSpec
    duration: float
    extra: dict[str, Any]
    n_electrodes: int | None = None


def campaign_runs(plan: DataFrame, found: DataFrame, registry: Registry, names: Sequence[str], simtime: float | None = None, sweep_group: str = "neuron_synapse", n_electrodes: int | None = None) -> list[CampaignRun]:
    """The runs of some campaigns of a launch plan, with label, duration and description from their settings, which
    come with the detailed inventory of the sweeps. One row a campaign comes to the driver."""
    settings_of = found.select("campaign", "manifest_text", "job_args_text")
    rows = {r["campaign"]: r for r in plan.filter("status = 'RUN'").join(settings_of, "campaign", "left").collect()}
    out = []
    for name in names:
        r = rows[name]
        manifest, job_args = (json.loads(r[k] or "{}") for k in ("manifest_text", "job_args_text"))
        axes, group = settings.active_axes(manifest, registry, sweep_group)
        spec = build_label_spec(registry, axes, group, settings.conn_prob_bounds(job_args), settings.kernel_bounds(job_args, registry.kernel_bounds))
        duration = settings.duration(job_args, simtime)
        out.append(CampaignRun(name, r["topology_trees"], r["detection_trees"], spec, duration, description_extra(name, duration, group, n_electrodes, manifest, job_args), n_electrodes))
    return out


def export_campaigns(spark: SparkSession, runs: Sequence[CampaignRun], out_root: str, encoder: EncoderSpec, at_once: int = 4, max_records: int | None = None, **options: Any) -> dict[str, ExportResult]:
    """A shard for every run, ``at_once`` of them side by side on the same executors. The first campaign that breaks a
    constraint stops those that haven't begun; finished shards stay, and ``pending`` leaves them out next time."""

    def one(run: CampaignRun) -> ExportResult:
        if run.duration < encoder.window_s:
            raise ValueError(f"{run.name}: the duration of {run.duration} s is below the encoder's window of {encoder.window_s} s")
        records = campaign_records(spark, run.topology_trees, run.detection_trees, run.spec, run.duration, run.name, run.n_electrodes, encoder.dt, encoder.sigma_s, max_records=max_records)
        extra = dict(run.extra)
        if run.n_electrodes is None:
            example = read_detections(spark, run.detection_trees, max_records=1).first()
            extra["observable"] = {**extra.get("observable", {}), "n_electrodes": example["n_electrodes"] if example else None}
        return export_embeddings(encoder, records, f"{out_root.rstrip('/')}/{run.name}", run.spec, IDENT, extra, **options)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        futures = [pool.submit(one, run) for run in runs]
        try:
            return {run.name: f.result() for run, f in zip(runs, futures)}
        finally:
            for f in futures:
                f.cancel()


def pooled_records(spark: SparkSession, runs: Sequence[CampaignRun], dt: float = 0.02, sigma_s: float = 0.04) -> DataFrame:
    """Records of many sweep folders or campaigns as one table, to be partitioned by ``campaign_id``."""
    tables = [campaign_records(spark, r.topology_trees, r.detection_trees, r.spec, r.duration, r.name, r.n_electrodes, dt, sigma_s) for r in runs]
    return reduce(DataFrame.unionByName, tables)


def write_pooled(records: DataFrame, path: str) -> None:
    """One folder a campaign below ``path``; a reader of one campaign opens no other's files."""
    records.write.partitionBy("campaign_id").parquet(path)
