"""Command line: export synthetic records, a campaign or all campaigns of a root, or take inventory.

Exit codes: 2 usage, 3 a path is missing, 4 nothing matches.
"""

from __future__ import annotations

import argparse
import dataclasses
import fnmatch
import importlib
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tracewell.operators.encoder import EncoderSpec, demo_spec, file_digests
from tracewell.operators.labels import assemble_labels, build_label_spec
from tracewell.operators.registry import Registry, assert_roundtrip
from tracewell.operators.traces import build_traces
from tracewell.plans.campaign import IDENT, campaign_records, campaign_runs, description_extra, export_campaigns, launch_plan, pending
from tracewell.plans.export import export_embeddings
from tracewell.sinks.store import Store
from tracewell.sources import settings
from tracewell.sources.inventory import detailed, inventory
from tracewell.sources.synthetic import synthetic_detections


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tracewell", description=__doc__)
    p.add_argument("--mode", choices=("synthetic", "campaign", "campaigns", "inventory"), default="synthetic")
    p.add_argument("--out", help="path of the shard without extension; for campaigns, the folder of the shards")
    p.add_argument("--sim_dir", help="folder with registry.parquet and registry.json (kernel_bounds, sweep_groups, log_params)")
    p.add_argument("--dsn_main_dir", help="folder put on the import path for --checkpoint")
    p.add_argument("--checkpoint", help="module:function that returns an EncoderSpec")
    p.add_argument("--campaign", help="folder with the sweep output; for campaigns and inventory, the root of all campaigns")
    p.add_argument("--mea_out", help="folder with the detections; for campaigns, the root of the detections if that is another")
    p.add_argument("--glob", default="*", help="names of the campaigns to run (campaigns)")
    p.add_argument("--at_once", type=int, default=4, help="campaigns to run side by side (campaigns)")
    p.add_argument("--campaign_id", default="campaign")
    p.add_argument("--n_electrodes", type=int)
    p.add_argument("--simtime", type=float)
    p.add_argument("--sweep_group", default="neuron_synapse")
    p.add_argument("--conn_prob_lo", type=float)
    p.add_argument("--conn_prob_hi", type=float)
    p.add_argument("--batch_size", type=int, default=256)
    p.add_argument("--max_records", type=int)
    p.add_argument("--n_sims", type=int, default=24)
    p.add_argument("--device", default="cpu", help="passed to the encoder factory")
    p.add_argument("--dry_run", action="store_true", help="show the plan and write nothing")
    return p


def load_registry(spark: SparkSession, folder: str) -> Registry:
    more = settings.read_json(spark, f"{folder}/registry.json")
    return Registry.read(spark.read.parquet(f"{folder}/registry.parquet"), more["kernel_bounds"], more.get("sweep_groups"), more.get("log_params"), more.get("log_base", "natural"))


def load_encoder(spark: SparkSession, factory: str, folder: str | None, device: str) -> EncoderSpec:
    """The factory's spec. Where it names the file of its weights, the digest is taken from that file; a factory that
    claims another digest is refused."""
    if folder and folder not in sys.path:
        sys.path.insert(0, folder)
    module, _, name = factory.partition(":")
    spec = getattr(importlib.import_module(module), name)(device)
    if spec.path and Store(spark).exists(spec.path):
        digest = file_digests(spark, spec.path).first()["sha256"]
        if spec.digest not in (digest, "0" * 64):
            raise SystemExit(f"the encoder claims the digest {spec.digest}, but {spec.path} has {digest}")
        return dataclasses.replace(spec, digest=digest)
    return spec


def run_campaigns(spark: SparkSession, args: argparse.Namespace, registry: Registry, encoder: EncoderSpec) -> int:
    """Every campaign of the root whose name matches and whose shard isn't complete, or (dry run) what would be run."""
    sweeps = detailed(spark, args.campaign)
    detections = inventory(spark, args.mea_out) if args.mea_out else sweeps
    plan = launch_plan(detections, sweeps).cache()
    rows = [r for r in plan.orderBy("campaign").collect() if fnmatch.fnmatchcase(r["campaign"], args.glob)]
    if not rows:
        print(f"no campaign matches {args.glob}", file=sys.stderr)
        return 4
    left = set(pending(spark, plan, args.out))
    names = [r["campaign"] for r in rows if r["campaign"] in left]
    for r in rows:
        say = "run" if r["campaign"] in left else f"skip ({r['reason'] or 'already exported'})"
        print(f"{r['campaign']}: {say}")
    if args.dry_run:
        return 0
    runs = campaign_runs(plan, sweeps, registry, names, args.simtime, args.sweep_group, args.n_electrodes)
    for name, out in export_campaigns(spark, runs, args.out, encoder, args.at_once, args.max_records, batch_size=args.batch_size).items():
        print(f"{name}: rows {out.n_rows}, held {', '.join(out.assertions_passed)}, {out.parquet_path}")
    print(f"exported {len(runs)}, skipped {len(rows) - len(runs)}")
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    need = {"synthetic": ("out", "sim_dir"), "campaign": ("out", "sim_dir", "checkpoint", "campaign", "mea_out"), "campaigns": ("out", "sim_dir", "checkpoint", "campaign"), "inventory": ("campaign",)}[args.mode]
    for name in need:
        if not getattr(args, name):
            p.error(f"--{name} is required for --mode {args.mode}")
    spark = spark or SparkSession.builder.appName("tracewell").getOrCreate()
    store = Store(spark)
    for name in ("campaign", "mea_out", "sim_dir"):
        if (name in need or args.mode == "campaigns" and name == "mea_out" and args.mea_out) and not store.exists(getattr(args, name)):
            print(f"--{name}: no such path: {getattr(args, name)}", file=sys.stderr)
            return 3
    if args.mode == "inventory":
        rows = detailed(spark, args.campaign).orderBy("campaign").collect()
        for r in rows:
            print(json.dumps(r.asDict()))
        return 0 if rows else 4

    registry = load_registry(spark, args.sim_dir)
    assert_roundtrip(registry.table(spark))
    if args.mode == "campaigns":
        return run_campaigns(spark, args, registry, load_encoder(spark, args.checkpoint, args.dsn_main_dir, args.device))
    campaign = args.mode == "campaign"
    manifest = settings.read_json(spark, f"{args.campaign}/manifest.json") if campaign else {}
    job_args = settings.read_json(spark, f"{args.campaign}/job_args.json") if campaign else {}
    axes, group = settings.active_axes(manifest, registry, args.sweep_group)
    spec = build_label_spec(registry, axes, group, settings.conn_prob_bounds(job_args, args.conn_prob_lo, args.conn_prob_hi), settings.kernel_bounds(job_args, registry.kernel_bounds))
    duration = settings.duration(job_args, args.simtime)
    encoder = load_encoder(spark, args.checkpoint, args.dsn_main_dir, args.device) if campaign else demo_spec(duration)
    if duration < encoder.window_s:
        raise SystemExit(f"the duration of {duration} s is below the encoder's window of {encoder.window_s} s: every trace would be dropped")
    if campaign:
        records = campaign_records(spark, args.campaign, args.mea_out, spec, duration, args.campaign_id, args.n_electrodes, encoder.dt, encoder.sigma_s, True, args.max_records)
    else:
        made = synthetic_detections(spark, spec, args.n_sims, duration, args.n_electrodes or 9)
        records = build_traces(assemble_labels(made, spec).drop("theta"), duration, encoder.dt, encoder.sigma_s)
    if args.dry_run:
        records.explain("formatted")
        return 0
    if campaign and records.limit(1).count() == 0:
        print("no detections found", file=sys.stderr)
        return 4
    n_e = args.n_electrodes or records.agg(F.max("n_electrodes")).first()[0]
    out = export_embeddings(encoder, records, args.out, spec, IDENT, description_extra(args.campaign_id, duration, group, n_e, manifest, job_args), args.batch_size)
    print(f"rows {out.n_rows}, traces used {out.n_traces_used}, too short {out.n_traces_skipped_short}, dimension {out.embedding_dim}")
    print("held: " + ", ".join(out.assertions_passed))
    print(f"{out.parquet_path}\n{out.sidecar_path}")
    for w in out.warnings:
        print(f"warning: {w}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
