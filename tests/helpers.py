"""A made-up registry and campaign trees for the tests."""

import json
import math
import os

import numpy as np

from tracewell.operators.registry import Registry

#: name, lo, hi: four log axes, two linear ones, one frozen.
AXES = [("Sigma", 0.5, 50.0), ("Tau", 1.0, 10.0), ("VA", -70.0, -50.0), ("Gain", 1.0, 200.0), ("Cm", 80.0, 200.0), ("VT", -52.0, -52.0), ("Rate", 0.01, 1.0)]
KERNEL = [(0.1, 1.0), (50.0, 500.0), (0.5, 3.0)]
ACTIVE = [0, 2, 3, 4]


def registry() -> Registry:
    names, bounds = [a[0] for a in AXES], [(a[1], a[2]) for a in AXES]
    base = Registry(names, ["u"] * len(names), bounds, bounds, KERNEL, {"neuron_synapse": ACTIVE})
    logs = base.log_axes
    theta = [tuple(map(math.log, b)) if k in logs else b for k, b in enumerate(bounds)]
    return Registry(names, ["u"] * len(names), bounds, theta, KERNEL, {"neuron_synapse": ACTIVE})


def write_campaign(root, n_topo=2, n_iter=3, n_e=4, duration=2.0, seed=0, name="campaign_a"):
    """Detections and sweep files of one campaign in one tree; returns its folder."""
    rng, reg = np.random.default_rng(seed), registry()
    base = os.path.join(str(root), name)
    for k in range(1, n_topo + 1):
        d = os.path.join(base, f"topo_{k}")
        os.makedirs(d, exist_ok=True)
        for i in range(n_iter):
            params = np.array([rng.uniform(lo, hi) for lo, hi in reg.bounds])
            theta = np.array([math.log(v) if j in reg.log_axes else v for j, v in enumerate(params)])
            n = int(rng.integers(50, 90))
            np.savez(os.path.join(d, f"mea_iter_{i:05d}.npz"), det_t=np.sort(rng.uniform(0, duration, n)), det_ch=rng.integers(0, n_e, n), theta=theta, params=params, topo_idx=k, electrode_centers=np.zeros((n_e, 2)), simtime=9.0)
            np.savez(os.path.join(d, f"iter_{i:05d}.npz"), conn_prob=rng.uniform(0.1, 0.6), p0_conn=rng.uniform(0.1, 1.0), d0_conn=rng.uniform(50, 500), beta_conn=rng.uniform(0.5, 3.0))
    with open(os.path.join(base, "manifest.json"), "w") as f:
        json.dump({"active_indices": ACTIVE, "sweep_group": "neuron_synapse", "n_total_runs": n_topo * n_iter, "manifest_version": 3}, f)
    with open(os.path.join(base, "job_args.json"), "w") as f:
        json.dump({"simtime": duration, "conn_prob_lo": 0.05, "p0_hi": 1.5, "conn_rule": "weibull"}, f)
    return base
