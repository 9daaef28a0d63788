"""Binning, smoothing and windows: golden, metamorphic and negative cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.functions.expr import edge_bin, gaussian_weights, trailing_index
from tracewell.operators.binning import bin_counts, channel_counts, dense_grid, grid_bins, rejected, window_samples
from tracewell.operators.smoothing import smooth_dense, smooth_rows
from tracewell.operators.traces import build_traces, pooled_counts, rate, traces_from_counts
from tracewell.operators.windows import cut_windows, window_rows


def made_spikes(seed, duration, n_e):
    rng = np.random.default_rng(seed)
    t, c = [], []
    for e in range(n_e):
        times = np.sort(np.clip(np.concatenate([rng.uniform(0, duration, rng.poisson(2 * duration)), rng.normal(duration / 2, 0.05, 30)]), 0, duration - 1e-9))
        t.append(times)
        c.append(np.full(len(times), e))
    return np.concatenate(t), np.concatenate(c)


@pytest.mark.parametrize("samples,starts", [(9000, [0]), (8999, []), (60000, [0, 9000, 18000, 27000, 36000, 45000])])
def test_window_counts(spark, samples, starts):
    df = spark.range(1).select("id", F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: i.cast("float")).alias("trace"))
    got = cut_windows(df, 9000).select("window_idx", "start", F.element_at("xw", 1), F.element_at("xw", -1), F.size("xw")).orderBy("start").collect()
    assert [tuple(r) for r in got] == [(i, s, float(s), float(s + 8999), 9000) for i, s in enumerate(starts)]


def test_windows_of_several_channels(spark):
    df = spark.createDataFrame([([[float(10 * c + i) for i in range(7)] for c in range(3)],)], "trace array<array<float>>")
    got = cut_windows(df, 3, 2).orderBy("start").collect()
    assert [r["start"] for r in got] == [0, 2, 4]
    assert got[1]["xw"] == [[2.0, 3.0, 4.0], [12.0, 13.0, 14.0], [22.0, 23.0, 24.0]]


@pytest.mark.parametrize("length,stride", [(5, 5), (5, 3), (3, 5), (1, 1), (12, 4)])
def test_row_windows_equal_array_windows(spark, length, stride):
    bins = 11
    rows = spark.range(bins).select(F.lit(1).alias("trace_id"), F.col("id").alias("bin"), F.col("id").cast("double").alias("x"))
    got = {(r[0], r[1]): r[2] for r in window_rows(rows, bins, length, stride).groupBy("window_idx", "start").agg(F.sum("x")).collect()}
    want = {(i, s): float(sum(range(s, s + length))) for i, s in enumerate(range(0, bins - length + 1, stride))}
    assert got == want


@pytest.mark.parametrize("length,stride", [(0, None), (3, 0)])
def test_bad_windows(spark, length, stride):
    with pytest.raises(ValueError):
        cut_windows(spark.createDataFrame([([1.0],)], "trace array<float>"), length, stride)


def test_edges_fall_into_the_bin_they_open(spark):
    dt, n = 0.02, 9000
    got = spark.range(n).select((F.col("id") * F.lit(dt)).alias("t"), "id").filter(edge_bin(F.col("t"), dt) != F.col("id")).count()
    assert got == 0
    assert (pooled_counts(np.arange(n) * dt, n, dt) == 1).all()


def test_grid_floors_and_windows_round():
    assert grid_bins(180.0, 0.02) == 9000
    assert (grid_bins(0.58, 0.02), window_samples(0.58, 0.02)) == (28, 29)
    for bad in ((0.0, 0.02), (math.inf, 0.02), (1.0, -1.0), (0.01, 0.02)):
        with pytest.raises(ValueError):
            grid_bins(*bad)


def test_counts_keep_the_declared_duration(spark):
    spikes = spark.createDataFrame([(1, 0.5, 0), (1, 3.0, 1), (1, 180.0, 0), (1, -0.1, 0), (1, 1.0, 9)], "trace_id int, t double, ch long")
    counts = bin_counts(spikes, 180.0, 0.02, 9)
    assert {(r["bin"], r["c"]) for r in counts.collect()} == {(25, 1), (150, 1)}
    assert dense_grid(counts, spikes, 9000).count() == 9000
    assert tuple(rejected(spikes, 180.0, 0.02, 9).first()) == (1, 2, 1)


def test_times_that_are_not_finite_stop_the_job(spark):
    spikes = spark.createDataFrame([(1, float("nan"), 0)], "trace_id int, t double, ch long")
    with pytest.raises(Exception, match="not finite"):
        bin_counts(spikes, 1.0, 0.1, 1).collect()
    with pytest.raises(ValueError):
        pooled_counts(np.array([np.inf]), 10, 0.1)


def test_silent_electrodes_count(spark):
    spikes = spark.createDataFrame([(1, 0.5, 0)], "trace_id int, t double, ch long")
    each = spark.createDataFrame([(1, 0), (1, 1)], "trace_id int, ch long")
    assert {(r["ch"], r["n"]) for r in channel_counts(spikes, each).collect()} == {(0, 1), (1, 0)}


def test_kernel():
    w = gaussian_weights(2.0)
    assert len(w) == 17 and abs(sum(w) - 1) < 1e-15 and w == w[::-1]
    assert gaussian_weights(0.0) == [1.0]
    with pytest.raises(ValueError):
        gaussian_weights(-1.0)


@pytest.mark.parametrize("sigma", [0.0, 0.4, 2.0])
def test_smoothing_forms_agree(spark, sigma):
    """Counts in the first and last bins make both reflections matter."""
    bins = 40
    dense = np.zeros(bins)
    dense[[0, 1, 7, 20, 33, 38, 39]] = [3, 1, 2, 5, 1, 4, 2]
    counts = spark.createDataFrame([(1, int(b), int(dense[b])) for b in np.flatnonzero(dense)], "trace_id int, bin long, c long")
    got = np.zeros(bins)
    for r in smooth_rows(counts, bins, sigma).collect():
        got[r["bin"]] = r["r"]
    want = smooth_dense(dense, sigma)
    assert np.abs(got - want).max() < 1e-14 and abs(want.sum() - dense.sum()) < 1e-12


def test_short_grids_reflect_again():
    w, r = np.array(gaussian_weights(2.0)), 8
    c = np.array([1.0, 4.0, 2.0])
    want = [sum(w[j + r] * c[min((b + j) % 6, 5 - (b + j) % 6)] for j in range(-r, r + 1)) for b in range(3)]
    assert np.abs(smooth_dense(c, 2.0) - want).max() < 1e-14


def test_sum_over_mean_is_the_number_of_electrodes():
    t, c = made_spikes(3, 60.0, 9)
    mean, pooled = (rate(t, c, 9, 3000, 0.02, 0.04, x).astype(float) for x in (True, False))
    assert abs(pooled.sum() / mean.sum() - 9) < 9e-6 and mean.min() >= 0


def test_array_path_equals_row_path(spark):
    t, c = made_spikes(11, 10.0, 3)
    records = spark.createDataFrame([(1, t.tolist(), c.tolist(), 3)], "trace_id int, det_t array<double>, det_ch array<long>, n_electrodes long")
    trace = np.array(build_traces(records, 10.0).first()["trace"])
    spikes = spark.createDataFrame([(1, float(x), int(y)) for x, y in zip(t, c)], "trace_id int, t double, ch long")
    counted = np.array(traces_from_counts(bin_counts(spikes, 10.0, 0.02, 3), 500, 3, 2.0).first()["trace"])
    assert np.abs(trace - counted).max() == 0
    rows = np.zeros(500)
    for r in smooth_rows(bin_counts(spikes, 10.0, 0.02, 3), 500, 2.0).collect():
        rows[r["bin"]] = r["r"] / 3
    assert np.abs(trace - rows.astype(np.float32)).max() < 1e-6


def test_trailing_index(spark):
    paths = spark.createDataFrame([("a/topo_10/mea_iter_00012.npz",), ("a/b7/iter.npz",), ("x9/run2_3",)], "p string")
    assert [r[0] for r in paths.select(trailing_index(F.col("p"))).collect()] == [12, None, 3]
