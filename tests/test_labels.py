"""Registry rules, label assembly and the unique join."""

import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import ACTIVE, KERNEL, registry
from tracewell.operators.labels import assemble_labels, build_label_spec
from tracewell.operators.registry import Registry, assert_roundtrip, log_set_drift, with_rules
from tracewell.operators.unique_join import key_violations, unique_join
from tracewell.sources import settings


def test_log_rule_needs_a_decade(spark):
    reg = registry()
    assert [reg.names[k] for k in reg.log_axes] == ["Sigma", "Tau", "Gain", "Rate"]
    assert reg.frozen == ["VT"]
    table = with_rules(reg.table(spark))
    assert [r["axis"] for r in table.filter("is_log").orderBy("axis").collect()] == reg.log_axes
    assert [r["name"] for r in table.filter("is_frozen").collect()] == ["VT"]


def test_roundtrip_holds_and_fails(spark):
    table = registry().table(spark)
    assert_roundtrip(table)
    with pytest.raises(AssertionError, match="A1"):
        assert_roundtrip(table, rtol=-1.0)


def test_stored_log_set_must_agree(spark):
    table = registry().table(spark)
    assert Registry.read(table, KERNEL, stored_log_axes=[6, 3, 1, 0]).names[0] == "Sigma"
    with pytest.raises(RuntimeError):
        Registry.read(table, KERNEL, stored_log_axes=[0, 1])
    with pytest.raises(RuntimeError):
        Registry.read(table, KERNEL, log_base="ten")
    drift = {tuple(r) for r in log_set_drift(table, spark.createDataFrame([(0,), (2,)], "axis int")).collect()}
    assert drift == {(1, "derived"), (3, "derived"), (6, "derived"), (2, "stored")}


def test_spec(spark):
    spec = build_label_spec(registry(), ACTIVE)
    assert spec.column_names == ["th_Sigma", "th_VA", "th_Gain", "th_Cm", "th_conn_prob", "th_p0_conn", "th_d0_conn", "th_beta_conn"]
    assert spec.coord == ["ln", "linear", "ln", "linear", "linear", "linear", "linear", "linear"]
    assert spec.table(spark).filter("registry_axis IS NULL").count() == 4
    block = spec.registry_block()
    assert block["n_log_axes"] == 4 and block["frozen_excluded"] == ["VT"] and block["topology_coord"] == "linear"


@pytest.mark.parametrize("axes", [[], [0, 0], [99], [5]])
def test_bad_axes(axes):
    with pytest.raises(ValueError):
        build_label_spec(registry(), axes)


def test_bad_kernel_bounds():
    with pytest.raises(ValueError):
        build_label_spec(registry(), ACTIVE, kernel_bounds=[(0, 1)])


def rows(spark, **change):
    params = [1.0, 2.0, -60.0, 10.0, 100.0, -52.0, 0.1]
    row = {"theta": [math.log(1.0), math.log(2.0), -60.0, math.log(10.0), 100.0, -52.0, math.log(0.1)], "params": params, "conn_prob": 0.2, "p0_conn": 0.5, "d0_conn": 100.0, "beta_conn": 1.0} | change
    return spark.createDataFrame([row], "theta array<double>, params array<double>, conn_prob double, p0_conn double, d0_conn double, beta_conn double")


def test_label_is_gathered_and_closed_by_connectivity(spark):
    got = assemble_labels(rows(spark), build_label_spec(registry(), [3, 0, 2])).first()["theta_a"]
    assert got == [math.log(10.0), 0.0, -60.0, 0.2, 0.5, 100.0, 1.0]


@pytest.mark.parametrize(
    "change,message",
    [({"theta": [1.0]}, "width"), ({"params": [1.0]}, "width"), ({"p0_conn": float("nan")}, "flat"), ({"d0_conn": None}, "missing"), ({"params": [1.5, 2.0, -60.0, 10.0, 100.0, -52.0, 0.1]}, "A6.*Sigma"), ({"params": [-1.0, 2.0, -60.0, 10.0, 100.0, -52.0, 0.1]}, "A6.*Sigma")],
)
def test_broken_rows_stop_the_job(spark, change, message):
    with pytest.raises(Exception, match=message):
        assemble_labels(rows(spark, **change), build_label_spec(registry(), ACTIVE)).collect()


def test_inactive_axes_and_absent_params_are_not_checked(spark):
    spec = build_label_spec(registry(), ACTIVE)
    off = [1.0, 999.0, -60.0, 10.0, 100.0, -52.0, 0.1]
    assert assemble_labels(rows(spark, params=off), spec).count() == 1
    assert assemble_labels(rows(spark, params=None), spec).count() == 1
    with pytest.raises(KeyError):
        assemble_labels(rows(spark).drop("beta_conn"), spec)


def test_unique_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, w int")
    assert {tuple(r) for r in unique_join(left, right, ["k"]).select("k", "v", "w").collect()} == {(1, "a", 10), (2, "b", 20)}
    twice = right.unionByName(right.filter("k = 2"))
    for a, b in ((left, right.filter("k <> 2")), (left, twice), (left.unionByName(left.filter("k = 1")), right)):
        with pytest.raises(Exception, match="not unique or has no match: k="):
            unique_join(a, b, ["k"]).collect()
    assert [tuple(r) for r in key_violations(left, twice, ["k"]).collect()] == [(2, 1, 2)]
    again = left.unionByName(left.filter("k = 1"))
    assert unique_join(again, right, ["k"], unique_left=False).count() == 3


def test_settings():
    reg = registry()
    assert settings.active_axes({}, reg, "neuron_synapse") == (ACTIVE, "neuron_synapse")
    assert settings.active_axes({"active_indices": [1], "sweep_group": "x"}, reg, "neuron_synapse") == ([1], "x")
    assert settings.conn_prob_bounds({"conn_prob_lo": 0.05}, hi=0.9) == (0.05, 0.9)
    assert settings.kernel_bounds({"p0_hi": 1.5, "beta_lo": 0.1}, KERNEL) == [(0.1, 1.5), (50.0, 500.0), (0.1, 3.0)]
    assert settings.duration({"simtime": 20}) == 20.0 and settings.duration({"simtime": 20}, 30.0) == 30.0 and settings.duration({}) == 180.0


def test_theta_of_values_without_logarithm_is_null(spark):
    from tracewell.functions.expr import to_theta

    got = spark.createDataFrame([(0.0,), (-1.0,), (1.0,)], "v double").select(to_theta(F.col("v"), F.lit(True))).collect()
    assert [r[0] for r in got] == [None, None, 0.0]
