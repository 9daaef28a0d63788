"""Rules as columns against the functions that raise, row by row."""

import itertools
import math

import pytest

from tests.test_labels import ACTIVE, registry, rows
from tracewell.operators.binning import grid_bins, window_samples
from tracewell.operators.labels import assemble_labels, build_label_spec
from tracewell.operators.rules import broken, record_rules, rule_counts, setting_rules
from tracewell.operators.windows import check_window

SETTINGS = "duration double, dt double, n_electrodes int, sigma_s double, window_s double, stride int, active_indices array<int>, n_axes int, kernel_bounds array<array<double>>"
SOUND = (10.0, 0.5, 4, 1.0, 5.0, None, [0, 2], 7, [[0.1, 1.0]] * 3)


def raises(f, *args):
    try:
        f(*args)
    except ValueError:
        return True
    return False


def test_grid_and_window_rules_are_those_that_raise(spark):
    values = (0.0, -1.0, 0.02, 0.5, 1.0, 2.5, 180.0, math.inf, math.nan)
    cases = [(d, t, w, s) for d, t in itertools.product(values, values) for w, s in ((1.0, None), (0.25, 1), (2.5, 0), (0.75, 3))]
    made = spark.createDataFrame([(d, t, 4, 1.0, w, s, [0], 7, [[0.1, 1.0]] * 3) for d, t, w, s in cases], SETTINGS)
    got = [r[0] for r in made.coalesce(1).select(broken(setting_rules())).collect()]
    for (d, t, w, s), rules in zip(cases, got):
        assert ("V1" in rules) == raises(grid_bins, d, t), (d, t)
        if math.isfinite(t) and t > 0:
            assert ("V3" in rules) == (raises(window_samples, w, t) or raises(check_window, 1, s)), (w, t, s)
            if not raises(grid_bins, d, t):
                assert ("V10" in rules) == (grid_bins(d, t) < round(w / t)), (d, t, w)


@pytest.mark.parametrize("active", [[0, 2], [], [1, 1], [7], [-1, 2], [6, 0]])
@pytest.mark.parametrize("kernel", [[[0.1, 1.0]] * 3, [[0.1, 1.0]] * 2, [[0.1, 1.0], [1.0], [0.1, 2.0]]])
def test_axis_rules_are_those_that_raise(spark, active, kernel):
    row = (*SOUND[:6], active, len(registry().names), kernel)
    got = spark.createDataFrame([row], SETTINGS).select(broken(setting_rules())).first()[0]
    assert bool({"V5", "V6"} & set(got)) == raises(build_label_spec, registry(), active, "", (0.1, 0.6), kernel)
    assert ("V6" in got) == (kernel != [[0.1, 1.0]] * 3)


def test_settings_that_are_missing_break_their_rules(spark):
    none = spark.createDataFrame([SOUND, (None,) * 9], SETTINGS)
    sound, missing = (r[0] for r in none.coalesce(1).select(broken(setting_rules())).collect())
    assert sound == [] and missing == ["V1", "V2", "V3", "V5", "V6", "V10", "V13"]
    assert {(r["n_broken"], r["n_rows"]) for r in rule_counts(none, setting_rules()).collect()} == {(1, 2)}
    assert {(r["n_broken"], r["n_rows"]) for r in rule_counts(none.limit(0), setting_rules()).collect()} == {(0, 0)}


NAN = float("nan")


@pytest.mark.parametrize(
    "change, rules",
    [({}, []), ({"theta": [1.0]}, ["V7"]), ({"theta": None}, ["V7"]), ({"params": [1.0]}, ["V7"]), ({"params": None}, []), ({"p0_conn": NAN}, ["V8"]), ({"d0_conn": None}, ["V8"]),
     ({"params": [1.5, 2.0, -60.0, 10.0, 100.0, -52.0, 0.1]}, ["A6"]), ({"params": [None] * 7}, ["A6"]), ({"theta": [1.0], "p0_conn": math.inf}, ["V7", "V8"])],
)
def test_record_rules_are_those_that_stop_the_label(spark, change, rules):
    spec, row = build_label_spec(registry(), ACTIVE), rows(spark, **change)
    checked = record_rules(spec)
    for times, more in (([0.5, 1.0], []), ([], []), ([NAN], ["V4"]), (None, ["V4"])):
        timed = spark.createDataFrame([(times,)], "det_t array<double>").crossJoin(row)
        assert timed.select(broken(checked)).first()[0] == more + rules
    if rules:
        with pytest.raises(Exception):
            assemble_labels(row, spec).collect()
    else:
        assert assemble_labels(row, spec).count() == 1
