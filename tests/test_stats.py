"""Experiment statistics and power analysis (two-proportion z-test, CI, power, n, MDE)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from funnelforge.functions.columns import norm_cdf
from funnelforge.operators.experiment import (minimum_detectable_effect,
                                              required_sample_size, two_proportion_test)


def _test(spark, cc, ct, tc, tt):
    df = spark.createDataFrame([(cc, ct, tc, tt)],
                               "control_converted long, control_total long, treatment_converted long, treatment_total long")
    return two_proportion_test(df).first().asDict()


def test_identical_rates_give_no_effect(spark):
    r = _test(spark, 500, 1000, 500, 1000)
    assert r["absolute_lift"] == pytest.approx(0.0)
    assert r["z"] == pytest.approx(0.0, abs=1e-9)
    assert r["p_value"] == pytest.approx(1.0, abs=1e-9)
    assert r["ci_low"] < 0 < r["ci_high"]


def test_known_result_matches_manual_calculation(spark):
    r = _test(spark, 15387, 24814, 17102, 25186)
    assert r["control_rate"] == pytest.approx(0.6201, abs=1e-3)
    assert r["treatment_rate"] == pytest.approx(0.6790, abs=1e-3)
    assert r["absolute_lift"] == pytest.approx(0.0589, abs=1e-3)
    assert r["z"] == pytest.approx(13.81, abs=0.05)
    assert r["p_value"] < 0.001
    assert r["ci_low"] == pytest.approx(0.0506, abs=1e-3)
    assert r["ci_high"] == pytest.approx(0.0673, abs=1e-3)
    assert r["power"] > 0.99
    assert r["ship"] is True
    # Independent recomputation.
    assert r["z"] == pytest.approx(13.812084, abs=1e-5)
    assert r["relative_lift"] == pytest.approx(0.0950414, abs=1e-6)


def test_confidence_interval_widens_with_smaller_samples(spark):
    big = _test(spark, 620, 1000, 680, 1000)
    small = _test(spark, 62, 100, 68, 100)
    assert (small["ci_high"] - small["ci_low"]) > (big["ci_high"] - big["ci_low"])


def test_same_observed_rates_not_significant_on_tiny_sample(spark):
    r = _test(spark, 6, 10, 7, 10)
    assert r["p_value"] > 0.05 or r["ci_low"] < 0
    assert r["ship"] is False


def test_negative_lift_gives_negative_diff_and_ci_below_zero_when_clear(spark):
    r = _test(spark, 7000, 10000, 6000, 10000)
    assert r["absolute_lift"] < 0
    assert r["ci_high"] < 0
    assert r["p_value"] < 0.001
    assert r["ship"] is False  # one-sided ship rule


def test_zero_variance_gives_null_statistics(spark):
    r = _test(spark, 100, 100, 50, 50)
    assert r["z"] is None and r["p_value"] is None and r["power"] is None
    assert r["ship"] is False
    r = _test(spark, 0, 100, 0, 0)
    assert r["treatment_rate"] is None and r["ship"] is False


def test_norm_cdf_matches_erfc(spark):
    xs = [-40.0, -37.5, -20.0, -8.0, -7.1, -7.0, -3.0, -1.0, -0.1, 0.0, 0.1, 1.0, 1.96, 3.0, 7.0, 7.2, 9.0, 40.0]
    rnd = random.Random(0)
    xs += [rnd.uniform(-10, 10) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", norm_cdf("x").alias("p")).collect()
    for r in got:
        exact = 0.5 * math.erfc(-r.x / math.sqrt(2))
        assert abs(r.p - exact) < 1e-15 + 1e-8 * exact


def _size(spark, p1, mde, **kw):
    df = spark.createDataFrame([(p1,)], "baseline_rate double")
    return required_sample_size(df, "baseline_rate", mde, **kw).first().asDict()


def test_known_textbook_value(spark):
    r = _size(spark, 0.62, 0.03)
    assert r["n_control_exact"] == pytest.approx(4039, rel=0.01)
    assert r["n_control"] == math.ceil(r["n_control_exact"])
    assert r["n_total"] == r["n_control"] + r["n_treatment"]


def test_larger_effect_needs_fewer_users(spark):
    assert _size(spark, 0.62, 0.08)["n_control"] < _size(spark, 0.62, 0.02)["n_control"]


def test_higher_power_needs_more_users(spark):
    assert _size(spark, 0.62, 0.03, power=0.95)["n_control"] > _size(spark, 0.62, 0.03, power=0.80)["n_control"]


def test_stricter_alpha_needs_more_users(spark):
    assert _size(spark, 0.62, 0.03, alpha=0.01)["n_control"] > _size(spark, 0.62, 0.03, alpha=0.05)["n_control"]


def test_unequal_allocation_changes_control_n(spark):
    assert _size(spark, 0.62, 0.03, ratio=2.0)["n_control"] < _size(spark, 0.62, 0.03, ratio=1.0)["n_control"]


def test_out_of_range_target_gives_null(spark):
    r = _size(spark, 0.99, 0.02)
    assert r["n_control"] is None
    r = _size(spark, 0.62, 0.05, mde_type="relative")
    assert r["mde_abs"] == pytest.approx(0.031)


def test_minimum_detectable_effect_round_trips_with_the_sample_size(spark):
    sized = _size(spark, 0.62, 0.03)
    df = spark.createDataFrame([(0.62, float(sized["n_control"]))], "baseline_rate double, n_control double")
    assert minimum_detectable_effect(df).first()["mde"] == pytest.approx(0.03, abs=1e-4)
    pinned = spark.createDataFrame([(0.62, 8000.0)], "baseline_rate double, n_control double")
    assert minimum_detectable_effect(pinned).first()["mde"] == pytest.approx(0.0213733, abs=1e-6)


def test_closed_form_mde_needs_the_size_it_was_given(spark):
    """The size required for the found effect is the given size, at many baselines and ratios."""
    rnd = random.Random(7)
    for ratio in (0.5, 1.0, 2.0):
        rows = [(rnd.uniform(0.01, 0.9), rnd.uniform(2000, 1e6)) for _ in range(300)]
        df = spark.createDataFrame(rows, "baseline_rate double, n_control double")
        found = minimum_detectable_effect(df, ratio=ratio).collect()
        for r in found:
            p1, p2 = r["baseline_rate"], r["baseline_rate"] + r["mde"]
            z = (1.959963984540054 + 0.8416212335729143) ** 2
            assert z * (p1 * (1 - p1) + p2 * (1 - p2) / ratio) / r["mde"] ** 2 == pytest.approx(r["n_control"], rel=1e-6)

