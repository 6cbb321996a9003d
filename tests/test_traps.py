"""Hand-written frame covering the semantic traps (NULL flags, minutes, weeks, ...)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from funnelforge.operators import experiment as X
from funnelforge.operators import funnel as FN
from funnelforge.operators import segments as SG
from funnelforge.operators import timing as TM
from funnelforge.operators.staging import stg_events, stg_users
from funnelforge.schemas import RAW_EVENTS, RAW_USERS

T = dt.datetime


@pytest.fixture(scope="module")
def frame(spark):
    users = [
        (1, "Control", "pt", "IOS", T(2026, 1, 3, 10, 0)),     # Saturday signup, full funnel
        (2, "control", "PT", "ios", T(2026, 1, 4, 0, 30)),     # Sunday signup, no events (T1)
        (3, "treatment", "es", "web", T(2026, 1, 5, 9, 0)),    # only a non-step event
        (4, "TREATMENT", "ES", "web", T(2026, 1, 6, 9, 0)),    # repeated step, txn before start
        (5, "treatment", "AE", "android", T(2026, 1, 7, 9, 0)),  # sub-minute gap
        (6, "holdout", "AE", "android", T(2026, 1, 8, 9, 0)),  # arm without events
    ]
    s = "signup_started"
    events = [
        (1, 1, s, T(2026, 1, 3, 10, 0, 0)), (2, 1, "SIGNUP_COMPLETED", T(2026, 1, 3, 10, 5)),
        (3, 1, "kyc_submitted", T(2026, 1, 3, 10, 30)), (4, 1, "first_deposit", T(2026, 1, 3, 12, 0)),
        (5, 1, "first_transaction", T(2026, 1, 3, 12, 59, 59)),
        (6, 3, "page_view", T(2026, 1, 5, 9, 1)),
        (7, 4, s, T(2026, 1, 6, 9, 0)), (8, 4, s, T(2026, 1, 6, 8, 0)),
        (9, 4, "first_transaction", T(2026, 1, 6, 7, 58, 30)),
        (10, 5, s, T(2026, 1, 7, 9, 0, 0)), (11, 5, "first_transaction", T(2026, 1, 7, 9, 0, 59)),
        (12, 99, s, T(2026, 1, 7, 9, 0)),  # unknown user
    ]
    u = stg_users(spark.createDataFrame(users, RAW_USERS))
    e = stg_events(spark.createDataFrame(events, RAW_EVENTS))
    return u.cache(), e.cache()


def test_staging_folds_case(frame):
    u, e = frame
    assert {r[0] for r in u.select("variant").distinct().collect()} == {"control", "treatment", "holdout"}
    assert e.filter(F.col("event_name") == "signup_completed").count() == 1


def test_funnel_nulls_repeats_and_minutes(frame):
    u, e = frame
    f = {r["user_id"]: r for r in FN.fct_funnel(u, e).collect()}
    assert len(f) == 6 and 99 not in f                       # unknown user vanishes (left join from users)
    assert f[2]["reached_signup_started"] is None             # no events -> NULL flags
    assert f[3]["reached_signup_started"] == 0                # only a non-step event -> 0
    assert f[1]["minutes_to_activate"] == 179                 # 10:00 -> 12:59:59 truncates
    assert f[4]["minutes_to_activate"] == -1                  # first start 08:00, txn 07:58:30 -> -1.5 -> -1
    assert f[5]["minutes_to_activate"] == 0                   # 59 seconds
    assert f[4]["reached_first_transaction"] == 1 and f[4]["reached_signup_completed"] == 0  # unordered flags


def test_ab_mart_keeps_nulls_in_total(frame):
    u, e = frame
    ab = {(r["variant"], r["funnel_step"]): r for r in FN.fct_ab_experiment(FN.fct_funnel(u, e)).collect()}
    assert ab[("control", "signup_started")]["total"] == 2     # NULL-flag user still counted
    assert ab[("control", "signup_started")]["converted"] == 1
    assert ab[("holdout", "signup_started")]["converted"] is None  # sum over only NULLs
    assert ab[("control", "first_transaction")]["conversion_rate"] == 0.5


def test_experiment_zero_fills_and_handles_all_converted(frame):
    u, e = frame
    t = {r["funnel_step"]: r for r in X.ab_test(FN.fct_funnel(u, e)).collect()}
    r = t["signup_completed"]
    assert r["control_converted"] == 1 and r["treatment_converted"] == 0 and r["treatment_rate"] == 0.0


def test_sunday_week_and_weekly_cohorts(frame):
    u, e = frame
    rows = SG.weekly_cohorts(FN.fct_funnel(u, e)).collect()
    weeks = {(r["signup_week"], r["variant"]): r for r in rows}
    # Saturday 2026-01-03 belongs to the week of Sunday 2025-12-28; Sunday 2026-01-04 starts a week.
    assert (dt.date(2025, 12, 28), "control") in weeks
    assert (dt.date(2026, 1, 4), "control") in weeks


def test_segment_activation_ignores_null_flags(frame):
    u, e = frame
    rows = {(r["country"], r["platform"]): r for r in SG.segment_activation(FN.fct_funnel(u, e), min_users=1).collect()}
    assert rows[("PT", "ios")]["users"] == 2
    assert rows[("PT", "ios")]["activation_pct"] == 100.0       # avg over the non-NULL flag only


def test_heatmap_counts_missing_as_zero(frame):
    u, e = frame
    rows = {r["country"]: r for r in SG.activation_heatmap(u, e).collect()}
    assert rows["PT"]["ios"] == 50.0


def test_time_to_activate_first_events_and_histogram_max(frame):
    u, e = frame
    tta = {r["user_id"]: r["minutes_to_activate"] for r in TM.time_to_activate(u, e).collect()}
    assert tta[1] == pytest.approx(179 + 59 / 60)
    assert tta[4] == pytest.approx(-1.5)
    assert tta[5] == pytest.approx(59 / 60)
    h = TM.histogram(TM.time_to_activate(u, e), "minutes_to_activate", ["variant"], 40).collect()
    assert sum(r["count"] for r in h) == 3
    assert all(0 <= r["bin"] <= 39 for r in h)
    top = [r for r in h if r["variant"] == "treatment"]
    assert max(r["bin"] for r in top) == 39                     # the maximum falls in the last bin


def test_funnel_dropoff_windows(frame):
    u, e = frame
    d = {r["funnel_step"]: r for r in FN.funnel_dropoff(FN.fct_ab_experiment(FN.fct_funnel(u, e))).collect()}
    assert d["signup_started"]["users_prev_step"] is None
    assert d["signup_started"]["users_at_step"] == 3  # NULL-flag arm adds nothing
    assert d["signup_completed"]["step_conversion"] == pytest.approx(1 / 3)


def test_unknown_step_missing_arm_and_empty_log(spark, frame):
    u, e = frame
    steps = ["signup_started", "no_such_step"]
    t = {r["funnel_step"]: r for r in X.ab_test(FN.fct_funnel(u, e, steps), steps).collect()}
    assert t["no_such_step"]["control_converted"] == 0 and t["no_such_step"]["z"] is None
    only_control = u.filter(F.col("variant") == "control")
    r = X.ab_test(FN.fct_funnel(only_control, e)).collect()
    assert all(x["treatment_total"] is None and x["ship"] is False for x in r)
    empty = e.limit(0)
    f = FN.fct_funnel(u, empty).collect()
    assert len(f) == 6 and all(x["reached_signup_started"] is None for x in f)
    assert FN.funnel_dropoff(FN.fct_ab_experiment(FN.fct_funnel(u, empty))).count() == 5
    assert TM.describe(TM.time_to_activate(u, empty), "minutes_to_activate").count() == 0
    assert SG.value_shares(u.filter("false"), "variant").count() == 0
