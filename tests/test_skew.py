"""A hot key holding a third of all rows: results stay exact and the hot key is
collapsed by partial aggregation before any shuffle."""

import pytest
from pyspark.sql import functions as F

from funnelforge.operators import funnel as FN
from funnelforge.operators.staging import stg_events, stg_users
from funnelforge.operators.timing import describe, time_to_activate
from funnelforge.sources.generate import generate


@pytest.fixture(scope="module")
def skewed(spark):
    users, events = generate(spark, n_users=4_000, seed=23)
    n = events.count()
    # Copies of user 1's events until user 1 holds about a third of all rows.
    hot = events.filter("user_id = 1")
    k = hot.count()
    reps = max(1, (n // 2) // k)
    extra = hot.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(reps)))).drop("r")
    return stg_users(users), stg_events(events.unionByName(extra)), reps, k, n


def test_hot_user_share(skewed):
    _, events, *_ = skewed
    total = events.count()
    assert events.filter("user_id = 1").count() / total > 0.3


def test_flags_exact_under_skew(skewed):
    users, events, *_ = skewed
    f = FN.fct_funnel(users, events)
    assert f.count() == 4_000 and f.select("user_id").distinct().count() == 4_000
    plan = f._jdf.queryExecution().executedPlan().toString()
    # Partial aggregation below the exchange on user_id.
    assert "partial_max" in plan


def test_first_event_semantics_under_skew(skewed):
    users, events, *_ = skewed
    tta = time_to_activate(users, events)
    assert tta.filter("user_id = 1").count() <= 1  # repeated events never fan out
    d = describe(tta, "minutes_to_activate").collect()
    assert all(r["count"] > 0 for r in d)
