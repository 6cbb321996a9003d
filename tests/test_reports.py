"""Reader orderings, the decision row, preview and the approximate distinct option."""

from pyspark.sql import functions as F

from funnelforge.operators.funnel import fct_ab_experiment, fct_funnel, funnel_dropoff
from funnelforge.operators.segments import distinct_users, segment_activation
from funnelforge.operators.staging import preview, stg_events, stg_users
from funnelforge.plans.reports import decision, ordered
from funnelforge.sources.generate import generate


def test_orderings_and_decision(spark):
    u, e = generate(spark, n_users=20_000, seed=42)
    users, events = stg_users(u), stg_events(e)
    f = fct_funnel(users, events).cache()
    ab = ordered(fct_ab_experiment(f), "fct_ab_experiment").collect()
    assert [r["step_order"] for r in ab] == sorted(r["step_order"] for r in ab)
    d = ordered(funnel_dropoff(fct_ab_experiment(f)), "funnel_dropoff").collect()
    assert d[0]["users_prev_step"] is None and d[0]["funnel_step"] == "signup_started"
    seg = ordered(segment_activation(f, min_users=500), "segment_activation").collect()
    pcts = [r["activation_pct"] for r in seg]
    assert pcts == sorted(pcts, reverse=True)
    row = decision(f).first()
    assert row["recommendation"] == "SHIP" and row["absolute_lift"] > 0
    assert preview(users).count() == 5
    exact = {r[0]: r[1] for r in distinct_users(events, ["event_name"]).collect()}
    approx = {r[0]: r[1] for r in distinct_users(events, ["event_name"], approx=True, rsd=0.01).collect()}
    for k in exact:
        assert abs(approx[k] - exact[k]) <= 0.05 * exact[k]
    assert F
