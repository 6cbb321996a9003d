"""Property tests: running totals, exact AUC and the power formulas on random inputs."""

import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from funnelforge.operators.metrics import roc_auc
from funnelforge.plans.prefix import running_totals

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 500), st.integers(-5, 20)), min_size=1,
                max_size=120, unique_by=lambda t: (t[0], t[1])),
       st.integers(2, 12), st.booleans())
def test_running_totals_equal_grouped_cumsum(spark, rows, blocks, descending):
    df = spark.createDataFrame(rows, "g string, k long, v long")
    got = running_totals(df, "k", ["v"], ["g"], blocks=blocks, descending=descending, totals=True).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(["g", "k"], ascending=[True, not descending])
    pdf["want"] = pdf.groupby("g")["v"].cumsum()
    pdf["tot"] = pdf.groupby("g")["v"].transform("sum")
    m = got.merge(pdf, on=["g", "k", "v"])
    assert len(m) == len(rows)
    assert (m["cum_v"] == m["want"]).all() and (m["tot_v"] == m["tot"]).all()


@SLOW
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 1)), min_size=2, max_size=80))
def test_auc_equals_pair_count(spark, rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "score double, label int")
    got = roc_auc(df).first()["auc"]
    if not pos or not neg:
        assert got is None
        return
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want, abs=1e-12)
