"""Feature table of the activation model (ported checks) and the MLlib fit."""

import pytest

from funnelforge.operators import quality as QC
from funnelforge.operators.features import activation_features, features_from_marts, split
from funnelforge.operators.funnel import fct_funnel
from funnelforge.operators.staging import dim_users, stg_events, stg_users
from funnelforge.schemas import CATEGORICAL, LEAKY_STEPS, NUMERIC, TARGET
from funnelforge.sources.generate import generate


@pytest.fixture(scope="module")
def tables(spark):
    u, e = generate(spark, n_users=8_000, seed=42)
    return stg_users(u).cache(), stg_events(e).cache()


@pytest.fixture(scope="module")
def features(tables):
    users, events = tables
    return activation_features(users, events).cache()


def test_population_is_subset_of_all_users(features, tables):
    assert 0 < features.count() <= tables[0].count()


def test_no_leakage_columns_present(features):
    leaky = [f"reached_{s}" for s in LEAKY_STEPS] + list(LEAKY_STEPS)
    assert QC.schema_problems(features, CATEGORICAL + NUMERIC + [TARGET], leaky) == []


def test_checks_pass(features, tables):
    rows = {r["check"]: r["passed"] for r in
            QC.feature_checks(features, tables[0], TARGET, CATEGORICAL + NUMERIC).collect()}
    assert all(rows.values()), rows


def test_mart_path_matches_local_population(features, tables):
    users, events = tables
    mart = features_from_marts(fct_funnel(users, events), dim_users(users))
    assert "minutes_signup_to_complete" not in mart.columns
    assert mart.count() == features.count()
    a = features.select("user_id", TARGET).exceptAll(mart.select("user_id", TARGET)).count()
    assert a == 0


def test_split_is_deterministic_and_stratified(features):
    s1 = split(features, 0.25, 42)
    s2 = split(features, 0.25, 42)
    assert QC.same_rows(s1, s2).first().asDict() == {"only_left": 0, "only_right": 0}
    from pyspark.sql import functions as F
    rows = s1.groupBy(TARGET).agg(F.avg(F.col("is_test").cast("double"))).collect()
    for r in rows:
        assert r[1] == pytest.approx(0.25, abs=0.03)


def test_logistic_model_learns_segment_signal(features):
    from funnelforge.operators import model as ML
    from funnelforge.operators.metrics import summary

    s = split(features, 0.25, 42)
    train, test = s.filter("NOT is_test"), s.filter("is_test")
    model = ML.fit_logistic(train, TARGET)
    coefs = dict(ML.coefficients(model))
    # variant carries no post-signup signal by construction; web and AE do.
    assert abs(coefs["variant_treatment"]) < abs(coefs["platform_web"])
    m = summary(ML.score(model, test, ("user_id",), TARGET), TARGET, "probability_activate").first()
    assert 0.5 < m["auc"] < 0.75 and 0 < m["brier"] < 0.3


def test_exact_split_has_exact_counts_per_label(features):
    import math

    from pyspark.sql import functions as F

    from funnelforge.operators.features import split_exact

    s = split_exact(features, TARGET, 0.25, 42)
    rows = s.groupBy(TARGET).agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()
    total = sum(r["n"] for r in rows)
    want = math.ceil(total / 4)
    assert sum(r["t"] for r in rows) == want
    for r in rows:
        assert abs(r["t"] - want * r["n"] / total) < 1
    assert total == features.count()


def test_exact_split_deals_the_total_by_largest_remainder(spark):
    from pyspark.sql import functions as F

    from funnelforge.operators.features import split_exact

    def tested(labels, size):
        df = spark.createDataFrame(list(enumerate(labels)), "user_id long, y int")
        rows = split_exact(df, "y", size).groupBy("y").agg(F.sum(F.col("is_test").cast("int")).alias("t"), F.count("*").alias("n")).collect()
        return {r["y"]: (r["t"], r["n"]) for r in rows}

    assert tested([0] * 5 + [1] * 5, 0.25) == {0: (2, 5), 1: (1, 5)}
    assert tested([None] * 20 + [0] * 40 + [1] * 40, 0.25) == {None: (5, 20), 0: (10, 40), 1: (10, 40)}
    assert tested([1] * 90 + [0] * 9 + [None], 0.1) == {1: (9, 90), 0: (1, 9), None: (0, 1)}


def test_unseen_category_encodes_to_zeros(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from funnelforge.operators.model import encoder_stages

    train = spark.createDataFrame([("PT", 1.0), ("ES", 2.0), ("AE", 3.0)], "country string, x double")
    model = Pipeline(stages=encoder_stages(["country"], ["x"])).fit(train)
    out = model.transform(spark.createDataFrame([("ES", 5.0), ("ZZ", 6.0)], "country string, x double"))
    rows = {r["country"]: r["v"] for r in out.select("country", vector_to_array("features").alias("v")).collect()}
    assert rows["ES"][:3] == [0.0, 1.0, 0.0]          # alphabetical slots AE, ES, PT
    assert rows["ZZ"][:3] == [0.0, 0.0, 0.0] and rows["ZZ"][3] == 6.0
