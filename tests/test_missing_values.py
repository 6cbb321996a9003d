"""NULL groups and values that no list names: no row may be lost."""

import pytest
from pyspark.sql import functions as F

from funnelforge.operators import experiment, metrics, segments, timing


@pytest.fixture(scope="module")
def arms(spark):
    rows = [(i, ["control", "treatment", "holdout", None][i % 4], float(i // 4), i % 3 == 0) for i in range(40)]
    return spark.createDataFrame(rows, "user_id long, variant string, x double, done boolean")


def test_describe_and_histogram_keep_the_null_group(arms):
    got = {r["variant"]: r for r in timing.describe(arms, "x").collect()}
    assert set(got) == {"control", "treatment", "holdout", None}
    for r in got.values():
        assert (r["count"], r["mean"], r["median"]) == (10, 4.5, 4.5)
        assert r["std"] == pytest.approx(3.0276503540974917)
    bins = timing.histogram(arms, "x", bins=5).groupBy("variant").agg(F.sum("count").alias("n"), F.count("*").alias("b")).collect()
    assert {r["variant"]: (r["n"], r["b"]) for r in bins} == {k: (10, 5) for k in got}
    some = timing.histogram(arms, "x", bins=40, include_empty=False)
    assert some.agg(F.sum("count")).first()[0] == 40 and some.count() == 40


def test_describe_of_a_group_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0)], "variant string, x double")
    got = {r["variant"]: tuple(r)[1:] for r in timing.describe(df, "x").collect()}
    assert got == {"a": (0, None, None, None), "b": (1, 2.0, 2.0, None)}


def test_crosstab_counts_every_row(arms):
    one = arms.withColumn("country", F.lit("PT"))
    found = segments.crosstab_shares(one, "country", "variant").first().asDict()
    assert found == {"country": "PT", "control": 0.25, "holdout": 0.25, "treatment": 0.25, "null": 0.25}
    listed = segments.crosstab_shares(one, "country", "variant", ["control", "treatment"]).first().asDict()
    assert listed == {"country": "PT", "control": 0.25, "treatment": 0.25, "other": 0.5}
    long = {r["variant"]: (r["n"], r["share"]) for r in segments.crosstab_shares_long(one, "country", "variant").collect()}
    assert long == {k: (10, 0.25) for k in ("control", "treatment", "holdout", None)}


def test_pivot_with_too_many_values_is_refused(arms):
    with pytest.raises(ValueError, match="long form"):
        segments.pivot_values(arms, "user_id", most=10)


def test_null_segment_keeps_its_baseline(spark):
    rows = [(i, "control" if i % 2 else "treatment", [None, "PT"][i % 4 // 2], "2024-01-01", int(i % 3 == 0)) for i in range(80)]
    f = spark.createDataFrame(rows, "user_id long, variant string, country string, signup_date string, reached_a int")
    got = {r["country"]: r["segment_users"] for r in experiment.baseline_rates(f, ["a"], ["country"]).collect()}
    assert got == {None: 40, "PT": 40}
    assert {r["country"] for r in experiment.mde_by_segment(f, ["a"], ["country"]).collect()} == {None, "PT"}


def test_auc_of_a_null_group_and_of_counts_beyond_a_long(spark):
    rows = [(g, s, int(s > 0.5)) for g in ("a", None) for s in (0.1, 0.4, 0.6, 0.9)]
    df = spark.createDataFrame(rows, "g string, score double, label int")
    assert {r["g"]: r["auc"] for r in metrics.summary(df, group_cols=["g"]).collect()} == {"a": 1.0, None: 1.0}
    big = spark.createDataFrame([(0.2, 0, 5_000_000_000, 5_000_000_000), (0.7, 4_500_000_000, 0, 9_500_000_000)],
                                "score double, pos long, neg long, cum_neg long").withColumn("cum_neg", F.lit(5_000_000_000))
    assert big.agg(metrics._auc_expr().alias("auc")).first()["auc"] == 1.0


def test_one_arm_with_nine_tenths_of_the_rows_is_spread(spark):
    """With broadcasts off no exchange is keyed by the arm alone, and results stay right."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(20000).select((F.when(F.col("id") % 10 == 0, "b").otherwise("a")).alias("variant"),
                                       (F.col("id") * 7919 % 20011).cast("double").alias("x"))
        for out in (timing.describe(df, "x"), timing.histogram(df, "x", bins=10)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            wide = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(variant" in ln.replace("#", "") or "hashpartitioning(_ff_group" in ln and "," not in ln]
            assert all("partial_" in plan for _ in wide)
        got = {r["variant"]: r["count"] for r in timing.describe(df, "x").collect()}
        assert got == {"a": 18000, "b": 2000}
        n = timing.histogram(df, "x", bins=10).groupBy("variant").agg(F.sum("count").alias("n")).collect()
        assert {r["variant"]: r["n"] for r in n} == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_csv_cells_that_do_not_fit_raise(spark, tmp_path):
    from funnelforge.sources import io

    (tmp_path / "u.csv").write_text("user_id,variant,country,platform,signup_ts\nbad,control,PT,ios,notatime\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_users_csv(spark, str(tmp_path / "u.csv")).collect()


def test_a_cluster_without_a_shared_folder_is_refused():
    from funnelforge import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
