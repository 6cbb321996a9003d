"""Loads with quarantine, persistent views, fingerprints, encodings, stored models and pivots of any value."""

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from funnelforge.operators import model as ML
from funnelforge.operators import quality as QC
from funnelforge.operators import segments as SG
from funnelforge.operators.features import split_exact
from funnelforge.plans import reports, warehouse
from funnelforge.schemas import RAW_USERS
from funnelforge.sources import io

GOOD = ["1,control,US,web,2024-01-01 10:00:00", "2,treatment,GB,ios,2024-01-02 11:30:00.123456", "3,,,,"]
BAD = ["x,control,US,web,2024-01-01 10:00:00", "4,control,US,web,yesterday", "5,control,US", "6,control,US,web,2024-01-01 10:00:00,more"]


def write_lines(lines):
    d = tempfile.mkdtemp(prefix="ff-load-")
    Path(d, "part.csv").write_text("\n".join(["user_id,variant,country,platform,signup_ts", *lines]) + "\n")
    return d


@pytest.fixture(scope="module")
def db(spark):
    name = "ff_given"
    io.create_database(spark, name, tempfile.mkdtemp(prefix="ff-given-"))
    return name


def test_load_splits_good_from_bad_lines(spark, db):
    done = io.load(spark, write_lines(GOOD + BAD), f"{db}.users", RAW_USERS, most_rejected=0.6)
    assert (done.rows, done.rejected) == (3, 4)
    assert sorted(r["user_id"] for r in spark.table(f"{db}.users").collect()) == [1, 2, 3]
    assert spark.table(f"{db}.users").where("user_id = 2").first()["signup_ts"].microsecond == 123456
    assert sorted(r["line"] for r in spark.table(done.quarantine).collect()) == sorted(BAD)
    again = io.load(spark, write_lines(GOOD[:1]), f"{db}.users", RAW_USERS)
    assert (again.rows, again.rejected, spark.table(f"{db}.users").count(), spark.table(again.quarantine).count()) == (1, 0, 1, 0)


def test_a_load_with_too_many_bad_lines_leaves_the_table(spark, db):
    io.load(spark, write_lines(GOOD), f"{db}.kept", RAW_USERS)
    with pytest.raises(ValueError, match="do not fit"):
        io.load(spark, write_lines(GOOD[:1] + BAD), f"{db}.kept", RAW_USERS)
    assert spark.table(f"{db}.kept").count() == 3
    assert io.load(spark, write_lines([]), f"{db}.empty", RAW_USERS).rows == 0


def test_staging_views_are_read_by_another_session_and_follow_a_reload(spark, db):
    users = spark.createDataFrame([(1, "Control", "us", "WEB", None)], RAW_USERS)
    events = spark.createDataFrame([(1, 1, "Signup", None)], "event_id long, user_id long, event_name string, event_ts timestamp")
    warehouse.staging_views(spark, db, users, events)
    other = spark.newSession()
    assert other.table(f"{db}.stg_users").first()["country"] == "US"
    warehouse.staging_views(spark, db, users.withColumn("country", F.lit("gb")), events)
    assert other.table(f"{db}.stg_users").first()["country"] == "GB" and other.table(f"{db}.stg_events").first()["event_name"] == "signup"
    kinds = {r["name"]: (r["kind"], r["definition"]) for r in io.lineage(spark, db).collect()}
    assert kinds["stg_users"][0] == "view" and f"{db}.raw_users" in kinds["stg_users"][1]


def test_partitioned_mart_prunes_by_the_named_parameter(spark, db):
    mart = spark.createDataFrame([(v, s, i, 5, 10) for v in ("control", "treatment") for i, s in enumerate("abc")],
                                 "variant string, funnel_step string, step_order int, converted int, total int")
    io.save_table(mart, f"{db}.ab_parts", partition_by=["funnel_step"])
    plan = spark.sql(f"SELECT * FROM {db}.ab_parts WHERE funnel_step = :step", args={"step": "b"})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(funnel_step" in plan and "(funnel_step" in plan


def test_fingerprint_ignores_order_and_partitions_only(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (None, "1", 2.5)], "i int, s string, x double")
    same = lambda other: QC.same_fingerprint("c", df, other).first()["passed"]
    assert same(df.repartition(3).orderBy(F.desc("i"))) and same(df.select("x", "s", "i").select("i", "s", "x"))
    assert not same(df.distinct()) and not same(df.withColumn("s", F.lit("a")))
    swapped = spark.createDataFrame([(1, None), (None, 1)], "a int, b int"), spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert not QC.same_fingerprint("c", *swapped).first()["passed"]
    assert QC.same_fingerprint("c", df.limit(0), df.limit(0)).first()["passed"] and QC.same_fingerprint("c", df, df.limit(0), equal=False).first()["passed"]


def test_schema_contract_lists_what_is_missing_or_leaky(spark):
    df = spark.createDataFrame([(1, "x")], "user_id int, reached_kyc string")
    rows = QC.schema_contract({"t": df}, {"t": ["user_id", "country"]}, {"t": ["reached_kyc", "reached_deposit"]}).collect()
    assert {(r["column_name"], r["rule"], r["data_type"], r["passed"]) for r in rows} == {
        ("user_id", "required", "int", True), ("country", "required", None, False),
        ("reached_kyc", "forbidden", "string", False), ("reached_deposit", "forbidden", None, True)}


@pytest.fixture(scope="module")
def training(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 2 == 0, "control").otherwise("treatment").alias("variant"),
        F.element_at(F.array(*[F.lit(c) for c in ("US", "GB", "PT")]), (F.col("id") % 3 + 1).cast("int")).alias("country"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("web")).alias("platform"), (F.col("id") % 7).cast("string").alias("signup_dayofweek"),
        (F.col("id") % 24).cast("int").alias("signup_hour"), (F.col("id") % 50 / 7.0).alias("minutes_signup_to_complete"))
    u = F.pmod(F.xxhash64("user_id"), F.lit(1000)) / 1000.0
    return rows.withColumn("y", (u < F.when(F.col("country") == "PT", 0.8).otherwise(0.25)).cast("int")).cache()


def test_one_hot_equals_the_mllib_encoder(spark, training):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    seen = training.where("country <> 'PT'")
    cats, nums = ["variant", "country", "platform", "signup_dayofweek"], ["signup_hour", "minutes_signup_to_complete"]
    got = {}
    for r in ML.one_hot(training, ML.categories(seen)).collect():
        got.setdefault(r["user_id"], {})[r["feature"]] = r["value"]
    stages = Pipeline(stages=ML.encoder_stages(cats, nums)).fit(seen)
    names = [f"{c}_{v}" for c, labels in zip(stages.stages[0].getInputCols(), stages.stages[0].labelsArray) for v in labels] + nums
    for r in stages.transform(training).select("user_id", vector_to_array("features").alias("x")).collect():
        assert got[r["user_id"]] == {n: v for n, v in zip(names, r["x"]) if v}


def test_gradient_is_zero_at_the_fit_and_not_beside_it(spark, training):
    model = ML.fit_logistic(training, "y")
    rows = {r["feature"]: abs(r["gradient"]) / max(r["scale"], 1e-9) for r in ML.logistic_gradient(model, training, "y").collect()}
    assert len(rows) == 2 + 3 + 1 + 7 + 2 + 1 and max(rows.values()) < 1e-5
    rough = ML.fit_logistic(training, "y", max_iter=1)
    assert max(abs(r["gradient"]) / max(r["scale"], 1e-9) for r in ML.logistic_gradient(rough, training, "y").collect()) > 1e-3


def test_boosting_stops_early_on_held_out_loss(spark, training):
    watched = ML.fit_gbt(training, "y", max_iter=30, early_stopping=True)
    assert 1 <= ML.rounds(watched) < 30
    assert ML.rounds(ML.fit_gbt(training, "y", max_iter=3, early_stopping=False)) == 3
    p = ML.score(watched, training, ("user_id", "country"), "y").groupBy((F.col("country") == "PT").alias("pt")).agg(F.avg("probability_activate").alias("p")).collect()
    by = {r["pt"]: r["p"] for r in p}
    assert by[True] > 0.6 > 0.4 > by[False]


def test_early_stopping_begins_above_the_row_limit(spark, training, monkeypatch):
    assert ML.rounds(ML.fit_gbt(training, "y", max_iter=4)) == 4
    monkeypatch.setattr(ML, "EARLY_ROWS", 3000)
    assert ML.rounds(ML.fit_gbt(training, "y", max_iter=4, tol=0.9)) < 4  # the second round cannot lower the loss by nine tenths


def test_stored_model_scores_as_the_fitted_one(spark, training):
    model = ML.fit_logistic(training, "y")
    path = tempfile.mkdtemp(prefix="ff-model-") + "/m"
    ML.save(model, path)
    again = ML.load(path)
    assert ML.coefficients(again) == ML.coefficients(model) and ML.feature_names(again) == ML.feature_names(model)
    one, two = (ML.score(m, training) for m in (model, again))
    assert QC.same_fingerprint("c", one, two).first()["passed"]
    ranked = reports.positioned(ML.coefficients_frame(spark, again), "coefficients").orderBy("position").collect()
    assert [r["position"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert [abs(r["coefficient"]) for r in ranked] == sorted((abs(r["coefficient"]) for r in ranked), reverse=True)


def test_pivots_take_any_value(spark):
    rows = [("r", v) for v in ("a", "A", "null", "other", "row", None, None, "x.y`z", "")]
    df = spark.createDataFrame(rows, "row string, v string")
    wide = SG.crosstab_shares(df, "row", "v", decimals=6)
    assert wide.columns == ["row", "", "A", "a_", "null", "other", "row_", "x.y`z", "null_"]
    assert [round(c * 9) for c in wide.first()[1:]] == [1, 1, 1, 1, 1, 1, 1, 2]
    listed = SG.crosstab_shares(df, "row", "v", ["a", "other", None], decimals=6)
    assert listed.columns == ["row", "a", "other", "null", "other_"] and [round(c * 9) for c in listed.first()[1:]] == [1, 1, 2, 5]


def test_exact_split_with_many_labels_and_any_id(spark):
    df = spark.range(-300, 300).select(F.col("id").alias("user_id"), F.when(F.col("id") % 3 > 0, (F.col("id") % 97).cast("string")).alias("label"))
    got = split_exact(df, "label", 0.25, 42).collect()
    n, tested = {}, {}
    for r in got:
        n[r["label"]] = n.get(r["label"], 0) + 1
        tested[r["label"]] = tested.get(r["label"], 0) + r["is_test"]
    assert len(got) == 600 and sum(tested.values()) == 150 and len(n) > 90
    assert all(abs(tested[k] - n[k] / 4) < 1 for k in n)
