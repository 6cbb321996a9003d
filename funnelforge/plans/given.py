"""Registered queries over the given tables for sources, sinks, orders, positions, encodings and models.

All run on adapter U (``events``, ``customer``, ``nation``). Queries whose numbers SQL cannot know (a fitted model's) return contract
rows: a check's name, the rows it covers, and whether it passed. Tables and models that a query stores go to the shared folder.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..operators import experiment as X
from ..operators import features as FT
from ..operators import metrics as MT
from ..operators import model as ML
from ..operators import quality as QC
from ..operators import segments as SG
from ..operators import timing as TM
from ..operators.funnel import ab_lift, funnel_dropoff, with_reached
from ..operators.staging import preview
from ..schemas import CATEGORICAL, RAW_EVENTS, RAW_USERS, flag_col
from ..session import checkpoint_dir, materialise
from ..sources import fixtures, io
from . import reports, warehouse
from .prefix import dense_ids
from .queries import Marts, nulls_marts, round_cols, u_marts

UNSEEN = "FRANCE"
MINUTES_TO_NEXT = 90
_LOCK = threading.Lock()


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _database(spark: SparkSession) -> str:
    """One database per application in the shared folder."""
    name = "given_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    io.create_database(spark, name, f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    return name


def _table(spark: SparkSession, name: str) -> str:
    return f"{_database(spark)}.{name}_{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------- positions and orders
def event_ids(spark, sf_dir):
    """A dense id for every event in (user_id, ts, event_id) order."""
    events = fixtures.read_table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return dense_ids(events, ["user_id", "ts", "event_id"], "position").select("event_id", "user_id", "position")


def _by_country(m: Marts) -> DataFrame:
    flagged = with_reached(m.users.select("user_id", "country"), m.events, m.raw.activation_step, "activated")
    return SG.rate_by(flagged, "country", "activated").select("country", F.round("rate", 4).alias("activation_rate"))


ORDERED = {
    "ab_experiment": lambda m: reports.positioned(m.ab, "fct_ab_experiment"),
    "funnel_dropoff": lambda m: reports.positioned(funnel_dropoff(m.ab), "funnel_dropoff"),
    "ab_lift": lambda m: reports.positioned(ab_lift(m.ab), "ab_lift"),
    "weekly_cohorts": lambda m: reports.positioned(SG.weekly_cohorts(m.funnel, m.raw.activation_step), "weekly_cohorts"),
    "segment_activation": lambda m: reports.positioned(SG.segment_activation(m.funnel, m.raw.activation_step, min_users=25), "segment_activation"),
    "activation_by_country": lambda m: reports.positioned(_by_country(m), ["-activation_rate", "country"]),
}


def preview_users(m: Marts) -> DataFrame:
    return preview(m.users, 5, ["user_id"])


def step_deadlines(m: Marts) -> DataFrame:
    return TM.step_deadlines(m.events, m.steps, MINUTES_TO_NEXT)


# --------------------------------------------------------------------------- sources and sinks
def csv_users(m: Marts) -> DataFrame:
    """The raw users through a CSV file and a load into a table."""
    spark, path = m.users.sparkSession, _folder(m.users.sparkSession, "raw-users-csv")
    io.write_csv(m.raw.users, path)
    return spark.table(io.load(spark, path, _table(spark, "raw_users"), RAW_USERS).table)


def csv_events(m: Marts) -> DataFrame:
    spark, path = m.users.sparkSession, _folder(m.users.sparkSession, "raw-events-csv")
    io.write_csv(m.raw.events, path)
    return spark.table(io.load(spark, path, _table(spark, "raw_events"), RAW_EVENTS).table)


def csv_quarantine(m: Marts) -> DataFrame:
    """Every unit whose id ends in 3 gets an unreadable time; counts of the load, and of what the two tables hold."""
    spark, path = m.users.sparkSession, _folder(m.users.sparkSession, "damaged-csv")
    spoilt = m.raw.users.withColumn("signup_ts", F.when(F.col("user_id") % 10 == 3, F.lit("not a time")).otherwise(F.date_format("signup_ts", "yyyy-MM-dd HH:mm:ss")))
    io.write_csv(spoilt, path)
    done = io.load(spark, path, _table(spark, "raw_users"), RAW_USERS, most_rejected=0.5)
    held = spark.table(done.table).agg(F.count(F.lit(1)).alias("rows_loaded"), F.sum((F.col("user_id") % 10 == 3).cast("int")).alias("bad_loaded"))
    kept = spark.table(done.quarantine).agg(F.count(F.lit(1)).alias("rows_rejected"), F.sum(F.col("line").contains("not a time").cast("long")).alias("lines_whole"))
    both = held.withColumn("_k", F.lit(1)).join(kept.withColumn("_k", F.lit(1)), "_k")  # one row each
    return both.select("rows_loaded", F.col("bad_loaded").cast("long").alias("bad_loaded"), "rows_rejected", "lines_whole",
                       F.lit(done.rows + done.rejected).cast("long").alias("lines"))


def inferred_users(m: Marts) -> DataFrame:
    """The raw users through a CSV whose types are inferred, as autodetecting loads do."""
    spark, path = m.users.sparkSession, _folder(m.users.sparkSession, "inferred-csv")
    io.write_csv(m.raw.users, path)
    got = io.load_csv_to_table(spark, path, _table(spark, "inferred_users"))
    return got.select(F.col("user_id").cast("long").alias("user_id"), "variant", "country", "platform", F.col("signup_ts").cast("timestamp").alias("signup_ts"))


def stored_funnel(m: Marts) -> DataFrame:
    """The funnel mart as a stored table, partitioned by signup date."""
    spark = m.users.sparkSession
    name = _table(spark, "fct_funnel")
    io.save_table(m.funnel, name, partition_by=["signup_date"])
    return spark.table(name).select(m.funnel.columns)


def staging_view(m: Marts) -> DataFrame:
    """The staging view over stored raw tables as another session of the application reads it."""
    spark = m.users.sparkSession
    database = f"{_database(spark)}_{uuid.uuid4().hex[:12]}"
    io.create_database(spark, database, _folder(spark, database))
    warehouse.staging_views(spark, database, m.raw.users, m.raw.events)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    path = _folder(spark, "view-read")
    io.write_parquet(other.table(f"{database}.stg_users"), path)
    return io.read_parquet(spark, path)


def partitioned_mart(m: Marts) -> DataFrame:
    """The experiment test from a mart partitioned by step, whose named parameter reads one partition."""
    spark = m.users.sparkSession
    name = _table(spark, "fct_ab_experiment")
    io.save_table(m.ab, name, partition_by=["funnel_step"])
    return round_cols(X.ab_test_parameterised(spark, name, m.completed), {"p_value", "power"})


# --------------------------------------------------------------------------- quality
def determinism(spark, sf_dir):
    """Marts and splits computed twice from differently partitioned events, compared by fingerprints."""
    def at(parts):
        raw = fixtures.unit_tables(spark, sf_dir)
        return Marts(fixtures.RawTables(raw.users.repartition(parts), raw.events.repartition(parts), raw.steps, raw.start_step, raw.activation_step))

    one, two = at(3), at(11)
    feats = [FT.activation_features(m.users, m.events, m.completed, m.raw.activation_step) for m in (one, two)]
    return QC._union([QC.same_fingerprint("funnel_mart_at_3_and_11_partitions", one.funnel, two.funnel),
                      QC.same_fingerprint("split_with_the_same_seed", FT.split(feats[0], seed=42), FT.split(feats[1], seed=42)),
                      QC.same_fingerprint("split_with_another_seed", FT.split(feats[0], seed=42), FT.split(feats[1], seed=43), equal=False)])


def schema_contract(m: Marts) -> DataFrame:
    local, mart = _features(m), _mart_features(m)
    names = {"features_local": local, "features_mart": mart}
    need = [*CATEGORICAL, "signup_hour", m.target]
    leaky = [flag_col(s) for s in m.steps if flag_col(s) != m.target]
    return QC.schema_contract(names, {"features_local": [*need, "minutes_signup_to_complete"], "features_mart": need}, {t: leaky for t in names})


# --------------------------------------------------------------------------- encodings and models
def _features(m: Marts) -> DataFrame:
    return FT.activation_features(m.users, m.events, m.completed, m.raw.activation_step)


def _mart_features(m: Marts) -> DataFrame:
    return FT.features_from_marts(m.funnel, m.users, m.completed, m.raw.activation_step)


def _one_hot(df: DataFrame) -> DataFrame:
    """Encoded with the categories of the other countries, so one country is unseen."""
    return ML.one_hot(df, ML.categories(df.where(F.col("country") != UNSEEN)))


def one_hot(m: Marts) -> DataFrame:
    return _one_hot(_features(m))


def one_hot_mart(m: Marts) -> DataFrame:
    """The same encoding on the mart path, which has no minutes."""
    return _one_hot(_mart_features(m))


class Fitted:
    """A logistic model fitted once, stored, and read back by every query; and its train and test rows."""

    def __init__(self, m: Marts, features: DataFrame):
        split = FT.split(features, 0.25, 42)
        self.target, self.features = m.target, features
        self.train, self.test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
        self.path = _folder(m.users.sparkSession, "logistic")
        self.fitted = ML.fit_logistic(self.train, self.target)
        ML.save(self.fitted, self.path)

    def model(self):
        return ML.load(self.path)


_FITTED: dict = {}


def _stored(m: Marts, kind: str) -> Fitted:
    key = (m.users.sparkSession.sparkContext.applicationId, id(m), kind)
    with _LOCK:
        if key not in _FITTED:
            _FITTED[key] = Fitted(m, _features(m) if kind == "local" else _mart_features(m))
        return _FITTED[key]


def coefficients_ranked(m: Marts) -> DataFrame:
    """The stored model's coefficients with their position by absolute value."""
    frame = ML.coefficients_frame(m.users.sparkSession, _stored(m, "local").model())
    return reports.positioned(frame, "coefficients")


def gradient(m: Marts) -> DataFrame:
    """The penalised gradient of the stored model on its training rows, in units of each feature (one that is always 0 as it is): 0 at the optimum."""
    kept = _stored(m, "local")
    found = ML.logistic_gradient(kept.model(), kept.train, kept.target)
    return found.select("feature", F.round(F.abs(F.coalesce(safe_div("gradient", "scale"), F.col("gradient"))), 4).alias("gradient"))


def _contract(scored: DataFrame, target: str, extra: list) -> DataFrame:
    """Contract rows of a scored table (user_id, target, probability_activate)."""
    p = F.col("probability_activate")
    scored = materialise(scored, "scored")
    one = scored.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users"), F.sum((~p.between(0, 1) | F.isnan(p)).cast("int")).alias("outside"),
                     F.sum(F.col(target)).alias("positives")).first()
    got = MT.summary(scored, target, "probability_activate").first()
    classes = MT.classification_report(scored, target, "probability_activate").collect()
    support = {r["class_label"]: r["support"] for r in classes}
    auc = BinaryClassificationEvaluator(rawPredictionCol="probability_activate", labelCol=target, numBins=0).evaluate(scored.withColumn(target, F.col(target).cast("double")))
    mean = one["positives"] / max(one["rows"], 1)
    checks = [("one_row_per_user", one["rows"] == one["users"]), ("probabilities_in_unit_interval", one["outside"] == 0),
              ("auc_as_the_evaluator", abs(auc - got["auc"]) < 1e-9), ("average_precision_in_unit_interval", 0 <= got["average_precision"] <= 1),
              ("brier_near_the_constant_or_below", got["brier"] <= mean * (1 - mean) * 1.25), ("report_supports_add_up", support["0"] + support["1"] == one["rows"] == support["accuracy"]),
              ("positives_as_labelled", support["1"] == one["positives"])] + extra
    return scored.sparkSession.createDataFrame([(n, one["rows"], bool(ok)) for n, ok in checks], "check_name string, rows long, passed boolean")


def logistic_contract(m: Marts, kind: str = "local") -> DataFrame:
    kept = _stored(m, kind)
    model = kept.model()
    same = ML.coefficients(model) == ML.coefficients(kept.fitted)
    ranked = [abs(c) for _, c in ML.coefficients(model)]
    scored = ML.score(model, kept.test, ("user_id",), kept.target)
    return _contract(scored, kept.target, [("stored_model_as_fitted", same), ("coefficients_ranked", ranked == sorted(ranked, reverse=True))])


def logistic_mart_contract(m: Marts) -> DataFrame:
    """The model of the mart path, which has no minutes."""
    return logistic_contract(m, "mart")


def gbt_contract(m: Marts) -> DataFrame:
    """Boosting watched by held-out loss, whatever the number of rows."""
    kept = _stored(m, "local")
    model = ML.fit_gbt(kept.train, kept.target, early_stopping=True)
    used = ML.rounds(model)
    scored = ML.score(model, kept.test, ("user_id",), kept.target)
    return _contract(scored, kept.target, [("rounds_within_limit", 1 <= used <= 100)])


def scores(m: Marts) -> DataFrame:
    """Every completed user scored by the stored model (targeting list): user, and whether the score is a probability."""
    kept = _stored(m, "local")
    got = ML.score(kept.model(), kept.features, ("user_id", "variant", "country", "platform"))
    return got.select("user_id", "variant", "country", "platform", F.col("probability_activate").between(0, 1).alias("is_probability"))


# --------------------------------------------------------------------------- pivots that take any value
def nulls_crosstab(m: Marts) -> DataFrame:
    """Arms NULL, ``holdout`` and the text ``null`` as columns of one table."""
    users = m.users.withColumn("variant", F.when(F.col("user_id") % 7 == 0, F.lit("null")).otherwise(F.col("variant")))
    wide = SG.crosstab_shares(users, "country", "variant")
    return wide.withColumnRenamed("null_", "missing").withColumnRenamed("null", "text_null")


def nulls_heatmap(m: Marts) -> DataFrame:
    """Listed platforms, a real platform ``other`` and all the rest, NULL included."""
    users = m.users.withColumn("platform", F.when(F.col("user_id") % 7 == 0, F.lit("other")).otherwise(F.col("platform")))
    wide = SG.activation_heatmap(users, m.events, m.raw.activation_step, col_values=["automobile", "other"])
    return wide.withColumnRenamed("other", "named_other").withColumnRenamed("other_", "rest")


_MARTS = {
    "preview_users": preview_users, "step_deadlines": step_deadlines, "csv_users": csv_users, "csv_events": csv_events, "csv_quarantine": csv_quarantine,
    "inferred_users": inferred_users, "stored_funnel": stored_funnel, "staging_view": staging_view, "partitioned_mart": partitioned_mart,
    "schema_contract": schema_contract, "one_hot": one_hot, "one_hot_mart": one_hot_mart, "coefficients_ranked": coefficients_ranked,
    "logistic_gradient": gradient, "logistic_contract": logistic_contract, "logistic_mart_contract": logistic_mart_contract, "gbt_contract": gbt_contract,
    "scores": scores,
}


def registry() -> dict:
    def on(marts, fn):
        return lambda spark, sf_dir: fn(marts(spark, sf_dir))

    out = {f"u_{name}": on(u_marts, fn) for name, fn in _MARTS.items()}
    out |= {f"u_ordered_{name}": on(u_marts, fn) for name, fn in ORDERED.items()}
    out |= {"u_nulls_crosstab": on(nulls_marts, nulls_crosstab), "u_nulls_activation_heatmap": on(nulls_marts, nulls_heatmap),
            "u_event_ids": event_ids, "u_determinism": determinism}
    return out
