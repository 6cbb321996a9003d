"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Queries prefixed ``u_`` run on adapter U (user-day units of the ``events`` table);
the others run on adapter G (the experiment log drawn for ten users per ``customer``
row). Columns whose value goes through ``exp`` (p-values, power) are rounded to 10
decimals in these reports so that a last-bit difference between math libraries does
not change a value hash; the library operators keep full precision.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import experiment as X
from ..operators import features as FT
from ..operators import funnel as FN
from ..operators import metrics as MT
from ..operators import model as ML
from ..operators import quality as QC
from ..operators import segments as SG
from ..operators import timing as TM
from ..operators.staging import dim_users, stg_events, stg_users
from ..schemas import CATEGORICAL, NUMERIC, flag_col
from ..sources.fixtures import RawTables, generated_source, generated_tables, nulls_tables, scored_events, unit_tables

EXP_DECIMALS = 10
G_PLATFORMS = ["ios", "android", "web"]
U_PLATFORMS = ["automobile", "building", "furniture", "household", "machinery"]


class Marts:
    """Staged tables and marts of one adapter. DataFrames are immutable lazy plans, so one
    set per (session, input) is built once and shared by every query."""

    def __init__(self, raw: RawTables):
        self.raw = raw
        self.steps = raw.steps
        self.users = stg_users(raw.users)
        self.events = stg_events(raw.events)

    @cached_property
    def funnel(self) -> DataFrame:
        return FN.fct_funnel(self.users, self.events, self.steps, self.raw.start_step, self.raw.activation_step)

    @cached_property
    def ab(self) -> DataFrame:
        return FN.fct_ab_experiment(self.funnel, self.steps)

    @cached_property
    def logistic(self):
        """The logistic model, fitted once for all queries that use it."""
        return ML.fit_logistic(_train_test(self)[0], self.target)

    @property
    def completed(self) -> str:
        return self.steps[1]

    @property
    def target(self) -> str:
        return flag_col(self.raw.activation_step)


_MARTS: dict = {}


def _cached(kind: str, spark: SparkSession, sf_dir: str, make) -> Marts:
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    m = _MARTS.get(key)
    if m is None:
        m = _MARTS[key] = Marts(make(spark, sf_dir))
    return m


def g_marts(spark: SparkSession, sf_dir: str) -> Marts:
    """Adapter G: marts over the generated raw tables (generated once per session)."""
    return _cached("g", spark, sf_dir, generated_source)


def g_generator(spark: SparkSession, sf_dir: str) -> Marts:
    """Adapter G with the generator itself as the source (for the generator queries)."""
    return _cached("g-plan", spark, sf_dir, generated_tables)


def u_marts(spark: SparkSession, sf_dir: str) -> Marts:
    return _cached("u", spark, sf_dir, unit_tables)


def round_cols(df: DataFrame, cols, decimals: int = EXP_DECIMALS) -> DataFrame:
    return df.select(*[F.round(c, decimals).alias(c) if c in cols else F.col(c) for c in df.columns])


# --------------------------------------------------------------------------- raw, staging, marts
def q_raw_users(m): return m.raw.users
def q_raw_events(m): return m.raw.events
def q_stg_users(m): return m.users
def q_stg_events(m): return m.events
def q_dim_users(m): return dim_users(m.users)
def q_funnel_flags(m): return FN.funnel_flags(m.events, m.steps)
def q_fct_funnel(m): return m.funnel
def q_fct_ab_experiment(m): return m.ab


# --------------------------------------------------------------------------- ad-hoc analyses
def q_funnel_dropoff(m): return FN.funnel_dropoff(m.ab)
def q_ab_lift(m): return FN.ab_lift(m.ab)
def q_weekly_cohorts(m): return SG.weekly_cohorts(m.funnel, m.raw.activation_step)


def q_segment_activation(m, min_users=500):
    return SG.segment_activation(m.funnel, m.raw.activation_step, min_users=min_users)


def q_distinct_users_by_step(m): return SG.distinct_users(m.events, ["event_name"])


# --------------------------------------------------------------------------- experiment
def q_ab_test(m):
    return round_cols(X.ab_test(m.funnel, m.steps), {"p_value", "power"})


def q_ab_test_by_country(m):
    return round_cols(X.ab_test(m.funnel, m.steps, ["country"]), {"p_value", "power"})


def q_ab_test_by_week(m):
    f = m.funnel.withColumn("signup_week", SG.week_start_sunday("signup_date"))
    return round_cols(X.ab_test(f, m.steps, ["signup_week"]), {"p_value", "power"})


def q_ab_test_from_mart(m):
    return round_cols(X.ab_test_from_mart(m.ab, m.completed), {"p_value", "power"})


def q_sample_size_by_country(m):
    return X.sample_size_by_segment(m.funnel, m.steps, ["country"], mde=0.02)


def q_sample_size_relative_by_platform(m):
    return X.sample_size_by_segment(m.funnel, m.steps, ["platform"], mde=0.05, mde_type="relative",
                                    alpha=0.05, power=0.9, ratio=2.0)


def q_mde_by_platform(m): return X.mde_by_segment(m.funnel, m.steps, ["platform"])
def q_mde_overall(m): return X.mde_by_segment(m.funnel, m.steps, ())


# --------------------------------------------------------------------------- dashboard / exploration
def q_funnel_by_variant(m): return FN.funnel_by_variant(m.users, m.events, m.steps)
def q_funnel_overall(m): return FN.funnel_overall(m.users, m.events, m.steps)
def q_lift_table(m): return X.lift_table(FN.funnel_by_variant(m.users, m.events, m.steps))


def q_activation_heatmap(m, platforms=G_PLATFORMS):
    """The listed platforms are columns even where a small input has none of them; others go to ``other``."""
    return SG.activation_heatmap(m.users, m.events, m.raw.activation_step, col_values=platforms)


def q_activation_heatmap_long(m):
    return SG.activation_heatmap_long(m.users, m.events, m.raw.activation_step)


def _tta(m):
    return TM.time_to_activate(m.users, m.events, m.raw.start_step, m.raw.activation_step)


def q_time_to_activate(m): return _tta(m)


def q_tta_describe(m):
    return round_cols(TM.describe(_tta(m), "minutes_to_activate", ["variant"]), {"mean", "std"}, 9)


def q_tta_histogram(m): return TM.histogram(_tta(m), "minutes_to_activate", ["variant"], 40)
def q_value_shares(m): return SG.value_shares(m.users, "variant")
def q_crosstab(m): return SG.crosstab_shares(m.users, "country", "variant")
def q_crosstab_long(m): return SG.crosstab_shares_long(m.users, "country", "variant")


def q_profile(m):
    u = SG.profile(m.users).select(F.lit("stg_users").alias("table_name"), "*")
    e = SG.profile(m.events).select(F.lit("stg_events").alias("table_name"), "*")
    return u.unionByName(e)


def q_arm_counts(m): return FN.arm_counts(m.users, m.events, m.completed)


# --------------------------------------------------------------------------- data quality
def q_model_tests(m):
    return QC.warehouse_checks(m.raw.users, m.raw.events, m.users, m.events, dim_users(m.users), m.funnel, m.ab,
                               m.steps)


def q_generator_contract(m):
    flags = FN.user_flags(m.users, m.events, m.steps, keep=("variant", "country", "platform"))
    return QC._union([
        QC.funnel_monotone(m.users, m.events, m.steps),
        QC.timestamps_in_step_order(m.events, m.steps),
        QC.segment_contract(flags, flag_col(m.completed), m.target, tol=0.02, done_bound=0.03,
                            act_bound=0.02, lift_bound=0.03),
    ])


def q_event_order_checks(m):
    return QC._union([QC.funnel_monotone(m.users, m.events, m.steps),
                      QC.timestamps_in_step_order(m.events, m.steps)])


# --------------------------------------------------------------------------- features and metrics
def _features(m):
    return FT.activation_features(m.users, m.events, m.completed, m.raw.activation_step)


def q_features_local(m): return _features(m)


def q_features_mart(m):
    return FT.features_from_marts(m.funnel, dim_users(m.users), m.completed, m.raw.activation_step)


def q_feature_checks(m):
    return QC.feature_checks(_features(m), m.users, m.target, [*CATEGORICAL, *NUMERIC])


def q_feature_split(m): return FT.split(_features(m), 0.25, 42)
def q_feature_split_exact(m): return FT.split_exact(_features(m), m.target, 0.25, 42)


def _scored_test(m):
    return FT.process_score(FT.split(_features(m), 0.25, 42)).filter(F.col("is_test"))


def q_score_metrics(m):
    return round_cols(MT.summary(_scored_test(m), m.target, "score"), {"average_precision", "brier"})


def q_score_report(m):
    return MT.classification_report(_scored_test(m), m.target, "score", 0.5, ("did_not_activate", "activated"))


def q_score_auc_by_platform(m):
    return MT.roc_auc(FT.process_score(_features(m)), m.target, "score", ["platform"])


# --------------------------------------------------------------------------- generator sanity tables
def q_gen_conversion_by_variant(m):
    # One flag per user, then one aggregate per arm: a NULL arm is an arm like any other.
    flagged = FN.with_reached(m.users.select("user_id", "variant"), m.events, m.completed, "done")
    return flagged.groupBy("variant").agg(
        F.sum(F.col("done").cast("long")).alias("completed_users"), F.count(F.lit(1)).alias("users"),
        F.round(F.sum(F.col("done").cast("long")) / F.count(F.lit(1)), 4).alias("conversion_rate"))


def _activation_by(m, dim):
    flagged = FN.with_reached(m.users.select("user_id", dim), m.events, m.raw.activation_step, "activated")
    return SG.rate_by(flagged, dim, "activated").select(dim, F.round("rate", 4).alias("activation_rate"))


def q_gen_activation_by_country(m): return _activation_by(m, "country")
def q_gen_activation_by_platform(m): return _activation_by(m, "platform")


# --------------------------------------------------------------------------- MLlib (rows-only checks)
def _train_test(m):
    s = FT.split(_features(m), 0.25, 42)
    return s.filter(~F.col("is_test")), s.filter(F.col("is_test"))


def q_logreg_coefficients(m):
    return ML.coefficients_frame(m.users.sparkSession, m.logistic)


def q_logreg_test_metrics(m):
    _, test = _train_test(m)
    scored = ML.score(m.logistic, test, ("user_id",), m.target)
    return MT.summary(scored, m.target, "probability_activate")


def q_gbt_test_metrics(m):
    train, test = _train_test(m)
    scored = ML.score(ML.fit_gbt(train, m.target), test, ("user_id",), m.target)
    return MT.summary(scored, m.target, "probability_activate")


def q_logreg_scores(m):
    """Score every completed user (targeting list)."""
    return ML.score(m.logistic, _features(m), ("user_id", "variant", "country", "platform"))


# --------------------------------------------------------------------------- missing and unlisted values
def nulls_marts(spark: SparkSession, sf_dir: str) -> Marts:
    """Adapter U with NULL and unlisted arms, nations and segments."""
    return _cached("nulls", spark, sf_dir, nulls_tables)


def q_split_nulls(m):
    """Exact split by a label that has NULLs: the arm."""
    return FT.split_exact(_features(m).select("user_id", "variant"), "variant", 0.25, 42)


def q_event_score_metrics(spark, sf_dir):
    return round_cols(MT.summary(scored_events(spark, sf_dir), "label", "score"), {"average_precision", "brier"})


def q_event_score_by_variant(spark, sf_dir):
    return round_cols(MT.summary(scored_events(spark, sf_dir), "label", "score", ["variant"]), {"average_precision", "brier"})


# --------------------------------------------------------------------------- registry
# Queries of both adapters; adapter-U names get the ``u_`` prefix.
_BOTH = {
    "stg_users": q_stg_users, "stg_events": q_stg_events, "dim_users": q_dim_users,
    "funnel_flags": q_funnel_flags, "fct_funnel": q_fct_funnel, "fct_ab_experiment": q_fct_ab_experiment,
    "funnel_dropoff": q_funnel_dropoff, "ab_lift": q_ab_lift, "weekly_cohorts": q_weekly_cohorts,
    "distinct_users_by_step": q_distinct_users_by_step,
    "ab_test": q_ab_test, "ab_test_by_country": q_ab_test_by_country, "ab_test_by_week": q_ab_test_by_week,
    "ab_test_from_mart": q_ab_test_from_mart,
    "sample_size_by_country": q_sample_size_by_country, "mde_by_platform": q_mde_by_platform,
    "mde_overall": q_mde_overall,
    "funnel_by_variant": q_funnel_by_variant, "funnel_overall": q_funnel_overall, "lift_table": q_lift_table,
    "time_to_activate": q_time_to_activate, "tta_describe": q_tta_describe, "tta_histogram": q_tta_histogram,
    "value_shares": q_value_shares, "crosstab": q_crosstab, "profile": q_profile, "arm_counts": q_arm_counts,
    "model_tests": q_model_tests,
    "features_local": q_features_local, "features_mart": q_features_mart, "feature_checks": q_feature_checks,
    "feature_split": q_feature_split, "feature_split_exact": q_feature_split_exact,
}
_G_ONLY = {
    "segment_activation": q_segment_activation,
    "activation_heatmap": q_activation_heatmap,
    "sample_size_relative_by_platform": q_sample_size_relative_by_platform,
    "generator_contract": q_generator_contract,
    "score_metrics": q_score_metrics, "score_report": q_score_report, "score_auc_by_platform": q_score_auc_by_platform,
    "gen_conversion_by_variant": q_gen_conversion_by_variant,
    "gen_activation_by_country": q_gen_activation_by_country,
    "gen_activation_by_platform": q_gen_activation_by_platform,
    "logreg_coefficients": q_logreg_coefficients, "logreg_test_metrics": q_logreg_test_metrics,
    "gbt_test_metrics": q_gbt_test_metrics, "logreg_scores": q_logreg_scores,
}
_U_ONLY = {
    "raw_users": q_raw_users, "raw_events": q_raw_events,
    "segment_activation": partial(q_segment_activation, min_users=25),
    "activation_heatmap": partial(q_activation_heatmap, platforms=U_PLATFORMS),
    "event_order_checks": q_event_order_checks,
}
_NULLS = {
    "tta_describe": q_tta_describe, "tta_histogram": q_tta_histogram, "crosstab_long": q_crosstab_long,
    "activation_heatmap_long": q_activation_heatmap_long, "sample_size_by_country": q_sample_size_by_country,
    "mde_by_platform": q_mde_by_platform, "conversion_by_variant": q_gen_conversion_by_variant,
    "split_exact": q_split_nulls, "value_shares": q_value_shares,
}
# The generator queries run the generator itself rather than the materialised tables.
_GENERATOR = {"raw_users": q_raw_users, "raw_events": q_raw_events}


def _build(fn, marts_fn):
    return lambda spark, sf_dir: fn(marts_fn(spark, sf_dir))


def registry() -> dict:
    out = {}
    for name, fn in {**_BOTH, **_G_ONLY}.items():
        out[name] = _build(fn, g_marts)
    for name, fn in _GENERATOR.items():
        out[name] = _build(fn, g_generator)
    for name, fn in {**_BOTH, **_U_ONLY}.items():
        out[f"u_{name}"] = _build(fn, u_marts)
    for name, fn in _NULLS.items():
        out[f"u_nulls_{name}"] = _build(fn, nulls_marts)
    from . import given

    out |= given.registry()
    out["u_event_score_metrics"] = q_event_score_metrics
    out["u_event_score_by_variant"] = q_event_score_by_variant
    return out
