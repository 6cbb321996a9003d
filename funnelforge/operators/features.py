"""Feature table of the post-signup activation model, its split and a reference score.

Population: users who completed signup. Target: reached the activation step. Steps
between the two (KYC, deposit) are never used as features (leakage guard).
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, fractional_minutes, hash_uniform
from ..plans.prefix import dense_ids, running_totals
from ..schemas import ACTIVATION_STEP, COMPLETED_STEP, flag_col
from ..session import materialise
from ..sources import generate as G


def activation_features(users: DataFrame, events: DataFrame, completed_step: str = COMPLETED_STEP,
                        activation_step: str = ACTIVATION_STEP) -> DataFrame:
    """user_id, variant, country, platform, signup_dayofweek (Mon=0), signup_hour,
    minutes_signup_to_complete, reached_<activation> (first completion event per user)."""
    name, ts = F.col("event_name"), F.col("event_ts")
    per_user = events.filter(name.isin(completed_step, activation_step)).groupBy("user_id").agg(
        F.min(F.when(name == F.lit(completed_step), ts)).alias("completed_ts"),
        F.max(F.when(name == F.lit(activation_step), F.lit(1)).otherwise(F.lit(0))).alias("_target"))
    pop = per_user.filter(F.col("completed_ts").isNotNull())
    df = users.select("user_id", "variant", "country", "platform", "signup_ts").join(pop, "user_id", "inner")
    return df.select(
        "user_id", "variant", "country", "platform",
        F.weekday("signup_ts").cast("string").alias("signup_dayofweek"),
        F.hour("signup_ts").alias("signup_hour"),
        fractional_minutes("signup_ts", "completed_ts").alias("minutes_signup_to_complete"),
        F.col("_target").alias(flag_col(activation_step)))


def features_from_marts(funnel: DataFrame, dim: DataFrame, completed_step: str = COMPLETED_STEP,
                        activation_step: str = ACTIVATION_STEP) -> DataFrame:
    """Mart path: fct_funnel JOIN dim_users, completed users; weekday with Sunday = 1."""
    f = funnel.filter(F.col(flag_col(completed_step)) == 1).select(
        "user_id", "variant", "country", "platform", flag_col(activation_step))
    u = dim.select("user_id", "signup_ts")
    return f.join(u, "user_id", "inner").select(
        "user_id", "variant", "country", "platform",
        F.hour("signup_ts").alias("signup_hour"),
        F.dayofweek("signup_ts").cast("string").alias("signup_dayofweek"),
        flag_col(activation_step))


def split(features: DataFrame, test_size: float = 0.25, seed: int = 42, col: str = "is_test") -> DataFrame:
    """Deterministic hash split: independent of partitioning, no shuffle. Each label is
    split with the same probability, so strata keep their share in expectation."""
    return features.withColumn(col, hash_uniform(F.col("user_id"), "split", seed) < F.lit(test_size))


def split_exact(features: DataFrame, label: str, test_size: float = 0.25, seed: int = 42,
                col: str = "is_test") -> DataFrame:
    """Exactly stratified split: ceil(test_size * n) of all n users are tested, dealt to the labels by
    largest remainder (ties to the smaller label, NULL first), and within each label those with the smallest draw.

    Sizes are whole-number arithmetic. Ranks come from block-wise running totals over the unique key (draw, user_id), so a
    label holding most rows is still spread over many tasks and the result does not depend on
    partitioning. There may be any number of labels: sizes come from the written copy, turns from a distributed
    order of the labels, and rows meet their label's quota by a null-safe join. A NULL label is a label like any other."""
    draw = F.conv(F.substring(F.md5(F.concat(F.col("user_id").cast("string"), F.lit(f":split:{seed}"))), 1, 13), 16, 10).cast("long")
    key, one, own, cum, tot = ("_split_key", "_one", "_label", "cum__one", "tot__one")
    ranked = running_totals(features.withColumn(key, F.struct(draw.alias("draw"), F.col("user_id"))).withColumn(one, F.lit(1).cast("long"))
                            .withColumn(own, F.struct(F.lit(0).alias("_"), F.col(label).alias("l"))), key, [one], [label], totals=True)
    big = "decimal(38,0)"
    share = Fraction(str(test_size))
    sizes = materialise(ranked.groupBy(own).agg(F.max(tot).cast(big).alias("n")), "sizes").withColumn("_k", F.lit(1))
    total = sizes.groupBy("_k").agg(F.sum("n").cast(big).alias("total")).selectExpr(
        "_k", "total", f"CAST((total * {share.numerator} + {share.denominator - 1}) div {share.denominator} AS {big}) AS want")
    dealt = sizes.join(F.broadcast(total), "_k").selectExpr(  # one row
        own, "want", f"CAST((want * n) div total AS {big}) AS whole", "(want * n) % total AS left")
    turns = dense_ids(dealt, [F.desc("left"), F.asc(own)], "turn").withColumn("_k", F.lit(1))
    rest = turns.groupBy("_k").agg((F.max("want") - F.sum("whole")).alias("rest"))
    quota = materialise(turns.join(F.broadcast(rest), "_k").select(own, (F.col("whole") + (F.col("turn") <= F.col("rest")).cast("int")).alias("_quota")), "quota")
    return ranked.join(quota, own).withColumn(col, F.col(cum) <= F.col("_quota")).drop(key, one, own, cum, tot, "_quota")


def process_score(features: DataFrame, out_col: str = "score") -> DataFrame:
    """Reference score: the generating probability of activation after signup
    (KYC x deposit x transaction), from country, platform and signup hour."""
    def lookup(col, mapping):
        out = None
        for k, v in mapping.items():
            out = F.when(F.col(col) == F.lit(k), F.lit(v)) if out is None else out.when(F.col(col) == F.lit(k), F.lit(v))
        return out.otherwise(F.lit(0.0))

    lo, hi = G.PROB_CLIP
    night = F.col("signup_hour").between(G.NIGHT_HOURS[0], G.NIGHT_HOURS[1])
    p_kyc = clip(F.lit(G.P_KYC_SUBMITTED) + lookup("country", G.KYC_COUNTRY_MODIFIER), lo, hi)
    p_dep = clip(F.lit(G.P_FIRST_DEPOSIT) + lookup("platform", G.DEPOSIT_PLATFORM_MODIFIER), lo, hi)
    p_txn = clip(F.lit(G.P_FIRST_TRANSACTION) + F.when(night, F.lit(G.TXN_NIGHT_SIGNUP_MODIFIER))
                 .otherwise(F.lit(G.TXN_DAY_SIGNUP_MODIFIER)), lo, hi)
    return features.withColumn(out_col, p_kyc * p_dep * p_txn)
