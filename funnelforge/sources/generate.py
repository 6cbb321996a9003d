"""Synthetic onboarding-experiment log as a Spark job.

Every random quantity is an md5 draw of ``(user_id, purpose, seed)``, so the output
depends only on the ids and the seed: not on partitioning, task order or retries.
Users come from a DataFrame of ids (``spark.range`` or ids derived from a given
table), the per-user funnel walk is a chain of Column expressions, the long event
log is an ``inline`` of the reached steps, and event ids are dense running totals
computed per block of users (no single-partition window). The ids are dealt by block
before anything is drawn, so the walk's wide rows are numbered where they are made.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import clip, hash_int, hash_uniform, weighted_choice
from ..plans.prefix import block_offsets
from ..schemas import STEPS

# ---------------------------------------------------------------------------
# Fixed values of the data-generating process.
# Variant affects only signup_completed; country moves KYC, platform moves the
# deposit, the signup hour moves the first transaction.
# ---------------------------------------------------------------------------
P_SIGNUP_COMPLETED_CONTROL = 0.62
P_SIGNUP_COMPLETED_TREATMENT = 0.68
P_KYC_SUBMITTED = 0.75
P_FIRST_DEPOSIT = 0.55
P_FIRST_TRANSACTION = 0.70
VARIANTS = ["control", "treatment"]
VARIANT_WEIGHTS = [0.5, 0.5]
COUNTRIES = ["PT", "ES", "PL", "GB", "AE"]
COUNTRY_WEIGHTS = [0.30, 0.25, 0.20, 0.15, 0.10]
PLATFORMS = ["ios", "android", "web"]
PLATFORM_WEIGHTS = [0.45, 0.40, 0.15]
KYC_COUNTRY_MODIFIER = {"PT": 0.05, "ES": 0.03, "GB": 0.02, "PL": 0.00, "AE": -0.10}
DEPOSIT_PLATFORM_MODIFIER = {"ios": 0.05, "android": 0.00, "web": -0.08}
NIGHT_HOURS = (0, 5)  # 00:00-05:59, inclusive hours
TXN_NIGHT_SIGNUP_MODIFIER = -0.06
TXN_DAY_SIGNUP_MODIFIER = 0.01
PROB_CLIP = (0.01, 0.99)
SIGNUP_START = dt.datetime(2026, 1, 1)
SIGNUP_WINDOW_MINUTES = 60 * 24 * 60
STEP_GAP_MINUTES = {
    "signup_completed": (3, 20),
    "kyc_submitted": (10, 90),
    "first_deposit": (30, 360),
    "first_transaction": (15, 600),
}
DEFAULT_SEED = 42

# Users per block when numbering events (bounded window size per task).
EVENT_ID_BLOCK_USERS = 1 << 14

_EPOCH_START = int(SIGNUP_START.replace(tzinfo=dt.timezone.utc).timestamp())


def _lookup(col, mapping: dict) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(0.0))


def funnel_walk(ids: DataFrame, seed: int = DEFAULT_SEED, keep: Sequence[str] = ()) -> DataFrame:
    """One row per user: attributes, the minute of every step after the window start (``_m0`` ..) and the number of
    steps reached (``_k``; they are the first of the funnel), and the columns ``keep`` of ``ids``.

    Every draw is computed once in its own projection (Catalyst keeps projections that
    would otherwise duplicate an md5), the derived values follow in later projections.
    """
    uid = F.col("user_id")
    draws = ["variant", "country", "platform", "complete", "kyc", "deposit", "transaction"]
    gap_steps = STEPS[1:]
    drawn = ids.select(F.col("user_id").cast("long").alias("user_id"), *keep).select(
        "user_id", *keep,
        *[hash_uniform(uid, d, seed).alias(f"_u_{d}") for d in draws],
        hash_int(uid, "signup_minute", seed, 0, SIGNUP_WINDOW_MINUTES - 1).alias("_m0"),
        *[hash_int(uid, f"gap_{s}", seed, *STEP_GAP_MINUTES[s]).alias(f"_g{i + 1}")
          for i, s in enumerate(gap_steps)],
    )
    # Step times in minutes after the window start: cumulative strictly positive gaps.
    minutes = [F.col("_m0")]
    for i in range(1, len(STEPS)):
        minutes.append(minutes[-1] + F.col(f"_g{i}"))
    attrs = drawn.select(
        "user_id", *keep, *[f"_u_{d}" for d in draws[3:]],
        weighted_choice(F.col("_u_variant"), VARIANTS, VARIANT_WEIGHTS).alias("variant"),
        weighted_choice(F.col("_u_country"), COUNTRIES, COUNTRY_WEIGHTS).alias("country"),
        weighted_choice(F.col("_u_platform"), PLATFORMS, PLATFORM_WEIGHTS).alias("platform"),
        *[m.alias(f"_m{i}") for i, m in enumerate(minutes)],
    )
    hour = F.floor((F.col("_m0") % F.lit(1440)) / F.lit(60))
    p_complete = F.when(F.col("variant") == "treatment", F.lit(P_SIGNUP_COMPLETED_TREATMENT)) \
        .otherwise(F.lit(P_SIGNUP_COMPLETED_CONTROL))
    p_kyc = clip(F.lit(P_KYC_SUBMITTED) + _lookup(F.col("country"), KYC_COUNTRY_MODIFIER), *PROB_CLIP)
    p_dep = clip(F.lit(P_FIRST_DEPOSIT) + _lookup(F.col("platform"), DEPOSIT_PLATFORM_MODIFIER), *PROB_CLIP)
    is_night = hour.between(NIGHT_HOURS[0], NIGHT_HOURS[1])
    p_txn = clip(F.lit(P_FIRST_TRANSACTION) + F.when(is_night, F.lit(TXN_NIGHT_SIGNUP_MODIFIER))
                 .otherwise(F.lit(TXN_DAY_SIGNUP_MODIFIER)), *PROB_CLIP)
    passed = attrs.select(
        "user_id", *keep, "variant", "country", "platform", *[f"_m{i}" for i in range(len(STEPS))],
        (F.col("_u_complete") < p_complete).alias("_p1"),
        (F.col("_u_kyc") < p_kyc).alias("_p2"),
        (F.col("_u_deposit") < p_dep).alias("_p3"),
        (F.col("_u_transaction") < p_txn).alias("_p4"),
    )

    reached = [F.lit(True)]
    for i in range(1, len(STEPS)):
        reached.append(reached[-1] & F.col(f"_p{i}") if i > 1 else F.col("_p1"))
    return passed.select(
        "user_id", *keep, "variant", "country", "platform",
        *[F.col(f"_m{i}").cast("int").alias(f"_m{i}") for i in range(len(STEPS))],
        sum(r.cast("int") for r in reached).alias("_k"))


def _ts(minute: str) -> F.Column:
    return F.timestamp_seconds(F.lit(_EPOCH_START) + F.col(minute).cast("long") * F.lit(60))


def raw_users_from_walk(walk: DataFrame) -> DataFrame:
    return walk.select("user_id", "variant", "country", "platform", _ts("_m0").alias("signup_ts"))


def numbered_walk(ids: DataFrame, seed: int = DEFAULT_SEED) -> DataFrame:
    """The walk with the user's block, and the number of events before the user in the block."""
    block = F.floor(F.col("user_id") / F.lit(EVENT_ID_BLOCK_USERS)).cast("long")
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ids.select(F.col("user_id").cast("long").alias("user_id")).withColumn("_block", block).repartition(n, "_block")
    before = Window.partitionBy("_block").orderBy("user_id").rowsBetween(Window.unboundedPreceding, -1)
    return funnel_walk(dealt, seed, keep=["_block"]).withColumn("_before", F.coalesce(F.sum("_k").over(before), F.lit(0)))


def number_events(numbered: DataFrame) -> DataFrame:
    """Add ``_offset``, the number of events of all users before the user."""
    offsets = block_offsets(numbered, "_block", "_k", "_offset")
    return (numbered.join(F.broadcast(offsets), "_block")  # one row per EVENT_ID_BLOCK_USERS users
            .withColumn("_offset", F.col("_offset") + F.col("_before")))


def raw_events_from_walk(walk: DataFrame) -> DataFrame:
    """Long event log of a walk with offsets; event_id is dense 1..M in (user_id, event_ts) order."""
    arr = F.array(*[
        F.struct(F.lit(i + 1).alias("step_order"), F.lit(s).alias("event_name"),
                 _ts(f"_m{i}").alias("event_ts"))
        for i, s in enumerate(STEPS)])
    # Reached steps form a prefix of the funnel, so the step order is the rank in time.
    events = walk.select("user_id", "_offset", "_k", F.inline(arr)).filter(F.col("step_order") <= F.col("_k"))
    return events.select((F.col("_offset") + F.col("step_order")).cast("long").alias("event_id"),
                         "user_id", "event_name", "event_ts")


def generate(spark: SparkSession, n_users: int | None = None, seed: int = DEFAULT_SEED,
             ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Return (raw_users, raw_events) for ids 1..n_users, or for the given id frame."""
    if ids is None:
        if n_users is None:
            raise ValueError("give n_users or ids")
        ids = spark.range(1, n_users + 1).withColumnRenamed("id", "user_id")
    return raw_users_from_walk(funnel_walk(ids, seed)), raw_events_from_walk(number_events(numbered_walk(ids, seed)))
