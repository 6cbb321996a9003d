"""Adapters from the given Parquet tables to the raw users / events contract.

Two adapters, both pure DataFrame plans whose work grows with the input tables:

* ``unit_tables`` (adapter U): one unit per (user, calendar day) in every user's
  active span of the ``events`` table. Units inherit country (nation name) and
  platform (market segment) from ``customer``; the arm is the parity of the user id;
  the event type is the funnel step. Days without events give units without events.
* ``generated_tables`` (adapter G): the synthetic experiment log, with ten users per
  ``customer`` row (ids ``c_custkey*10 + 1 .. + 10``). ``generated_source`` writes it once
  per session into the checkpoint folder, bucketed by ``user_id``, and reads it back.
"""

from __future__ import annotations

import hashlib
import threading
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ACTIVATION_STEP, START_STEP, STEPS
from ..session import checkpoint_dir
from .generate import DEFAULT_SEED, generate, number_events, numbered_walk, raw_events_from_walk, raw_users_from_walk

# Fixed values of adapter U: event types taken as funnel steps, in this order.
UNIT_STEPS = ["signup", "view", "click", "purchase", "error"]
UNIT_START_STEP = "signup"
UNIT_ACTIVATION_STEP = "purchase"
UNIT_DAY_FACTOR = 100_000  # unit id = user_id * factor + days since 1970-01-01
USERS_PER_CUSTOMER = 10


@dataclass
class RawTables:
    users: DataFrame
    events: DataFrame
    steps: list
    start_step: str
    activation_step: str


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unit_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    day = F.to_date("ts")
    unit = F.col("user_id") * F.lit(UNIT_DAY_FACTOR) + F.unix_date(day).cast("long")

    raw_events = ev.select(
        F.col("event_id").cast("long").alias("event_id"),
        unit.alias("user_id"),
        F.col("event_type").alias("event_name"),
        F.col("ts").alias("event_ts"))

    spans = ev.groupBy("user_id").agg(F.min(day).alias("d0"), F.max(day).alias("d1"))
    days = spans.select("user_id", F.explode(F.sequence("d0", "d1")).alias("day"))
    customer = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    raw_users = (days
                 .join(customer, "user_id", "left")
                 .join(nation, "c_nationkey", "left")
                 .select((F.col("user_id") * F.lit(UNIT_DAY_FACTOR)
                          + F.unix_date("day").cast("long")).alias("user_id"),
                         F.when(F.col("user_id") % 2 == 0, F.lit("control"))
                         .otherwise(F.lit("treatment")).alias("variant"),
                         F.col("n_name").alias("country"),
                         F.col("c_mktsegment").alias("platform"),
                         F.col("day").cast("timestamp").alias("signup_ts")))
    return RawTables(raw_users, raw_events, list(UNIT_STEPS), UNIT_START_STEP, UNIT_ACTIVATION_STEP)


def nulls_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """Adapter U with missing and unlisted values: of ten users one has no arm and one the arm
    ``holdout``; one nation and one market segment are NULL."""
    u = unit_tables(spark, sf_dir)
    digit = F.expr(f"(user_id div {UNIT_DAY_FACTOR}) % 10")
    users = u.users.withColumns({
        "variant": F.when(digit == 0, F.lit(None)).when(digit == 1, F.lit("holdout")).otherwise(F.col("variant")),
        "country": F.nullif("country", F.lit("FRANCE")),
        "platform": F.nullif("platform", F.lit("BUILDING"))})
    return RawTables(users, u.events, u.steps, u.start_step, u.activation_step)


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score with about as many distinct values as rows: label purchase, score value / (1 + value), arm with NULLs."""
    digit = F.col("user_id") % 10
    return read_table(spark, sf_dir, "events").where("value IS NOT NULL AND event_type IS NOT NULL").select(
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.col("value") / (F.lit(1.0) + F.col("value"))).alias("score"),
        F.when(digit == 0, F.lit(None)).when(digit == 1, F.lit("holdout")).when(digit % 2 == 0, F.lit("control"))
        .otherwise(F.lit("treatment")).alias("variant"))


def _customer_ids(spark: SparkSession, sf_dir: str, users_per_customer: int) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey")
    first = F.col("c_custkey").cast("long") * F.lit(users_per_customer) + F.lit(1)
    return cust.select(F.explode(F.sequence(first, first + F.lit(users_per_customer - 1))).alias("user_id"))


def customer_user_ids(spark: SparkSession, sf_dir: str,
                      users_per_customer: int = USERS_PER_CUSTOMER) -> DataFrame:
    # The expansion multiplies the work after the scan: spread the ids by user_id, which
    # also leaves every user-keyed aggregate and join downstream without an exchange.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _customer_ids(spark, sf_dir, users_per_customer).repartition(n, "user_id")


def generated_tables(spark: SparkSession, sf_dir: str, seed: int = DEFAULT_SEED,
                     users_per_customer: int = USERS_PER_CUSTOMER) -> RawTables:
    """The generator's plans (computed on every use)."""
    users, events = generate(spark, seed=seed, ids=customer_user_ids(spark, sf_dir, users_per_customer))
    return RawTables(users, events, list(STEPS), START_STEP, ACTIVATION_STEP)


_MATERIALISED: dict = {}
_LOCK = threading.Lock()


def generated_source(spark: SparkSession, sf_dir: str, seed: int = DEFAULT_SEED,
                     users_per_customer: int = USERS_PER_CUSTOMER) -> RawTables:
    """The generated raw tables written once per session as Parquet into the session's
    checkpoint folder (shared storage on a cluster) and read back: downstream marts
    read a table, as a warehouse would, instead of re-running the generator, and the
    lineage is cut (a lost executor re-reads files instead of recomputing the log)."""
    key = (spark.sparkContext.applicationId, str(Path(sf_dir).resolve()), seed, users_per_customer)
    with _LOCK:  # one writer per session and input, even when queries run concurrently
        return _MATERIALISED.get(key) or _materialise(spark, sf_dir, seed, users_per_customer, key)


def _materialise(spark: SparkSession, sf_dir: str, seed: int, users_per_customer: int, key) -> RawTables:
    digest = hashlib.sha1(repr(key).encode()).hexdigest()[:16]
    root = f"{checkpoint_dir(spark).rstrip('/')}/generated-{digest}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def store(df: DataFrame, name: str) -> DataFrame:
        # Bucketed by user_id (one file per bucket): user-keyed aggregates and joins over
        # the two tables read co-partitioned data and need no exchange. At most five events
        # per user, so no bucket can hold a hot key.
        table = f"ff_generated_{digest}_{name}"
        (df.write.mode("overwrite").format("parquet")
         .bucketBy(n, "user_id").option("path", f"{root}/{name}").saveAsTable(table))
        return spark.table(table)

    # Every user is drawn once: the walk is stored, users and events are read from it.
    walk = store(numbered_walk(_customer_ids(spark, sf_dir, users_per_customer), seed).repartition(n, "user_id"), "walk")
    events = store(raw_events_from_walk(number_events(walk)), "raw_events")
    hit = RawTables(raw_users_from_walk(walk), events, list(STEPS), START_STEP, ACTIVATION_STEP)
    _MATERIALISED[key] = hit
    return hit
