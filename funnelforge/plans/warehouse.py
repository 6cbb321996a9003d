"""Warehouse build: raw tables -> staging views -> mart tables -> declared tests.

Raw tables are stored, staging models are persistent views over them in the same database (any session that shares the
catalogue reads them; their lineage is the view's text), marts are
written tables (which also cuts the lineage for every downstream reader), and the
model tests run on what was written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import funnel as FN
from ..operators.quality import warehouse_checks
from ..operators.staging import dim_users
from ..schemas import ACTIVATION_STEP, START_STEP, STEPS
from ..sources import io


# The staging models as SQL, for views that outlive the session.
STAGING = {
    "stg_users": "SELECT CAST(user_id AS BIGINT) AS user_id, lower(variant) AS variant, upper(country) AS country, lower(platform) AS platform, "
                 "CAST(signup_ts AS TIMESTAMP) AS signup_ts, to_date(CAST(signup_ts AS TIMESTAMP)) AS signup_date FROM {db}.raw_users",
    "stg_events": "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id, lower(event_name) AS event_name, "
                  "CAST(event_ts AS TIMESTAMP) AS event_ts FROM {db}.raw_events",
}


def staging_views(spark: SparkSession, database: str, raw_users: DataFrame, raw_events: DataFrame) -> None:
    """Store the raw tables and (re)create the staging views over them."""
    for name, df in (("raw_users", raw_users), ("raw_events", raw_events)):
        io.publish(spark, df, f"{database}.{name}")
    for name, query in STAGING.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query.format(db=database)}")


@dataclass
class Warehouse:
    database: str
    stg_users: DataFrame
    stg_events: DataFrame
    dim_users: DataFrame
    fct_funnel: DataFrame
    fct_ab_experiment: DataFrame
    tests: DataFrame


def build(spark: SparkSession, raw_users: DataFrame, raw_events: DataFrame, database: str = "analytics",
          location: str | None = None, steps=STEPS, start_step: str = START_STEP,
          activation_step: str = ACTIVATION_STEP, buckets: int | None = None,
          funnel_partition_by: list[str] | None = None) -> Warehouse:
    """``buckets``: bucket dim_users and fct_funnel by user_id (joins without exchange).
    ``funnel_partition_by``: e.g. ``["signup_date"]`` so cohort reads prune partitions."""
    io.create_database(spark, database, location)
    staging_views(spark, database, raw_users, raw_events)
    su, se = spark.table(f"{database}.stg_users"), spark.table(f"{database}.stg_events")
    bucket = (buckets, "user_id") if buckets else None
    io.save_table(dim_users(su), f"{database}.dim_users", bucket_by=bucket)
    dim = spark.table(f"{database}.dim_users")
    io.save_table(FN.fct_funnel(dim, se, steps, start_step, activation_step), f"{database}.fct_funnel",
                  bucket_by=bucket, partition_by=funnel_partition_by)
    funnel = spark.table(f"{database}.fct_funnel")
    io.save_table(FN.fct_ab_experiment(funnel, steps), f"{database}.fct_ab_experiment")
    ab = spark.table(f"{database}.fct_ab_experiment")
    tests = warehouse_checks(raw_users, raw_events, su, se, dim, funnel, ab, steps)
    return Warehouse(database, su, se, dim, funnel, ab, tests)
