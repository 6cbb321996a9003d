"""Staging and dimension models: typed, case-folded projections of the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_users(raw_users: DataFrame) -> DataFrame:
    ts = F.col("signup_ts").cast("timestamp")
    return raw_users.select(
        F.col("user_id").cast("long").alias("user_id"),
        F.lower("variant").alias("variant"),
        F.upper("country").alias("country"),
        F.lower("platform").alias("platform"),
        ts.alias("signup_ts"),
        F.to_date(ts).alias("signup_date"),
    )


def stg_events(raw_events: DataFrame) -> DataFrame:
    return raw_events.select(
        F.col("event_id").cast("long").alias("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.lower("event_name").alias("event_name"),
        F.col("event_ts").cast("timestamp").alias("event_ts"),
    )


def dim_users(users: DataFrame) -> DataFrame:
    return users.select("user_id", "variant", "country", "platform", "signup_ts", "signup_date")


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """First rows for a look at the data (a limit is the feature here); in the given order, each task keeps its first n."""
    return (df.orderBy(*order) if order else df).limit(n)
