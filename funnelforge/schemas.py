"""Table schemas and the fixed values of the onboarding funnel."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the modelled pipeline for identical results).
# Funnel steps in order, experiment arms, and accepted values of the marts.
# ---------------------------------------------------------------------------
STEPS = ["signup_started", "signup_completed", "kyc_submitted", "first_deposit", "first_transaction"]
ARMS = ("control", "treatment")
CONTROL, TREATMENT = ARMS
START_STEP = "signup_started"
ACTIVATION_STEP = "first_transaction"
COMPLETED_STEP = "signup_completed"
LEAKY_STEPS = ("kyc_submitted", "first_deposit")

# Feature table of the activation model.
CATEGORICAL = ["variant", "country", "platform", "signup_dayofweek"]
NUMERIC = ["signup_hour", "minutes_signup_to_complete"]
TARGET = "reached_first_transaction"

RAW_USERS = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("variant", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("platform", T.StringType(), True),
    T.StructField("signup_ts", T.TimestampType(), True),
])

RAW_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_name", T.StringType(), True),
    T.StructField("event_ts", T.TimestampType(), True),
])


def flag_col(step: str) -> str:
    return f"reached_{step}"


def ts_col(step: str) -> str:
    return f"ts_{step}"
