"""Reader-side ordering and the decision report.

Stored marts and registered queries stay unsorted (an ORDER BY inside a stored table
promises nothing to its readers); these readers apply the orderings the analyses
present, with explicit tie-breaks, on the small result tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.experiment import ab_test
from ..schemas import COMPLETED_STEP, STEPS
from .prefix import dense_ids

# Column names; a leading "-" means descending, "|" an absolute value.
ORDERINGS = {
    "fct_ab_experiment": ["step_order", "variant"],
    "funnel_dropoff": ["step_order"],
    "ab_lift": ["step_order"],
    "weekly_cohorts": ["signup_week", "variant"],
    "segment_activation": ["-activation_pct", "country", "platform"],
    "coefficients": ["-|coefficient", "feature"],
    "lift_table": ["step_order"],
    "funnel_by_variant": ["step_order", "variant"],
    "ab_test": ["step_order"],
}


def _key(spec: str):
    desc = spec.startswith("-")
    name = spec.lstrip("-")
    col = F.abs(F.col(name[1:])) if name.startswith("|") else F.col(name)
    return col.desc() if desc else col.asc()


def ordered(df: DataFrame, report: str) -> DataFrame:
    return df.orderBy(*[_key(s) for s in ORDERINGS[report]])


def positioned(df: DataFrame, report: str | list[str]) -> DataFrame:
    """df plus ``position`` (from 1) in the report's order: a total order as a column, from range
    partitions and offsets, so that it survives storage and no task sorts all rows."""
    return dense_ids(df, [_key(s) for s in (ORDERINGS[report] if isinstance(report, str) else report)])


def group_means_desc(df: DataFrame, dim: str, rate: str = "rate") -> DataFrame:
    """Group means, highest first (ties by the group value)."""
    return df.orderBy(F.desc(rate), F.col(dim))


def decision(funnel: DataFrame, step: str = COMPLETED_STEP, steps=STEPS, alpha: float = 0.05) -> DataFrame:
    """One row for the step under test, with the ship / do-not-ship recommendation."""
    t = ab_test(funnel, steps, alpha=alpha).filter(F.col("funnel_step") == F.lit(step))
    return t.withColumn("recommendation",
                        F.when(F.col("ship"), F.lit("SHIP")).otherwise(F.lit("DO NOT SHIP")))
