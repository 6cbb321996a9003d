"""User-grain funnel marts and funnel reports.

Every per-step quantity is computed in ONE pass over the events: a conditional
aggregate per user (partial aggregation collapses a hot user's events before the
shuffle), then one left join to the users on ``user_id``. Per-step reports aggregate
wide (one row per arm) and unpivot the tiny result, so the fact table is scanned once
however many steps there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div, sql_ident, sql_str, whole_minutes
from ..schemas import ACTIVATION_STEP, START_STEP, STEPS, flag_col, ts_col


def funnel_flags(events: DataFrame, steps: Sequence[str] = STEPS,
                 ts_steps: Sequence[str] | None = None) -> DataFrame:
    """One row per user: 0/1 ``reached_<step>`` flags and first ``ts_<step>`` times.

    Flags are unordered existence flags; repeated events keep the first time.
    """
    ts_steps = list(steps) if ts_steps is None else list(ts_steps)
    aggs = [F.expr(f"max(CASE WHEN event_name = {sql_str(s)} THEN 1 ELSE 0 END)").alias(flag_col(s))
            for s in steps]
    aggs += [F.expr(f"min(CASE WHEN event_name = {sql_str(s)} THEN event_ts END)").alias(ts_col(s))
             for s in ts_steps]
    return events.groupBy("user_id").agg(*aggs)


def fct_funnel(users: DataFrame, events: DataFrame, steps: Sequence[str] = STEPS,
               start_step: str = START_STEP, activation_step: str = ACTIVATION_STEP) -> DataFrame:
    """users LEFT JOIN per-user flags; NULL flags for users without events."""
    flags = funnel_flags(events, steps, ts_steps=[start_step, activation_step])
    joined = users.select("user_id", "variant", "country", "platform", "signup_date") \
        .join(flags, "user_id", "left")
    return joined.select(
        "user_id", "variant", "country", "platform", "signup_date",
        *[flag_col(s) for s in steps],
        whole_minutes(ts_col(start_step), ts_col(activation_step)).alias("minutes_to_activate"),
    )


def _unpivot_steps(wide: DataFrame, keys: Sequence[str], steps: Sequence[str], value: str) -> DataFrame:
    rows = ", ".join(f"named_struct('funnel_step', {sql_str(s)}, 'step_order', {i + 1}, "
                     f"{sql_str(value)}, {sql_ident(f'_v{i}')})" for i, s in enumerate(steps))
    return wide.select(*keys, F.expr(f"inline(array({rows}))"))


def step_counts(funnel: DataFrame, steps: Sequence[str] = STEPS, group_cols: Sequence[str] = (),
                arm_col: str | None = "variant", zero_fill: bool = False) -> DataFrame:
    """(group..., arm, funnel_step, step_order, converted, total) from a user-grain table.

    ``total`` counts every user (NULL flags included); ``converted`` is NULL for a group
    in which nobody has a flag unless ``zero_fill``.
    """
    keys = [*group_cols, *([arm_col] if arm_col else [])]
    sums = []
    for i, s in enumerate(steps):
        v = f"sum({sql_ident(flag_col(s))})"
        sums.append(F.expr(f"CAST({f'coalesce({v}, 0)' if zero_fill else v} AS BIGINT)").alias(f"_v{i}"))
    wide = funnel.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *sums)
    return _unpivot_steps(wide, [*keys, "total"], steps, "converted")


def fct_ab_experiment(funnel: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Arm x step conversion table: variant, funnel_step, step_order, converted, total, rate."""
    c = step_counts(funnel, steps)
    return c.select("variant", "funnel_step", "step_order", "converted", "total",
                    safe_div(F.col("converted"), F.col("total")).alias("conversion_rate"))


def reached_users(events: DataFrame, step: str) -> DataFrame:
    """Distinct ids of users with at least one event of ``step`` (semi-join side)."""
    return events.filter(F.col("event_name") == F.lit(step)).groupBy("user_id").agg(F.lit(1).alias("_hit"))


def with_reached(users: DataFrame, events: DataFrame, step: str, name: str = "reached") -> DataFrame:
    """Boolean existence column: did the user have an event of ``step``? (False if none)."""
    return users.join(reached_users(events, step), "user_id", "left") \
        .withColumn(name, F.col("_hit").isNotNull()).drop("_hit")


def arm_counts(users: DataFrame, events: DataFrame, step: str, arm_col: str = "variant") -> DataFrame:
    """converted / total per arm for one step; users without the event count as not converted."""
    flagged = with_reached(users.select("user_id", arm_col), events, step)
    return flagged.groupBy(arm_col).agg(
        F.sum(F.col("reached").cast("long")).alias("converted"),
        F.count(F.lit(1)).alias("total"))


def user_flags(users: DataFrame, events: DataFrame, steps: Sequence[str] = STEPS,
               keep: Sequence[str] = ("variant",)) -> DataFrame:
    """Users with 0/1 flags for every step, users without events as 0 (one event pass)."""
    flags = funnel_flags(events, steps, ts_steps=[])
    out = users.select("user_id", *keep).join(flags, "user_id", "left")
    return out.select("user_id", *keep, *[F.coalesce(flag_col(s), F.lit(0)).alias(flag_col(s)) for s in steps])


def funnel_by_variant(users: DataFrame, events: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """step, variant, converted, total, rate, cumulative_rate (zero-filled)."""
    c = step_counts(user_flags(users, events, steps), steps, zero_fill=True)
    w = Window.partitionBy("variant").orderBy("step_order")
    return c.select(
        F.col("funnel_step").alias("step"), "step_order", "variant", "converted", "total",
        safe_div(F.col("converted"), F.col("total")).alias("rate"),
        safe_div(F.col("converted"), F.first("total").over(w)).alias("cumulative_rate"))


def funnel_overall(users: DataFrame, events: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """step, users, cumulative_rate, step_conversion over all users."""
    c = step_counts(user_flags(users, events, steps, keep=()), steps, arm_col=None, zero_fill=True)
    # At most len(steps) rows: an unpartitioned window is bounded.
    w = Window.orderBy("step_order")
    return c.select(
        F.col("funnel_step").alias("step"), "step_order", F.col("converted").alias("users"),
        safe_div(F.col("converted"), F.col("total")).alias("cumulative_rate"),
        safe_div(F.col("converted"), F.lag("converted").over(w)).alias("step_conversion"))


def funnel_dropoff(ab: DataFrame) -> DataFrame:
    """Step-over-step and cumulative conversion from the arm x step table."""
    steps = ab.groupBy("funnel_step", "step_order").agg(F.sum("converted").alias("users_at_step"))
    w = Window.orderBy("step_order")  # one row per step
    prev = F.lag("users_at_step").over(w)
    return steps.select(
        "funnel_step", "step_order", "users_at_step", prev.alias("users_prev_step"),
        safe_div(F.col("users_at_step"), prev).alias("step_conversion"),
        safe_div(F.col("users_at_step"), F.first("users_at_step").over(w)).alias("cumulative_conversion"))


def ab_lift(ab: DataFrame, control: str = "control", treatment: str = "treatment") -> DataFrame:
    """Control and treatment conversion side by side per step, with the absolute lift."""
    rate = lambda arm: F.max(F.when(F.col("variant") == F.lit(arm), F.col("conversion_rate")))
    return ab.groupBy("funnel_step", "step_order").agg(
        rate(control).alias("control_rate"), rate(treatment).alias("treatment_rate"),
        (rate(treatment) - rate(control)).alias("absolute_lift"))
