"""Time-to-event reports: time to activate, its summary and its histogram.

Time to activate uses the FIRST event of each step per user (one conditional
aggregate, no fan-out join of repeated events). Medians are exact without moving a
group into one task: values are reduced to distinct (group, value) counts, running
counts come from the block-wise prefix sums, and the middle ranks are picked with an
aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fractional_minutes
from ..plans.prefix import running_totals
from ..schemas import ACTIVATION_STEP, START_STEP

#: Tasks over which a group's values are spread where they meet the group's bounds.
SALTS = 64


def time_to_activate(users: DataFrame, events: DataFrame, start_step: str = START_STEP,
                     activation_step: str = ACTIVATION_STEP, keep: Sequence[str] = ("variant",)) -> DataFrame:
    """user_id, variant, minutes_to_activate (fractional) for users with both events."""
    # Only timestamps are used, so pruning to the two steps before aggregating is safe
    # and reaches the Parquet scan.
    ev = events.filter(F.col("event_name").isin(start_step, activation_step))
    firsts = ev.groupBy("user_id").agg(
        F.min(F.when(F.col("event_name") == F.lit(start_step), F.col("event_ts"))).alias("t0"),
        F.min(F.when(F.col("event_name") == F.lit(activation_step), F.col("event_ts"))).alias("t1"))
    firsts = firsts.filter(F.col("t0").isNotNull() & F.col("t1").isNotNull())
    return firsts.join(users.select("user_id", *keep), "user_id", "inner").select(
        "user_id", *keep, fractional_minutes("t0", "t1").alias("minutes_to_activate"))


def step_deadlines(events: DataFrame, steps: Sequence[str], minutes: int) -> DataFrame:
    """user_id, funnel_step, step_order, first_ts, due_ts: one frame per step under one another, each user's first event of the step
    and the time ``minutes`` later by which the next step is due.

    One conditional aggregate per user instead of a scan per step, then one row per step reached."""
    name = F.col("event_name")
    firsts = events.where(name.isin(list(steps))).groupBy("user_id").agg(
        *[F.min(F.when(name == F.lit(s), F.col("event_ts"))).alias(f"_t{i}") for i, s in enumerate(steps)])
    rows = F.array(*[F.struct(F.lit(s).alias("funnel_step"), F.lit(i + 1).alias("step_order"), F.col(f"_t{i}").alias("first_ts")) for i, s in enumerate(steps)])
    return (firsts.select("user_id", F.inline(rows)).where(F.col("first_ts").isNotNull())
            .withColumn("due_ts", F.col("first_ts") + F.make_dt_interval(mins=F.lit(minutes))))


def _value_counts(df: DataFrame, value: str, group_cols: Sequence[str]) -> DataFrame:
    """Distinct (group, value) with counts: partial aggregation makes a popular value one row per task."""
    return df.filter(F.col(value).isNotNull()).groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_n"))


def _median():
    """Mean of the values at the two middle ranks, from running counts and group totals."""
    r1, r2 = F.expr("(tot__n + 1) div 2"), F.expr("tot__n div 2 + 1")
    return r1, r2


def exact_median(df: DataFrame, value: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact median per group (mean of the two middle values for even counts)."""
    g = list(group_cols)
    cum = running_totals(_value_counts(df, value, g), value, ["_n"], g, totals=True)
    r1, r2 = _median()
    v1, v2 = (F.min(F.when(F.col("cum__n") >= r, F.col(value))) for r in (r1, r2))
    return cum.groupBy(*g).agg(((v1 + v2) / F.lit(2.0)).alias("median"))


def describe(df: DataFrame, value: str, group_cols: Sequence[str] = ("variant",),
             approx_median: bool = False, accuracy: int = 10_000) -> DataFrame:
    """count, mean, median, sample std per group (a NULL group included). The median is exact by
    default, and everything comes from the one table of value counts; with ``approx_median`` it comes
    from the mergeable quantile sketch in a plain aggregate. Groups without a value have count 0."""
    g = list(group_cols)
    if approx_median:
        return df.groupBy(*g).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                                  F.percentile_approx(value, 0.5, accuracy).cast("double").alias("median"),
                                  F.stddev_samp(value).alias("std"))
    counts = df.groupBy(*g, value).agg(F.count(value).alias("_n")).withColumn("_s", F.col(value) * F.col("_n"))
    cum = running_totals(counts, value, ["_n", "_s"], g, totals=True)
    r1, r2 = _median()
    v1, v2 = (F.min(F.when(F.col("cum__n") >= r, F.col(value))) for r in (r1, r2))
    off = F.col(value) - F.col("tot__s") / F.col("tot__n")
    n = F.sum("_n")
    return cum.groupBy(*g).agg(
        n.alias("count"), (F.sum("_s") / F.nullif(n, F.lit(0))).alias("mean"), ((v1 + v2) / F.lit(2.0)).alias("median"),
        F.when(n > 1, F.sqrt(F.sum(off * off * F.col("_n")) / (n - 1))).alias("std"))


def histogram(df: DataFrame, value: str, group_cols: Sequence[str] = ("variant",), bins: int = 40,
              include_empty: bool = True) -> DataFrame:
    """Equal-width histogram per group over [min, max]; the maximum falls in the last bin.

    Returns group, bin, bin_lo, bin_hi, count; with ``include_empty`` every one of the
    ``bins`` bins of a group is listed (count 0 when empty). A NULL group is a group like any
    other. Values meet their group's bounds by (group, salt), so a group that holds most
    values is spread over SALTS tasks.
    """
    g = list(group_cols)
    key, salt = F.struct(F.lit(0).alias("_"), *g), F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int")
    counts = _value_counts(df, value, g)
    bounds = counts.groupBy(*g).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).withColumn("_g", key)
    salted = bounds.select("_g", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    j = counts.withColumn("_g", key).withColumn("_salt", salt).join(salted, ["_g", "_salt"])
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    h = j.groupBy("_g", b.alias("bin")).agg(F.sum("_n").alias("count"))
    if include_empty:
        # groups x bins rows: every bin of every group, then the counts joined on (group, bin).
        grid = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        h = grid.join(h, ["_g", "bin"], "left").withColumn("count", F.coalesce(F.col("count"), F.lit(0).cast("long")))
    else:
        h = bounds.join(h, "_g")
    return h.select(*g, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + F.lit(1)) * width).alias("bin_hi"), "count")
