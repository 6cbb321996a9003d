"""Two-proportion experiment statistics as row-parallel Column arithmetic.

Arms are paired by conditional aggregation (one row per group, no self-join); the
z-test, confidence interval, achieved power, lift and ship decision are Column
expressions, so any number of steps, segments or weeks is evaluated in one plan.
Zero variance (every user or nobody converts) gives NULL statistics, not an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import CI_Z, norm_cdf, safe_div, sql_ident, sql_str, z_quantile
from ..schemas import CONTROL, STEPS, TREATMENT
from .funnel import step_counts


def pair_arms(counts: DataFrame, group_cols: Sequence[str], arm_col: str = "variant",
              conv_col: str = "converted", total_col: str = "total",
              control: str = CONTROL, treatment: str = TREATMENT) -> DataFrame:
    """One row per group with control_* and treatment_* counts beside each other."""
    def pick(a, c):
        return F.expr(f"CAST(max(CASE WHEN {sql_ident(arm_col)} = {sql_str(a)} THEN {sql_ident(c)} END) AS BIGINT)")

    return counts.groupBy(*group_cols).agg(
        pick(control, conv_col).alias("control_converted"),
        pick(control, total_col).alias("control_total"),
        pick(treatment, conv_col).alias("treatment_converted"),
        pick(treatment, total_col).alias("treatment_total"))


def two_proportion_test(paired: DataFrame, alpha: float = 0.05, ci_z: float = CI_Z) -> DataFrame:
    """Pooled z-test, two-sided p, unpooled CI of the difference, achieved power, ship flag.

    ``alpha`` moves the power and the ship rule; the interval is ``ci_z`` standard errors wide (95 %)."""
    z_alpha = z_quantile(1 - alpha / 2)
    cc, ct, tc, tt = "control_converted", "control_total", "treatment_converted", "treatment_total"
    p_c, p_t = f"try_divide({cc}, {ct})", f"try_divide({tc}, {tt})"
    p_pool = f"try_divide({cc} + {tc}, {ct} + {tt})"
    se_pool = f"sqrt({p_pool} * (1 - {p_pool}) * (try_divide(1, {ct}) + try_divide(1, {tt})))"
    se_diff = f"sqrt(try_divide({p_c} * (1 - {p_c}), {ct}) + try_divide({p_t} * (1 - {p_t}), {tt}))"
    out = paired.select(
        "*",
        F.expr(p_c).alias("control_rate"), F.expr(p_t).alias("treatment_rate"),
        F.expr(f"{p_t} - {p_c}").alias("absolute_lift"),
        F.expr(f"try_divide({p_t} - {p_c}, {p_c})").alias("relative_lift"),
        F.expr(f"try_divide({p_t} - {p_c}, {se_pool})").alias("z"),
        F.expr(se_diff).alias("_se_diff"))
    # The approximation names its argument many times: each argument is a column of its own.
    out = out.select("*", F.expr("-abs(z)").alias("_z"),
                     F.expr(f"try_divide(abs(absolute_lift), _se_diff) - {z_alpha!r}D").alias("_zp"))
    out = out.select(
        "*",
        (F.lit(2.0) * norm_cdf("_z")).alias("p_value"),
        F.expr(f"absolute_lift - {ci_z!r}D * _se_diff").alias("ci_low"),
        F.expr(f"absolute_lift + {ci_z!r}D * _se_diff").alias("ci_high"),
        norm_cdf("_zp").alias("power"))
    return out.withColumn(
        "ship", F.expr(f"coalesce(p_value < {float(alpha)!r}D AND ci_low > 0, false)")
    ).drop("_se_diff", "_z", "_zp")


def ab_test(funnel: DataFrame, steps: Sequence[str] = STEPS, group_cols: Sequence[str] = (),
            alpha: float = 0.05) -> DataFrame:
    """Experiment evaluation of every step (and segment) from the user-grain funnel mart.

    Users without events count as not converted.
    """
    counts = step_counts(funnel, steps, group_cols, zero_fill=True)
    paired = pair_arms(counts, [*group_cols, "funnel_step", "step_order"])
    return two_proportion_test(paired, alpha)


def ab_test_from_mart(ab: DataFrame, step: str | None = None, alpha: float = 0.05) -> DataFrame:
    """Experiment evaluation read from the arm x step mart (optionally one step)."""
    src = ab if step is None else ab.filter(F.col("funnel_step") == F.lit(step))
    src = src.withColumn("converted", F.coalesce(F.col("converted"), F.lit(0)))
    return two_proportion_test(pair_arms(src, ["funnel_step", "step_order"]), alpha)


def ab_test_parameterised(spark, table: str, step: str, alpha: float = 0.05) -> DataFrame:
    """Parameterised mart scan (named SQL parameter), then the test."""
    counts = spark.sql(
        f"SELECT variant, funnel_step, step_order, coalesce(converted, 0) AS converted, total "
        f"FROM {table} WHERE funnel_step = :step", args={"step": step})
    return two_proportion_test(pair_arms(counts, ["funnel_step", "step_order"]), alpha)


def lift_table(by_variant: DataFrame) -> DataFrame:
    """step, lift_pp, ci_half_pp (1.96 x unpooled standard error, in points)."""
    paired = pair_arms(by_variant, ["step", "step_order"])
    cc, ct = F.col("control_converted"), F.col("control_total")
    tc, tt = F.col("treatment_converted"), F.col("treatment_total")
    p_c, p_t = safe_div(cc, ct), safe_div(tc, tt)
    se = F.sqrt(safe_div(p_c * (F.lit(1) - p_c), ct) + safe_div(p_t * (F.lit(1) - p_t), tt))
    return paired.select("step", "step_order",
                         ((p_t - p_c) * F.lit(100)).alias("lift_pp"),
                         (F.lit(CI_Z) * se * F.lit(100)).alias("ci_half_pp"))


# ---------------------------------------------------------------------------
# Power analysis, re-aimed at measured baselines (one row per segment x step).
# ---------------------------------------------------------------------------

def _k(alpha: float, power: float) -> float:
    return (z_quantile(1 - alpha / 2) + z_quantile(power)) ** 2


def required_sample_size(df: DataFrame, p1_col: str = "baseline_rate", mde: float = 0.02,
                         mde_type: str = "absolute", alpha: float = 0.05, power: float = 0.80,
                         ratio: float = 1.0) -> DataFrame:
    """Per-arm n for a two-proportion test (Wald). NULL when baseline + effect leaves (0, 1)."""
    p1 = F.col(p1_col)
    eff = F.lit(mde) if mde_type == "absolute" else F.lit(mde) * p1
    p2 = p1 + eff
    valid = (p2 > 0) & (p2 < 1) & (eff != 0)
    pooled = p1 * (F.lit(1) - p1) + (p2 * (F.lit(1) - p2)) / F.lit(ratio)
    d = p1 - p2
    n = F.when(valid, (F.lit(_k(alpha, power)) * pooled) / (d * d))
    out = df.select("*", eff.alias("mde_abs"), p2.alias("target_rate"), n.alias("n_control_exact"))
    nc = F.ceil(F.col("n_control_exact"))
    nt = F.ceil(F.col("n_control_exact") * F.lit(ratio))
    return out.select("*", nc.cast("long").alias("n_control"), nt.cast("long").alias("n_treatment"),
                      (nc + nt).cast("long").alias("n_total"))


def minimum_detectable_effect(df: DataFrame, p1_col: str = "baseline_rate", n_col: str = "n_control",
                              alpha: float = 0.05, power: float = 0.80, ratio: float = 1.0,
                              out_col: str = "mde") -> DataFrame:
    """Smallest absolute lift detectable with the given control size (closed form of the
    upward search on [1e-5, 1 - p1 - 1e-5])."""
    k = _k(alpha, power)
    kr = k / ratio
    p1, n = F.col(p1_col), F.col(n_col).cast("double")
    a = n + F.lit(kr)
    b = F.lit(kr) * (F.lit(1) - F.lit(2) * p1)
    c = F.lit(k) * p1 * (F.lit(1) - p1) * F.lit(1 + 1 / ratio)
    d = safe_div(b + F.sqrt(b * b + F.lit(4) * a * c), F.lit(2) * a)
    hi = F.lit(1) - p1 - F.lit(1e-5)
    # No room for an upward effect (baseline at 1): NULL.
    return df.withColumn(out_col, F.when(hi >= F.lit(1e-5), F.least(F.greatest(d, F.lit(1e-5)), hi)))


def runtime_days(total, daily) -> F.Column:
    """Days to collect ``total`` users at ``daily`` signups per day."""
    return F.ceil(safe_div(F.col(total) if isinstance(total, str) else total,
                           F.col(daily) if isinstance(daily, str) else daily)).cast("long")


def baseline_rates(funnel: DataFrame, steps: Sequence[str] = STEPS, segment_cols: Sequence[str] = (),
                   control: str = CONTROL) -> DataFrame:
    """Per segment x step: control-arm size and rate, segment size and daily signups."""
    keys = list(segment_cols)
    if not keys:
        # Whole population as one segment: a constant key, the segment table has one row.
        funnel, keys = funnel.withColumn("_all", F.lit(1)), ["_all"]
    counts = step_counts(funnel, steps, keys, zero_fill=True)
    paired = pair_arms(counts, [*keys, "funnel_step", "step_order"])
    seg = funnel.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("segment_users"),
        F.countDistinct("signup_date").alias("signup_days"))
    seg = seg.withColumn("daily_signups", safe_div(F.col("segment_users"), F.col("signup_days")))
    # One row per segment; AQE broadcasts it when small at run time.
    # The keys are compared as one struct, so a NULL segment meets itself.
    key = F.struct(F.lit(0).alias("_"), *keys)
    paired, seg = paired.withColumn("_seg", key), seg.withColumn("_seg", key).drop(*keys)
    joined = paired.join(F.broadcast(seg) if not segment_cols else seg, "_seg", "inner")
    return joined.select(*segment_cols, "funnel_step", "step_order",
                         F.col("control_total").alias("control_users"),
                         safe_div(F.col("control_converted"), F.col("control_total")).alias("baseline_rate"),
                         "segment_users", "daily_signups")


def sample_size_by_segment(funnel: DataFrame, steps: Sequence[str] = STEPS,
                           segment_cols: Sequence[str] = (), mde: float = 0.02,
                           mde_type: str = "absolute", alpha: float = 0.05, power: float = 0.80,
                           ratio: float = 1.0) -> DataFrame:
    base = baseline_rates(funnel, steps, segment_cols)
    sized = required_sample_size(base, "baseline_rate", mde, mde_type, alpha, power, ratio)
    return sized.withColumn("runtime_days", runtime_days("n_total", "daily_signups")) \
        .drop("n_control_exact")


def mde_by_segment(funnel: DataFrame, steps: Sequence[str] = STEPS, segment_cols: Sequence[str] = (),
                   alpha: float = 0.05, power: float = 0.80, ratio: float = 1.0) -> DataFrame:
    base = baseline_rates(funnel, steps, segment_cols)
    out = minimum_detectable_effect(base, "baseline_rate", "control_users", alpha, power, ratio)
    return out.withColumn("mde_relative", safe_div(F.col("mde"), F.col("baseline_rate")))
