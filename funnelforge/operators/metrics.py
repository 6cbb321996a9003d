"""Classifier metrics as aggregates: exact ROC-AUC (mid-ranks for ties), step-wise
average precision, Brier score, classification report and the PR baseline.

Scores are first reduced to distinct values with positive / negative counts (partial
aggregation, so a popular score is one row); the running counts the ranking metrics
need come from block-wise prefix sums, never from a single-task global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div, sql_ident, sql_str
from ..plans.prefix import running_totals


def _score_counts(scored: DataFrame, label: str, score: str, group_cols: Sequence[str]) -> DataFrame:
    y = F.col(label).cast("long")
    return scored.groupBy(*group_cols, score).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"), F.count(F.lit(1)).alias("cnt"))


def _ranked(scored: DataFrame, label: str, score: str, group_cols: Sequence[str]) -> DataFrame:
    """Distinct scores with ascending running counts and group totals (one pass)."""
    return running_totals(_score_counts(scored, label, score, group_cols), score, ["pos", "neg", "cnt"],
                          group_cols, totals=True)


def _auc_expr():
    below = F.col("cum_neg") - F.col("neg")
    # 2 x numerator is an integer: exact in decimal, one division at the end.
    # Each factor is a decimal before the product: counts beyond 2^31 on both sides overflow a long.
    num2 = F.sum((F.col("pos").cast("decimal(19,0)") * (F.lit(2) * below + F.col("neg")).cast("decimal(19,0)")).cast("decimal(38,0)"))
    return safe_div(num2.cast("double"), F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double"))


def _ap_expr():
    # Counts at or above a threshold = group total minus the ascending counts below it.
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    at_or_above = F.col("tot_cnt") - F.col("cum_cnt") + F.col("cnt")
    return safe_div(F.sum(F.col("pos") * safe_div(tp, at_or_above)), F.sum("pos"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score",
            group_cols: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve = P(score+ > score-) + P(tie)/2, exact."""
    g = list(group_cols)
    return _ranked(scored, label, score, g).groupBy(*g).agg(_auc_expr().alias("auc"))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score",
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """Sum over distinct thresholds (descending) of recall increment x precision."""
    g = list(group_cols)
    return _ranked(scored, label, score, g).groupBy(*g).agg(_ap_expr().alias("average_precision"))


def brier(scored: DataFrame, label: str = "label", score: str = "score",
          group_cols: Sequence[str] = ()) -> DataFrame:
    d = F.col(score) - F.col(label).cast("double")
    return scored.groupBy(*group_cols).agg(F.avg(d * d).alias("brier"))


def summary(scored: DataFrame, label: str = "label", score: str = "score",
            group_cols: Sequence[str] = ()) -> DataFrame:
    """n, positives, pr_baseline, auc, average_precision, brier from ONE pass over the
    scored rows (everything is a function of the distinct-score table)."""
    g = list(group_cols)
    y = F.col(label).cast("double")
    d = scored.groupBy(*g, score).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(F.lit(1) - F.col(label).cast("long")).alias("neg"),
        F.count(F.lit(1)).alias("cnt"),
        F.sum((F.col(score) - y) * (F.col(score) - y)).alias("_sq"))
    r = running_totals(d, score, ["pos", "neg", "cnt"], g, totals=True)
    return r.groupBy(*g).agg(
        F.sum("cnt").alias("n"), F.sum("pos").alias("positives"),
        (F.sum("pos") / F.sum("cnt")).alias("pr_baseline"),
        _auc_expr().alias("auc"), _ap_expr().alias("average_precision"),
        (F.sum("_sq") / F.sum("cnt")).alias("brier"))


def classification_report(scored: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = 0.5, names: Sequence[str] = ("0", "1")) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and weighted averages.
    A zero denominator gives 0, as the common report does."""
    y = f"CAST({sql_ident(label)} AS BIGINT)"
    p = f"CAST({sql_ident(score)} >= {float(threshold)!r}D AS BIGINT)"
    cm = scored.agg(F.expr(f"sum({y} * {p})").alias("tp"), F.expr(f"sum((1 - {y}) * {p})").alias("fp"),
                    F.expr(f"sum({y} * (1 - {p}))").alias("fn"), F.expr(f"sum((1 - {y}) * (1 - {p}))").alias("tn"))
    tp, fp, fn, tn = ("CAST(tp AS DOUBLE)", "CAST(fp AS DOUBLE)", "CAST(fn AS DOUBLE)", "CAST(tn AS DOUBLE)")

    def z(x):
        return f"coalesce({x}, 0.0D)"

    prec1, rec1 = z(f"try_divide({tp}, {tp} + {fp})"), z(f"try_divide({tp}, {tp} + {fn})")
    prec0, rec0 = z(f"try_divide({tn}, {tn} + {fn})"), z(f"try_divide({tn}, {tn} + {fp})")
    f1_1 = z(f"try_divide(2.0D * {prec1} * {rec1}, {prec1} + {rec1})")
    f1_0 = z(f"try_divide(2.0D * {prec0} * {rec0}, {prec0} + {rec0})")
    s1, s0 = f"({tp} + {fn})", f"({tn} + {fp})"
    total = f"({s1} + {s0})"

    def row(name, pr, rc, f1, sup):
        return (f"named_struct('class_label', {sql_str(name)}, 'precision', {pr}, 'recall', {rc}, "
                f"'f1_score', {f1}, 'support', CAST({sup} AS BIGINT))")

    null = "CAST(NULL AS DOUBLE)"
    rows = ", ".join([
        row(names[0], prec0, rec0, f1_0, s0),
        row(names[1], prec1, rec1, f1_1, s1),
        row("accuracy", null, null, z(f"try_divide({tp} + {tn}, {total})"), total),
        row("macro avg", f"({prec0} + {prec1}) / 2", f"({rec0} + {rec1}) / 2", f"({f1_0} + {f1_1}) / 2", total),
        row("weighted avg", z(f"try_divide({prec0} * {s0} + {prec1} * {s1}, {total})"),
            z(f"try_divide({rec0} * {s0} + {rec1} * {s1}, {total})"),
            z(f"try_divide({f1_0} * {s0} + {f1_1} * {s1}, {total})"), total)])
    return cm.select(F.expr(f"inline(array({rows}))"))
