"""Cohort, segment and distribution reports over the user-grain tables.

All are grouped aggregates (partial + final hash aggregation). Pivots are null-safe conditional
aggregates, one per column. They take the values that the data hold (NULL as the column ``null``), so every row is in
the table; naming the values saves that pass, and rows with other values (NULL too, unless listed as None) are then counted in
the column ``other``. A column whose name is taken already gets an underscore. The ``*_long`` forms need neither.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div, week_start_sunday
from ..schemas import ACTIVATION_STEP, flag_col
from ..session import materialise
from .funnel import with_reached

#: Columns of a pivot whose values are looked up.
MAX_PIVOT = 1000


def weekly_cohorts(funnel: DataFrame, activation_step: str = ACTIVATION_STEP) -> DataFrame:
    """Signup week (Sunday start) x variant: signups, activated, activation_rate."""
    flag = F.col(flag_col(activation_step))
    return funnel.groupBy(week_start_sunday("signup_date").alias("signup_week"), "variant").agg(
        F.count(F.lit(1)).alias("signups"),
        F.sum(flag).cast("long").alias("activated"),
        safe_div(F.sum(flag), F.count(F.lit(1))).alias("activation_rate"))


def segment_activation(funnel: DataFrame, activation_step: str = ACTIVATION_STEP,
                       segment_cols: Sequence[str] = ("country", "platform"),
                       min_users: int = 500) -> DataFrame:
    """Activation % and mean minutes to activate per segment, segments of >= min_users.

    Users without events are ignored by the average (NULL flag), as in the mart.
    """
    flag = F.col(flag_col(activation_step))
    agg = funnel.groupBy(*segment_cols).agg(
        F.count(F.lit(1)).alias("users"),
        F.round(F.avg(flag) * F.lit(100), 1).alias("activation_pct"),
        F.round(F.avg("minutes_to_activate")).alias("avg_minutes_to_activate"))
    return agg.filter(F.col("users") >= F.lit(min_users))


def pivot_values(df: DataFrame, col: str, most: int = MAX_PIVOT) -> list[str | None]:
    """The distinct values of a column as text, sorted, None (for NULL) last; more than ``most`` raise an error."""
    found = [r[0] for r in df.select(F.col(col).cast("string")).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} values: use the long form")
    return sorted(v for v in found if v is not None) + [None] * (None in found)


def pivot_names(row: str, values: Sequence[str | None], rest: bool = False) -> list[str]:
    """Column names of pivoted values: the value itself, ``null`` for NULL and, with ``rest``, ``other`` for all that is not listed. A name
    that is taken (by the row's column, by a value that differs in case, by a value ``null`` or ``other``) gets underscores."""
    taken, out = {row.lower()}, {}
    for key in sorted(range(len(values)), key=lambda i: values[i] is None):  # real values first
        name = "null" if values[key] is None else values[key]
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out[key] = name
    names = [out[i] for i in range(len(values))]
    if rest:
        name = "other"
        while name.lower() in taken:
            name += "_"
        names.append(name)
    return names


def _pivot(df: DataFrame, row: str, col: str, col_values: Sequence[str | None] | None, cell) -> tuple[DataFrame, list[str]]:
    """One aggregate per row value with ``cell(condition)`` for every listed value, null-safely, and for the rest where values are given."""
    values = pivot_values(df, col) if col_values is None else list(col_values)
    names = pivot_names(row, values, rest=col_values is not None)
    text = F.col(col).cast("string")
    is_ = [text.eqNullSafe(F.lit(v)) for v in values]
    if col_values is not None:
        listed = text.isin([v for v in values if v is not None])
        is_.append(~F.coalesce(listed, F.lit(None in values)))
    return df.groupBy(row).agg(*[cell(c).alias(n) for c, n in zip(is_, names)]), names


def activation_heatmap_long(users: DataFrame, events: DataFrame, activation_step: str = ACTIVATION_STEP,
                            rows: str = "country", cols: str = "platform") -> DataFrame:
    """rows, cols, users, activation rate in percent: one row per cell, whatever its values."""
    flagged = with_reached(users.select("user_id", rows, cols), events, activation_step, "activated")
    return flagged.groupBy(rows, cols).agg(
        F.count(F.lit(1)).alias("users"), (F.avg(F.col("activated").cast("double")) * F.lit(100)).alias("activation_pct"))


def activation_heatmap(users: DataFrame, events: DataFrame, activation_step: str = ACTIVATION_STEP,
                       rows: str = "country", cols: str = "platform",
                       col_values: Sequence[str] | None = None) -> DataFrame:
    """rows x cols activation rate in percent (users without events count as 0; no users: NULL).

    With ``col_values`` the column ``other`` holds the users with any other value; without any it is NULL. Without, one
    pass looks up the values."""
    flagged = with_reached(users.select("user_id", rows, cols), events, activation_step, "activated")
    if col_values is None:
        flagged = materialise(flagged, "flagged")  # read for the values, then for the cells
    return _pivot(flagged, rows, cols, col_values, lambda c: F.avg(F.when(c, F.col("activated").cast("double"))) * F.lit(100))[0]


def rate_by(df: DataFrame, dim: str, flag: str) -> DataFrame:
    """Mean of a 0/1 (or Boolean) column per value of ``dim``."""
    return df.groupBy(dim).agg(F.avg(F.col(flag).cast("double")).alias("rate"))


def distinct_users(events: DataFrame, group_cols: Sequence[str], id_col: str = "user_id",
                   approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Distinct ids per group (exact by default; HyperLogLog++ with relative std. dev.
    ``rsd`` on request: a fixed-size sketch per group instead of a distinct shuffle)."""
    f = F.approx_count_distinct(id_col, rsd) if approx else F.countDistinct(id_col)
    return events.groupBy(*group_cols).agg(f.alias("distinct_users"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Normalised value counts of one column (any cardinality: the total is a one-row
    aggregate joined on a constant key, never a single-task window over the values)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total")).withColumn("_k", F.lit(1))
    return counts.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k", "inner") \
        .select(col, "n", (F.col("n") / F.col("_total")).alias("share"))


def crosstab_shares_long(df: DataFrame, row: str, col: str, decimals: int = 3) -> DataFrame:
    """row, col, n, share of the row's total: one row per cell that occurs, whatever its values.

    The total of a row sums its cells, so the window runs over distinct cells only."""
    cells = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(row))
    return cells.select(row, col, "n", F.round(safe_div("n", total), decimals).alias("share"))


def crosstab_shares(df: DataFrame, row: str, col: str, col_values: Sequence[str] | None = None,
                    decimals: int = 3) -> DataFrame:
    """Row-normalised crosstab, rounded; a missing cell is 0. Shares are of all rows of ``df``."""
    cell = lambda c: F.round(safe_div(F.coalesce(F.sum(F.when(c, F.lit(1))), F.lit(0)), F.count(F.lit(1))), decimals)
    return _pivot(df, row, col, col_values, cell)[0]


def profile(df: DataFrame, id_col: str = "user_id") -> DataFrame:
    """rows, distinct ids and NULL cells of a table in one aggregate."""
    nulls = sum(F.sum(F.col(c).isNull().cast("long")) for c in df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(id_col).alias("distinct_ids"),
                  nulls.alias("null_cells"))
