"""Data-quality checks: model tests (unique / not_null / accepted_values) and the
contracts of the event log, the experiment and the feature table.

Each check is an aggregate returning verdict rows, and checks over one table share a
pass: all tests of a model fold into one grouped pass on its unique key, and the
segment checks of the experiment are one grouping-sets aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import sql_ident, sql_str
from ..schemas import ARMS, STEPS, flag_col
from .funnel import funnel_flags

def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def model_checks(df: DataFrame, model: str, unique: Sequence[str] = (), not_null: Sequence[str] = (),
                 accepted: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows (model, column_name, test, failures); NULL passes accepted_values.

    With a uniqueness test, every test of the model is folded into ONE grouped pass on the
    unique key (per-key partial sums, then one small aggregate); otherwise one aggregate.
    """
    accepted = dict(accepted or {})
    unique = list(unique)
    key = unique[0] if unique else None

    def bad_value(c, values):
        lst = ", ".join(sql_str(v) for v in values)
        return f"({sql_ident(c)} IS NOT NULL AND NOT ({sql_ident(c)} IN ({lst})))"

    def is_null(c):
        return f"({sql_ident(c)} IS NULL)"

    rows = []  # (column, test, SQL aggregate over the grouped or plain frame)
    if key is not None:
        parts = [F.expr("count(1)").alias("_n")]
        for i, c in enumerate(not_null):
            if c != key:
                parts.append(F.expr(f"sum(CAST({is_null(c)} AS BIGINT))").alias(f"_nn{i}"))
        for j, (c, values) in enumerate(accepted.items()):
            if c != key:
                parts.append(F.expr(f"sum(CAST({bad_value(c, values)} AS BIGINT))").alias(f"_ac{j}"))
        src = df.groupBy(key).agg(*parts)
        for i, c in enumerate(not_null):
            rows.append((c, "not_null", f"sum(CASE WHEN {is_null(key)} THEN _n ELSE 0 END)" if c == key
                         else f"sum(_nn{i})"))
        for j, (c, values) in enumerate(accepted.items()):
            rows.append((c, "accepted_values", f"sum(CASE WHEN {bad_value(c, values)} THEN _n ELSE 0 END)"
                         if c == key else f"sum(_ac{j})"))
        rows.append((key, "unique", f"sum(CAST((NOT {is_null(key)} AND _n > 1) AS BIGINT))"))
    else:
        for c in not_null:
            rows.append((c, "not_null", f"sum(CAST({is_null(c)} AS BIGINT))"))
        for c, values in accepted.items():
            rows.append((c, "accepted_values", f"sum(CAST({bad_value(c, values)} AS BIGINT))"))
        src = df
    cells = ", ".join(f"named_struct('column_name', {sql_str(c)}, 'test', {sql_str(t)}, 'failures', {a})"
                      for c, t, a in rows)
    out = [src.agg(F.expr(f"array({cells})").alias("_c")).select(F.inline("_c")).select(
        F.lit(model).alias("model"), "column_name", "test",
        F.coalesce(F.col("failures"), F.lit(0)).cast("long").alias("failures"))]
    for c in unique[1:]:
        dup = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n")) \
            .filter(F.col("_n") > 1)
        out.append(dup.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit("unique").alias("test"),
            F.col("failures").cast("long").alias("failures")))
    return _union(out)


def warehouse_checks(raw_users: DataFrame, raw_events: DataFrame, stg_u: DataFrame, stg_e: DataFrame,
                     dim: DataFrame, funnel: DataFrame, ab: DataFrame, steps: Sequence[str] = STEPS,
                     arms: Sequence[str] = ARMS) -> DataFrame:
    """The declared tests of every raw table, staging view and mart."""
    return _union([
        model_checks(raw_users, "raw_users", unique=["user_id"], not_null=["user_id"]),
        model_checks(raw_events, "raw_events", unique=["event_id"], not_null=["event_id", "user_id"]),
        model_checks(stg_u, "stg_users", unique=["user_id"], not_null=["user_id", "variant"],
                     accepted={"variant": arms}),
        model_checks(stg_e, "stg_events", unique=["event_id"], not_null=["event_id", "user_id", "event_name"],
                     accepted={"event_name": steps}),
        model_checks(dim, "dim_users", unique=["user_id"], not_null=["user_id"], accepted={"variant": arms}),
        model_checks(funnel, "fct_funnel", unique=["user_id"], not_null=["user_id", flag_col(steps[0])]),
        model_checks(ab, "fct_ab_experiment", not_null=["funnel_step", "conversion_rate"],
                     accepted={"funnel_step": steps}),
    ])


def _verdict(df_one_row: DataFrame, check: str, value, passed) -> DataFrame:
    return _verdicts(df_one_row, [(check, value, passed)])


def _verdicts(df_one_row: DataFrame, checks) -> DataFrame:
    """(check, value, passed) rows from ONE pass over a one-row aggregate."""
    cells = [F.struct(F.lit(c).alias("check"), v.cast("double").alias("value"),
                      F.coalesce(ok, F.lit(False)).alias("passed")) for c, v, ok in checks]
    return df_one_row.select(F.inline(F.array(*cells)))


def funnel_monotone(users: DataFrame, events: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Users per step never increase along the funnel, and every user starts it."""
    flags = funnel_flags(events, steps, ts_steps=[])
    sums = flags.agg(*[F.sum(flag_col(s)).alias(f"_s{i}") for i, s in enumerate(steps)])
    n = users.agg(F.count(F.lit(1)).alias("_users"))
    row = sums.withColumn("_k", F.lit(1)).join(F.broadcast(n.withColumn("_k", F.lit(1))), "_k")
    mono = reduce(lambda a, b: a & b, [F.col(f"_s{i}") >= F.col(f"_s{i + 1}") for i in range(len(steps) - 1)])
    return _verdicts(row, [
        ("steps_non_increasing", F.col(f"_s{len(steps) - 1}"), mono),
        ("first_step_covers_users", F.col("_s0"), F.col("_s0") == F.col("_users")),
    ])


def timestamps_in_step_order(events: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Users whose events are not time-ordered along the funnel (every event of an earlier
    step must not be later than any event of a later step). One grouped pass, no window."""
    name, ts = F.col("event_name"), F.col("event_ts")
    aggs = []
    for i, s in enumerate(steps):
        aggs.append(F.min(F.when(name == F.lit(s), ts)).alias(f"_mn{i}"))
        aggs.append(F.max(F.when(name == F.lit(s), ts)).alias(f"_mx{i}"))
    per_user = events.groupBy("user_id").agg(*aggs)
    bad = None
    for j in range(1, len(steps)):
        prev_max = F.greatest(*[F.col(f"_mx{i}") for i in range(j)]) if j > 1 else F.col("_mx0")
        v = F.coalesce(F.col(f"_mn{j}") < prev_max, F.lit(False))
        bad = v if bad is None else (bad | v)
    n = per_user.agg(F.sum(bad.cast("long")).alias("_bad"))
    return _verdict(n, "timestamps_in_step_order", F.coalesce(F.col("_bad"), F.lit(0)),
                    F.coalesce(F.col("_bad"), F.lit(0)) == 0)


def arm_balance(users: DataFrame, tol: float = 0.02, arms: Sequence[str] = ARMS) -> DataFrame:
    """Largest deviation of an arm's share from an even split."""
    n = F.count(F.lit(1))
    devs = [F.abs(F.sum((F.col("variant") == F.lit(a)).cast("long")) / n - F.lit(1.0 / len(arms)))
            for a in arms]
    one = users.agg(F.greatest(*devs).alias("_dev") if len(devs) > 1 else devs[0].alias("_dev"))
    return _verdict(one, "arm_balance", F.col("_dev"), F.col("_dev") < F.lit(tol))


def rate_spread_check(df: DataFrame, dim: str, flag: str, bound: float, below: bool, check: str) -> DataFrame:
    """Spread (max - min) of a 0/1 rate across groups, tested against a bound."""
    rates = df.groupBy(dim).agg(F.avg(F.col(flag).cast("double")).alias("_r"))
    one = rates.agg((F.max("_r") - F.min("_r")).alias("_sp"))
    ok = (F.col("_sp") < F.lit(bound)) if below else (F.col("_sp") > F.lit(bound))
    return _verdict(one, check, F.col("_sp"), ok)


def lift_above(flags: DataFrame, flag: str, bound: float, control: str = ARMS[0],
               treatment: str = ARMS[1]) -> DataFrame:
    """Treatment rate minus control rate, tested against a lower bound."""
    f = F.col(flag).cast("double")
    one = flags.agg((F.avg(F.when(F.col("variant") == treatment, f))
                     - F.avg(F.when(F.col("variant") == control, f))).alias("_d"))
    return _verdict(one, "treatment_lift", F.col("_d"), F.col("_d") > F.lit(bound))


def segment_contract(flags: DataFrame, done: str, act: str, tol: float = 0.02, done_bound: float = 0.03,
                     act_bound: float = 0.02, lift_bound: float = 0.03, control: str = ARMS[0],
                     treatment: str = ARMS[1]) -> DataFrame:
    """Arm balance, completion / activation spreads by country and platform, and the lift,
    from ONE grouping-sets aggregate over the user flags (then a one-row aggregate)."""
    sets = flags.groupingSets([["country"], ["platform"], ["variant"]], "country", "platform", "variant").agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("_n"),
        F.avg(F.col(done).cast("double")).alias("_done"), F.avg(F.col(act).cast("double")).alias("_act"))
    by_country, by_platform, by_variant = "_gid = 3", "_gid = 5", "_gid = 6"

    def spread(where, c):
        return f"max(CASE WHEN {where} THEN {c} END) - min(CASE WHEN {where} THEN {c} END)"

    total = f"sum(CASE WHEN {by_variant} THEN _n END)"

    def share(arm):
        return f"sum(CASE WHEN {by_variant} AND variant = {sql_str(arm)} THEN _n END)"

    def rate(arm):
        return f"max(CASE WHEN {by_variant} AND variant = {sql_str(arm)} THEN _done END)"

    one = sets.agg(
        F.expr(f"greatest(abs({share(control)} / {total} - 0.5D), abs({share(treatment)} / {total} - 0.5D))")
        .alias("arm_balance"),
        F.expr(spread(by_country, "_done")).alias("completion_spread_country"),
        F.expr(spread(by_platform, "_done")).alias("completion_spread_platform"),
        F.expr(spread(by_country, "_act")).alias("activation_spread_country"),
        F.expr(spread(by_platform, "_act")).alias("activation_spread_platform"),
        F.expr(f"{rate(treatment)} - {rate(control)}").alias("treatment_lift"))
    checks = [("arm_balance", F.col("arm_balance") < F.lit(tol)),
              ("completion_spread_country", F.col("completion_spread_country") < F.lit(done_bound)),
              ("completion_spread_platform", F.col("completion_spread_platform") < F.lit(done_bound)),
              ("activation_spread_country", F.col("activation_spread_country") > F.lit(act_bound)),
              ("activation_spread_platform", F.col("activation_spread_platform") > F.lit(act_bound)),
              ("treatment_lift", F.col("treatment_lift") > F.lit(lift_bound))]
    return _verdicts(one, [(n, F.col(n), ok) for n, ok in checks])


def feature_checks(features: DataFrame, users: DataFrame, target: str,
                   feature_cols: Sequence[str], minutes_col: str | None = "minutes_signup_to_complete") -> DataFrame:
    """Binary target, no NULL features, non-negative minutes, sane prevalence and population."""
    t = F.col(target)
    nulls = sum(F.sum(F.col(c).isNull().cast("long")) for c in [*feature_cols, target])
    aggs = [F.count(F.lit(1)).alias("_n"), F.avg(t.cast("double")).alias("_prev"),
            F.sum((~t.isin(0, 1)).cast("long")).alias("_nonbin"), nulls.alias("_nulls")]
    if minutes_col:
        aggs.append(F.sum((F.col(minutes_col) < 0).cast("long")).alias("_neg"))
    one = features.agg(*aggs)
    n_users = users.agg(F.count(F.lit(1)).alias("_users"))
    row = one.withColumn("_k", F.lit(1)).join(F.broadcast(n_users.withColumn("_k", F.lit(1))), "_k")
    nonbin, nulls = F.coalesce(F.col("_nonbin"), F.lit(0)), F.coalesce(F.col("_nulls"), F.lit(0))
    checks = [
        ("target_binary", nonbin, nonbin == 0),
        ("no_missing_values", nulls, nulls == 0),
        ("prevalence_reasonable", F.col("_prev"), (F.col("_prev") > 0.05) & (F.col("_prev") < 0.95)),
        ("population_within_users", F.col("_n"), (F.col("_n") > 0) & (F.col("_n") <= F.col("_users"))),
    ]
    if minutes_col:
        neg = F.coalesce(F.col("_neg"), F.lit(0))
        checks.append(("minutes_non_negative", neg, neg == 0))
    return _verdicts(row, checks)


def schema_problems(df: DataFrame, required: Sequence[str], forbidden: Sequence[str]) -> list[str]:
    """Leakage / completeness check on the column set (no data is read)."""
    cols = set(df.columns)
    out = [f"missing: {c}" for c in required if c not in cols]
    out += [f"leaky: {c}" for c in forbidden if c in cols]
    return out


def schema_contract(tables: dict[str, DataFrame], required: dict[str, Sequence[str]], forbidden: dict[str, Sequence[str]]) -> DataFrame:
    """table_name, column_name, rule, data_type, passed: the analysed schemas as a relation, joined with the columns that each table must
    and must not have. No data are read; names are compared exactly."""
    spark = next(iter(tables.values())).sparkSession
    schema = spark.createDataFrame([(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields],
                                   "table_name string, column_name string, data_type string")
    rules = spark.createDataFrame([(t, c, rule) for rule, by in (("required", required), ("forbidden", forbidden)) for t, cols in by.items() for c in cols],
                                  "table_name string, column_name string, rule string")
    there = F.col("data_type").isNotNull()
    return rules.join(schema, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "rule", "data_type", F.when(F.col("rule") == "required", there).otherwise(~there).alias("passed"))


def fingerprint(df: DataFrame) -> DataFrame:
    """rows, hash_one, hash_two: one row that is equal for equal multisets of rows, whatever their order and partitions.

    Two 64-bit row hashes are added as whole numbers: partial sums merge in any order, and a table of any size
    is compared by three numbers instead of by two set differences. Repeated rows count as often as they occur."""
    row = [F.col(f"`{c}`") for c in sorted(df.columns)]
    one, two = F.xxhash64(F.lit(1), *row), F.xxhash64(F.lit(2), *reversed(row))
    present = [F.xxhash64(*[c.isNull() for c in row])]  # NULL leaves a hash as it is: (NULL, 1) and (1, NULL) must differ
    whole = lambda h: F.coalesce(F.sum(F.xxhash64(h, *present).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("rows"), whole(one).alias("hash_one"), whole(two).alias("hash_two"))


def same_fingerprint(check: str, a: DataFrame, b: DataFrame, equal: bool = True) -> DataFrame:
    """check_name, rows (of a), passed: whether two tables hold the same rows (or, with ``equal`` false, do not)."""
    both = fingerprint(a).join(fingerprint(b).withColumnsRenamed({"rows": "n", "hash_one": "h1", "hash_two": "h2"}))  # one row each
    same = (F.col("rows") == F.col("n")) & (F.col("hash_one") == F.col("h1")) & (F.col("hash_two") == F.col("h2"))
    return both.select(F.lit(check).alias("check_name"), "rows", (same == F.lit(equal)).alias("passed"))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset equality as data: rows only in a, rows only in b (both 0 when equal)."""
    return a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_left")).withColumn("_k", F.lit(1)).join(
        b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_right")).withColumn("_k", F.lit(1)), "_k").drop("_k")


__all__ = ["model_checks", "warehouse_checks", "funnel_monotone", "timestamps_in_step_order", "arm_balance",
           "rate_spread_check", "lift_above", "segment_contract", "feature_checks", "schema_problems", "schema_contract",
           "fingerprint", "same_fingerprint", "same_rows"]
