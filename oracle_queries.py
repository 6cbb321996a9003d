"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL over the pre-registered Parquet views. The adapters are
rebuilt as CTEs: adapter U (user-day units of ``events``) and adapter G (the md5-drawn
experiment log with ten users per ``customer`` row).
"""

from __future__ import annotations

import statistics

SEED = 42
STEPS = ["signup_started", "signup_completed", "kyc_submitted", "first_deposit", "first_transaction"]
U_STEPS = ["signup", "view", "click", "purchase", "error"]


def _d(x) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def draw(key: str, name: str, seed: int = SEED) -> str:
    return (f"(CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{name}:{seed}'), 1, 13) AS BIGINT)"
            f" AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))")


def draw_int(key: str, name: str, lo: int, hi: int, seed: int = SEED) -> str:
    return f"CAST({lo} + floor({draw(key, name, seed)} * {_d(float(hi - lo + 1))}) AS BIGINT)"


def norm_cdf(x: str) -> str:
    """Normal CDF by the series 1/2 + phi(x) (x + x^3/3 + x^5/(3 5) + ..), summed from its small end; exact to 1e-15 on [-8, 8] and held there
    beyond. (The library uses a rational approximation.)"""
    sq, near = f"least({x} * {x}, {_d(64.0)})", f"greatest(least({x}, {_d(8.0)}), {_d(-8.0)})"
    series = f"list_reduce(range(160, 0, -1), lambda acc, k: {_d(1.0)} + {sq} / (2 * k + 1) * acc, {_d(1.0)})"
    return f"(CASE WHEN {x} IS NOT NULL THEN {_d(0.5)} + exp(-{sq} / 2) / sqrt(2 * pi()) * {near} * {series} END)"


def zq(p: float) -> float:
    return statistics.NormalDist().inv_cdf(p)


# ---------------------------------------------------------------------------
# Adapters
# ---------------------------------------------------------------------------

def g_ctes(seed: int = SEED) -> str:
    u = lambda n: draw("user_id", n, seed)
    gi = lambda n, lo, hi: draw_int("user_id", n, lo, hi, seed)
    ts = lambda m: f"(TIMESTAMP '2026-01-01 00:00:00' + to_minutes(CAST({m} AS BIGINT)))"
    return f"""
g_ids AS (
  SELECT unnest(range(CAST(c_custkey AS BIGINT) * 10 + 1, CAST(c_custkey AS BIGINT) * 10 + 11)) AS user_id
  FROM customer),
g_a AS (
  SELECT user_id,
    CASE WHEN {u('variant')} < {_d(0.5)} THEN 'control' ELSE 'treatment' END AS variant,
    CASE WHEN {u('country')} < {_d(0.3)} THEN 'PT' WHEN {u('country')} < {_d(0.55)} THEN 'ES'
         WHEN {u('country')} < {_d(0.75)} THEN 'PL' WHEN {u('country')} < {_d(0.9)} THEN 'GB' ELSE 'AE' END AS country,
    CASE WHEN {u('platform')} < {_d(0.45)} THEN 'ios' WHEN {u('platform')} < {_d(0.85)} THEN 'android'
         ELSE 'web' END AS platform,
    {gi('signup_minute', 0, 86399)} AS m0
  FROM g_ids),
g_b AS (
  SELECT *,
    floor((m0 % 1440) / 60) AS hr,
    m0 + {gi('gap_signup_completed', 3, 20)} AS m1
  FROM g_a),
g_c AS (
  SELECT *,
    m1 + {gi('gap_kyc_submitted', 10, 90)} AS m2
  FROM g_b),
g_d AS (
  SELECT *,
    m2 + {gi('gap_first_deposit', 30, 360)} AS m3
  FROM g_c),
g_e AS (
  SELECT *,
    m3 + {gi('gap_first_transaction', 15, 600)} AS m4,
    least(greatest({_d(0.75)} + CASE country WHEN 'PT' THEN {_d(0.05)} WHEN 'ES' THEN {_d(0.03)}
        WHEN 'GB' THEN {_d(0.02)} WHEN 'PL' THEN {_d(0.0)} WHEN 'AE' THEN {_d(-0.1)} ELSE {_d(0.0)} END,
        {_d(0.01)}), {_d(0.99)}) AS p_kyc,
    least(greatest({_d(0.55)} + CASE platform WHEN 'ios' THEN {_d(0.05)} WHEN 'android' THEN {_d(0.0)}
        WHEN 'web' THEN {_d(-0.08)} ELSE {_d(0.0)} END, {_d(0.01)}), {_d(0.99)}) AS p_dep,
    least(greatest({_d(0.7)} + CASE WHEN hr BETWEEN 0 AND 5 THEN {_d(-0.06)} ELSE {_d(0.01)} END,
        {_d(0.01)}), {_d(0.99)}) AS p_txn,
    CASE WHEN variant = 'treatment' THEN {_d(0.68)} ELSE {_d(0.62)} END AS p_complete
  FROM g_d),
g_walk AS (
  SELECT user_id, variant, country, platform,
    {ts('m0')} AS t0, {ts('m1')} AS t1, {ts('m2')} AS t2, {ts('m3')} AS t3, {ts('m4')} AS t4,
    TRUE AS r0,
    {u('complete')} < p_complete AS r1,
    ({u('complete')} < p_complete) AND ({u('kyc')} < p_kyc) AS r2,
    ({u('complete')} < p_complete) AND ({u('kyc')} < p_kyc) AND ({u('deposit')} < p_dep) AS r3,
    ({u('complete')} < p_complete) AND ({u('kyc')} < p_kyc) AND ({u('deposit')} < p_dep)
      AND ({u('transaction')} < p_txn) AS r4
  FROM g_e),
raw_users AS (
  SELECT user_id, variant, country, platform, t0 AS signup_ts FROM g_walk),
g_long AS (
  SELECT user_id, 'signup_started' AS event_name, t0 AS event_ts FROM g_walk WHERE r0
  UNION ALL SELECT user_id, 'signup_completed', t1 FROM g_walk WHERE r1
  UNION ALL SELECT user_id, 'kyc_submitted', t2 FROM g_walk WHERE r2
  UNION ALL SELECT user_id, 'first_deposit', t3 FROM g_walk WHERE r3
  UNION ALL SELECT user_id, 'first_transaction', t4 FROM g_walk WHERE r4),
raw_events AS (
  SELECT CAST(row_number() OVER (ORDER BY user_id, event_ts) AS BIGINT) AS event_id,
         user_id, event_name, event_ts FROM g_long)"""


def u_ctes() -> str:
    return """
u_ev AS (
  SELECT event_id, user_id AS uid, event_type, CAST(ts AS TIMESTAMP) AS ts FROM events),
raw_events AS (
  SELECT CAST(event_id AS BIGINT) AS event_id,
         CAST(uid AS BIGINT) * 100000 + date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS user_id,
         event_type AS event_name, ts AS event_ts
  FROM u_ev),
u_spans AS (
  SELECT uid, min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM u_ev GROUP BY uid),
u_days AS (
  SELECT uid, CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
  FROM u_spans),
raw_users AS (
  SELECT CAST(d.uid AS BIGINT) * 100000 + date_diff('day', DATE '1970-01-01', d.day) AS user_id,
         CASE WHEN d.uid % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant,
         n.n_name AS country, c.c_mktsegment AS platform, CAST(d.day AS TIMESTAMP) AS signup_ts
  FROM u_days d
  LEFT JOIN customer c ON c.c_custkey = d.uid
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""


def nulls_ctes() -> str:
    """Adapter U with missing and unlisted values."""
    return u_ctes().replace("raw_users AS (", "unit_users AS (") + """,
raw_users AS (
  SELECT user_id, CASE (user_id // 100000) % 10 WHEN 0 THEN NULL WHEN 1 THEN 'holdout' ELSE variant END AS variant,
         nullif(country, 'FRANCE') AS country, nullif(platform, 'BUILDING') AS platform, signup_ts
  FROM unit_users)"""


def staging_ctes() -> str:
    return """
stg_users AS (
  SELECT CAST(user_id AS BIGINT) AS user_id, lower(variant) AS variant, upper(country) AS country,
         lower(platform) AS platform, CAST(signup_ts AS TIMESTAMP) AS signup_ts,
         CAST(CAST(signup_ts AS TIMESTAMP) AS DATE) AS signup_date
  FROM raw_users),
stg_events AS (
  SELECT CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS BIGINT) AS user_id,
         lower(event_name) AS event_name, CAST(event_ts AS TIMESTAMP) AS event_ts
  FROM raw_events),
dim_users AS (
  SELECT user_id, variant, country, platform, signup_ts, signup_date FROM stg_users)"""


def flags_cte(steps, ts_steps, name="flags") -> str:
    """Flags from each user's list of distinct event names; times from the first event of each name."""
    cols = [f"CAST(list_contains(list(event_name), '{s}') AS INTEGER) AS reached_{s}" for s in steps]
    cols += [f"min(first_ts) FILTER (WHERE event_name = '{s}') AS ts_{s}" for s in ts_steps]
    return f"""
{name} AS (
  SELECT user_id, {', '.join(cols)}
  FROM (SELECT user_id, event_name, min(event_ts) AS first_ts FROM stg_events GROUP BY user_id, event_name)
  GROUP BY user_id)"""


def fct_funnel_ctes(steps, start, act) -> str:
    flags = ", ".join(f"f.reached_{s}" for s in steps)
    return flags_cte(steps, [start, act]) + f""",
fct_funnel AS (
  SELECT u.user_id, u.variant, u.country, u.platform, u.signup_date, {flags},
         datesub('minute', f.ts_{start}, f.ts_{act}) AS minutes_to_activate
  FROM stg_users u LEFT JOIN flags f USING (user_id))"""


def fct_ab_ctes(steps) -> str:
    """Arms x steps: arm sizes, and distinct users per arm and event name (unknown for an arm without any event)."""
    values = ", ".join(f"('{s}', {i + 1})" for i, s in enumerate(steps))
    return f""",
step_list(funnel_step, step_order) AS (VALUES {values}),
arm_sizes AS (
  SELECT u.variant, count(*) AS total, count(f.user_id) AS with_events
  FROM stg_users u LEFT JOIN flags f USING (user_id) GROUP BY u.variant),
arm_steps AS (
  SELECT u.variant, e.event_name, count(DISTINCT u.user_id) AS n
  FROM stg_users u JOIN stg_events e USING (user_id) GROUP BY u.variant, e.event_name),
fct_ab AS (
  SELECT a.variant, s.funnel_step, s.step_order, CASE WHEN with_events > 0 THEN CAST(coalesce(r.n, 0) AS BIGINT) END AS converted,
         CAST(a.total AS BIGINT) AS total,
         CASE WHEN with_events > 0 THEN CAST(coalesce(r.n, 0) AS DOUBLE) / nullif(a.total, 0) END AS conversion_rate
  FROM arm_sizes a CROSS JOIN step_list s
  LEFT JOIN arm_steps r ON r.variant IS NOT DISTINCT FROM a.variant AND r.event_name = s.funnel_step)"""


def base(adapter: str, steps=None, marts: bool = True) -> str:
    """WITH clause: adapter, staging and (optionally) the marts."""
    if adapter == "g":
        steps, start, act, ctes = STEPS, "signup_started", "first_transaction", g_ctes()
    else:
        steps, start, act, ctes = U_STEPS, "signup", "purchase", u_ctes() if adapter == "u" else nulls_ctes()
    sql = "WITH " + ctes.strip() + "," + staging_ctes()
    if marts:
        sql += "," + fct_funnel_ctes(steps, start, act) + fct_ab_ctes(steps)
    return sql


def adapter_steps(adapter: str):
    return STEPS if adapter == "g" else U_STEPS


# ---------------------------------------------------------------------------
# Shared statistic spellings
# ---------------------------------------------------------------------------

def two_prop_select(alpha: float = 0.05) -> str:
    """Columns of the two-proportion test over a relation with control_/treatment_ counts."""
    za = zq(1 - alpha / 2)
    return f"""
  SELECT *,
    absolute_lift - {_d(1.96)} * se_diff AS ci_low,
    absolute_lift + {_d(1.96)} * se_diff AS ci_high,
    {norm_cdf(f'(abs(absolute_lift) / nullif(se_diff, 0) - {_d(za)})')} AS power
  FROM (
    SELECT *,
      p_t - p_c AS absolute_lift,
      (p_t - p_c) / nullif(p_c, 0) AS relative_lift,
      (p_t - p_c) / nullif(sqrt(p_pool * (1 - p_pool) * (CAST(1 AS DOUBLE) / nullif(control_total, 0) + CAST(1 AS DOUBLE) / nullif(treatment_total, 0))), 0) AS z,
      sqrt(p_c * (1 - p_c) / nullif(control_total, 0) + p_t * (1 - p_t) / nullif(treatment_total, 0)) AS se_diff
    FROM (
      SELECT *,
        CAST(control_converted AS DOUBLE) / nullif(control_total, 0) AS p_c,
        CAST(treatment_converted AS DOUBLE) / nullif(treatment_total, 0) AS p_t,
        CAST(control_converted + treatment_converted AS DOUBLE) / nullif(control_total + treatment_total, 0) AS p_pool
      FROM paired) s1) s2"""


def two_prop_final(group_cols: list[str], alpha: float = 0.05, decimals: int = 10) -> str:
    g = ", ".join(group_cols)
    return f"""
SELECT {g}, control_converted, control_total, treatment_converted, treatment_total,
       p_c AS control_rate, p_t AS treatment_rate, absolute_lift, relative_lift, z,
       round(2.0 * {norm_cdf('-abs(z)')}, {decimals}) AS p_value,
       ci_low, ci_high, round(power, {decimals}) AS power,
       coalesce(2.0 * {norm_cdf('-abs(z)')} < {alpha} AND ci_low > 0, FALSE) AS ship
FROM ({two_prop_select(alpha)}) t"""


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

def _act(adapter: str) -> str:
    return "first_transaction" if adapter == "g" else "purchase"


def q_raw_users(a):
    return base(a, marts=False) + "\nSELECT * FROM raw_users"


def q_raw_events(a):
    return base(a, marts=False) + "\nSELECT * FROM raw_events"


def q_stg_users(a):
    return base(a, marts=False) + "\nSELECT * FROM stg_users"


def q_stg_events(a):
    return base(a, marts=False) + "\nSELECT * FROM stg_events"


def q_dim_users(a):
    return base(a, marts=False) + "\nSELECT * FROM dim_users"


def q_funnel_flags(a):
    steps = adapter_steps(a)
    return base(a, marts=False) + "," + flags_cte(steps, steps, "all_flags") + "\nSELECT * FROM all_flags"


def q_fct_funnel(a):
    return base(a) + "\nSELECT * FROM fct_funnel"


def q_fct_ab_experiment(a):
    return base(a) + "\nSELECT * FROM fct_ab"


def q_funnel_dropoff(a):
    return base(a) + """,
per_step AS (SELECT step_order, funnel_step, CAST(sum(converted) AS BIGINT) AS n FROM fct_ab GROUP BY ALL)
SELECT here.funnel_step, here.step_order, here.n AS users_at_step, before.n AS users_prev_step,
       CAST(here.n AS DOUBLE) / nullif(before.n, 0) AS step_conversion,
       CAST(here.n AS DOUBLE) / nullif((SELECT n FROM per_step WHERE step_order = 1), 0) AS cumulative_conversion
FROM per_step here LEFT JOIN per_step before ON before.step_order + 1 = here.step_order"""


def q_ab_lift(a):
    return base(a) + """
SELECT funnel_step, step_order, c.conversion_rate AS control_rate, t.conversion_rate AS treatment_rate,
       t.conversion_rate - c.conversion_rate AS absolute_lift
FROM (FROM fct_ab WHERE variant = 'control') c FULL JOIN (FROM fct_ab WHERE variant = 'treatment') t USING (funnel_step, step_order)"""


def q_weekly_cohorts(a):
    f = f"reached_{_act(a)}"
    return base(a) + f"""
SELECT CAST(signup_date - CAST(dayofweek(signup_date) AS INTEGER) AS DATE) AS signup_week, variant,
       CAST(count(*) AS BIGINT) AS signups, CAST(sum({f}) AS BIGINT) AS activated,
       CAST(sum({f}) AS DOUBLE) / nullif(count(*), 0) AS activation_rate
FROM fct_funnel GROUP BY 1, 2"""


def q_segment_activation(a, min_users=500):
    f = f"reached_{_act(a)}"
    return base(a) + f"""
SELECT country, platform, CAST(count(*) AS BIGINT) AS users,
       round(avg({f}) * 100, 1) AS activation_pct,
       round(avg(minutes_to_activate)) AS avg_minutes_to_activate
FROM fct_funnel GROUP BY country, platform
HAVING count(*) >= {min_users}"""


def step_counts_cte(a, group_cols=(), zero_fill=True, name="counts") -> str:
    steps = adapter_steps(a)
    g = "".join(f"{c}, " for c in group_cols)
    parts = [f"SELECT {g}variant, '{s}' AS funnel_step, {i + 1} AS step_order, reached_{s} AS reached FROM fct_funnel"
             for i, s in enumerate(steps)]
    conv = "coalesce(sum(reached), 0)" if zero_fill else "sum(reached)"
    return f""",
{name}_long AS (
  {' UNION ALL '.join(parts)}),
{name} AS (
  SELECT {g}variant, funnel_step, step_order, CAST({conv} AS BIGINT) AS converted,
         CAST(count(*) AS BIGINT) AS total
  FROM {name}_long GROUP BY {g}variant, funnel_step, step_order)"""


def paired_cte(src: str, group_cols, conv="converted", total="total") -> str:
    g = ", ".join(group_cols)
    return f""",
paired AS (
  SELECT {g},
    CAST(max(CASE WHEN variant = 'control' THEN {conv} END) AS BIGINT) AS control_converted,
    CAST(max(CASE WHEN variant = 'control' THEN {total} END) AS BIGINT) AS control_total,
    CAST(max(CASE WHEN variant = 'treatment' THEN {conv} END) AS BIGINT) AS treatment_converted,
    CAST(max(CASE WHEN variant = 'treatment' THEN {total} END) AS BIGINT) AS treatment_total
  FROM {src} GROUP BY {g})"""


def q_ab_test(a):
    return (base(a) + step_counts_cte(a) + paired_cte("counts", ["funnel_step", "step_order"])
            + two_prop_final(["funnel_step", "step_order"]))


# ---------------------------------------------------------------------------
# Dashboard / EDA tables
# ---------------------------------------------------------------------------

def _start(a: str) -> str:
    return "signup_started" if a == "g" else "signup"


def user_flags_cte(a) -> str:
    steps = adapter_steps(a)
    cols = ", ".join(f"coalesce(f.reached_{s}, 0) AS reached_{s}" for s in steps)
    parts = [f"SELECT variant, '{s}' AS step, {i + 1} AS step_order, reached_{s} AS reached FROM uf"
             for i, s in enumerate(steps)]
    return f""",
uf AS (SELECT u.user_id, u.variant, {cols} FROM stg_users u LEFT JOIN flags f USING (user_id)),
fbv_long AS ({' UNION ALL '.join(parts)}),
fbv AS (
  SELECT step, step_order, variant, CAST(sum(reached) AS BIGINT) AS converted, CAST(count(*) AS BIGINT) AS total
  FROM fbv_long GROUP BY step, step_order, variant)"""


def q_funnel_by_variant(a):
    return base(a) + user_flags_cte(a) + """
SELECT step, step_order, variant, converted, total, CAST(converted AS DOUBLE) / nullif(total, 0) AS rate,
       CAST(converted AS DOUBLE) / nullif(first_value(total) OVER (PARTITION BY variant ORDER BY step_order), 0)
         AS cumulative_rate
FROM fbv"""


def q_funnel_overall(a):
    return base(a) + user_flags_cte(a) + """,
fo AS (SELECT step, step_order, CAST(sum(reached) AS BIGINT) AS converted, CAST(count(*) AS BIGINT) AS total
       FROM fbv_long GROUP BY step, step_order)
SELECT step, step_order, converted AS users, CAST(converted AS DOUBLE) / nullif(total, 0) AS cumulative_rate,
       CAST(converted AS DOUBLE) / nullif(lag(converted) OVER (ORDER BY step_order), 0) AS step_conversion
FROM fo"""


def q_lift_table(a):
    return base(a) + user_flags_cte(a) + paired_cte("fbv", ["step", "step_order"]) + f"""
SELECT step, step_order, (p_t - p_c) * 100 AS lift_pp,
       {_d(1.96)} * sqrt(p_c * (1 - p_c) / nullif(control_total, 0) + p_t * (1 - p_t) / nullif(treatment_total, 0))
         * 100 AS ci_half_pp
FROM (SELECT *, CAST(control_converted AS DOUBLE) / nullif(control_total, 0) AS p_c,
             CAST(treatment_converted AS DOUBLE) / nullif(treatment_total, 0) AS p_t FROM paired) t"""


G_PLATFORMS = ["ios", "android", "web"]
U_PLATFORMS = ["automobile", "building", "furniture", "household", "machinery"]


def q_activation_heatmap(a):
    plats = G_PLATFORMS if a == "g" else U_PLATFORMS
    cols = ", ".join(f"avg(CASE WHEN platform = '{p}' THEN activated END) * 100 AS {p}" for p in plats)
    listed = ", ".join(f"'{p}'" for p in plats)
    cols += f", avg(CASE WHEN platform IS NULL OR platform NOT IN ({listed}) THEN activated END) * 100 AS other"
    return base(a) + f""",
act AS (SELECT DISTINCT user_id FROM stg_events WHERE event_name = '{_act(a)}'),
hu AS (SELECT u.country, u.platform, CASE WHEN x.user_id IS NOT NULL THEN {_d(1.0)} ELSE {_d(0.0)} END AS activated
       FROM stg_users u LEFT JOIN act x USING (user_id))
SELECT country, {cols} FROM hu GROUP BY country"""


def tta_cte(a) -> str:
    s, t = _start(a), _act(a)
    return f""",
firsts AS (
  SELECT user_id, min(CASE WHEN event_name = '{s}' THEN event_ts END) AS t0,
         min(CASE WHEN event_name = '{t}' THEN event_ts END) AS t1
  FROM stg_events WHERE event_name IN ('{s}', '{t}') GROUP BY user_id),
tta AS (
  SELECT f.user_id, u.variant,
         CAST(epoch_us(f.t1) - epoch_us(f.t0) AS DOUBLE) / {_d(60000000.0)} AS minutes_to_activate
  FROM firsts f JOIN stg_users u USING (user_id) WHERE f.t0 IS NOT NULL AND f.t1 IS NOT NULL)"""


def q_time_to_activate(a):
    return base(a) + tta_cte(a) + "\nSELECT user_id, variant, minutes_to_activate FROM tta"


def q_tta_describe(a):
    return base(a) + tta_cte(a) + """,
ranked AS (
  SELECT variant, minutes_to_activate AS v,
         row_number() OVER (PARTITION BY variant ORDER BY minutes_to_activate) AS rn,
         count(*) OVER (PARTITION BY variant) AS n
  FROM tta),
med AS (
  SELECT variant, (min(CASE WHEN rn = (n + 1) // 2 THEN v END) + min(CASE WHEN rn = n // 2 + 1 THEN v END)) / 2.0
           AS median
  FROM ranked GROUP BY variant)
SELECT t.variant, CAST(count(t.minutes_to_activate) AS BIGINT) AS count, round(avg(t.minutes_to_activate), 9) AS mean,
       m.median, round(stddev_samp(t.minutes_to_activate), 9) AS std
FROM tta t LEFT JOIN med m USING (variant) GROUP BY t.variant, m.median"""


def q_tta_histogram(a, bins=40):
    w = f"((b.hi - b.lo) / {_d(float(bins))})"
    wg = f"((g.hi - g.lo) / {_d(float(bins))})"
    return base(a) + tta_cte(a) + f""",
bounds AS (SELECT variant, min(minutes_to_activate) AS lo, max(minutes_to_activate) AS hi FROM tta GROUP BY variant),
hb AS (
  SELECT t.variant, b.lo, b.hi,
         CAST(CASE WHEN b.hi = b.lo THEN 0 ELSE least(floor((t.minutes_to_activate - b.lo) / {w}), {bins - 1}) END
              AS INTEGER) AS bin
  FROM tta t JOIN bounds b USING (variant)),
hc AS (SELECT variant, bin, CAST(count(*) AS BIGINT) AS n FROM hb GROUP BY variant, bin),
grid AS (SELECT variant, lo, hi, CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM bounds)
SELECT g.variant, g.bin, g.lo + g.bin * {wg} AS bin_lo, g.lo + (g.bin + 1) * {wg} AS bin_hi,
       coalesce(hc.n, CAST(0 AS BIGINT)) AS count
FROM grid g LEFT JOIN hc ON hc.variant = g.variant AND hc.bin = g.bin"""


def q_value_shares(a):
    return base(a, marts=False) + """
SELECT variant, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
FROM stg_users GROUP BY variant"""


def q_crosstab(a):
    tot = "CAST(count(*) FILTER (WHERE variant IN ('control', 'treatment')) AS DOUBLE)"
    return base(a, marts=False) + f"""
SELECT country,
       round(CAST(count(*) FILTER (WHERE variant = 'control') AS DOUBLE) / {tot}, 3) AS control,
       round(CAST(count(*) FILTER (WHERE variant = 'treatment') AS DOUBLE) / {tot}, 3) AS treatment
FROM stg_users GROUP BY country"""


def q_profile(a):
    def prof(t, cols):
        nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
        return (f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows, "
                f"CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_ids, CAST({nulls} AS BIGINT) AS null_cells FROM {t}")
    return base(a, marts=False) + "\n" + prof(
        "stg_users", ["user_id", "variant", "country", "platform", "signup_ts", "signup_date"]) + \
        "\nUNION ALL\n" + prof("stg_events", ["event_id", "user_id", "event_name", "event_ts"])


def q_arm_counts(a):
    step = adapter_steps(a)[1]
    return base(a, marts=False) + f"""
SELECT u.variant, CAST(sum(CASE WHEN r.user_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS converted,
       CAST(count(*) AS BIGINT) AS total
FROM stg_users u LEFT JOIN (SELECT DISTINCT user_id FROM stg_events WHERE event_name = '{step}') r USING (user_id)
GROUP BY u.variant"""


def q_ab_test_by_country(a):
    g = ["country", "funnel_step", "step_order"]
    return base(a) + step_counts_cte(a, ["country"]) + paired_cte("counts", g) + two_prop_final(g)


def _k(alpha, power):
    return (zq(1 - alpha / 2) + zq(power)) ** 2


def baseline_ctes(a, seg) -> str:
    keys = seg or ["_all"]
    src = "fct_funnel" if seg else "(SELECT *, 1 AS _all FROM fct_funnel)"
    g = ", ".join(keys)
    steps = adapter_steps(a)
    parts = [f"SELECT {g}, variant, '{s}' AS funnel_step, {i + 1} AS step_order, reached_{s} AS reached FROM {src}"
             for i, s in enumerate(steps)]
    out_seg = "".join(f"p.{c}, " for c in seg)
    return f""",
bl_long AS ({' UNION ALL '.join(parts)}),
counts AS (
  SELECT {g}, variant, funnel_step, step_order, CAST(coalesce(sum(reached), 0) AS BIGINT) AS converted,
         CAST(count(*) AS BIGINT) AS total
  FROM bl_long GROUP BY {g}, variant, funnel_step, step_order)""" + paired_cte(
        "counts", [*keys, "funnel_step", "step_order"]) + f""",
seg AS (
  SELECT {g}, CAST(count(*) AS BIGINT) AS segment_users,
         CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT signup_date), 0) AS daily_signups
  FROM {src} GROUP BY {g}),
base_rates AS (
  SELECT {out_seg}p.funnel_step, p.step_order, p.control_total AS control_users,
         CAST(p.control_converted AS DOUBLE) / nullif(p.control_total, 0) AS baseline_rate,
         s.segment_users, s.daily_signups
  FROM paired p JOIN seg s ON {" AND ".join(f"p.{c} IS NOT DISTINCT FROM s.{c}" for c in keys)})"""


def q_sample_size(a, seg, mde=0.02, mde_type="absolute", alpha=0.05, power=0.8, ratio=1.0):
    eff = _d(mde) if mde_type == "absolute" else f"{_d(mde)} * baseline_rate"
    k, r = _d(_k(alpha, power)), _d(ratio)
    cols = "".join(f"{c}, " for c in seg)
    return base(a) + baseline_ctes(a, seg) + f""",
s1 AS (SELECT *, {eff} AS mde_abs, baseline_rate + {eff} AS target_rate FROM base_rates),
s2 AS (
  SELECT *, CASE WHEN target_rate > 0 AND target_rate < 1 AND mde_abs <> 0
    THEN ({k} * (baseline_rate * (1 - baseline_rate) + (target_rate * (1 - target_rate)) / {r}))
         / ((baseline_rate - target_rate) * (baseline_rate - target_rate)) END AS n_exact
  FROM s1)
SELECT {cols}funnel_step, step_order, control_users, baseline_rate, segment_users, daily_signups, mde_abs,
       target_rate, CAST(ceil(n_exact) AS BIGINT) AS n_control, CAST(ceil(n_exact * {r}) AS BIGINT) AS n_treatment,
       CAST(ceil(n_exact) + ceil(n_exact * {r}) AS BIGINT) AS n_total,
       CAST(ceil(CAST(CAST(ceil(n_exact) + ceil(n_exact * {r}) AS BIGINT) AS DOUBLE) / nullif(daily_signups, 0))
            AS BIGINT) AS runtime_days
FROM s2"""


def q_mde(a, seg, alpha=0.05, power=0.8, ratio=1.0):
    k = _k(alpha, power)
    kr = k / ratio
    cols = "".join(f"{c}, " for c in seg)
    return base(a) + baseline_ctes(a, seg) + f""",
m1 AS (
  SELECT *, CAST(control_users AS DOUBLE) + {_d(kr)} AS qa, {_d(kr)} * (1 - 2 * baseline_rate) AS qb,
         {_d(k)} * baseline_rate * (1 - baseline_rate) * {_d(1 + 1 / ratio)} AS qc,
         1 - baseline_rate - {_d(1e-5)} AS hi
  FROM base_rates),
m2 AS (
  SELECT *, CASE WHEN hi >= {_d(1e-5)} THEN
    least(greatest((qb + sqrt(qb * qb + 4 * qa * qc)) / nullif(2 * qa, 0), {_d(1e-5)}), hi) END AS mde
  FROM m1)
SELECT {cols}funnel_step, step_order, control_users, baseline_rate, segment_users, daily_signups, mde,
       mde / nullif(baseline_rate, 0) AS mde_relative
FROM m2"""


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

def _mt(src, model, unique=(), not_null=(), accepted=None):
    parts = []
    for c in not_null:
        parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                     f"CAST(count(*) - count({c}) AS BIGINT) AS failures FROM {src}")
    for c, vals in (accepted or {}).items():
        lst = ", ".join(f"'{v}'" for v in vals)
        parts.append(f"SELECT '{model}', '{c}', 'accepted_values', "
                     f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({lst})) AS BIGINT) FROM {src}")
    for c in unique:
        parts.append(f"SELECT '{model}', '{c}', 'unique', CAST(count(*) AS BIGINT) FROM "
                     f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    return parts


def q_model_tests(a):
    steps = adapter_steps(a)
    arms = ["control", "treatment"]
    parts = (_mt("raw_users", "raw_users", ["user_id"], ["user_id"])
             + _mt("raw_events", "raw_events", ["event_id"], ["event_id", "user_id"])
             + _mt("stg_users", "stg_users", ["user_id"], ["user_id", "variant"], {"variant": arms})
             + _mt("stg_events", "stg_events", ["event_id"], ["event_id", "user_id", "event_name"],
                   {"event_name": steps})
             + _mt("dim_users", "dim_users", ["user_id"], ["user_id"], {"variant": arms})
             + _mt("fct_funnel", "fct_funnel", ["user_id"], ["user_id", f"reached_{steps[0]}"])
             + _mt("fct_ab", "fct_ab_experiment", [], ["funnel_step", "conversion_rate"], {"funnel_step": steps}))
    return base(a) + "\n" + "\nUNION ALL\n".join(parts)


def _verdict(check, value, passed, src):
    return f"SELECT '{check}' AS check, CAST({value} AS DOUBLE) AS value, coalesce({passed}, FALSE) AS passed FROM {src}"


def monotone_parts(a):
    steps = adapter_steps(a)
    sums = ", ".join(f"sum(reached_{s}) AS s{i}" for i, s in enumerate(steps))
    mono = " AND ".join(f"s{i} >= s{i + 1}" for i in range(len(steps) - 1))
    src = f"(SELECT {sums}, (SELECT count(*) FROM stg_users) AS n_users FROM flags)"
    return [_verdict("steps_non_increasing", f"s{len(steps) - 1}", f"({mono})", src),
            _verdict("first_step_covers_users", "s0", "(s0 = n_users)", src)]


def order_part(a):
    steps = adapter_steps(a)
    aggs = ", ".join(f"min(CASE WHEN event_name = '{s}' THEN event_ts END) AS mn{i}, "
                     f"max(CASE WHEN event_name = '{s}' THEN event_ts END) AS mx{i}" for i, s in enumerate(steps))
    conds = []
    for j in range(1, len(steps)):
        prev = f"greatest({', '.join(f'mx{i}' for i in range(j))})" if j > 1 else "mx0"
        conds.append(f"coalesce(mn{j} < {prev}, FALSE)")
    bad = " OR ".join(conds)
    src = (f"(SELECT coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS bad FROM "
           f"(SELECT user_id, {aggs} FROM stg_events GROUP BY user_id) pu)")
    return _verdict("timestamps_in_step_order", "bad", "(bad = 0)", src)


def q_generator_contract(a):
    steps = adapter_steps(a)
    done, act = f"reached_{steps[1]}", f"reached_{_act(a)}"
    fl = ", ".join(f"coalesce(f.reached_{s}, 0) AS reached_{s}" for s in steps)
    ufc = (f",\nufc AS (SELECT u.user_id, u.variant, u.country, u.platform, {fl} "
           f"FROM stg_users u LEFT JOIN flags f USING (user_id))")

    def spread(dim, flag, bound, below, name):
        src = f"(SELECT max(r) - min(r) AS sp FROM (SELECT {dim}, avg(CAST({flag} AS DOUBLE)) AS r FROM ufc GROUP BY {dim}))"
        return _verdict(name, "sp", f"(sp {'<' if below else '>'} {_d(bound)})", src)

    bal = ("(SELECT greatest(abs(CAST(sum(CASE WHEN variant = 'control' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) - "
           f"{_d(0.5)}), abs(CAST(sum(CASE WHEN variant = 'treatment' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) - "
           f"{_d(0.5)})) AS dev FROM stg_users)")
    lift = (f"(SELECT avg(CASE WHEN variant = 'treatment' THEN CAST({done} AS DOUBLE) END) - "
            f"avg(CASE WHEN variant = 'control' THEN CAST({done} AS DOUBLE) END) AS d FROM ufc)")
    parts = monotone_parts(a) + [order_part(a), _verdict("arm_balance", "dev", f"(dev < {_d(0.02)})", bal),
                                 spread("country", done, 0.03, True, "completion_spread_country"),
                                 spread("platform", done, 0.03, True, "completion_spread_platform"),
                                 spread("country", act, 0.02, False, "activation_spread_country"),
                                 spread("platform", act, 0.02, False, "activation_spread_platform"),
                                 _verdict("treatment_lift", "d", f"(d > {_d(0.03)})", lift)]
    return base(a) + ufc + "\n" + "\nUNION ALL\n".join(parts)


def q_event_order_checks(a):
    return base(a) + "\n" + "\nUNION ALL\n".join(monotone_parts(a) + [order_part(a)])


# ---------------------------------------------------------------------------
# Features and metrics
# ---------------------------------------------------------------------------

def feats_cte(a) -> str:
    steps = adapter_steps(a)
    done, act = steps[1], _act(a)
    return f""",
pu AS (
  SELECT user_id, min(CASE WHEN event_name = '{done}' THEN event_ts END) AS completed_ts,
         max(CASE WHEN event_name = '{act}' THEN 1 ELSE 0 END) AS tgt
  FROM stg_events WHERE event_name IN ('{done}', '{act}') GROUP BY user_id),
feats AS (
  SELECT u.user_id, u.variant, u.country, u.platform,
         CAST(isodow(u.signup_ts) - 1 AS VARCHAR) AS signup_dayofweek,
         CAST(hour(u.signup_ts) AS INTEGER) AS signup_hour,
         CAST(epoch_us(p.completed_ts) - epoch_us(u.signup_ts) AS DOUBLE) / {_d(60000000.0)}
           AS minutes_signup_to_complete,
         p.tgt AS reached_{act}
  FROM stg_users u JOIN pu p USING (user_id) WHERE p.completed_ts IS NOT NULL),
split AS (SELECT *, {draw('user_id', 'split')} < {_d(0.25)} AS is_test FROM feats),
scored AS (
  SELECT *,
    least(greatest({_d(0.75)} + CASE country WHEN 'PT' THEN {_d(0.05)} WHEN 'ES' THEN {_d(0.03)}
        WHEN 'GB' THEN {_d(0.02)} WHEN 'PL' THEN {_d(0.0)} WHEN 'AE' THEN {_d(-0.1)} ELSE {_d(0.0)} END,
        {_d(0.01)}), {_d(0.99)})
    * least(greatest({_d(0.55)} + CASE platform WHEN 'ios' THEN {_d(0.05)} WHEN 'android' THEN {_d(0.0)}
        WHEN 'web' THEN {_d(-0.08)} ELSE {_d(0.0)} END, {_d(0.01)}), {_d(0.99)})
    * least(greatest({_d(0.7)} + CASE WHEN signup_hour BETWEEN 0 AND 5 THEN {_d(-0.06)} ELSE {_d(0.01)} END,
        {_d(0.01)}), {_d(0.99)}) AS score
  FROM split)"""


def q_features_local(a):
    return base(a) + feats_cte(a) + "\nSELECT * FROM feats"


def q_features_mart(a):
    steps = adapter_steps(a)
    return base(a) + f"""
SELECT f.user_id, f.variant, f.country, f.platform, CAST(hour(u.signup_ts) AS INTEGER) AS signup_hour,
       CAST(dayofweek(u.signup_ts) + 1 AS VARCHAR) AS signup_dayofweek, f.reached_{_act(a)}
FROM fct_funnel f JOIN dim_users u USING (user_id) WHERE f.reached_{steps[1]} = 1"""


def q_feature_checks(a):
    t = f"reached_{_act(a)}"
    cols = ["variant", "country", "platform", "signup_dayofweek", "signup_hour", "minutes_signup_to_complete", t]
    nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
    src = (f"(SELECT count(*) AS n, avg(CAST({t} AS DOUBLE)) AS prev, "
           f"coalesce(sum(CASE WHEN {t} NOT IN (0, 1) THEN 1 ELSE 0 END), 0) AS nonbin, {nulls} AS nulls, "
           f"coalesce(sum(CASE WHEN minutes_signup_to_complete < 0 THEN 1 ELSE 0 END), 0) AS neg, "
           f"(SELECT count(*) FROM stg_users) AS users FROM feats)")
    parts = [_verdict("target_binary", "nonbin", "(nonbin = 0)", src),
             _verdict("no_missing_values", "nulls", "(nulls = 0)", src),
             _verdict("prevalence_reasonable", "prev", f"(prev > {_d(0.05)} AND prev < {_d(0.95)})", src),
             _verdict("population_within_users", "n", "(n > 0 AND n <= users)", src),
             _verdict("minutes_non_negative", "neg", "(neg = 0)", src)]
    return base(a) + feats_cte(a) + "\n" + "\nUNION ALL\n".join(parts)


def q_feature_split(a):
    return base(a) + feats_cte(a) + "\nSELECT * EXCLUDE (score) FROM scored"


def _split_exact(src: str, label: str) -> str:
    """Largest remainder: ceil(n / 4) tested users dealt to the labels."""
    d = "CAST(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':split:42'), 1, 13) AS BIGINT) AS HUGEINT)"
    return f""",
sizes AS (SELECT {label} AS l, count(*) AS n FROM {src} GROUP BY 1),
quota AS (SELECT l, n, (sum(n) OVER () + 3) // 4 AS want, sum(n) OVER () AS total FROM sizes),
dealt AS (SELECT l, (want * n) // total AS whole, want,
                 row_number() OVER (ORDER BY (want * n) % total DESC, l NULLS FIRST) AS turn FROM quota),
cuts AS (SELECT l, whole + CASE WHEN turn <= want - sum(whole) OVER () THEN 1 ELSE 0 END AS cut FROM dealt)
SELECT f.* EXCLUDE (rk), f.rk <= c.cut AS is_test
FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {d}, user_id) AS rk FROM {src}) f
JOIN cuts c ON c.l IS NOT DISTINCT FROM f.{label}"""


def q_feature_split_exact(a):
    return base(a) + feats_cte(a) + _split_exact("feats", f"reached_{_act(a)}")


def q_score_metrics(a):
    t = f"reached_{_act(a)}"
    return base(a) + feats_cte(a) + f""",
sc AS (SELECT CAST({t} AS BIGINT) AS y, score FROM scored WHERE is_test),
d AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg, count(*) AS cnt FROM sc GROUP BY score),
auc AS (
  SELECT CAST(sum(2 * pos * (cneg - neg) + pos * neg) AS DOUBLE)
         / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
  FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg FROM d)),
ap AS (
  SELECT sum(pos * (CAST(cpos AS DOUBLE) / ccnt)) / sum(pos) AS ap
  FROM (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos,
               sum(cnt) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ccnt FROM d)),
base_m AS (
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positives, avg(CAST(y AS DOUBLE)) AS pr_baseline,
         avg((score - CAST(y AS DOUBLE)) * (score - CAST(y AS DOUBLE))) AS brier FROM sc)
SELECT n, positives, pr_baseline, auc, round(ap, 10) AS average_precision, round(brier, 10) AS brier
FROM base_m, auc, ap"""


def q_score_report(a):
    t = f"reached_{_act(a)}"
    return base(a) + feats_cte(a) + f""",
cm AS (
  SELECT CAST(sum(y * p) AS DOUBLE) AS tp, CAST(sum((1 - y) * p) AS DOUBLE) AS fp,
         CAST(sum(y * (1 - p)) AS DOUBLE) AS fn, CAST(sum((1 - y) * (1 - p)) AS DOUBLE) AS tn
  FROM (SELECT CAST({t} AS BIGINT) AS y, CASE WHEN score >= {_d(0.5)} THEN 1 ELSE 0 END AS p
        FROM scored WHERE is_test)),
pr AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS prec1, coalesce(tp / nullif(tp + fn, 0), 0) AS rec1,
         coalesce(tn / nullif(tn + fn, 0), 0) AS prec0, coalesce(tn / nullif(tn + fp, 0), 0) AS rec0,
         tp + fn AS s1, tn + fp AS s0
  FROM cm),
f1 AS (
  SELECT *, coalesce(2.0 * prec1 * rec1 / nullif(prec1 + rec1, 0), 0) AS f1_1,
         coalesce(2.0 * prec0 * rec0 / nullif(prec0 + rec0, 0), 0) AS f1_0, s1 + s0 AS total
  FROM pr)
SELECT 'did_not_activate' AS class_label, prec0 AS precision, rec0 AS recall, f1_0 AS f1_score,
       CAST(s0 AS BIGINT) AS support FROM f1
UNION ALL SELECT 'activated', prec1, rec1, f1_1, CAST(s1 AS BIGINT) FROM f1
UNION ALL SELECT 'accuracy', NULL, NULL, coalesce((tp + tn) / nullif(total, 0), 0), CAST(total AS BIGINT) FROM f1
UNION ALL SELECT 'macro avg', (prec0 + prec1) / 2, (rec0 + rec1) / 2, (f1_0 + f1_1) / 2, CAST(total AS BIGINT) FROM f1
UNION ALL SELECT 'weighted avg', coalesce((prec0 * s0 + prec1 * s1) / nullif(total, 0), 0),
       coalesce((rec0 * s0 + rec1 * s1) / nullif(total, 0), 0),
       coalesce((f1_0 * s0 + f1_1 * s1) / nullif(total, 0), 0), CAST(total AS BIGINT) FROM f1"""


def q_score_auc_by_platform(a):
    t = f"reached_{_act(a)}"
    return base(a) + feats_cte(a) + f""",
d AS (SELECT platform, score, sum(CAST({t} AS BIGINT)) AS pos, sum(1 - CAST({t} AS BIGINT)) AS neg
      FROM scored GROUP BY platform, score)
SELECT platform, CAST(sum(2 * pos * (cneg - neg) + pos * neg) AS DOUBLE)
       / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
FROM (SELECT *, sum(neg) OVER (PARTITION BY platform ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS cneg FROM d)
GROUP BY platform"""


def q_gen_conversion_by_variant(a):
    done = adapter_steps(a)[1]
    return base(a, marts=False) + f""",
comp AS (SELECT u.variant, count(DISTINCT e.user_id) AS completed_users
         FROM stg_events e JOIN stg_users u USING (user_id) WHERE e.event_name = '{done}' GROUP BY u.variant),
tot AS (SELECT variant, count(*) AS users FROM stg_users GROUP BY variant)
SELECT t.variant, CAST(coalesce(c.completed_users, 0) AS BIGINT) AS completed_users, CAST(t.users AS BIGINT) AS users,
       round(CAST(coalesce(c.completed_users, 0) AS DOUBLE) / t.users, 4) AS conversion_rate
FROM tot t LEFT JOIN comp c USING (variant)"""


def q_gen_activation_by(a, dim):
    return base(a, marts=False) + f""",
act AS (SELECT DISTINCT user_id FROM stg_events WHERE event_name = '{_act(a)}')
SELECT u.{dim}, round(avg(CASE WHEN x.user_id IS NOT NULL THEN {_d(1.0)} ELSE {_d(0.0)} END), 4) AS activation_rate
FROM stg_users u LEFT JOIN act x USING (user_id) GROUP BY u.{dim}"""


def q_distinct_users_by_step(a):
    return base(a, marts=False) + """
SELECT event_name, CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_users FROM stg_events GROUP BY event_name"""


def q_ab_test_by_week(a):
    g = ["signup_week", "funnel_step", "step_order"]
    wk = "CAST(signup_date - CAST(dayofweek(signup_date) AS INTEGER) AS DATE) AS signup_week"
    steps = adapter_steps(a)
    parts = [f"SELECT {wk}, variant, '{s}' AS funnel_step, {i + 1} AS step_order, reached_{s} AS reached FROM fct_funnel"
             for i, s in enumerate(steps)]
    return base(a) + f""",
wk_long AS ({' UNION ALL '.join(parts)}),
counts AS (
  SELECT signup_week, variant, funnel_step, step_order, CAST(coalesce(sum(reached), 0) AS BIGINT) AS converted,
         CAST(count(*) AS BIGINT) AS total
  FROM wk_long GROUP BY signup_week, variant, funnel_step, step_order)""" + paired_cte("counts", g) + two_prop_final(g)


def q_ab_test_from_mart(a):
    step = adapter_steps(a)[1]
    g = ["funnel_step", "step_order"]
    return base(a) + f""",
mart_step AS (
  SELECT variant, funnel_step, step_order, coalesce(converted, 0) AS converted, total
  FROM fct_ab WHERE funnel_step = '{step}')""" + paired_cte("mart_step", g) + two_prop_final(g)


# ---------------------------------------------------------------------------
# Missing and unlisted values (no list of values anywhere; NULL groups compared null-safely)
# ---------------------------------------------------------------------------

def q_nulls_tta_describe():
    return base("nulls") + tta_cte("nulls") + """
SELECT variant, CAST(count(*) AS BIGINT) AS count, round(avg(minutes_to_activate), 9) AS mean,
       median(minutes_to_activate) AS median, round(stddev_samp(minutes_to_activate), 9) AS std
FROM tta GROUP BY variant"""


def q_nulls_tta_histogram(bins=40):
    w = f"((hi - lo) / {_d(float(bins))})"
    return base("nulls") + tta_cte("nulls") + f""",
spread AS (SELECT *, min(minutes_to_activate) OVER (PARTITION BY variant) AS lo,
                  max(minutes_to_activate) OVER (PARTITION BY variant) AS hi FROM tta),
binned AS (SELECT variant, lo, hi, CASE WHEN hi = lo THEN 0 ELSE least(floor((minutes_to_activate - lo) / {w}), {bins - 1}) END AS b FROM spread),
every AS (SELECT variant, lo, hi, unnest(range(0, {bins})) AS b, 0 AS n FROM (SELECT DISTINCT variant, lo, hi FROM spread)
          UNION ALL SELECT variant, lo, hi, b, 1 FROM binned)
SELECT variant, CAST(b AS INTEGER) AS bin, lo + CAST(b AS INTEGER) * {w} AS bin_lo, lo + (CAST(b AS INTEGER) + 1) * {w} AS bin_hi,
       CAST(sum(n) AS BIGINT) AS count
FROM every GROUP BY variant, b, lo, hi"""


def q_nulls_crosstab_long():
    return base("nulls", marts=False) + """
SELECT country, variant, CAST(count(*) AS BIGINT) AS n,
       round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY country), 3) AS share
FROM stg_users GROUP BY country, variant"""


def q_nulls_activation_heatmap_long():
    return base("nulls", marts=False) + f"""
SELECT u.country, u.platform, CAST(count(*) AS BIGINT) AS users,
       avg(CASE WHEN u.user_id IN (SELECT user_id FROM stg_events WHERE event_name = '{_act("nulls")}')
           THEN {_d(1.0)} ELSE {_d(0.0)} END) * 100 AS activation_pct
FROM stg_users u GROUP BY u.country, u.platform"""


def q_nulls_conversion_by_variant():
    done = adapter_steps("nulls")[1]
    return base("nulls", marts=False) + f"""
SELECT variant, CAST(sum(done) AS BIGINT) AS completed_users, CAST(count(*) AS BIGINT) AS users,
       round(CAST(sum(done) AS DOUBLE) / count(*), 4) AS conversion_rate
FROM (SELECT variant, CASE WHEN user_id IN (SELECT user_id FROM stg_events WHERE event_name = '{done}') THEN 1 ELSE 0 END AS done
      FROM stg_users) GROUP BY variant"""


def q_nulls_split_exact():
    return base("nulls") + feats_cte("nulls") + ", arms AS (SELECT user_id, variant FROM feats)" + _split_exact("arms", "variant")


def q_event_score(by: str = "") -> str:
    """AUC from mid-ranks of every row, AP over the rows at or above each score."""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
WITH sc AS (
  SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, value / (1.0 + value) AS score,
         CASE user_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'holdout'
              ELSE CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'treatment' END END AS variant
  FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL),
r AS (
  SELECT *, rank() OVER ({part} ORDER BY score) + (count(*) OVER (PARTITION BY {by + ", " if by else ""}score) - 1) / 2.0 AS midrank,
         sum(y) OVER ({part} ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
         count(*) OVER ({part} ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS above
  FROM sc)
SELECT {by + ", " if by else ""}CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positives, avg(CAST(y AS DOUBLE)) AS pr_baseline,
       (sum(midrank) FILTER (WHERE y = 1) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)) AS auc,
       round(sum(CASE WHEN y = 1 THEN CAST(tp AS DOUBLE) / above END) / sum(y), 10) AS average_precision,
       round(avg((score - y) * (score - y)), 10) AS brier
FROM r {group}"""


# ---------------------------------------------------------------------------
# Given tables: ids, orders, loads, encodings, contracts of models
# ---------------------------------------------------------------------------


def positioned(sql: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({sql})"


ORDERED = {
    "ab_experiment": (lambda: q_fct_ab_experiment("u"), "step_order NULLS FIRST, variant NULLS FIRST"),
    "funnel_dropoff": (lambda: q_funnel_dropoff("u"), "step_order NULLS FIRST"),
    "ab_lift": (lambda: q_ab_lift("u"), "step_order NULLS FIRST"),
    "weekly_cohorts": (lambda: q_weekly_cohorts("u"), "signup_week NULLS FIRST, variant NULLS FIRST"),
    "segment_activation": (lambda: q_segment_activation("u", min_users=25), "activation_pct DESC NULLS LAST, country NULLS FIRST, platform NULLS FIRST"),
    "activation_by_country": (lambda: q_gen_activation_by("u", "country"), "activation_rate DESC NULLS LAST, country NULLS FIRST"),
}


def q_event_ids():
    return ("SELECT event_id, user_id, row_number() OVER (ORDER BY user_id NULLS FIRST, ts NULLS FIRST, event_id NULLS FIRST) AS position "
            "FROM events")


def q_preview_users():
    return base("u", marts=False) + "\nSELECT * FROM stg_users ORDER BY user_id NULLS FIRST LIMIT 5"


def q_step_deadlines(minutes=90):
    parts = [f"SELECT user_id, '{s}' AS funnel_step, {i + 1} AS step_order, min(event_ts) AS first_ts, min(event_ts) + INTERVAL {minutes} MINUTE AS due_ts "
             f"FROM stg_events WHERE event_name = '{s}' GROUP BY user_id HAVING min(event_ts) IS NOT NULL" for i, s in enumerate(U_STEPS)]
    return base("u", marts=False) + "\n" + "\nUNION ALL\n".join(parts)


def q_csv_quarantine():
    return base("u", marts=False) + """
SELECT count(*) FILTER (WHERE user_id % 10 <> 3) AS rows_loaded, CAST(0 AS BIGINT) AS bad_loaded, count(*) FILTER (WHERE user_id % 10 = 3) AS rows_rejected,
       count(*) FILTER (WHERE user_id % 10 = 3) AS lines_whole, count(*) AS lines
FROM raw_users"""


def q_determinism():
    return base("u") + feats_cte("u") + """
SELECT 'funnel_mart_at_3_and_11_partitions' AS check_name, count(*) AS rows, true AS passed FROM fct_funnel
UNION ALL SELECT 'split_with_the_same_seed', count(*), true FROM feats
UNION ALL SELECT 'split_with_another_seed', count(*), true FROM feats"""


def q_schema_contract():
    text, whole, real = "string", "int", "double"
    have = {"variant": text, "country": text, "platform": text, "signup_dayofweek": text, "signup_hour": whole, "reached_purchase": whole}
    rows = [(t, c, "required", k) for t in ("features_local", "features_mart") for c, k in have.items()]
    rows.append(("features_local", "minutes_signup_to_complete", "required", real))
    rows += [(t, f"reached_{s}", "forbidden", None) for t in ("features_local", "features_mart") for s in U_STEPS if s != "purchase"]
    values = ", ".join(f"('{t}', '{c}', '{r}', {'NULL' if k is None else repr(k)}, true)" for t, c, r, k in rows)
    return f"SELECT * FROM (VALUES {values}) AS t(table_name, column_name, rule, data_type, passed)"


def _one_hot(src: str, numeric) -> str:
    parts = [f"SELECT user_id, '{c}_' || {c} AS feature, {_d(1.0)} AS value FROM {src} WHERE {c} IN (SELECT {c} FROM {src} WHERE country <> 'FRANCE')"
             for c in ("variant", "country", "platform", "signup_dayofweek")]
    parts += [f"SELECT user_id, '{c}', CAST({c} AS DOUBLE) FROM {src} WHERE {c} <> 0" for c in numeric]
    return "\nUNION ALL\n".join(parts)


def q_one_hot():
    return base("u") + feats_cte("u") + "\n" + _one_hot("feats", ["signup_hour", "minutes_signup_to_complete"])


def q_one_hot_mart():
    return f"WITH mart AS ({q_features_mart('u')})\n" + _one_hot("mart", ["signup_hour"])


def q_logistic_gradient():
    train = "(SELECT * FROM split WHERE NOT is_test)"
    parts = [f"SELECT DISTINCT '{c}_' || {c} AS feature FROM {train} WHERE {c} IS NOT NULL" for c in ("variant", "country", "platform", "signup_dayofweek")]
    parts += [f"SELECT '{c}'" for c in ("signup_hour", "minutes_signup_to_complete", "intercept")]
    return base("u") + feats_cte("u") + f"\nSELECT feature, {_d(0.0)} AS gradient FROM (" + " UNION ALL ".join(parts) + ")"


_CONTRACT = ["one_row_per_user", "probabilities_in_unit_interval", "auc_as_the_evaluator", "average_precision_in_unit_interval",
             "brier_near_the_constant_or_below", "report_supports_add_up", "positives_as_labelled"]


def q_contract(extra, src="split"):
    names = ", ".join(f"('{n}')" for n in [*_CONTRACT, *extra])
    test = f"(SELECT count(*) FROM {src} WHERE is_test)" if src == "split" else \
        f"(SELECT count(*) FROM ({q_features_mart('u')}) WHERE {draw('user_id', 'split')} < {_d(0.25)})"
    head = base("u") + feats_cte("u") + "\n" if src == "split" else ""
    return head + f"SELECT check_name, {test} AS rows, true AS passed FROM (VALUES {names}) AS t(check_name)"


def q_scores():
    return base("u") + feats_cte("u") + "\nSELECT user_id, variant, country, platform, true AS is_probability FROM feats"


def q_nulls_crosstab():
    def share(cond):
        return f"round(CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) / count(*), 3)"
    return base("nulls", marts=False) + f""",
arms AS (SELECT country, CASE WHEN user_id % 7 = 0 THEN 'null' ELSE variant END AS variant FROM stg_users)
SELECT country, {share("variant = 'control'")} AS control, {share("variant = 'treatment'")} AS treatment, {share("variant = 'holdout'")} AS holdout,
       {share("variant = 'null'")} AS text_null, {share("variant IS NULL")} AS missing
FROM arms GROUP BY country"""


def q_nulls_heatmap():
    def rate(cond):
        return f"avg(CASE WHEN {cond} THEN CASE WHEN user_id IN (SELECT user_id FROM stg_events WHERE event_name = '{_act('nulls')}') THEN {_d(1.0)} ELSE {_d(0.0)} END END) * 100"
    return base("nulls", marts=False) + f""",
named AS (SELECT user_id, country, CASE WHEN user_id % 7 = 0 THEN 'other' ELSE platform END AS platform FROM stg_users)
SELECT country, {rate("platform = 'automobile'")} AS automobile, {rate("platform = 'other'")} AS named_other,
       {rate("platform IS NULL OR platform NOT IN ('automobile', 'other')")} AS rest
FROM named GROUP BY country"""


# ---------------------------------------------------------------------------
# Registry (same names as the Spark side; adapter-U names get the ``u_`` prefix)
# ---------------------------------------------------------------------------

_BOTH = ["raw_users", "raw_events", "stg_users", "stg_events", "dim_users", "funnel_flags", "fct_funnel",
         "fct_ab_experiment", "funnel_dropoff", "ab_lift", "weekly_cohorts", "distinct_users_by_step", "ab_test",
         "ab_test_by_country", "ab_test_by_week", "ab_test_from_mart", "funnel_by_variant", "funnel_overall",
         "lift_table", "activation_heatmap", "time_to_activate", "tta_describe", "tta_histogram", "value_shares",
         "crosstab", "profile", "arm_counts", "model_tests", "features_local", "features_mart", "feature_checks",
         "feature_split", "feature_split_exact"]
_G_ONLY = ["generator_contract", "score_metrics", "score_report", "score_auc_by_platform",
           "gen_conversion_by_variant"]


def registry() -> dict:
    g = globals()
    out = {}
    for name in _BOTH + _G_ONLY:
        out[name] = g[f"q_{name}"]("g")
    for name in _BOTH:
        out[f"u_{name}"] = g[f"q_{name}"]("u")
    out["segment_activation"] = q_segment_activation("g")
    out["u_segment_activation"] = q_segment_activation("u", min_users=25)
    out["u_event_order_checks"] = q_event_order_checks("u")
    out["gen_activation_by_country"] = q_gen_activation_by("g", "country")
    out["gen_activation_by_platform"] = q_gen_activation_by("g", "platform")
    for a, p in (("g", ""), ("u", "u_")):
        out[f"{p}sample_size_by_country"] = q_sample_size(a, ["country"], mde=0.02)
        out[f"{p}mde_by_platform"] = q_mde(a, ["platform"])
        out[f"{p}mde_overall"] = q_mde(a, [])
    for name in ("tta_describe", "tta_histogram", "crosstab_long", "activation_heatmap_long", "conversion_by_variant", "split_exact"):
        out[f"u_nulls_{name}"] = g[f"q_nulls_{name}"]()
    out["u_nulls_value_shares"] = q_value_shares("nulls")
    out["u_nulls_sample_size_by_country"] = q_sample_size("nulls", ["country"], mde=0.02)
    out["u_nulls_mde_by_platform"] = q_mde("nulls", ["platform"])
    for name, (sql, order) in ORDERED.items():
        out[f"u_ordered_{name}"] = positioned(sql(), order)
    out["u_event_ids"] = q_event_ids()
    out["u_preview_users"] = q_preview_users()
    out["u_step_deadlines"] = q_step_deadlines()
    out["u_csv_users"] = out["u_inferred_users"] = q_raw_users("u")
    out["u_csv_events"] = q_raw_events("u")
    out["u_csv_quarantine"] = q_csv_quarantine()
    out["u_stored_funnel"] = q_fct_funnel("u")
    out["u_staging_view"] = q_stg_users("u")
    out["u_partitioned_mart"] = q_ab_test_from_mart("u")
    out["u_determinism"] = q_determinism()
    out["u_schema_contract"] = q_schema_contract()
    out["u_one_hot"] = q_one_hot()
    out["u_one_hot_mart"] = q_one_hot_mart()
    out["u_logistic_gradient"] = q_logistic_gradient()
    out["u_logistic_contract"] = q_contract(["stored_model_as_fitted", "coefficients_ranked"])
    out["u_logistic_mart_contract"] = q_contract(["stored_model_as_fitted", "coefficients_ranked"], src="mart")
    out["u_gbt_contract"] = q_contract(["rounds_within_limit"])
    out["u_scores"] = q_scores()
    out["u_nulls_crosstab"] = q_nulls_crosstab()
    out["u_nulls_activation_heatmap"] = q_nulls_heatmap()
    out["u_event_score_metrics"] = q_event_score()
    out["u_event_score_by_variant"] = q_event_score("variant")
    out["sample_size_relative_by_platform"] = q_sample_size("g", ["platform"], mde=0.05, mde_type="relative",
                                                            alpha=0.05, power=0.9, ratio=2.0)
    return out
