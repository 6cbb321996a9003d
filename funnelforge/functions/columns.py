"""Column-level building blocks: every function returns a JVM-side Column.

Nothing here is a Python UDF; all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

import statistics

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Coefficients of the double-precision normal CDF of Hart (1968)
# as published by G. West, "Better approximations to cumulative normal
# functions", Wilmott (2005). Highest power first.
# ---------------------------------------------------------------------------
NORM_CDF_NUM = [0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
                112.079291497871, 221.213596169931, 220.206867912376]
NORM_CDF_DEN = [0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
                296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
NORM_CDF_SPLIT = 7.07106781186547
NORM_CDF_CUTOFF = 37.0
NORM_CDF_TAIL_SHIFT = 0.65
SQRT_2PI = 2.506628274631

# Confidence-interval multiplier of the lift report (a literal, distinct from the
# quantile used for power).
CI_Z = 1.96

TWO_POW_52 = float(2 ** 52)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(v: str) -> str:
    """Spark SQL string literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ident(name: str) -> str:
    """Spark SQL quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def _dlit(v: float) -> str:
    """Spark SQL double literal with the exact value of the Python float."""
    return f"{float(v)!r}D"


def norm_cdf_sql(x: str) -> str:
    """Standard normal CDF of the SQL expression ``x`` as Spark SQL text:
    lower tail by a degree 6/7 rational function below 7.07, a continued fraction above,
    0 beyond 37; the upper tail by symmetry."""
    a = f"abs({x})"

    def horner(c):
        acc = f"({_dlit(c[0])} * {a} + {_dlit(c[1])})"
        for k in c[2:]:
            acc = f"({acc} * {a} + {_dlit(k)})"
        return acc

    e = f"exp(-({a} * {a}) / {_dlit(2.0)})"
    body = f"(({e} * {horner(NORM_CDF_NUM)}) / {horner(NORM_CDF_DEN)})"
    cf = f"({a} + {_dlit(NORM_CDF_TAIL_SHIFT)})"
    for k in (4.0, 3.0, 2.0, 1.0):
        cf = f"({a} + {_dlit(k)} / {cf})"
    tail = f"({e} / {cf} / {_dlit(SQRT_2PI)})"
    lower = (f"(CASE WHEN {a} > {_dlit(NORM_CDF_CUTOFF)} THEN {_dlit(0.0)} "
             f"WHEN {a} < {_dlit(NORM_CDF_SPLIT)} THEN {body} ELSE {tail} END)")
    return f"(CASE WHEN {x} > 0 THEN {_dlit(1.0)} - {lower} ELSE {lower} END)"


def norm_cdf(x) -> Column:
    """Standard normal CDF as a Column (max abs error ~1e-16 against erfc).

    ``x`` is a column name or a Spark SQL expression string; the whole approximation is
    parsed once as one expression (a single round trip when the plan is built).
    """
    if not isinstance(x, str):
        raise TypeError("norm_cdf takes a column name or a SQL expression string")
    return F.expr(norm_cdf_sql(f"({x})"))


def z_quantile(p: float) -> float:
    """Standard normal quantile of a literal probability (evaluated once on the driver)."""
    return statistics.NormalDist().inv_cdf(p)


def safe_div(num, den) -> Column:
    """NULL instead of an error (or infinity) when the denominator is 0 or NULL."""
    return F.try_divide(_col(num), _col(den))


def clip(x, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_col(x), F.lit(lo)), F.lit(hi))


def hash_uniform(key, name: str, seed: int) -> Column:
    """Deterministic U[0,1) draw from md5(key:name:seed), 52 bits.

    Independent of partitioning and of executor retries; DuckDB and Python reproduce it
    bit for bit.
    """
    text = F.concat(_col(key).cast("string"), F.lit(f":{name}:{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(TWO_POW_52)


def hash_int(key, name: str, seed: int, lo: int, hi: int) -> Column:
    """Deterministic integer draw, inclusive range [lo, hi]."""
    return (F.lit(lo) + F.floor(hash_uniform(key, name, seed) * F.lit(float(hi - lo + 1)))).cast("long")


def weighted_choice(u: Column, values: list[str], weights: list[float]) -> Column:
    """Categorical draw: CASE over the cumulative weights."""
    out = None
    acc = 0.0
    for v, w in zip(values[:-1], weights[:-1]):
        acc = round(acc + w, 12)
        out = F.when(u < F.lit(acc), F.lit(v)) if out is None else out.when(u < F.lit(acc), F.lit(v))
    last = F.lit(values[-1])
    return last if out is None else out.otherwise(last)


def week_start_sunday(d) -> Column:
    """First day of the Sunday-based week (dayofweek: Sunday = 1)."""
    d = _col(d)
    return F.date_sub(d, F.dayofweek(d) - F.lit(1))


def whole_minutes(t0, t1) -> Column:
    """Minutes between two timestamps, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _col(t0), _col(t1))


def fractional_minutes(t0, t1) -> Column:
    """Exact elapsed minutes as a double."""
    return (F.unix_micros(_col(t1)) - F.unix_micros(_col(t0))) / F.lit(60_000_000.0)
