"""Plan shape: one scan of the events per mart, pruning, pushdown, no Python in plans."""

import pytest

import __spark_entry__ as E
import oracle_queries as oracle
from funnelforge.plans import queries as core
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def registry():
    return core.registry()


def test_no_python_evaluation_in_any_sql_checked_query(spark, registry):
    sqls = oracle.registry()
    for name, fn in registry.items():
        if name not in sqls:
            continue
        p = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


def test_ab_mart_scans_events_once_and_prunes_columns(spark, registry):
    df = registry["u_fct_ab_experiment"](spark, SF_SMALL)
    phys = df._jdf.queryExecution().executedPlan().toString()
    # An executed adaptive plan prints its final and initial forms: keep one.
    phys = phys.split("== Initial Plan ==")[0]
    scans = [ln for ln in phys.splitlines() if "FileScan parquet" in ln and "events.parquet" in ln]
    # One scan for the units' events, one for the day spans of the units table.
    assert len(scans) <= 2, phys
    for ln in scans:
        assert "props" not in ln and "value" not in ln.split("ReadSchema")[-1]


def test_time_to_activate_filters_before_the_aggregate(spark, registry):
    df = registry["time_to_activate"](spark, SF_SMALL)
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "signup_started" in opt and "first_transaction" in opt


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert set(df.columns) >= {"funnel_step", "z", "p_value", "ci_low", "ci_high", "power", "ship"}


def test_every_query_has_a_registered_callable_and_sql_keys_are_known():
    q, s = core.registry(), oracle.registry()
    assert set(s) <= set(q)
    assert len(s) >= 60


def test_single_partition_exchanges_only_above_aggregates(spark, registry):
    """A single-partition exchange may only move partial aggregates (one row per task or a
    step-sized table), never raw or per-user rows."""
    import re

    for name in oracle.registry():
        plan = registry[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[-1]
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            depth = len(line) - len(line.lstrip(" :+-"))
            child = next(ln for ln in lines[i + 1:] if len(ln) - len(ln.lstrip(" :+-")) > depth)
            assert re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate", child), (name, line, child)


def test_bucketed_source_needs_no_user_shuffle(spark, registry):
    for name in ("fct_funnel", "features_local", "time_to_activate"):
        df = registry[name](spark, SF_SMALL)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Exchange hashpartitioning(user_id" not in final, (name, final)
