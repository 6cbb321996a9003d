"""Every SQL-checkable registered query against its DuckDB oracle at sf0.001."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import oracle_queries as oracle
from funnelforge.plans import queries as core
from tests.conftest import SF_SMALL
from tools.compare_oracle import TABLES, frame_hash

SQLS = oracle.registry()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if Path(p).exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    sdf = core.registry()[name](spark, SF_SMALL)
    rows = sdf.collect()
    got = pd.DataFrame([tuple(r) for r in rows], columns=sdf.columns, dtype=object)
    cur = con.execute(SQLS[name])
    want = pd.DataFrame(cur.fetchall(), columns=[d[0] for d in cur.description], dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)
