"""Embedding whitening against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelforge.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, n long, g string, idx string, z int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "mine", "mine", k) for k, (i, v) in enumerate(rows)], SCHEMA)


def brute(rows, most=16):
    """Per length: (n, deviation by vector, whitened by vector up to sign, explained) of the usable vectors."""
    out = {}
    kept = [v for _, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    for d in {len(v) for v in kept} - {0}:
        x = [tuple(math.floor(64 * c) + 1000000 for c in v) for v in kept if len(v) == d]
        fit = sorted(set(x))
        n, total = len(fit), [sum(c) for c in zip(*fit)]
        at = lambda v: np.array([(n * c - s) / n for c, s in zip(v, total)])
        e, axes = np.linalg.eigh(np.mean([np.outer(at(v), at(v)) for v in fit], axis=0))
        e, axes = e[::-1][:most], axes[:, ::-1][:, :most]
        used = e > max(e[0], 0) * 1e-12
        with np.errstate(all="ignore"):
            out[d] = {v: (n, sum((n * c - s) ** 2 for c, s in zip(v, total)), np.where(used, at(v) @ axes / np.sqrt(e), np.nan), e) for v in set(x)}
    return out


def check(spark, rows, most=16):
    got = whitening.whiten(frame(spark, rows), components=most).collect()
    want = brute(rows, most)
    usable = [(k, i, v) for k, (i, v) in enumerate(rows) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    assert sorted((r["z"], r["vec_id"] is None, r["vec_id"]) for r in got) == sorted((k, i is None, i) for k, i, _ in usable)
    signs = {}
    for r in sorted(got, key=lambda r: r["z"]):
        assert (r["n"], r["g"], r["idx"]) == (7, "mine", "mine")
        v = r["embedding"]
        if not v:
            assert r["whitened"] == [] and r["n_"] == 0
            continue
        n, deviation, z, e = want[len(v)][tuple(math.floor(64 * c) + 1000000 for c in v)]
        assert (r["n_"], r["deviation"]) == (n, deviation)
        found = np.array([np.nan if c is None else c for c in r["whitened"]])
        assert (np.isnan(found) == np.isnan(z)).all()
        for k in np.flatnonzero(np.abs(z) > 1e-6):
            assert signs.setdefault((len(v), k), np.sign(found[k] * z[k])) == np.sign(found[k] * z[k])
        assert np.allclose(np.abs(found), np.abs(z), rtol=1e-7, atol=1e-7, equal_nan=True)
        if e.sum() > 0:
            assert r["identity_error"] <= 1e-4
    return got


def test_whitening_equals_brute_force(spark):
    r = np.random.default_rng(1)
    mixed = r.normal(size=(150, 20)) @ r.normal(size=(20, 20)) + 5000.0
    rows = [(i, v) for i, v in enumerate(mixed.tolist())]
    rows += [(200 + i, mixed[0].tolist()) for i in range(80)] + [(3, mixed[3].tolist()), (None, mixed[4].tolist())]
    rows += [(300, None), (301, [None] * 20), (302, [math.nan] * 20), (303, [math.inf] + [0.0] * 19), (304, []), (305, [0.0] * 20)]
    rows += [(400 + i, v) for i, v in enumerate(r.normal(size=(30, 3)).tolist())]
    check(spark, rows)
    check(spark, rows, most=2)


def test_too_few_vectors_leave_components_null(spark):
    got = check(spark, [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 4.0]), (3, [1.0, 2.0, 4.0])])
    assert all([c is not None for c in r["whitened"]] == [True, False, False] for r in got)
    one = check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert all(r["whitened"] == [None, None] and r["explained"] == [None, None] and r["identity_error"] is None and r["deviation"] == 0 for r in one)


def test_huge_entries_do_not_fail(spark):
    got = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(got) == 3 and all(r["deviation"] is None for r in got if abs(r["embedding"][0]) > 1)


def test_empty_table_and_nothing_usable(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0])]).limit(0)).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [math.nan])])).count() == 0


def test_query_over_the_given_table(spark):
    rows = whitening.op11_embedding_whitening(spark, "/root/testdata/sf0.001").cache()
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert rows.count() == 16 * table.count()
    per = rows.groupBy("component").agg(F.avg(F.col("whitened") ** 2).alias("v"), F.first("explained").alias("e")).orderBy("component").collect()
    assert [r["v"] for r in per] == pytest.approx([1.0] * 16) and [r["e"] for r in per] == sorted((r["e"] for r in per), reverse=True)
