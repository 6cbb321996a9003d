"""Ranking metrics and block-wise prefix sums against brute force on small fixtures."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from funnelforge.operators.metrics import average_precision, brier, classification_report, roc_auc
from funnelforge.operators.timing import describe, exact_median
from funnelforge.plans.prefix import running_totals


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(rows):
    P = sum(y for _, y in rows)
    ap = 0.0
    for t in sorted({s for s, _ in rows}, reverse=True):
        sel = [(s, y) for s, y in rows if s >= t]
        tp = sum(y for _, y in sel)
        pos_at = sum(y for s, y in rows if s == t)
        ap += pos_at / P * tp / len(sel)
    return ap


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(600):
        y = 1 if rnd.random() < 0.3 else 0
        s = round(min(1.0, max(0.0, rnd.gauss(0.4 + 0.2 * y, 0.2))), 2)  # many ties
        rows.append((s, y))
    return rows, spark.createDataFrame(rows, "score double, label int").repartition(5)


def test_auc_matches_pairwise_count(scored, spark):
    rows, df = scored
    assert roc_auc(df).first()["auc"] == pytest.approx(_brute_auc(rows), abs=1e-12)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert roc_auc(df).first()["auc"] == pytest.approx(_brute_auc(rows), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_average_precision_matches_stepwise_definition(scored):
    rows, df = scored
    assert average_precision(df).first()["average_precision"] == pytest.approx(_brute_ap(rows), abs=1e-12)


def test_brier_and_report(scored):
    rows, df = scored
    assert brier(df).first()["brier"] == pytest.approx(sum((s - y) ** 2 for s, y in rows) / len(rows))
    rep = {r["class_label"]: r for r in classification_report(df, threshold=0.5).collect()}
    tp = sum(1 for s, y in rows if s >= 0.5 and y == 1)
    fp = sum(1 for s, y in rows if s >= 0.5 and y == 0)
    fn = sum(1 for s, y in rows if s < 0.5 and y == 1)
    assert rep["1"]["precision"] == pytest.approx(tp / (tp + fp))
    assert rep["1"]["recall"] == pytest.approx(tp / (tp + fn))
    assert rep["accuracy"]["support"] == len(rows)


def test_grouped_auc(spark):
    rnd = random.Random(3)
    rows = [(g, round(rnd.random(), 1), rnd.randint(0, 1)) for g in "abc" for _ in range(150)]
    df = spark.createDataFrame(rows, "g string, score double, label int")
    got = {r["g"]: r["auc"] for r in roc_auc(df, group_cols=["g"]).collect()}
    for g in "abc":
        assert got[g] == pytest.approx(_brute_auc([(s, y) for gg, s, y in rows if gg == g]), abs=1e-12)


def test_running_totals_with_hot_group_and_many_blocks(spark):
    rnd = random.Random(5)
    rows = [("hot", i, rnd.randint(1, 9)) for i in range(3000)] + [("cold", i, rnd.randint(1, 9)) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    out = running_totals(df, "k", ["v"], ["g"], blocks=16).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values(["g", "k"])
    pdf["cum_v"] = pdf.groupby("g")["v"].cumsum()
    m = out.merge(pdf, on=["g", "k", "v"], suffixes=("", "_x"))
    assert len(m) == len(rows) and (m["cum_v"] == m["cum_v_x"]).all()
    desc = running_totals(df.filter("g = 'cold'"), "k", ["v"], descending=True, blocks=4).toPandas()
    cold = pdf[pdf.g == "cold"].drop(columns=["cum_v"]).sort_values("k", ascending=False)
    cold["c"] = cold["v"].cumsum()
    m = desc.merge(cold, on=["k", "v"])
    assert (m["cum_v"] == m["c"]).all()


def test_exact_median_and_describe(spark):
    rnd = random.Random(9)
    rows = [(g, float(rnd.randint(0, 40))) for g in ("a", "b") for _ in range(101 if g == "a" else 100)]
    df = spark.createDataFrame(rows, "variant string, x double")
    med = {r["variant"]: r["median"] for r in exact_median(df, "x", ["variant"]).collect()}
    pdf = pd.DataFrame(rows, columns=["variant", "x"])
    for g, s in pdf.groupby("variant")["x"]:
        assert med[g] == s.median()
    d = {r["variant"]: r for r in describe(df, "x").collect()}
    assert d["b"]["std"] == pytest.approx(pdf[pdf.variant == "b"]["x"].std())
    assert exact_median(df, "x").first()["median"] == pdf["x"].median()
    assert F  # noqa


def test_auc_agrees_with_mllib_evaluator(scored):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows, df = scored
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC",
                                       numBins=0)
    ml_auc = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert roc_auc(df).first()["auc"] == pytest.approx(ml_auc, abs=1e-9)


def test_approximate_median_is_close(spark):
    rnd = random.Random(21)
    rows = [("a", rnd.random() * 100) for _ in range(5000)]
    df = spark.createDataFrame(rows, "variant string, x double")
    exact = describe(df, "x").first()["median"]
    approx = describe(df, "x", approx_median=True).first()["median"]
    assert abs(exact - approx) < 1.0


def test_dense_ids_number_every_row_once_in_order(spark):
    from funnelforge.plans.prefix import dense_ids

    rnd = random.Random(8)
    rows = [(rnd.randint(0, 3), rnd.choice([None, "a", "b"]), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "u int, s string, i int")
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
    for parts, blocks in ((3, 7), (11, None)):
        got = dense_ids(df.repartition(parts), ["u", "s", "i"], "at", start=10, blocks=blocks).orderBy("at").collect()
        assert [tuple(r) for r in got] == [(*r, k) for k, r in enumerate(want, 10)]
    down = dense_ids(df, [F.desc("i")], "at").where("at <= 2").orderBy("at").collect()
    assert [r["i"] for r in down] == [3999, 3998]
    assert dense_ids(df.limit(0), ["u"], "at").count() == 0


def test_blocks_come_from_range_partitions_without_arrays(spark):
    df = spark.range(5000).selectExpr("id % 2 AS g", "id AS k", "1L AS v")
    plan = running_totals(df, "k", ["v"], ["g"], blocks=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan and "cume" not in plan
    spread = running_totals(df.where("g = 0"), "k", ["v"], ["g"], blocks=16)
    assert spread.agg(F.max("cum_v")).first()[0] == 2500
