"""The toxicity fit against a plain penalised fit on ratio-scaled features."""

import numpy as np
import pytest

from funnelforge.llm import textcore as tc
from funnelforge.llm import toxicity as tx
from tests.llm.test_models_and_tokens import toxic_table

import pyarrow as pa


def features(texts, y):
    """(0/1 matrix over all buckets that occur, bucket ids, ratios) by counting."""
    per = [set(tx.grams(*tc.buffers(pa.array([t])))[0].tolist()) for t in texts]
    buckets = sorted(set().union(*per))
    x = np.array([[b in p for b in buckets] for p in per], dtype=float)
    pos, neg = y.sum(), (1 - y).sum()
    one, zero = x[y == 1].sum(0), x[y == 0].sum(0)
    return x, np.array(buckets), np.log((one + 1) / (pos + 2)) - np.log((zero + 1) / (neg + 2))


def newton(x, y, l2=1.0, rounds=60):
    """Minimum of the summed log-loss plus l2 / 2 squared weights (not of the intercept), by Newton steps."""
    x1 = np.c_[x, np.ones(len(x))]
    w, keep = np.zeros(x1.shape[1]), np.append(np.full(x.shape[1], l2), 1e-9)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x1 @ w))
        w -= np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(keep), x1.T @ (p - y) + keep * w)
    return w


def as_rows(x):
    doc, col = np.nonzero(x)
    return doc, col, x[doc, col]


def test_fit_is_the_penalised_optimum_on_ratio_scaled_features_and_not_on_signs():
    r = np.random.default_rng(3)
    y = (r.random(120) < 0.4).astype(float)
    x = (r.random((120, 12)) < np.where(y[:, None] == 1, np.linspace(0.1, 0.9, 12), 0.35)).astype(float)
    ratio = np.log((x[y == 1].sum(0) + 1) / (y.sum() + 2)) - np.log((x[y == 0].sum(0) + 1) / ((1 - y).sum() + 2))
    scaled, want = x * ratio, newton(x * ratio, y)
    w, b = tx.logistic(*as_rows(scaled), y, 12, rounds=3000)
    assert np.allclose(scaled @ w + b, scaled @ want[:-1] + want[-1], atol=0.02)
    signs = x * np.sign(ratio)
    other, c = tx.logistic(*as_rows(signs), y, 12, rounds=3000)
    assert np.abs((scaled @ w + b) - (signs @ other + c)).max() > 0.2  # the sizes of the ratios are in the score


def test_training_in_tasks_equals_counting_by_hand(spark):
    docs, labels, truth = toxic_table(spark, 150)
    again = docs.unionByName(docs.limit(40))  # repeated rows count once
    weight, _ = tx.train(again.repartition(5), labels)
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [(r["doc_id"], r["text"] or "") for r in docs.where(~tx.held_out("doc_id")).orderBy("doc_id").collect() if r["doc_id"] in known]
    y = np.array([known[i] for i, _ in rows])
    x, buckets, ratio = features([t for _, t in rows], y)
    count = np.zeros((2, tx.BUCKETS), dtype=np.int64)
    count[0, buckets], count[1, buckets] = x[y == 0].sum(0), x[y == 1].sum(0)
    got, pos, neg = tx._counts(tx._sample(again, labels, "doc_id", "text", tx.SAMPLE))
    assert (got == count).all() and (pos, neg) == (y.sum(), (1 - y).sum())
    kept = tx.ratios(count, int(y.sum()), int((1 - y).sum()))
    assert np.allclose(kept[buckets][kept[buckets] != 0], ratio[kept[buckets] != 0])
    used = np.flatnonzero(kept)
    assert set(np.flatnonzero(weight)) <= set(used.tolist()) and len(used) > 0
    inside = x[:, np.searchsorted(buckets, used)] * kept[used]
    w, _ = tx.logistic(*as_rows(inside), y.astype(float), len(used))
    assert weight[used] == pytest.approx(w * kept[used], abs=1e-4)
