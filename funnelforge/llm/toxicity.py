"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the character n-grams (orders ``ORDERS``, A-Z lower-cased, ASCII other than letters as
blanks) that a text contains, hashed to ``BUCKETS`` buckets. Each bucket's value is its naive Bayes
log-count ratio, r = log((toxic docs with it + 1) / (toxic docs + 2)) - the same for the others;
buckets whose presence does not depend on the label (likelihood-ratio statistic of at most ``MIN_Z`` squared) are left out. A logistic regression
with L2 penalty is trained on these scaled features and scores every whole text. The penalty is the same for all weights, so the size of a ratio
says how cheaply a bucket moves the score.

The classifier is fitted on at most ``SAMPLE`` labelled documents (the first by a hash of the id),
of which each ``held_out`` fold (crc32 of the id as text modulo ``FOLDS`` is 0) is kept out. Only
texts enter a score; of several rows of one id one counts in training. Without two classes among the labels the score is the share of toxic labels
(0.5 without any).

Null texts are scored as empty ones. Labels that are null do not count; of several labels of one
document the largest counts. Rows without a doc_id are scored and are in no fold. Other columns
pass through, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textcore as tc
from .shared import fresh, read, texts, units, written

ORDERS = (3, 4, 5, 6)
BUCKETS = 1 << 20
MIN_Z = 5.0
SAMPLE = 8000
FOLDS = 5
L2 = 1.0
#: Buckets whose counts travel together.
BLOCK = 1 << 12

_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[65:91] += 32
_LETTER[[x for x in range(128) if not chr(x).isalpha()]] = 32


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every text, and where each text's n-grams begin."""
    lead = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(lead)])[off]
    code = np.frombuffer(_LETTER[data].tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    size = np.diff(at)
    per_order = [np.maximum(size - o + 1, 0) for o in ORDERS]
    first = np.concatenate([[0], np.cumsum(np.sum(per_order, axis=0))])
    out = np.zeros(first[-1], dtype=np.int32)
    place = first[:-1].copy()
    h = np.zeros(len(code), dtype=np.uint64)
    for o in range(1, ORDERS[-1] + 1):
        n = len(code) - o + 1
        if n <= 0:
            break
        h = h[:n] * np.uint64(0x9E3779B97F4A7C15) + code[o - 1 :]
        if o in ORDERS:
            k = per_order[ORDERS.index(o)]
            out[tc.ragged(place, k)] = ((tc.mix(h) >> np.uint64(44)).astype(np.int32) & (BUCKETS - 1))[tc.ragged(at[:-1], k)]
            place += k
    return out, first


class Distinct:
    """The distinct buckets of a text, in time linear in its length."""

    def __init__(self):
        self.last = np.zeros(BUCKETS, dtype=np.int32)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        turn = np.arange(len(ids), dtype=np.int32)
        self.last[ids] = turn
        return ids[self.last[ids] == turn]


def ratios(count: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """The naive Bayes log-count ratio of each bucket, 0 where its presence does not depend on the label. count: documents with
    the bucket, by label."""
    ratio = np.log((count[1] + 1) / (pos + 2)) - np.log((count[0] + 1) / (neg + 2))
    return np.where(_g_statistic(count, pos, neg) > MIN_Z**2, ratio, 0.0)


def _g_statistic(count: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """Likelihood-ratio statistic of each bucket's presence against the label (chi-square with one degree)."""
    g = np.zeros(count.shape[1])
    total, both = count.sum(0), pos + neg
    for have, n in ((count[1], pos), (count[0], neg)):
        for seen, share in ((have, total / both), (n - have, 1 - total / both)):
            at = seen > 0
            g[at] += 2 * seen[at] * np.log(seen[at] / (n * share[at]))
    return g


def logistic(doc, col, value, y, m, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the summed log-loss plus L2 / 2 times the squared weights (both divided by the number of rows).

    Every value of a bucket is its ratio, so a bucket with a large ratio needs a small weight and is penalised less: the
    values keep their sizes. One factor for all of them brings the rows to unit length on average, for the steps' sake only: the
    penalty is that of the unscaled values."""
    n = len(y)
    scale = np.sqrt(max(float((value * value).sum()) / n, 1e-12))
    value, l2 = value / scale, L2 / (n * scale * scale)
    w, b = np.zeros(m), float(np.log(y.mean() / (1 - y.mean())))
    g1, g2 = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, rounds + 1):
        z = b + np.bincount(doc, value * w[col], n)
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        g = np.append(np.bincount(col, value * e[doc], m) + l2 * w, e.sum())
        g1, g2 = 0.9 * g1 + 0.1 * g, 0.999 * g2 + 0.001 * g * g
        step = 0.05 * (g1 / (1 - 0.9**t)) / (np.sqrt(g2 / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w / scale, float(b)


def scores(column: pa.Array, weight: np.ndarray, intercept: float) -> np.ndarray:
    """Score of every text of a column."""
    ids, first = grams(*tc.buffers(column))
    hit = np.flatnonzero((weight != 0)[ids])
    doc = np.searchsorted(first, hit, "right") - 1
    pair = np.unique(doc * BUCKETS + ids[hit])  # each bucket of a text once
    z = intercept + np.bincount(pair // BUCKETS, weight[pair % BUCKETS], len(column))
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> DataFrame:
    """(doc_id, toxic, text) of the training documents, one row per id: of several texts of an id the least counts."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out("doc_id")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # so many rows at most are broadcast
    return written(texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
                   .groupBy("doc_id", "toxic").agg(F.coalesce(F.min("text"), F.lit("")).alias("text")), "toxic-sample")


def _present(batch: pa.RecordBatch, distinct: Distinct):
    """The distinct buckets of every text, one text at a time."""
    data, off = tc.buffers(batch.column(batch.schema.get_field_index("text")))
    for i in range(batch.num_rows):
        yield distinct(grams(data[off[i] : off[i + 1]], np.array([0, off[i + 1] - off[i]]))[0])


def _counts(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """Documents with each bucket by label, and of each label. Tasks add up their texts; their counts meet by block of buckets."""
    def count(batches):
        distinct, own, docs = Distinct(), np.zeros((2, BUCKETS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for y, r in zip((batch.column(1).to_numpy() != 0).astype(int).tolist(), _present(batch, distinct)):
                own[y, r] += 1
                docs[y] += 1
        for at in np.flatnonzero(own.reshape(2, -1, BLOCK).any(axis=(0, 2))).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([own[:, at * BLOCK : (at + 1) * BLOCK].tobytes()], pa.binary())], ["block", "counts"])
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([docs.tobytes()], pa.binary())], ["block", "counts"])

    def add(batches):
        for (at,), held in units(batches, 1):
            parts = (np.frombuffer(x, np.int64) for batch in held for x in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([reduce(np.add, parts).tobytes()], pa.binary())], ["block", "counts"])

    schema, out, docs = "block long, counts binary", np.zeros((2, BUCKETS), dtype=np.int64), np.zeros(2, dtype=np.int64)
    for r in rows.mapInArrow(count, schema).repartition("block").sortWithinPartitions("block").mapInArrow(add, schema).collect():  # BUCKETS numbers at most
        if r["block"] < 0:
            docs = np.frombuffer(r["counts"], np.int64)
        else:
            out[:, r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], np.int64).reshape(2, -1)
    return out, int(docs[1]), int(docs[0])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """(weight by bucket, intercept) from at most ``sample`` labelled documents outside the held-out fold; a weight is the coefficient times
    the ratio. Texts stay in the tasks; the driver gets the counts of the buckets and, of each document, the buckets that tell the labels apart."""
    rows = _sample(docs, labels, id_col, text_col, sample)
    count, pos, neg = _counts(rows)
    weight = np.zeros(BUCKETS, dtype=np.float32)
    if not pos or not neg:
        p = (pos + 0.5) / (pos + neg + 1)
        return weight, float(np.log(p / (1 - p)))
    ratio = ratios(count, pos, neg)
    used = ratio != 0
    held = rows.sparkSession.sparkContext.broadcast(np.packbits(used))

    def pick(batches):
        own, distinct = np.unpackbits(held.value).astype(bool), Distinct()
        for batch in batches:
            kept = [np.sort(r[own[r]]).astype(np.int32).tobytes() for r in _present(batch, distinct)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(kept, pa.binary())], ["doc_id", "toxic", "buckets"])

    got = rows.mapInArrow(pick, "doc_id long, toxic int, buckets binary").toArrow().sort_by("doc_id")
    ids = [np.frombuffer(x, np.int32) for x in got.column(2).to_pylist()]
    col = np.concatenate(ids)
    w, b = logistic(np.repeat(np.arange(len(ids)), [len(x) for x in ids]), (np.cumsum(used) - 1)[col], ratio[col],
                    (got.column(1).to_numpy() != 0).astype(float), int(used.sum()))
    weight[used] = w * ratio[used]
    return weight, b


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", column: str = "score") -> DataFrame:
    """docs plus the score column."""
    weight, intercept = model
    held = docs.sparkSession.sparkContext.broadcast(weight)  # BUCKETS floats, whatever the input
    out = fresh(docs, column)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index(text_col)

    def work(batches):
        for batch in batches:
            data, off = tc.buffers(batch.column(at))
            done = np.empty(batch.num_rows)
            i = 0
            while i < batch.num_rows:
                # n-grams take many times their text
                j = min(batch.num_rows, max(i + 1, int(np.searchsorted(off, off[i] + tc.SLICE_BYTES // 4, "right")) - 1))
                done[i:j] = scores(batch.column(at).slice(i, j - i), held.value, intercept)
                i = j
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done)], [*batch.schema.names, out])

    return docs.mapInArrow(work, schema)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    return (score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted")))
