"""Substring deduplication by relative Lempel-Ziv parsing against every document.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a run of ``window`` words that holds
it also starts in a document with a smaller doc_id.

Every document is an indexed reference block. The index samples *seeds*: of every ``window``
consecutive words, the ``k``-grams (k = window // 2 + 1) with the smallest hash, so equal windows
sample equal seeds, and two neighbouring seeds of a text overlap or touch. The parse of a document
takes at each seed the earliest document that has it and extends the factor greedily from seed to
seed as long as both texts go on alike. Factors of at least ``window`` words are duplicate
spans. Windows that reach over a factor's boundary may still be copied from elsewhere: for seeds
near a boundary, all windows sampled by them, wherever they occur, are compared by hash. So the
result is exact (up to collisions of 128-bit hashes), while a long copy costs one factor.

Null and empty texts have no words. Rows without a doc_id stay whole and are no reference. Rows
that share a doc_id are judged apart (none is smaller than the other). An empty table gives an
empty result. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as tc
from .shared import fresh, read, texts, written

WINDOW = 50


def _sizes(window: int) -> tuple[int, int]:
    """Words of a seed, and seeds of a window."""
    k = window // 2 + 1
    return k, window - k + 1


def _minima(words: tc.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed hashes by word, the smallest of each window by its first word, and valid windows."""
    k, w = _sizes(window)
    seed = words.grams(k)
    least = tc.sliding(seed, w, np.minimum)
    doc = words.doc_of_word()
    return seed, least, doc[: len(least)] == doc[window - 1 :][: len(least)]


def seeds(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(a1, a2, doc_id, tkey, pos) of every sampled seed; docs has doc_id, text, tkey."""
    k, w = _sizes(window)

    def work(batches):
        for batch, data, off in tc.slices(batches, "text"):
            words = tc.Words(data, off, hashes=2)
            seed, least, valid = _minima(words, window)
            if not valid.any():
                continue
            # A seed is sampled if it is the least of some valid window that holds it.
            top = np.where(valid, least, 0)
            edge = np.zeros(w - 1, dtype=np.uint64)
            reach = tc.sliding(np.concatenate([edge, top, edge]), w, np.maximum)[: len(seed)]
            at = np.flatnonzero((reach == seed[: len(reach)]) & (reach > 0))
            doc = words.doc_of_word()[at]
            yield pa.RecordBatch.from_arrays(
                [tc.signed(seed[at]), tc.signed(words.grams(k, 1)[at]), batch.column(0).take(pa.array(doc)),
                 batch.column(2).take(pa.array(doc)), pa.array((at - words.first[doc]).astype(np.int32))],
                ["a1", "a2", "doc_id", "tkey", "pos"])

    return docs.mapInArrow(work, "a1 long, a2 long, doc_id long, tkey long, pos int")


def factors(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """The greedy parse of each document's seeds with their references.

    Gives the factors of at least ``window`` words (edge false, words start to end) and the seeds
    whose windows a factor does not settle (edge true). Rows come sorted; a factor cut at the end
    of an Arrow batch only leaves more seeds to compare.
    """
    k, _ = _sizes(window)

    def work(batches):
        for batch in batches:
            c = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
            n = len(c["pos"])
            if not n:
                continue
            step = np.diff(c["pos"].astype(np.int64))
            on = (step == np.diff(c["rpos"].astype(np.int64))) & (step > 0) & (step <= k)
            for name in ("doc_id", "tkey", "rdoc", "rkey"):
                on &= c[name][1:] == c[name][:-1]
            first = np.flatnonzero(np.concatenate([[True], ~on]))
            last = np.concatenate([first[1:], [n]]) - 1
            size = last - first + 1
            begin, end = np.repeat(c["pos"][first], size), np.repeat(c["pos"][last], size)
            loose = (c["pos"] < begin + (window - k)) | (c["pos"] > end - (window - k))
            whole = first[c["pos"][last] + k - c["pos"][first] >= window]
            at = np.concatenate([whole, np.flatnonzero(loose)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[x][at]) for x in ("a1", "a2", "doc_id", "tkey")]
                + [pa.array(begin[at].astype(np.int32)), pa.array((end[at] + k).astype(np.int32)),
                   pa.array(np.arange(len(at)) >= len(whole))],
                ["a1", "a2", "doc_id", "tkey", "start", "end", "edge"])

    return (found.select("doc_id", "tkey", "pos", "rdoc", "rkey", "rpos", "a1", "a2")
            .repartition("doc_id", "tkey").sortWithinPartitions("doc_id", "tkey", "pos")
            .mapInArrow(work, "a1 long, a2 long, doc_id long, tkey long, start int, end int, edge boolean"))


def _boundary_windows(asked: DataFrame, window: int) -> DataFrame:
    """(h1, h2, doc_id, tkey, start) of the windows that the asked seeds (array at) sample."""
    def work(batches):
        for batch, data, off in tc.slices(batches, "text"):
            words = tc.Words(data, off, hashes=2)
            seed, least, valid = _minima(words, window)
            lists = batch.column(3)
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            pos = lists.flatten().to_numpy(zero_copy_only=False) + words.first[doc]
            reach = _sizes(window)[1]
            start = tc.ragged(pos - reach + 1, np.full(len(pos), reach))
            pos = np.repeat(pos, reach)
            ok = (start >= 0) & (start < len(least))
            start, pos = start[ok], pos[ok]
            start = np.unique(start[valid[start] & (least[start] == seed[pos])])
            owner = words.doc_of_word()[start] if len(start) else start
            h = [words.grams(window, x)[start] if len(start) else np.zeros(0, np.uint64) for x in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [tc.signed(h[0]), tc.signed(h[1]), batch.column(0).take(pa.array(owner)), batch.column(2).take(pa.array(owner)),
                 pa.array((start - words.first[owner]).astype(np.int32))], ["h1", "h2", "doc_id", "tkey", "start"])

    return asked.mapInArrow(work, "h1 long, h2 long, doc_id long, tkey long, start int")


def spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, tkey, start, end): words that an earlier document has; docs has doc_id, text, tkey."""
    all_seeds = written(seeds(docs, window), "seeds")
    shared = (all_seeds.groupBy("a1", "a2").agg(F.min("doc_id").alias("rdoc"), F.max("doc_id").alias("last"))
              .where("rdoc < last").drop("last"))
    # The small sides are written first: a join of two plain exchanges can split a hot seed's rows.
    held = written(all_seeds.join(written(shared, "shared"), ["a1", "a2"]), "shared-seeds")
    origin = (held.where("doc_id = rdoc").groupBy("a1", "a2").agg(F.min(F.struct("tkey", "pos")).alias("at"))
              .select("a1", "a2", F.col("at.tkey").alias("rkey"), F.col("at.pos").alias("rpos")))
    parse = written(factors(held.where("doc_id > rdoc").join(written(origin, "origins"), ["a1", "a2"]), window), "factors")

    loose = written(parse.where("edge").select("a1", "a2").distinct(), "loose")
    asked = held.join(loose, ["a1", "a2"], "left_semi").groupBy("doc_id", "tkey").agg(F.collect_list("pos").alias("at"))
    windows = written(_boundary_windows(docs.join(asked, ["doc_id", "tkey"]).select("doc_id", "text", "tkey", "at"), window), "windows")
    earliest = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("rdoc"), F.max("doc_id").alias("last")).where("rdoc < last")
    copied = windows.join(written(earliest, "earliest"), ["h1", "h2"]).where("doc_id > rdoc")
    return (parse.where("not edge").select("doc_id", "tkey", "start", "end")
            .unionByName(copied.select("doc_id", "tkey", "start", (F.col("start") + window).alias("end"))))


def cut(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs plus kept_text, n_words and n_removed."""
    span, doc, key = (fresh(docs, n) for n in ("dup_spans", "dup_doc", "dup_key"))
    coded = F.shiftleft(F.col("start").cast("long"), 32) + F.col("end")
    lists = found.groupBy(F.col("doc_id").alias(doc), F.col("tkey").alias(key)).agg(F.collect_list(coded).alias(span))
    text = F.col(f"`{text_col}`").cast("string")
    joined = docs.join(lists, (docs[f"`{id_col}`"].cast("long") == lists[doc]) & (F.xxhash64(text) == lists[key]), "left").drop(doc, key)

    @F.pandas_udf("kept_text string, n_words long, n_removed long")
    def kept(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s in zip(text, spans):
            words = (t or "").encode().split()
            n, gone = len(words), 0
            if s is not None and len(s):
                s = np.asarray(s, dtype=np.int64)
                depth = np.zeros(n + 1, dtype=np.int64)
                np.add.at(depth, s >> 32, 1)
                np.subtract.at(depth, s & 0xFFFFFFFF, 1)
                stays = np.cumsum(depth[:-1]) == 0
                words = [words[i] for i in np.flatnonzero(stays).tolist()]
                gone = n - len(words)
            rows.append((b" ".join(words).decode(), n, gone))
        return pd.DataFrame(rows, columns=["kept_text", "n_words", "n_removed"])

    out = fresh(joined, "cut")
    done = joined.withColumn(out, kept(text, F.col(span)))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns],
                       *[F.col(f"{out}.{c}").alias(c) for c in ("kept_text", "n_words", "n_removed")])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs plus kept_text (kept words joined by one space), n_words and n_removed."""
    if window < 3:
        raise ValueError("a window has three words at least")
    rows = texts(docs, id_col, text_col).where("doc_id is not null").withColumn("tkey", F.xxhash64("text"))
    return cut(docs, spans(rows, window), id_col, text_col)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (dedup(docs).select("doc_id", "n_words", "n_removed",
                               F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")))


#: The same rows in DuckDB SQL: every window of every document, compared as text.
OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
first AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN first USING (h) WHERE doc_id > m),
words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
agg AS (SELECT doc_id, count(g.p) AS n_removed, string_agg(x, ' ' ORDER BY words.p) FILTER (WHERE g.p IS NULL) AS kept
        FROM words LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN agg USING (doc_id)
"""
