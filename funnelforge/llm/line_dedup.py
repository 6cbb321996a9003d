"""Reversible line deduplication: sharded cuckoo filters over exact reference-count tables.

A document's text is split at ``\\n``; a line's key is the line without ``[\\x20\\x09-\\x0D]`` at
both ends and with A-Z lower-cased. Keys of at least ``min_chars`` code points that at least
``min_docs`` documents hold are *blocked*: every document but the one with the largest id loses
all lines with that key.

State (three tables, all in shared storage):

* ``postings(k1, k2, doc_id)``: which document holds which key (128-bit key hashes);
* ``refs(k1, k2, n_docs, max_doc)``: the exact reference counts;
* ``filters(shard, blob)``: a cuckoo filter of the blocked keys per shard.

Inserting or deleting documents changes the reference counts by the batch's own counts, and only
keys that cross ``min_docs`` are inserted into or deleted from their shard's filter; where there are more of them than the shards are sized for, the
filters are made anew over twice the shards. Applying
the index sends every document's keys past its shard's filter; what passes is checked against the
exact counts, so a false positive never removes a line.

Null texts and empty texts are one empty line. Rows that share a doc_id count as one document and
are cut alike; rows without a doc_id are neither counted nor cut. An empty table gives an empty
index. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cuckoo import CuckooFilter
from .shared import fresh, read, texts, written

MIN_CHARS, MIN_DOCS = 20, 3
#: Blocked keys that a shard is sized for.
SHARD_KEYS = 1 << 16
#: Postings of a shard that one task probes: a shard that holds a hot key's postings is copied to as many tasks as it takes.
PROBED = 1 << 18


@dataclass
class LineIndex:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int
    min_docs: int


def _key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line's key, or None where the key is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or len(key.decode()) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _postings(docs: DataFrame, min_chars: int) -> DataFrame:
    """(k1, k2, doc_id) of every key of a document, once."""
    def work(batches):
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if doc is None or not text:
                    continue
                own = {k for line in text.encode().split(b"\n") if (k := _key(line, min_chars))}
                ids += [doc] * len(own)
                keys += own
            k = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(k[:, 0])), pa.array(np.ascontiguousarray(k[:, 1])),
                                              pa.array(ids, pa.int64())], ["k1", "k2", "doc_id"])

    return docs.mapInArrow(work, "k1 long, k2 long, doc_id long").distinct()


def _refs(postings: DataFrame) -> DataFrame:
    return postings.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))


def _shard(shards: int):
    return F.pmod(F.col("k1"), F.lit(shards)).cast("int")


def _make_filters(blocked: DataFrame, shards: int) -> DataFrame:
    return _change_filters(None, blocked.select("k1", "k2", F.lit(1).alias("step")), shards)


def _change_filters(filters: DataFrame | None, changes: DataFrame, shards: int) -> DataFrame:
    """Each shard's filter, then its changes (step -1: delete, 1: insert) in one sorted run."""
    rows = changes.select(_shard(shards).alias("shard"), "k1", "k2", "step", F.lit(None).cast("binary").alias("blob"))
    if filters is not None:
        rows = rows.unionByName(filters.select("shard", F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
                                               F.lit(-2).alias("step"), "blob"))

    def work(batches):
        at, held = None, None
        for pdf in batches:
            for shard, part in pdf.groupby("shard", sort=False):
                if shard != at:
                    if held is not None:
                        yield pd.DataFrame({"shard": [at], "blob": [held.to_bytes()]})
                    at, held = shard, CuckooFilter(2 * SHARD_KEYS)
                for step, some in part.groupby("step", sort=False):
                    if step == -2:
                        held = CuckooFilter.from_bytes(some["blob"].iloc[0])
                    else:
                        (held.insert if step == 1 else held.delete)(some["k1"].to_numpy(), some["k2"].to_numpy())
        if held is not None:
            yield pd.DataFrame({"shard": [at], "blob": [held.to_bytes()]})

    return (rows.repartition("shard").sortWithinPartitions("shard", "step")
            .mapInPandas(work, "shard int, blob binary"))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
    """An index of all documents."""
    postings = written(_postings(texts(docs, id_col, text_col), min_chars), "postings")
    refs = written(_refs(postings), "refs")
    blocked = refs.where(F.col("n_docs") >= min_docs)
    shards = max(16, -(-blocked.count() // SHARD_KEYS))
    return LineIndex(postings, refs, written(_make_filters(blocked, shards), "filters"), shards, min_chars, min_docs)


def _moved(index: LineIndex, refs: DataFrame, touched: DataFrame) -> DataFrame:
    """Keys of ``touched`` that cross min_docs between the index's counts and ``refs``."""
    old = index.refs.join(touched, ["k1", "k2"], "left_semi").select("k1", "k2", F.col("n_docs").alias("before"))
    new = refs.join(touched, ["k1", "k2"], "left_semi").select("k1", "k2", F.col("n_docs").alias("after"))
    was, now = (F.coalesce(c, F.lit(0)) >= index.min_docs for c in ("before", "after"))
    return (old.join(new, ["k1", "k2"], "full").where(was != now)
            .select("k1", "k2", F.when(now, 1).otherwise(-1).alias("step")))


def _with(index: LineIndex, postings: DataFrame, refs: DataFrame, touched: DataFrame) -> LineIndex:
    blocked = refs.where(F.col("n_docs") >= index.min_docs)
    now = blocked.count()
    if now > index.shards * SHARD_KEYS:  # filters twice as many as needed, from the exact counts: each key is moved a bounded number of times
        shards = 2 * -(-now // SHARD_KEYS)
        return LineIndex(postings, refs, written(_make_filters(blocked, shards), "filters"), shards, index.min_chars, index.min_docs)
    moved = written(_moved(index, refs, touched), "moved")
    filters = written(_change_filters(index.filters, moved, index.shards), "filters")
    return LineIndex(postings, refs, filters, index.shards, index.min_chars, index.min_docs)


def insert(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    """The index after adding documents; documents it already holds count once."""
    batch = _postings(texts(docs, id_col, text_col), index.min_chars)
    new = written(batch.join(index.postings, ["k1", "k2", "doc_id"], "left_anti"), "postings")
    refs = written(index.refs.unionByName(_refs(new)).groupBy("k1", "k2")
                   .agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc")), "refs")
    return _with(index, index.postings.unionByName(new), refs, new.select("k1", "k2").distinct())


def delete(index: LineIndex, doc_ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
    """The index without these documents, as if they had never been inserted."""
    gone_ids = doc_ids.select(F.col(f"`{id_col}`").cast("long").alias("doc_id")).distinct()
    gone = written(index.postings.join(gone_ids, "doc_id", "left_semi").select("k1", "k2", "doc_id"), "gone")
    rest = written(index.postings.join(gone, ["k1", "k2", "doc_id"], "left_anti"), "postings")
    touched = gone.select("k1", "k2").distinct()
    again = _refs(rest.join(touched, ["k1", "k2"], "left_semi"))
    refs = written(index.refs.join(touched, ["k1", "k2"], "left_anti").unionByName(again), "refs")
    return _with(index, rest, refs, touched)


def _probe(index: LineIndex, postings: DataFrame) -> DataFrame:
    """Postings that their shard's filter may hold.

    Filters and postings meet in one shuffle; in a partition each shard's filter comes first and its
    postings stream past it, so a task holds one filter. A shard's filter goes to a place for every PROBED of its
    postings, and a posting to the one its document names.
    """
    none = F.lit(0).cast("long")  # not null: pandas would turn the keys of that batch into floats
    placed = postings.select(_shard(index.shards).alias("shard"), "k1", "k2", "doc_id")
    salts = written(placed.groupBy("shard").agg(F.ceil(F.count("*") / PROBED).cast("int").alias("salts")), "salts")
    held = index.filters.join(salts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                                F.lit(0).alias("step"), none.alias("k1"), none.alias("k2"), none.alias("doc_id"), "blob")
    asked = placed.join(salts, "shard").select("shard", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int").alias("salt"),
                            F.lit(1).alias("step"), "k1", "k2", "doc_id", F.lit(None).cast("binary").alias("blob"))

    def work(batches):
        at, held = None, None
        for pdf in batches:
            for place, part in pdf.groupby(["shard", "salt"], sort=False):
                if place != at:
                    at, held = place, None
                first = part["step"] == 0
                if first.any():
                    held = CuckooFilter.from_bytes(part.loc[first, "blob"].iloc[0])
                    part = part[~first]
                if held is not None and len(part):
                    k = part[["k1", "k2", "doc_id"]]
                    yield k[held.contains(k["k1"].to_numpy(), k["k2"].to_numpy())]

    return (held.unionByName(asked).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "step")
            .mapInPandas(work, "k1 long, k2 long, doc_id long"))


def losses(index: LineIndex, postings: DataFrame | None = None) -> DataFrame:
    """(doc_id, keys): the keys whose lines the document loses, at most one per line it has."""
    blocked = index.refs.where(F.col("n_docs") >= index.min_docs).select("k1", "k2", "max_doc")
    return (_probe(index, index.postings if postings is None else postings).join(blocked, ["k1", "k2"])
            .where(F.col("doc_id") < F.col("max_doc"))
            .groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2")).alias("keys")))


def apply(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs plus kept_text, n_lines (before dropping) and n_dropped."""
    lost, key = fresh(docs, "lost_keys"), fresh(docs, "lost_id")
    found = losses(index).select(F.col("doc_id").alias(key), F.col("keys").alias(lost))
    joined = docs.join(found, docs[f"`{id_col}`"].cast("long") == found[key], "left").drop(key)
    min_chars = index.min_chars

    @F.pandas_udf("kept_text string, n_lines long, n_dropped long")
    def cut(text: pd.Series, keys: pd.Series) -> pd.DataFrame:
        rows = []
        for t, k in zip(text, keys):
            lines = (t or "").encode().split(b"\n")
            kept = lines
            if k is not None and len(k):
                gone = {np.int64([x["k1"], x["k2"]]).tobytes() for x in k}
                kept = [line for line in lines if _key(line, min_chars) not in gone]
            rows.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["kept_text", "n_lines", "n_dropped"])

    return _unpacked(joined, docs.columns, lost, cut, text_col)


def _unpacked(joined, columns, lost, cut, text_col):
    out = fresh(joined, "cut")
    done = joined.withColumn(out, cut(F.col(f"`{text_col}`"), F.col(lost)))
    return done.select(*[F.col(f"`{c}`") for c in columns],
                       *[F.col(f"{out}.{c}").alias(c) for c in ("kept_text", "n_lines", "n_dropped")])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (apply(build(docs), docs)
            .select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")))


#: The same rows in DuckDB SQL.
OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
blocked AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT l.*, b.k IS NOT NULL AND l.doc_id < b.keeper AS gone FROM lines l LEFT JOIN blocked b ON l.k = b.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
