"""Phrase collocations counted in quotient filters.

1. *Chunks.* Texts are cut into pieces and words inside map tasks. A chunk (a few MB of one language) is a table row: its own
   vocabulary with counts, and the words as places in it. The vocabularies add up to the corpus counts n and f(word).
2. *Ids.* Words with at least ``min_count`` occurrences get dense ids; no other word can be part of a candidate. The ids go back to the chunks through a join on
   (lang, word) with one row per chunk and word, and a chunk's words become ids, with breaks at piece ends and other words.
3. *Levels.* For two words, then three, up to ``longest``: every task packs its n-grams into keys, counts them in sorted runs and writes
   counting quotient filters (``quotient_filter``), one per shard of the permuted keys. The filters of a shard are merged; n-grams with ``min_count``
   are the candidates of that length. From three words on, an n-gram is packed only if both its parts of n - 1 words may be candidates, which a
   Bloom filter of at most ``BLOOM`` bits tells (it errs on one side only, and a full one only saves nothing).
4. *Scores.* Cuts meet the counts of their two parts by joins; scores are whole numbers of up to 38 digits.
5. *Dropping* looks at phrases one word longer only: a longer phrase with enough occurrences has one of these inside it with as many.
6. *Ranks.* The best of a language are taken in salted groups first, so no task sorts all of a language.

Counts cover all documents, are exact and grow with nothing but the distinct n-grams, spread evenly by the permutation; copies and hot phrases add up inside
the map tasks. The only broadcast is the Bloom filter.

Null texts are empty, a null lang counts as ``und``. Repeated rows count as often as they occur, ids are not looked at, and other columns are ignored, whatever their
names. An empty table or one without frequent phrases gives no rows. A text of any length belongs to one chunk.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import quotient_filter as qf
from . import textcore as tc
from .shared import indexed, read, units, written

MIN_COUNT, LONGEST, PERCENT, TOP = 100, 5, 100, 2000
CHUNK, HOLD, PER_SHARD, BLOOM, PROBES = 4 << 20, 1 << 20, 1 << 20, 1 << 28, 3
SALTS = 64
#: 0: part of a word, 1: blank, 2: end of a piece
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2


def cut(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, lower-cased, and for each the number of its piece."""
    data, off = tc.buffers(column)
    low = tc.LOWER[data]
    kind = _KIND[low]
    word = kind == 0
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edge = off[1:-1][off[1:-1] < len(data)]
    begins[edge] = word[edge]
    starts = np.flatnonzero(begins)
    piece = np.cumsum(kind == 2, dtype=np.int64)[starts] + np.searchsorted(off, starts, "right")
    held = low[word]
    places = np.append((np.cumsum(word, dtype=np.int64) - 1)[starts], len(held))
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(held.tobytes()))
    return words, piece


def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, lang, n, vocab, counts, wide, words): words are places in vocab plus 1, with 0 between pieces."""

    def work(batches):
        task, made = TaskContext.get().partitionId() << 32, 0
        for batch, _, _ in tc.slices(batches, "text", CHUNK):
            lang = batch.column(0).dictionary_encode()
            code = lang.indices.to_numpy()
            for k, name in enumerate(lang.dictionary.to_pylist()):
                words, piece = cut(batch.column(1).take(pa.array(np.flatnonzero(code == k))))
                if not len(words):
                    continue
                found = words.dictionary_encode()
                places, vocab = found.indices.to_numpy(), found.dictionary.cast(pa.string())
                wide = len(vocab) > 65534
                seq = np.insert(places.astype(np.uint32 if wide else np.uint16) + 1, np.flatnonzero(np.diff(piece)) + 1, 0)
                counts = pa.array(np.bincount(places, minlength=len(vocab)))
                whole = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                yield pa.RecordBatch.from_arrays([pa.array([task + made]), pa.array([name]), pa.array([len(words)]), whole(vocab), whole(counts),
                                                  pa.array([wide]), pa.array([seq.tobytes()], pa.binary())],
                                                 ["chunk", "lang", "n", "vocab", "counts", "wide", "words"])
                made += 1

    schema = "chunk long, lang string, n long, vocab array<string>, counts array<long>, wide boolean, words binary"
    return written(docs.mapInArrow(work, schema), "chunks")


def _as_ids(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """(seq): the words of each chunk as ids plus 1, with 0 where no candidate can pass."""
    met = (chunks.select("chunk", "lang", F.posexplode("vocab").alias("pos", "word")).join(words, ["lang", "word"])
           .groupBy("chunk").agg(F.collect_list(F.struct("pos", "id")).alias("known"), ))
    rows = chunks.select("chunk", F.size("vocab").alias("size"), "wide", "words").join(met, "chunk").select("size", "wide", "words", "known")

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                known = batch.column(3)[i].values
                to = np.zeros(batch.column(0)[i].as_py() + 1, dtype=np.uint32)
                to[known.field(0).to_numpy() + 1] = known.field(1).to_numpy() + 1
                seq = to[np.frombuffer(batch.column(2)[i].as_buffer(), np.uint32 if batch.column(1)[i].as_py() else np.uint16)]
                stay = seq > 0
                stay[1:] |= seq[:-1] > 0
                yield pa.RecordBatch.from_arrays([pa.array([seq[stay].tobytes()], pa.binary())], ["seq"])

    return written(rows.mapInArrow(work, "seq binary"), "ids")


def _hashes(ids: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(ids[0]), dtype=np.uint64)
    for x in ids:
        h = tc.mix(h ^ x.astype(np.uint64))
    return h


class Bloom:
    """A Bloom filter of 2^bits bits."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def places(self, h: np.ndarray) -> list[np.ndarray]:
        return [(tc.mix(h + np.uint64(k)) >> np.uint64(64 - self.bits)).astype(np.int64) for k in range(PROBES)]

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), dtype=bool)
        for p in self.places(h):
            out &= (self.data[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0
        return out


def _columns_of(column) -> list[np.ndarray]:
    """A list column of n ids each as n arrays."""
    flat = column.flatten().to_numpy()
    return list(flat.reshape(len(column), -1).T)


def _bloom(phrases: DataFrame, n: int) -> Bloom:
    """Of the phrases' ids, put together from blocks of 2^16 bits; at most BLOOM bits come to the driver."""
    bits = max(16, min(BLOOM.bit_length() - 1, (10 * n).bit_length()))
    empty = Bloom(bits, np.zeros(0, np.uint8))

    def mark(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                places = np.unique(np.concatenate(empty.places(_hashes(_columns_of(batch.column(0))))))
                starts = np.flatnonzero(np.append(True, np.diff(places >> 16) > 0))
                for some in np.split(places, starts[1:]):
                    bitmap = blocks.setdefault(int(some[0]) >> 16, np.zeros(1 << 13, np.uint8))
                    np.bitwise_or.at(bitmap, (some & 0xFFFF) >> 3, np.uint8(1) << (some & 7).astype(np.uint8))
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array(list(blocks)), pa.array([b.tobytes() for b in blocks.values()], pa.binary())], ["block", "bitmap"])

    def unite(batches):
        for (block,), held in units(batches, 1):
            maps = (np.frombuffer(b, np.uint8) for batch in held for b in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([reduce(np.bitwise_or, maps).tobytes()], pa.binary())], ["block", "bitmap"])

    schema = "block long, bitmap binary"
    blocks = phrases.select("ids").mapInArrow(mark, schema).repartition("block").sortWithinPartitions("block").mapInArrow(unite, schema)
    data = np.zeros((1 << bits) // 8, np.uint8)
    for r in blocks.collect():
        data[r["block"] << 13 : (r["block"] + 1) << 13] = np.frombuffer(r["bitmap"], np.uint8)
    return Bloom(bits, data)


def _grams(seq: np.ndarray, n: int, bloom: Bloom | None) -> list[np.ndarray]:
    """The ids of every n-gram of a sequence that may be a candidate."""
    m = len(seq) - n + 1
    if m <= 0:
        return [seq[:0]] * n
    good = np.logical_and.reduce([seq[i : i + m] > 0 for i in range(n)])
    if bloom is not None:
        at = np.flatnonzero(good)
        part = [seq[at + i] - 1 for i in range(n)]
        at = at[bloom.has(_hashes(part[:-1]))]
        at = at[bloom.has(_hashes([seq[at + i] - 1 for i in range(1, n)]))]
    else:
        at = np.flatnonzero(good)
    return [seq[at + i] - 1 for i in range(n)]


def count_grams(ids: DataFrame, n: int, id_bits: int, shard_bits: int, bloom: Bloom | None, min_count: int, hold: int = HOLD) -> DataFrame:
    """(ids, a) of the n-grams with at least min_count occurrences."""
    keys = qf.Keys(n, id_bits)
    shard_bits = min(shard_bits, keys.widths[0] - 1)
    held = ids.sparkSession.sparkContext.broadcast(bloom)

    def filters(batches):
        runs, size = [], 0

        def merged():
            return qf.combine([np.concatenate(c) for c in zip(*[r[0] for r in runs])], np.concatenate([r[1] for r in runs]))

        def flush(columns, counts):
            shard = qf.shards(columns[0], keys.widths[0], shard_bits)
            starts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
            for x, y in zip(starts[:-1], starts[1:]):
                data = qf.encode([c[x:y] for c in columns], counts[x:y], keys.widths, shard_bits)
                yield pa.RecordBatch.from_arrays([pa.array([int(shard[x])]), pa.array([data], pa.binary())], ["shard", "filter"])

        for batch in batches:
            for raw in batch.column(0):
                grams = _grams(np.frombuffer(raw.as_buffer(), np.uint32), n, held.value)
                if not len(grams[0]):
                    continue
                packed = keys.pack(grams)
                columns, counts = qf.combine(packed, np.ones(len(packed[0]), dtype=np.int64))
                runs.append((keys.permute(columns), counts))
                size += len(counts)
                if size >= hold:
                    runs = [merged()]
                    size = len(runs[0][1])
                    if size >= hold // 2:
                        yield from flush(*runs[0])
                        runs, size = [], 0
        if runs:
            yield from flush(*merged())

    def merge(batches):
        for _, some in units(batches, 1):
            columns = counts = None
            parts, size = [], 0
            datas = (b for batch in some for b in batch.column(1).to_pylist())
            for data in datas:
                parts.append(qf.decode(data, keys.widths))
                size += len(parts[-1][1])
                if size >= 2 * PER_SHARD:
                    parts = [qf.combine([np.concatenate(c) for c in zip(*[p[0] for p in parts])], np.concatenate([p[1] for p in parts]))]
                    size = len(parts[0][1])
            columns, counts = qf.combine([np.concatenate(c) for c in zip(*[p[0] for p in parts])], np.concatenate([p[1] for p in parts]))
            often = counts >= min_count
            found = np.stack(keys.ids([c[often] for c in columns]), axis=1).astype(np.int32)
            at = pa.array(np.arange(len(found) + 1, dtype=np.int32) * n)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(at, pa.array(found.ravel())), pa.array(counts[often])], ["ids", "a"])

    made = ids.mapInArrow(filters, "shard long, filter binary").repartition("shard").sortWithinPartitions("shard")
    return written(made.mapInArrow(merge, "ids array<int>, a long"), f"grams-{n}")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in whole numbers of 38 digits."""
    whole = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", whole(a) * whole(n) * F.lit(1000).cast("decimal(4,0)"), whole(left) * whole(right))


def _first(rows: DataFrame, top: int) -> DataFrame:
    """rows with their rank in lang, up to top; salted groups send on their best only."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS * SALTS))
    rows = rows.withColumn("s", salt)
    for part in (["lang", "s"], ["lang", F.pmod("s", F.lit(SALTS))]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("rank") <= top).drop("rank")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("s")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST,
                 percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of two to ``longest`` words of every language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    chunks = _chunks(texts)
    totals = written(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = (chunks.select("lang", F.explode(F.arrays_zip(F.col("vocab").alias("word"), F.col("counts").alias("count"))).alias("w"))
             .select("lang", "w.word", "w.count").groupBy("lang", "word").agg(F.sum("count").alias("a")).where(F.col("a") >= min_count))
    words = written(indexed(words, "frequent").withColumnRenamed("idx", "id"), "words")
    size, tokens = words.count(), totals.agg(F.sum("n")).first()[0] or 0
    ids = _as_ids(chunks, words.select("lang", "word", "id"))
    id_bits, shard_bits = max(1, (size - 1).bit_length()), max(0, (tokens // PER_SHARD).bit_length())
    levels, bloom = [], None
    for n in range(2, longest + 1):
        level = count_grams(ids, n, id_bits, shard_bits, bloom, min_count)
        found = level.count()
        if not found:
            break
        levels.append(level)
        if n < longest:
            bloom = _bloom(level, found)
    if not levels:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    phrases = reduce(DataFrame.unionByName, levels)
    inside = reduce(DataFrame.unionByName, [longer.select(F.slice("ids", s, k).alias("ids"), F.col("a").alias("longer"))
                                            for k, longer in enumerate(levels[1:], 2) for s in (1, 2)] or [phrases.select("ids", F.col("a").alias("longer")).limit(0)])
    inside = written(inside.groupBy("ids").agg(F.max("longer").alias("longer")), "inside")
    kept = written(phrases.join(inside, "ids", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).select("ids", "a"), "kept")
    counts = phrases.unionByName(words.select(F.array(F.col("id").cast("int")).alias("ids"), "a"))
    lang = words.select(F.col("id").cast("int").alias("first"), "lang")
    cuts = (kept.withColumn("first", F.get("ids", F.lit(0))).join(lang, "first").join(totals, "lang")
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
            .withColumn("left", F.slice("ids", 1, F.col("k"))).withColumn("right", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k"))))
    cuts = (cuts.join(counts.select(F.col("ids").alias("left"), F.col("a").alias("l")), "left")
            .join(counts.select(F.col("ids").alias("right"), F.col("a").alias("r")), "right"))
    best = (cuts.groupBy("ids", "a", "lang", "n").agg(F.min(F.struct(_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("b"))
            .select("ids", "a", "lang", "n", "b.score", "b.l", "b.r"))
    best = written(best, "best")
    texts_of = (best.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select(F.col("id").cast("int").alias("id"), "word"), "id")
                .groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("ws"))
                .select("ids", F.array_join(F.transform("ws", lambda w: w["word"]), " ").alias("phrase")))
    return _first(best.join(texts_of, "ids"), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents").select("lang", "text"))


#: The same rows in DuckDB SQL: every n-gram of every piece, and every phrase inside every longer one.
OP13_SQL = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
ws AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
place AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, (VALUES (1), (2), (3), (4), (5)) AS s(k)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM place GROUP BY ALL),
total AS (SELECT lang, sum(len(w)) AS n FROM ws GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= 100),
part AS (SELECT lang, k, a, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2)),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM part GROUP BY ALL),
cut AS (SELECT lang, phrase, a, array_to_string(w[:h], ' ') AS one, array_to_string(w[h + 1:], ' ') AS two, h FROM (SELECT *, unnest(range(1, k)) AS h FROM c)),
scored AS (SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r, n, h, (CAST(1000 AS HUGEINT) * cut.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = one JOIN f y ON y.lang = cut.lang AND y.phrase = two JOIN total ON total.lang = cut.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) AS o FROM scored),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE o = 1 AND (longer IS NULL OR 100 * longer < 100 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
