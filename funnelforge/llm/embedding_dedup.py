"""Near-duplicate vectors by iterative quantisation (ITQ) and multi-index Hamming tables.

1. *Classes.* Equal vectors form a class; its smallest id stands for it.
2. *Codes.* On a sample of at most ``SAMPLE`` classes (the first by a hash of the id), the unit vectors
   are centred and projected on their principal axes, and a rotation is learned that balances
   the variance over the bits: sign codes and orthogonal Procrustes fits alternate. Every class gets a code of
   at most 64 bits a rotation.
3. *Tables.* Consecutive substrings of the code index one table each. A substring has log2(classes / ``CHUNK``) bits (``LEAST_BITS`` at
   least), so that a bucket of evenly spread vectors holds about ``CHUNK`` of them however many there are. Every sampled vector gets two partners at a cosine of exactly
   ``least`` (one in a random direction, one in the direction between two other vectors), and tables are added - a new rotation
   where a code is used up - until the share of pairs that meet in a table is at least ``RECALL`` in each tenth of the sample by
   distance from the mean. (Without a common direction a bit differs with probability 0.1 at cosine 0.95; with
   one, the centred vectors are shorter and it differs more often.) A class is copied once per table: probes of
   neighbouring buckets would cost a copy per bit, where a table more costs one.
4. *Rerank.* The original vectors of a bucket are compared by cosine in double precision. Buckets are cut into chunks of
   about ``CHUNK`` rows, and each pair of chunks is a unit of work of its own, so a hot bucket is spread and a task holds
   two chunks. A pair counts in the first table where it meets. A unit emits each vector's number of links and a spanning forest
   of them, never the pairs, so its output is linear in its rows.

The steps are the same at every size. Vectors are compared with those of the same length, and every length has codes of its own.

Links are pairs with cosine >= ``least``. Vectors that are null, zero, or hold null or non-finite components
link with nothing. Rows that share an
id count as vectors of their own for links, and as one node for components. An empty table gives
no rows. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import components, fresh, read, spanning, units, written

LEAST, SAMPLE, CHUNK, ROUNDS = 0.95, 8192, 1024, 25
#: Share of pairs at the threshold that the tables must find, the most tables tried for it, and the shortest substring.
RECALL, MOST, LEAST_BITS = 0.9995, 160, 4


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def partners(unit: np.ndarray, least: float, random: np.random.Generator) -> list[np.ndarray]:
    """For each unit vector two others at cosine least: off in a random direction, and in one between two vectors of the sample."""
    one, two = (random.permutation(len(unit)) for _ in range(2))
    out = []
    for off in (random.standard_normal(unit.shape), unit[one] - unit[two]):
        off = off - (off * unit).sum(1, keepdims=True) * unit
        size = np.linalg.norm(off, axis=1, keepdims=True)
        out.append(least * unit + np.sqrt(1 - least * least) * off / np.where(size > 1e-9, size, np.inf))
    return out


class Itq:
    """Mean, and projections onto rotated principal axes; a code bit is the sign of a coordinate.

    tables is the list of (rotation, first bit, end); recall is the share of pairs at cosine least that meet in a table, in the
    worst tenth of x."""

    def __init__(self, x: np.ndarray, classes: int, rounds: int = ROUNDS, least: float = LEAST):
        unit = _unit(x)
        self.mean = unit.mean(0)
        x = unit - self.mean
        bits = min(64, x.shape[1])
        width = min(bits, max(LEAST_BITS, int(np.ceil(np.log2(max(2.0, classes / CHUNK))))))
        _, axes = np.linalg.eigh(x.T @ x)
        axes = axes[:, ::-1][:, :bits]
        v = x @ axes
        random = np.random.Generator(np.random.PCG64(11))
        pairs = partners(unit, least, np.random.Generator(np.random.PCG64(12)))
        met = np.zeros((len(pairs), len(x)), dtype=bool)
        tenths = np.array_split(np.argsort((x * x).sum(1), kind="stable"), min(10, len(x)))
        self.axes, self.tables, self.recall = [], [], 0.0
        while self.recall < RECALL and len(self.tables) < MOST:
            r = np.linalg.qr(random.standard_normal((bits, bits)))[0]
            for _ in range(rounds):
                b = np.where(v @ r >= 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(b.T @ v)
                r = (left @ right).T
            self.axes.append(axes @ r)
            own, others = self._bits(unit, axes @ r), [self._bits(other, axes @ r) for other in pairs]
            for first in range(0, bits - width + 1, width):
                for k, other in enumerate(others):
                    met[k] |= (other[:, first : first + width] == own[:, first : first + width]).all(1)
                self.tables.append((len(self.axes) - 1, first, first + width))
                self.recall = min(float(met[k, t].mean()) for k in range(len(pairs)) for t in tenths)
                if self.recall >= RECALL or len(self.tables) == MOST:
                    break

    def _bits(self, unit: np.ndarray, axes: np.ndarray) -> np.ndarray:
        return (unit - self.mean) @ axes >= 0

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The bucket in each table."""
        unit = _unit(x)
        bits = [self._bits(unit, axes) for axes in self.axes]
        return np.stack([bits[r][:, i:j] @ (1 << np.arange(j - i, dtype=np.int64)) for r, i, j in self.tables], axis=1).astype(np.int32)


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): usable vectors as double arrays."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                   & F.exists("v", lambda x: x != 0)))


def _coded(classes: DataFrame, model: Itq, kind: str) -> DataFrame:
    """(c, copies, code, x): code holds the bucket in each table, x the vector's numbers (kind f4 where they were floats, else f8)."""
    held = classes.sparkSession.sparkContext.broadcast(model)  # one matrix of the vectors' length a rotation

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                codes = held.value.codes(x)
                flat = pa.array(codes.ravel())
                at = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * codes.shape[1])
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.ListArray.from_arrays(at, flat), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())],
                                                 ["c", "copies", "code", "x"])

    return classes.select("c", "copies", "v").mapInArrow(work, "c long, copies long, code array<int>, x binary")


def compare(table: int, ids, copies, codes, x, side, same: bool, least: float):
    """Links of one unit: (id, number of linked rows) and a forest (u, v).

    side marks the rows of the second chunk; in a unit of one chunk (same) all rows are compared.
    """
    a = np.flatnonzero(~side) if not same else np.arange(len(ids))
    b = np.flatnonzero(side) if not same else a
    unit = _unit(x)
    link = unit[a] @ unit[b].T >= least
    if same:
        np.fill_diagonal(link, False)
    i, j = np.nonzero(link)
    i, j = a[i], b[j]
    for t in range(table):
        new = codes[i, t] != codes[j, t]
        i, j = i[new], j[new]
    n = np.zeros(len(ids), dtype=np.int64)
    np.add.at(n, i, copies[j])
    if not same:
        np.add.at(n, j, copies[i])
    return n, spanning(ids, i, j)


def _links(coded: DataFrame, tables: int, least: float, kind: str) -> DataFrame:
    """(u, v, n): v null: u has n linked rows; else a link of the forest."""
    rows = coded.select("c", "copies", "code", "x", F.posexplode("code").alias("t", "b"))
    chunks = written(coded.select(F.posexplode("code").alias("t", "b")).groupBy("t", "b").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "buckets")
    many = chunks.where("chunks > 1")
    own = F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int")
    rows = (rows.join(many, ["t", "b"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("t", "b", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                    (F.col("own") > F.col("other")).alias("side"), "c", "copies", "code", "x"))

    def work(batches):
        for (t, _, p, q), held in units(batches, 4):
            some = pa.Table.from_batches(held).combine_chunks()
            codes = some["code"].combine_chunks().flatten().to_numpy().reshape(some.num_rows, tables)
            x = np.frombuffer(b"".join(some["x"].to_pylist()), kind).reshape(some.num_rows, -1).astype(np.float64)
            ids, copies, side = (some[k].to_numpy() for k in ("c", "copies", "side"))
            n, forest = compare(t, ids, copies, codes, x, side.astype(bool), p == q, least)
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[k], forest[:, 0]])), pa.concat_arrays([pa.nulls(len(k), pa.int64()), pa.array(forest[:, 1])]),
                 pa.array(np.concatenate([n[k], np.zeros(len(forest), np.int64)]))], ["u", "v", "n"])

    return (rows.repartition("t", "b", "p", "q").sortWithinPartitions("t", "b", "p", "q")
            .mapInArrow(work, "u long, v long, n long"))


def dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = LEAST) -> DataFrame:
    """vectors plus n_links, component_id (smallest linked id) and kept (it is the row's own)."""
    key = lambda v: (F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"))
    valid = _valid(vectors, id_col, vec_col)
    classes = written(valid.select("vec_id", *key("v"), "v").groupBy("h1", "h2")
                      .agg(F.min("vec_id").alias("c"), F.count("*").alias("copies"), F.any_value("v").alias("v")).withColumn("size", F.size("v")), "classes")
    names = classes.select("h1", "h2", "c", "copies")
    element = vectors.select(F.col(f"`{vec_col}`")).schema[0].dataType.elementType
    kind = "f4" if element == T.FloatType() else "f8"
    found = classes.sparkSession.createDataFrame([], "u long, v long, n long")
    for size, n in sorted((r["size"], r["count"]) for r in classes.groupBy("size").count().collect()):
        some = classes.where(F.col("size") == size)
        sample = some.orderBy(F.xxhash64("c"), "c").limit(SAMPLE).select("v").toArrow().column(0)
        model = Itq(sample.combine_chunks().flatten().to_numpy().reshape(len(sample), -1), n, least=least)
        coded = written(_coded(some, model, kind), "codes")
        found = found.unionByName(written(_links(coded, len(model.tables), least, kind), "links"))
    counts = found.where("v is null").groupBy(F.col("u").alias("c")).agg(F.sum("n").alias("n"))
    joined = components(found.where("v is not null").select("u", "v")).select(F.col("node").alias("c"), "component")
    per_class = written(names.join(counts, "c", "left").join(joined, "c", "left")
                        .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                                F.coalesce("component", "c").alias("component_id")), "per-class")
    one, two, row = (fresh(vectors, n) for n in ("hash_one", "hash_two", "valid_row"))
    v = F.col(f"`{vec_col}`").cast("array<double>")
    per_class = per_class.withColumnsRenamed({"h1": one, "h2": two})
    own = vectors[f"`{id_col}`"].cast("long")
    joined = vectors.join(per_class, (F.xxhash64(v) == per_class[one]) & (F.xxhash64(F.lit(1), v) == per_class[two]) & own.isNotNull(), "left").drop(one, two)
    return (joined.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
            .withColumn("component_id", F.coalesce("component_id", own)).withColumn("kept", F.coalesce(own == F.col("component_id"), F.lit(True))))


def op9_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


#: The same rows in DuckDB SQL: every pair of vectors.
OP9_SQL = r"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS u, b.vec_id AS w FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
         WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS d, vec_id AS r FROM embeddings UNION SELECT d, w FROM reach JOIN link ON u = r),
comp AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d),
n AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN comp ON d = vec_id LEFT JOIN n ON u = vec_id
"""
