"""Tables in the shared folder, and connected components by alternating star contraction."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import checkpoint_dir

BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20
#: Links that a task of a component step writes.
LINKS = 1 << 14


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the folder named by spark.checkpoint.dir and read it back.

    Cuts the lineage: an executor lost later costs a read of files, not a new computation.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def indexed(df: DataFrame, name: str) -> DataFrame:
    """df, written, plus a dense row number ``idx`` from 0. The rows of a written partition are numbered in place; offsets come from one
    count per partition, so no task sees more than its own rows (and one row per partition)."""
    held = written(df.withColumn("idx", F.monotonically_increasing_id()), name)
    part = F.shiftright("idx", 33)
    sizes = held.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    return (held.withColumn("part", part).join(F.broadcast(before), "part")
            .withColumn("idx", F.col("idx").bitwiseAND((1 << 33) - 1) + F.col("before")).drop("part", "before"))


def _forest(batches):
    """Union-find over the links of one task: the same components with fewer links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p] if p in parent else p
        return x

    for pdf in batches:
        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= 200_000:
            yield _links(parent, root)
            parent.clear()
    yield _links(parent, root)


def _links(parent, root):
    rows = [(x, r) for x in list(parent) if (r := root(x)) != x]
    return pd.DataFrame(rows, columns=["u", "v"], dtype=np.int64)


def spanning(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A forest (rows u, v with v < u) that connects what the links ids[i] - ids[j] connect."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.arange(len(ids))
    i, j, label = rank[i], rank[j], np.arange(len(ids))
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return np.stack([ids[order[moved]], ids[order[label[moved]]]], axis=1)


def units(batches, keys: int):
    """(key, batches) of every run of rows with equal values in the first ``keys`` columns."""
    at, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in key:
            new[1:] |= k[1:] != k[:-1]
        cut = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for x, y in zip(cut[:-1], cut[1:]):
            unit = tuple(int(k[x]) for k in key)
            if unit != at and held:
                yield at, held
                held = []
            at = unit
            held.append(batch.slice(x, y - x))
    if held:
        yield at, held


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every node in ``links(u, v)``; component is its smallest node.

    Large-star and small-star steps alternate until the set of links is a star per component
    (a fixed point). Each step takes a minimum per node, which combines before the shuffle, is written, and
    joins back to the links: both sides of the join are then plain exchanges, and adaptive execution splits the partition of a hot
    node. Tables are written by a task for every LINKS of their rows, so that a small graph is not spread over thousands of files.
    """
    edge = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
    links = links.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    links, before = written(links.mapInPandas(_forest, edge).distinct(), "links"), None
    for _ in range(max_rounds):
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
        stored = lambda df, name: written(df.coalesce(1 + 2 * now[0] // LINKS), name)  # noqa: E731, B023
        sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = stored(sides.join(least, "u").where(F.col("v") > F.col("u"))
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        small = large.join(stored(large.groupBy("u").agg(F.min("v").alias("m")), "least"), "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        links = stored(small, "links")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def long_rows(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows and BATCH_BYTES (one row at least) in this session: texts are long, and a Python worker holds
    a batch. Smaller settings of the caller stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).rstrip("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have (Spark compares names without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, as (doc_id long, text string), so that no other name can clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
