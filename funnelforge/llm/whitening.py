"""Embedding whitening with MLlib's BlockMatrix.

1. *Grid.* Every entry c becomes the whole number floor(64 c); the fit list holds each distinct vector of them once, found by a
   distinct that combines before the shuffle. All statistics are over the fit list.
2. *Blocks.* The centred vectors get dense row numbers (a count per written partition turned into offsets) and become an
   IndexedRowMatrix and from there a BlockMatrix, whose blocks hold at most ``BLOCK`` numbers.
3. *Scatter.* The transposed matrix times the matrix, its middle dimension split over the tasks, gives a matrix as wide as the
   vectors. Only this one comes to the driver, where ``numpy.linalg.eigh`` decomposes it.
4. *Projection.* All rows, blocked in the same way, are multiplied by the whitening matrix (axes over the roots of their
   eigenvalues) as a BlockMatrix, and meet their other columns by row number, so that equal vectors never share a key.
5. *Check.* The scatter of the whitened fit list, again a product of BlockMatrices, is held against the identity.

A whole mean is taken off as whole numbers and only its fraction as a double, so that a large common offset costs no digits.
Driver: one sum per dimension, the square matrix, and the block keys that MLlib gathers for a product (two ints per 8 MB block).

Rows whose vector is null or holds null or non-finite entries go. Vectors of different lengths are spaces of their own, each with its own
fit list. Entries beyond 2^53 on the grid count as 2^53. Components whose eigenvalue is at most 1e-12 of the largest (fewer
distinct vectors than dimensions, or one only) cannot be scaled: their values are null, and identity_error leaves them out. An empty vector has no
components. A deviation beyond 64 bits is null. Equal eigenvalues take any axes of their space. Rows without an id and repeated rows
are rows like others; an empty table gives no rows. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh, indexed, read, written

GRID, COMPONENTS, BLOCK, FLAT = 64, 16, 1 << 20, 1e-12
_MOST = float(1 << 53)


def grid(vec_col: str):
    """The vector on the grid; null where it is not usable."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    usable = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(usable, F.transform(v, lambda c: F.floor(F.greatest(F.least(c * GRID, F.lit(_MOST)), F.lit(-_MOST)))))


def _per_entry(whole: list[int], other: list, unit: str, how):
    """how(entry - whole mean, other) for every entry of g; the two lists are literals as long as the vector."""
    means, rest = (F.expr(f"array({', '.join(f'{x!r}{u}' for x in some)})") for some, u in ((whole, "L"), (other, unit)))
    return F.transform("g", lambda x, i: how(x - means[i], rest[i]))


def _blocks(rows: DataFrame, n: int, d: int) -> BlockMatrix:
    """Rows (idx, v: array of d doubles) as a BlockMatrix."""
    tall = max(1, min(BLOCK // d, -(-n // (2 * rows.sparkSession.sparkContext.defaultParallelism))))
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("idx", array_to_vector("v").alias("v")), "v")
    return IndexedRowMatrix(vectors, n, d).toBlockMatrix(tall, d)


def _scatter(blocks: BlockMatrix, splits: int) -> np.ndarray:
    """blocks^T blocks. One block results, so without splits of the middle dimension one task would take all rows; the split is a
    parameter of the JVM method that the Python method leaves out."""
    left = blocks.transpose()._java_matrix_wrapper
    square = left.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(square, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _rows(blocks: BlockMatrix) -> DataFrame:
    """(idx, z) without a detour through Python rows."""
    found = callMLlibFunc("getIndexedRows", blocks.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return found.select(F.col("index").alias("idx"), vector_to_array("vector").alias("z"))


def _fit_one(fit: DataFrame, rows: DataFrame, d: int, most: int, names: dict) -> DataFrame:
    """Whitened rows of one vector length. fit (idx, g) and rows (idx, g, ..) are tables."""
    spark = rows.sparkSession
    n = fit.count()
    sums = dict(fit.select(F.posexplode("g")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(20,0)")).alias("s")).collect())
    whole, left = zip(*[divmod(int(sums[i]), n) for i in range(d)])
    centred = _per_entry(whole, [e / n for e in left], "D", lambda x, o: x.cast("double") - o)
    blocks = _blocks(fit.select("idx", centred.alias("v")), n, d)
    splits = 2 * spark.sparkContext.defaultParallelism
    values, axes = np.linalg.eigh(_scatter(blocks, splits) / n)
    k = min(most, d)
    total, values, axes = float(values.sum()), values[::-1][:k], axes[:, ::-1][:, :k]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(k)])
    used = values > max(float(values[0]), 0.0) * FLAT
    white = np.where(used, axes / np.sqrt(np.where(used, values, 1.0)), 0.0)
    by = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, white.ravel("F")))], 1), d, k)
    off = _scatter(blocks.multiply(by), splits) / n - np.eye(k)
    error = float(np.abs(off[np.ix_(used, used)]).max()) if used.any() else None
    m = rows.count()
    found = _rows(_blocks(rows.select("idx", centred.alias("v")), m, d).multiply(by))
    size = F.lit(n).cast("long")
    far = _per_entry(whole, left, "L", lambda x, o: F.try_subtract(F.try_multiply(x, size), o))
    squares = F.aggregate(F.transform(far, lambda t: F.try_multiply(t, t)), F.lit(0).cast("long"), F.try_add)
    z = F.transform(F.col("z"), lambda x, i: F.when(F.array(*[F.lit(bool(u)) for u in used])[i], x))
    share = F.array(*[F.lit(max(float(v), 0.0) / total if total > 0 else None).cast("double") for v in values])
    new = {"n": size, "deviation": squares, "whitened": z, "explained": share, "identity_error": F.lit(error).cast("double")}
    return rows.join(found, "idx").select(*names["kept"], *[new[c].alias(names[c]) for c in new])


NEW = ("n", "deviation", "whitened", "explained", "identity_error")


def whiten(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The usable rows of vectors plus n (size of the fit list), deviation (sum of squares of n x - S), whitened (array<double>, one per
    component), explained (array<double>, shares of the trace) and identity_error; an underscore follows names that vectors has."""
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(vectors.columns)]
    rows = vectors.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(vectors.columns)], grid(vec_col).alias("g")).where("g IS NOT NULL")
    rows = written(rows.withColumn("d", F.size("g")), "grid")
    names = {"kept": kept} | {c: fresh(vectors, c) for c in NEW}
    fit = written(rows.select("g", "d").distinct(), "fit")
    out = [rows.where("d = 0").select(*kept, F.lit(0).cast("long").alias(names["n"]), F.lit(0).cast("long").alias(names["deviation"]),
                                      F.array().cast("array<double>").alias(names["whitened"]), F.array().cast("array<double>").alias(names["explained"]),
                                      F.lit(None).cast("double").alias(names["identity_error"]))]
    for d in sorted(r["d"] for r in fit.select("d").where("d > 0").distinct().collect()):
        own, all_ = indexed(fit.where(F.col("d") == d).select("g"), "fit-rows"), indexed(rows.where(F.col("d") == d).drop("d"), "rows")
        out.append(_fit_one(own, all_, d, components, names))
    return reduce(DataFrame.unionByName, out)


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    white = whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return (white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("pos", "whitened"))
            .select("vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", "pos").alias("explained"), "identity_error"))
