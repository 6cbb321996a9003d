"""Activation-risk models on MLlib: one-hot encoding, logistic regression, gradient
boosting, named coefficients, optimality of a fit, stored models and scoring.

Training data is persisted (memory and disk) for the iterative fits and released
afterwards; boosting checkpoints its lineage into the session's checkpoint folder. Above ``EARLY_ROWS``
rows boosting is watched by the loss on a tenth of the training rows. ``one_hot`` is the encoding as a
relation (row, feature, value), for readers that want no vectors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_uniform
from ..schemas import CATEGORICAL, NUMERIC
from ..session import checkpoint_dir, materialise

#: Rows above which boosting stops early, and the share of them that watches it.
EARLY_ROWS, VALIDATION = 10_000, 0.1
_HELD = "is_validation"


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Only the columns the table has (the mart path has no minutes feature)."""
    return [c for c in cols if c in df.columns]


def encoder_stages(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    """One-hot per category in alphabetical order; an unseen value becomes all zeros
    (the kept 'unknown' index is the dropped last slot)."""
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        VectorAssembler(inputCols=[*ohe, *numeric], outputCol="features"),
    ]


def _fit(train: DataFrame, estimator, target: str, categorical, numeric, columns: dict | None = None) -> PipelineModel:
    """``estimator`` makes the last stage from the number of training rows."""
    data = train.withColumns({"label": F.col(target).cast("double"), **(columns or {})}).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[*encoder_stages(categorical, numeric), estimator(data.count())]).fit(data)
    finally:
        data.unpersist()


def fit_logistic(train: DataFrame, target: str, categorical: Sequence[str] = CATEGORICAL,
                 numeric: Sequence[str] = NUMERIC, max_iter: int = 1000, tol: float = 1e-10) -> PipelineModel:
    """L2 logistic regression with strength 1 per sample (regParam = 1 / n), unscaled inputs."""
    categorical, numeric = present(train, categorical), present(train, numeric)
    return _fit(train, lambda n: LogisticRegression(
        maxIter=max_iter, tol=tol, regParam=1.0 / max(n, 1), elasticNetParam=0.0,
        standardization=False, featuresCol="features", labelCol="label"), target, categorical, numeric)


def fit_gbt(train: DataFrame, target: str, categorical: Sequence[str] = CATEGORICAL,
            numeric: Sequence[str] = NUMERIC, max_iter: int = 100, seed: int = 42, early_stopping: bool | None = None,
            validation: float = VALIDATION, tol: float = 1e-4, id_col: str = "user_id") -> PipelineModel:
    """Gradient-boosted trees: at most 100 rounds, rate 0.1, depth 5, 20 rows per leaf, 255 bins.

    With early stopping (default: above EARLY_ROWS rows) a share of the rows, drawn by a hash of the id, is held out of the trees;
    a round that lowers the loss on them by less than ``tol`` of it is the last, and the model is the best prefix of the
    rounds. ``rounds`` tells how many were kept."""
    categorical, numeric = present(train, categorical), present(train, numeric)
    checkpoint_dir(train.sparkSession)
    gbt = GBTClassifier(maxIter=max_iter, stepSize=0.1, maxDepth=5, minInstancesPerNode=20, maxBins=255,
                        seed=seed, checkpointInterval=10, featuresCol="features", labelCol="label")
    watched = gbt.copy({gbt.validationIndicatorCol: _HELD, gbt.validationTol: tol})
    held = hash_uniform(F.col(id_col), "validation", seed) < F.lit(validation)
    return _fit(train, lambda n: watched if early_stopping or (early_stopping is None and n > EARLY_ROWS) else gbt,
                target, categorical, numeric, {_HELD: held})


def rounds(model: PipelineModel) -> int:
    """Boosting rounds that a fitted model keeps."""
    return model.stages[-1].getNumTrees


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("user_id",), target: str | None = None,
          out_col: str = "probability_activate") -> DataFrame:
    """Probability of the positive class for every row."""
    cols = [*keep, *([target] if target else [])]
    return model.transform(df).select(*cols, vector_to_array("probability")[1].alias(out_col))


def feature_names(model: PipelineModel) -> list[str]:
    """The names of the feature vector's slots."""
    assembler, indexer = model.stages[-2], model.stages[0]
    names = [f"{col}_{v}" for col, labels in zip(indexer.getInputCols(), indexer.labelsArray) for v in labels]  # dropLast removes only the unknown slot
    return names + [c for c in assembler.getInputCols() if not c.endswith("__ohe")]


def coefficients(model: PipelineModel) -> list[tuple[str, float]]:
    """(feature name, coefficient) of the logistic stage, largest |effect| first."""
    return sorted(zip(feature_names(model), model.stages[-1].coefficients.toArray().tolist()), key=lambda t: -abs(t[1]))


def coefficients_frame(spark, model: PipelineModel) -> DataFrame:
    rows = coefficients(model)
    return spark.createDataFrame(rows, "feature string, coefficient double")


def logistic_gradient(model: PipelineModel, train: DataFrame, target: str) -> DataFrame:
    """feature, gradient, scale: the derivative of the penalised mean log-loss by each coefficient (and the intercept) at the fit,
    and the root mean square of the feature on ``train``. At the optimum every gradient is 0.

    One pass: each row emits its non-zero features times its residual, which add up before the shuffle."""
    last, spark = model.stages[-1], train.sparkSession
    names = [*feature_names(model), "intercept"]
    slots = spark.createDataFrame(list(enumerate(zip(names, [*last.coefficients.toArray().tolist(), 0.0]))), "pos int, slot struct<feature: string, coefficient: double>")
    scored = model.transform(train.withColumn("label", F.col(target).cast("double")))
    x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    rows = scored.select((vector_to_array("probability")[1] - F.col("label")).alias("off"), F.posexplode(x))
    sums = rows.groupBy("pos").agg(F.sum(F.col("col") * F.col("off")).alias("g"), F.sum(F.col("col") * F.col("col")).alias("q"), F.count(F.lit(1)).alias("n"))
    return sums.join(slots, "pos").select("slot.feature", (F.col("g") / F.col("n") + F.lit(last.getRegParam()) * F.col("slot.coefficient")).alias("gradient"),
                                          F.sqrt(F.col("q") / F.col("n")).alias("scale"))


def categories(train: DataFrame, categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """column, value: every value that a categorical column takes, NULL excepted; a stored table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present(train, categorical)]))
    return materialise(train.select(pairs.alias("p")).select("p.*").where("value IS NOT NULL").distinct(), "categories")


def one_hot(df: DataFrame, known: DataFrame, categorical: Sequence[str] = CATEGORICAL, numeric: Sequence[str] = NUMERIC,
            id_col: str = "user_id") -> DataFrame:
    """id, feature, value: the one-hot matrix as a sparse relation. A category is a feature ``column_value`` of value 1; one that ``known`` does
    not list, or NULL, has no row. Numeric columns are passed through, zeros and NULLs without a row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present(df, categorical)])
    hot = (df.select(id_col, F.explode(pairs).alias("p")).select(id_col, "p.*").join(known, ["column", "value"])
           .select(id_col, F.concat_ws("_", "column", "value").alias("feature"), F.lit(1.0).alias("value")))
    plain = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in present(df, numeric)])
    return hot.unionByName(df.select(id_col, F.inline(plain)).where("value <> 0"))


def save(model: PipelineModel, path: str) -> None:
    """Store a fitted model, its category lists and feature names with it, in shared storage."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
