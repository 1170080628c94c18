"""Regression models, comparison, cross-validation, search and batch scoring."""

from __future__ import annotations

import itertools
import math
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from costlake.functions.features import amount_from_log10
from costlake.operators.cleaning import fill_categories
from costlake.operators.quantiles import DEFAULT_ACCURACY, quantiles_row

# ---------------------------------------------------------------- estimators


def ridge_log_cost(label: str = "label", penalty: float = 0.05, iterations: int = 80,
                   solver: str = "l-bfgs") -> LinearRegression:
    """Ridge on the log target, solved the same way at every width so that models can be compared.

    Ask for ``normal`` (one pass over the rows, up to 4,096 features) where that is not needed.
    """
    return LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction",
                            solver=solver, maxIter=iterations, regParam=penalty, elasticNetParam=0.0,
                            standardization=True)


# Settings of the estimators that are compared.
FOREST = dict(maxBins=64, minInstancesPerNode=5, subsamplingRate=0.8, featureSubsetStrategy="sqrt", maxMemoryInMB=512, seed=42)
BOOSTED = dict(maxBins=64, stepSize=0.08, minInstancesPerNode=5, subsamplingRate=0.8, featureSubsetStrategy="sqrt", maxMemoryInMB=512, seed=42)
ABSOLUTE = dict(lossType="absolute", stepSize=0.05, minInstancesPerNode=3, subsamplingRate=1.0, featureSubsetStrategy="all")
SAMPLED = dict(stepSize=0.05, minInstancesPerNode=1)
SHALLOW = dict(stepSize=0.05, maxBins=50, subsamplingRate=0.8, featureSubsetStrategy="0.2", minInstancesPerNode=6)
TREES, FOREST_DEPTH = 35, 10
ROUNDS, BOOSTED_DEPTH = 25, 6
ROBUST_ROUNDS, ROBUST_DEPTH = 1000, 9
SAMPLED_ROUNDS, SAMPLED_DEPTH, SAMPLED_COLUMNS, SAMPLED_ROWS = 250, 10, 0.9, 0.8
SHALLOW_ROUNDS, SHALLOW_DEPTH = 300, 3


def random_forest(label: str = "label", trees: int = TREES, depth: int = FOREST_DEPTH, **params) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, **{**FOREST, **params})


def boosted_trees(label: str = "label", rounds: int = ROUNDS, depth: int = BOOSTED_DEPTH, **params) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, **{**BOOSTED, **params})


def robust_boosted_trees(label: str = "label", rounds: int = ROBUST_ROUNDS, depth: int = ROBUST_DEPTH, **params) -> GBTRegressor:
    """Boosting on absolute error; :func:`costlake.operators.huber.fit_huber` has the Huber loss."""
    return boosted_trees(label, rounds, depth, **{**ABSOLUTE, **params})


def column_sampled_boosted_trees(label: str = "label", rounds: int = SAMPLED_ROUNDS, depth: int = SAMPLED_DEPTH,
                                 columns: float = SAMPLED_COLUMNS, rows: float = SAMPLED_ROWS, **params) -> GBTRegressor:
    """Boosting with row and column sampling."""
    return boosted_trees(label, rounds, depth, **{**SAMPLED, "subsamplingRate": rows, "featureSubsetStrategy": str(columns), **params})


def shallow_boosted_trees(label: str = "label", rounds: int = SHALLOW_ROUNDS, depth: int = SHALLOW_DEPTH, **params) -> GBTRegressor:
    """Many small trees (about five leaves) on coarse bins."""
    return boosted_trees(label, rounds, depth, **{**SHALLOW, **params})


def penalised_linear(train: DataFrame, alpha: float, l1_ratio: float, label: str = "label",
                     wide: bool = False, iterations: int = 100, tolerance: float = 1e-6) -> LinearRegression:
    """Elastic net with the penalty meant on the mean-squared objective
    ``|y - Xw|^2 / 2n + alpha * (l1 * |w| + (1 - l1) / 2 * |w|^2)``; ``l1_ratio = 1`` is the lasso.

    Spark divides the L2 part by the label's deviation, so that factor is put back (the
    normal-equation solver means the population deviation, l-bfgs the sample one). Up to 4096
    features one pass builds the normal equations; set ``wide`` beyond that.
    """
    spread = F.stddev_samp(label) if wide else F.stddev_pop(label)
    deviation = train.agg(spread).first()[0] or 1.0
    total = alpha * (l1_ratio + deviation * (1 - l1_ratio))
    return LinearRegression(featuresCol="features", labelCol=label, solver="l-bfgs" if wide else "normal",
                            maxIter=iterations, tol=tolerance, regParam=total,
                            elasticNetParam=(alpha * l1_ratio / total) if total else 0.0,
                            standardization=False)


def ridge(train: DataFrame, alpha: float, label: str = "label", **limits) -> LinearRegression:
    """Ridge with the penalty meant on the sum of squares: ``|y - Xw|^2 + alpha * |w|^2``."""
    return penalised_linear(train, alpha / train.count(), 0.0, label, **limits)


def lasso(train: DataFrame, alpha: float, label: str = "label", **limits) -> LinearRegression:
    return penalised_linear(train, alpha, 1.0, label, **limits)


# ------------------------------------------- quadratic kernel ridge, explicit


def quadratic_features(df: DataFrame, features: str, size: int, gamma: float, coef0: float,
                       out: str = "quadratic") -> DataFrame:
    """The feature map whose dot product is ``(gamma * <a, b> + coef0) ** 2``."""
    x = vector_to_array(F.col(features))
    named = df.withColumn("__x", x)
    cells = [F.lit(float(gamma)) * F.col("__x")[i] * F.col("__x")[i] for i in range(size)]
    cells += [F.lit(math.sqrt(2) * gamma) * F.col("__x")[i] * F.col("__x")[j]
              for i, j in itertools.combinations(range(size), 2)]
    cells += [F.lit(math.sqrt(2 * gamma * coef0)) * F.col("__x")[i] for i in range(size)]
    cells.append(F.lit(float(coef0)))
    return named.withColumn(out, array_to_vector(F.array(*cells))).drop("__x")


def quadratic_width(size: int) -> int:
    return size + size * (size - 1) // 2 + size + 1


def fit_quadratic_ridge(train: DataFrame, features: str, size: int, label: str = "label",
                        alpha: float = 0.5, gamma: float = 0.05, coef0: float = 1.0, solver: str = "normal"):
    """Degree-2 polynomial kernel ridge solved in feature space, never as an n x n kernel.

    The penalty enters as one extra row per dimension (``sqrt(alpha)`` on that dimension,
    label 0), which is the same least-squares problem. Returns the fitted model; score with
    ``model.transform(quadratic_features(...))``. The ``normal`` solver is exact and takes up to
    4,096 dimensions (88 features); ask for ``l-bfgs``, which iterates, beyond that.
    """
    width = quadratic_width(size)
    mapped = quadratic_features(train, features, size, gamma, coef0).select(
        "quadratic", F.col(label).cast("double").alias(label))
    axes = F.transform(F.sequence(F.lit(0), F.lit(width - 1)),
                       lambda j: F.when(j == F.col("id"), math.sqrt(alpha)).otherwise(0.0))
    penalty = train.sparkSession.range(width).select(
        array_to_vector(axes).alias("quadratic"), F.lit(0.0).alias(label))
    regression = LinearRegression(featuresCol="quadratic", labelCol=label, fitIntercept=False, regParam=0.0,
                                  standardization=False, solver=solver, maxIter=500, tol=1e-10)
    return regression.fit(mapped.unionByName(penalty))


# ------------------------------------------------------------ baseline, scoring


def median_baseline(train: DataFrame, rows: DataFrame, target: str,
                    accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """``prediction_cost`` is the training median and ``prediction`` its log10."""
    median = quantiles_row(train, target, [0.5], exact, accuracy=accuracy).scalar()
    return rows.withColumns({"prediction_cost": median, "prediction": F.log10(median)})


def with_amounts(predictions: DataFrame, low: float, high: float) -> DataFrame:
    """Log predictions back on the amount scale, raw and held inside the model's domain."""
    return predictions.withColumns({
        "prediction_cost_raw": F.pow(F.lit(10.0), F.col("prediction")),
        "prediction_cost": amount_from_log10(F.col("prediction"), low, high),
    })


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to a scoring schema: absent nullable fields become NULL, absent required ones raise.

    Rows with NULL in a required field stay, so the caller sees a NULL prediction for them.
    """
    missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    extra = [F.col(c) for c in df.columns if c not in schema.names]
    fields = [(F.col(f.name).try_cast(f.dataType) if f.name in df.columns
               else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
    return df.select(*extra, *fields)


def score(model: PipelineModel, df: DataFrame, schema: StructType, low: float, high: float) -> DataFrame:
    """Predictions of a saved pipeline; missing categories take the slot they have in training."""
    categories = [f.name for f in schema if f.nullable and isinstance(f.dataType, StringType)]
    rows = fill_categories(conform(df, schema), categories)
    return with_amounts(model.transform(rows), low, high)


# -------------------------------------------------------- comparison and search


def compare(models: dict[str, Estimator], train: DataFrame, rows: DataFrame,
            keep: list[str], parallelism: int = 1) -> tuple[dict[str, Model], DataFrame]:
    """Fit every model, ``parallelism`` at a time, and stack its predictions on ``rows`` under a ``model`` column."""
    if parallelism > 1:
        pool = ThreadPool(parallelism)
        try:
            fitted = dict(zip(models, pool.map(inheritable_thread_target(train.sparkSession)(lambda e: e.fit(train)), models.values(), 1)))
        finally:
            pool.close()
    else:
        fitted = {name: estimator.fit(train) for name, estimator in models.items()}
    scored = [m.transform(rows).select(F.lit(name).alias("model"), *keep, "prediction")
              for name, m in fitted.items()]
    return fitted, reduce(DataFrame.unionByName, scored)


# ------------------------------------------------------------------ inspection


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Slot names the assembler recorded in the column's metadata."""
    attrs = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a.get("name", f"{features}_{a['idx']}")) for kind in attrs.values() for a in kind)
    return [name for _, name in slots]


def feature_importances(model: Model, df: DataFrame, features: str = "features") -> DataFrame:
    """Rows ``feature, importance``, one per vector slot."""
    values = model.featureImportances.toArray().tolist()
    rows = list(zip(feature_names(df, features), values))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def fit_stages(stages: list[Transformer | Estimator], train: DataFrame) -> PipelineModel:
    return Pipeline(stages=stages).fit(train)
