"""Gradient boosting with the Huber loss.

Each round takes the turning point d as a quantile of the absolute residuals, fits a tree to the residuals held
within [-d, d], and then sets every leaf anew: the median m of its residuals plus the mean of the residuals' distances
from m held within [-d, d]. Rows stay distributed; the driver sees one tree and one number a leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.operators.quantiles import DEFAULT_ACCURACY
from costlake.operators.trees import Tree, from_debug_string, summed, unnamed, with_arrays
from costlake.session import settle

#: Nodes up to which trees are applied as an expression, without Python workers.
FEW_NODES = 256
#: Rounds after which the rows' state is written, so that a lost executor costs that many rounds at most.
SETTLE_EVERY = 5


@dataclass(frozen=True)
class HuberModel:
    """A start value and trees whose predictions are added at a rate."""

    start: float
    rate: float
    trees: list[Tree]
    turning_points: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return summed(self.trees, self.start, self.rate, x)

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        """``df`` with a prediction; a NULL vector gives a NULL. Few nodes become one expression; many travel once to each worker."""
        if sum(len(tree.feature) for tree in self.trees) <= FEW_NODES:
            total = F.lit(self.start)
            for tree in self.trees:
                total = total + F.lit(self.rate) * tree.expression(F.col("__x"))
            known = df.withColumn("__x", F.when(F.col(features).isNotNull(), vector_to_array(features)))
            return known.withColumn(out, F.when(F.col("__x").isNotNull(), total)).drop("__x")
        shared = df.sparkSession.sparkContext.broadcast((self.trees, self.start, self.rate))  # rounds * 2^(depth + 1) nodes at most
        return with_arrays(df, features, T.StructField(out, T.DoubleType()), lambda x: pa.array(summed(*shared.value, x)))


def fit_huber(train: DataFrame, features: str = "features", label: str = "label", rounds: int = 1000, depth: int = 9, rate: float = 0.05,
              alpha: float = 0.9, least_rows: int = 3, bins: int = 64, accuracy: int = DEFAULT_ACCURACY, seed: int = 42) -> HuberModel:
    """Boost ``rounds`` trees of a depth on the rows of ``train``; rows with a NULL label or vector take no part.

    ``alpha`` is the share of residuals inside the turning point, ``least_rows`` the least rows of a leaf. Medians and
    turning points come from sketches of the given accuracy, which are exact while a sketch holds all distinct
    values. It ends early when the turning point is 0, as nothing would change any more. No rows give no trees and start 0.
    """
    rows = unnamed(train, features).select(F.col(features).alias("features"), F.col(label).cast("double").alias("y"))
    rows = rows.filter(F.col("y").isNotNull() & ~F.isnan("y") & F.col("features").isNotNull())
    start = rows.agg(F.percentile_approx("y", 0.5, accuracy)).first()[0]
    if start is None:
        return HuberModel(0.0, rate, [], [])
    grower = DecisionTreeRegressor(featuresCol="features", labelCol="__held", maxDepth=depth, minInstancesPerNode=least_rows,
                                   maxBins=bins, maxMemoryInMB=512, seed=seed).setLeafCol("__leaf")
    state = rows.withColumn("rest", F.col("y") - F.lit(start)).persist(StorageLevel.MEMORY_AND_DISK)
    trees, points = [], []
    try:
        for done in range(1, rounds + 1):
            point = float(state.agg(F.percentile_approx(F.abs("rest"), alpha, accuracy)).first()[0])
            if point == 0:
                break
            held = state.withColumn("__held", F.greatest(F.lit(-point), F.least(F.lit(point), F.col("rest"))))
            model = grower.fit(held)
            placed = model.transform(state).select("features", "y", "rest", F.col("__leaf").cast("int").alias("leaf")).persist(StorageLevel.MEMORY_AND_DISK)
            values = _leaf_values(placed, model.numLeaves if hasattr(model, "numLeaves") else (model.numNodes + 1) // 2, point, accuracy)
            trees.append(from_debug_string(model.toDebugString).with_leaf_values(np.array(values)))
            points.append(point)
            if done == rounds:  # nobody reads the residuals of the last round
                placed.unpersist()
                break
            after = placed.select("features", "y", (F.col("rest") - rate * F.element_at(F.array(*map(F.lit, values)), F.col("leaf") + 1)).alias("rest"))
            after = settle(after) if done % SETTLE_EVERY == 0 else after
            after = after.persist(StorageLevel.MEMORY_AND_DISK)
            after.count()
            placed.unpersist()
            state.unpersist()
            state = after
    finally:
        state.unpersist()
    return HuberModel(float(start), rate, trees, points)


def _leaf_values(placed: DataFrame, leaves: int, point: float, accuracy: int) -> list[float]:
    """What each leaf adds: its median residual and the mean distance from it, held within the turning point."""
    middles = {r["leaf"]: r["m"] for r in placed.groupBy("leaf").agg(F.percentile_approx("rest", 0.5, accuracy).alias("m")).collect()}
    middle = [float(middles.get(i, 0.0)) for i in range(leaves)]
    off = F.col("rest") - F.element_at(F.array(*map(F.lit, middle)), F.col("leaf") + 1)
    steps = {r["leaf"]: r["s"] for r in placed.groupBy("leaf").agg(F.avg(F.greatest(F.lit(-point), F.least(F.lit(point), off))).alias("s")).collect()}
    return [m + float(steps.get(i, 0.0)) for i, m in enumerate(middle)]
