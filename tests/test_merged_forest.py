"""Forests on merged rows against plain means of the drawn rows, and against forests on all rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from costlake.operators import crossval, merged_forest, models


def repeated(spark, rows=4000):
    """Few unlike vectors, a label that varies within each, and some rows without a key."""
    df = spark.range(rows).select(
        F.when(F.col("id") % 97 > 0, F.col("id")).alias("record_id"), (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
        (F.col("id") % 5).cast("int").alias("fold"), (F.col("id") % 2 * 10 + F.pmod(F.xxhash64("id"), F.lit(100)) / 50).alias("label"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_trees_are_means_of_the_drawn_rows(spark):
    df = repeated(spark)
    forest = models.random_forest(trees=7, depth=1, featureSubsetStrategy="all")
    fitted = merged_forest.MergingForest(forest).fit(df)
    assert isinstance(fitted, merged_forest.MergedForest)
    rest = [c for c in df.columns]
    dealt = F.when(F.col("record_id").isNull(), F.xxhash64(*rest, F.lit(42))).otherwise(F.xxhash64("record_id", F.lit(42)))
    found = df.select(dealt.alias("dealt"), "a", "label").toPandas()
    drawn = merged_forest.draws(found["dealt"].to_numpy(), 7, merged_forest.poisson_steps(0.8))
    assert drawn.mean() == pytest.approx(0.8, abs=0.05)
    got = {r["a"]: r["p"] for r in fitted.transform(df).groupBy("a").agg(F.avg("prediction").alias("p"), F.count("*").alias("n")).collect()}
    for a in (0.0, 1.0):  # one split, on the column that matters
        mine = (found["a"] == a).to_numpy()
        means = [np.average(found["label"][mine], weights=drawn[mine, t]) for t in range(7)]
        assert got[a] == pytest.approx(np.mean(means), rel=1e-9)


def test_a_leaf_needs_enough_drawn_rows_not_vectors(spark):
    df = repeated(spark, 400)
    split = merged_forest.MergingForest(models.random_forest(trees=3, depth=1, featureSubsetStrategy="all", minInstancesPerNode=100)).fit(df)
    whole = merged_forest.MergingForest(models.random_forest(trees=3, depth=1, featureSubsetStrategy="all", minInstancesPerNode=250)).fit(df)
    assert [t.totalNumNodes for t in split.grown] == [3, 3, 3] and [t.totalNumNodes for t in whole.grown] == [1, 1, 1]


def test_merged_and_unmerged_agree_in_cross_validation(spark):
    df = repeated(spark)
    plain = models.random_forest(trees=10, depth=3)
    both = {"merged": merged_forest.MergingForest(plain), "rows": merged_forest.MergingForest(plain, worth=1e9)}
    assert isinstance(both["rows"].fit(df), RandomForestRegressionModel)
    scores = {(r["model"], r["fold"], r["side"]): r["mse"] for r in crossval.cross_validated_sides(both, df, folds=5).collect()}
    assert len(scores) == 20
    for k in range(5):
        for side in ("train", "test"):
            assert scores["merged", k, side] == pytest.approx(scores["rows", k, side], rel=0.1)


def test_predicted_rows_stay_as_they_are(spark):
    df = repeated(spark)
    scored = merged_forest.MergingForest(models.random_forest(trees=3, depth=2)).fit(df).transform(df)
    assert scored.columns == [*df.columns, "prediction"]
    assert scored.count() == df.count() and scored.filter("prediction IS NULL").isEmpty()
    assert scored.schema["features"].metadata == df.schema["features"].metadata
