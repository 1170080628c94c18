"""Boosting within a task and trees on cells against those of ``pyspark.ml``."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from checks import q_models, registry
from costlake.operators import boosting, cells, forest_grid


@pytest.fixture(scope="module")
def shared_vectors(spark):
    """2,000 rows with some 400 unlike vectors."""
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 12, 2000), rng.integers(0, 2, 2000), rng.integers(-3, 4, 2000) / 4, np.full(2000, 5.0)], axis=1)
    y = x @ [0.3, -1.0, 2.0, 0.0] + x[:, 0] * x[:, 1] * 0.2 + rng.normal(size=2000)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, d double, label double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).repartition(3)


def predictions(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()])


def test_all_rounds_of_the_variants_are_made(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(q_models, "_fit_and_measure", lambda spark, sf, estimators, *a, **k: asked.update(estimators))
    registry.QUERIES["mod_07_boosted_variants"](None, None)
    made = {name: getattr(e, "boosting", e) for name, e in asked.items()}
    assert {name: (e.getMaxIter(), e.getMaxDepth()) for name, e in made.items()} == {"absolute_loss": (1000, 9), "sampled_columns": (250, 10), "shallow": (300, 3)}


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_boosting_in_a_task_is_that_of_spark(shared_vectors, loss):
    plain = GBTRegressor(lossType=loss, maxIter=12, maxDepth=4, stepSize=0.2, minInstancesPerNode=5, maxBins=64)
    model = boosting.CompactBoosting(plain).fit(shared_vectors)
    assert isinstance(model, boosting.BoostedTrees) and len(model.trees) == 12
    got, want = predictions(model, shared_vectors), predictions(plain.fit(shared_vectors), shared_vectors)
    assert np.allclose(got, want, atol=1e-9)


def test_larger_tables_and_odd_rows_are_left_to_spark(shared_vectors):
    plain = GBTRegressor(maxIter=2, maxDepth=2)
    small = boosting.CompactBoosting(plain, most_rows=100).fit(shared_vectors)
    assert not isinstance(small, boosting.BoostedTrees)
    unknown = shared_vectors.withColumn("features", F.when(F.col("id") > 0, F.col("features")))
    scored = boosting.CompactBoosting(plain).fit(shared_vectors).transform(unknown)
    assert scored.count() == 2000 and scored.filter("prediction IS NULL").count() == 1


def test_drawn_rows_and_columns_dont_depend_on_partitions(shared_vectors, monkeypatch):
    sampled = GBTRegressor(maxIter=20, maxDepth=5, stepSize=0.2, subsamplingRate=0.6, featureSubsetStrategy="0.5", seed=3)
    first = boosting.CompactBoosting(sampled).fit(shared_vectors)
    again = boosting.CompactBoosting(sampled).fit(shared_vectors.repartition(7))
    assert np.allclose(predictions(first, shared_vectors), predictions(again, shared_vectors))
    y = np.array([r[0] for r in shared_vectors.orderBy("id").select("label").collect()])
    assert np.mean((predictions(first, shared_vectors) - y) ** 2) < 1.3
    counts = [t.count[0] for t in first.trees]
    assert len(set(counts)) > 5 and 1100 < min(counts) and max(counts) < 1300
    assert all(((t.count[t.feature < 0]) >= 1).all() for t in first.trees)


def test_trees_on_cells_are_those_of_spark(spark, shared_vectors, monkeypatch):
    plain = DecisionTreeRegressor(maxDepth=7, minInstancesPerNode=3, maxBins=64)
    want = predictions(plain.fit(shared_vectors), shared_vectors)
    made, _, cell = cells.unlike_cells(shared_vectors, "features", 64)
    rows = shared_vectors.select("id", cell.alias("c"), "label", "features").orderBy("id").collect()
    at = np.searchsorted(made.names, [r["c"] for r in rows])
    weight, total = np.bincount(at).astype(float), np.bincount(at, [r["label"] for r in rows])
    x = np.array([r["features"].toArray() for r in rows])
    for entries, some in ((4_000_000, 500_000), (60, 50)):
        monkeypatch.setattr(cells, "ENTRIES", entries)
        monkeypatch.setattr(cells, "SLICE", some)
        tree, leaf = cells.Grower(made).grow(weight, total, 7, 3, 4, np.random.default_rng(0))
        assert np.allclose(tree.value[leaf[at]], want) and (tree.leaves(x) == leaf[at]).all()
    same = cells.unpacked(dict(zip(("feature", "threshold", "left", "right", "value", "count"), cells.packed(tree))))
    assert (same.feature == tree.feature).all() and (same.value == tree.value).all()


def test_bins_part_at_equal_shares_and_odd_values():
    assert cells.parting(np.array([1.0, 2.0, 4.0]), np.array([1, 1, 1]), 64).tolist() == [1.5, 3.0]
    many = cells.parting(np.arange(1000.0), np.ones(1000, int), 10)
    assert len(many) == 9 and np.allclose(np.diff(many), 100)
    odd = cells.parting(np.array([-np.inf, 0.0, np.inf, np.nan]), np.ones(4, int), 64)
    assert odd.tolist() == [-np.inf, 0.0] and cells.parting(np.array([3.0]), np.array([5]), 64).tolist() == []
    assert [cells.columns_of(s, 41, 1) for s in ("all", "auto", "sqrt", "onethird", "0.2", "5", "1.0")] == [41, 41, 7, 14, 9, 5, 41]


def test_grid_search_on_shared_vectors_scores_as_spark_does(spark, shared_vectors, tmp_path, monkeypatch):
    rows = shared_vectors.withColumn("fold", F.col("id") % 3)  # folds 0 and 1 are held in turn
    grid = forest_grid.Grid(trees=(10, 40), depth=(3, 8), least_split=(2, 60), least_leaf=(1, 20))
    want = forest_grid.forest_scores(rows, grid, "plain", str(tmp_path / "plain"), folds=2)
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda *a: pytest.fail("a fit of Spark"))
    got = forest_grid.forest_scores(rows, grid, "cells", str(tmp_path / "cells"), folds=2, parallelism=2, key="id")
    keys = ["trees", "depth", "least_split", "least_leaf", "fold"]
    both = got.join(want.withColumnRenamed("rmse", "plain"), keys).collect()
    assert len(both) == 2 * 16
    # the draws are others, so errors are alike only
    assert all(r["rmse"] == pytest.approx(r["plain"], rel=0.03) for r in both)
    again = forest_grid.forest_scores(rows.repartition(5), grid, "again", str(tmp_path / "cells"), folds=2, key="id")
    assert all(r["rmse"] == pytest.approx(r["other"]) for r in again.join(got.withColumnRenamed("rmse", "other"), keys).collect())
    odd = rows.unionByName(rows.limit(3).withColumn("label", F.lit(None).cast("double"))).withColumn("id", F.when(F.col("id") > 5, F.col("id")))
    assert forest_grid.forest_scores(odd, forest_grid.Grid((2,), (2,), (2,), (1,)), "odd", str(tmp_path / "odd"), folds=4, key="id").count() == 3


def test_errors_on_cells_are_those_of_all_held_rows(spark, shared_vectors):
    rows = shared_vectors.select("features", "label", (F.col("id") % 2).alias("fold"), F.xxhash64("id").alias("__dealt"))
    grid = forest_grid.Grid(trees=(2, 4), depth=(2, 5), least_split=(2,), least_leaf=(3,))
    forests = forest_grid.CellForests(rows, grid, "features", "label", "fold", 2, 0, dict(maxBins=64, subsamplingRate=1.0, featureSubsetStrategy="all"))
    grown = []
    nested = forest_grid.nested_predictions
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(forest_grid, "nested_predictions", lambda forest, *a: (grown.append(forest), nested(forest, *a))[1])
        got = forests.errors_of(3, [0, 1])((3, 1))
    # trees know the draws of the other fold only
    assert all(800 < t.count[0] < 1200 and t.count[t.feature < 0].min() >= 3 for t in grown[0]) and len(grown[0]) == 4
    scored = nested(grown[0], grid, rows.filter("fold = 1"))
    want = scored.agg(*[F.sqrt(F.avg(F.pow(F.get("predictions", i) - F.col("label"), 2))) for i in range(4)]).first()
    assert got == pytest.approx(list(want))
    forests.close()
