"""Sweeps from moments, Huber boosting, trees as arrays, nested forests and two-sided cross-validation against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from costlake.operators import crossval, forest_grid, huber, models, sweep, trees
from costlake.sources import reports


def table(spark, x, y, fold=None):
    width = x.shape[1]
    rows = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold if fold is not None else np.arange(len(y)) % 5)]
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(width)) + ", label double, fold int").repartition(4)
    return VectorAssembler(inputCols=[f"x{i}" for i in range(width)], outputCol="features").transform(df)


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 5)) * [1, 10, 0.1, 1, 1] + [0, 1000, 0, 0, 0]
    x[:, 4] = 3.0  # doesn't vary
    y = x @ [2.0, 0.3, -5.0, 0.0, 1.0] + rng.normal(size=600)
    return x, y, np.arange(600) % 5


def plain_fit(x, y, alpha, l1):
    """Proximal gradient on |y - Xw|^2 / 2n + alpha * (...), features centred."""
    mx, my = x.mean(axis=0), y.mean()
    a, b = x - mx, y - my
    scale = np.maximum(a.std(axis=0), 1e-12)
    w = np.zeros(x.shape[1])
    for _ in range(20_000):
        for j in range(x.shape[1]):
            if scale[j] <= 1e-12:
                continue
            pull = a[:, j] @ (b - a @ w + a[:, j] * w[j]) / len(y)
            w[j] = math.copysign(max(abs(pull) - alpha * l1, 0), pull) / (scale[j] ** 2 + alpha * (1 - l1))
        if _ > 200:
            break
    return w, my - mx @ w


def test_sweep_is_each_fit_on_its_own(spark, noisy):
    x, y, fold = noisy
    got = {(r["model"], r["alpha"], r["fold"]): r for r in sweep.fold_sweep(table(spark, x, y, fold), {"ridge": [0.5, 40.0], "lasso": [0.01, 0.3]}).collect()}
    assert len(got) == 20
    for (model, alpha, k), r in got.items():
        inside = fold == k
        w, c = plain_fit(x[~inside], y[~inside], alpha / (~inside).sum() if model == "ridge" else alpha, float(model == "lasso"))
        for side, prefix in ((inside, ""), (~inside, "train_")):
            gap = y[side] - x[side] @ w - c
            assert r[f"{prefix}rmse"] == pytest.approx(math.sqrt((gap ** 2).mean()), rel=1e-6)
            assert r[f"{prefix}r2"] == pytest.approx(1 - (gap ** 2).mean() / y[side].var(), rel=1e-6)
        assert r["rows"] == inside.sum()


def test_sweep_reads_the_rows_once(spark, noisy):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = table(spark, *noisy).select("x0", "x1", "label", "fold")
    counted = VectorAssembler(inputCols=["x0", "x1"], outputCol="features").transform(df.mapInArrow(count, df.schema))
    sweep.penalty_sweep(counted, {"ridge": [0.1, 1.0, 10.0], "lasso": [0.1]}).collect()
    assert seen.value == 600


def test_sweep_without_rows_or_with_nulls(spark, noisy):
    x, y, fold = noisy
    df = table(spark, x, y, fold)
    df = df.withColumn("features", F.when(F.col("x0").isNotNull(), F.col("features")))
    odd = df.limit(3).withColumn("features", F.when(F.lit(False), F.col("features"))).unionByName(df.limit(20).withColumn("label", F.lit(None).cast("double"))).unionByName(df.limit(5).withColumn("fold", F.lit(None).cast("int")))
    a, b = (sweep.penalty_sweep(d, {"ridge": [1.0]}).first()["rmse"] for d in (df, df.unionByName(odd)))
    assert a == pytest.approx(b)
    assert sweep.penalty_sweep(df.limit(0), {"ridge": [1.0]}).count() == 0
    assert sweep.penalty_sweep(df.filter("fold = 1"), {"ridge": [1.0]}).count() == 0


def test_trees_as_arrays_predict_what_the_models_do(spark, noisy):
    df = trees.unnamed(table(spark, *noisy))
    one = DecisionTreeRegressor(maxDepth=6, seed=1).fit(df)
    x = np.array([r["features"].toArray() for r in df.collect()])
    tree = trees.from_debug_string(one.toDebugString)
    assert np.allclose(tree.value[tree.leaves(x)], [r["prediction"] for r in one.transform(df).collect()])
    flat = trees.from_debug_string(DecisionTreeRegressor(maxDepth=0).fit(df).toDebugString)
    assert len(flat.feature) == 1 and flat.leaves(x).tolist() == [0] * len(x)


def stop_here(tree, row, depth, least_split):
    node = level = 0
    while tree.feature[node] >= 0 and level < depth and tree.count[node] >= least_split:
        node = tree.left[node] if row[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
        level += 1
    return tree.value[node]


def test_nested_forests_are_cut_as_asked(spark, noisy, tmp_path, monkeypatch):
    df = trees.unnamed(table(spark, *noisy))
    forest = RandomForestRegressor(numTrees=6, maxDepth=8, seed=2).fit(df)
    forest.write().save(str(tmp_path / "forest"))
    found = trees.forest_trees(spark.read.parquet(str(tmp_path / "forest" / "data")))
    grid = forest_grid.Grid(trees=(2, 6), depth=(3, 100), least_split=(2, 60), least_leaf=(1,))
    for most in (3_000_000, 50):
        monkeypatch.setattr(forest_grid, "MOST_NODES", most)
        rows = forest_grid.nested_predictions(found, grid, df).collect()
        for r in rows[:50]:
            x = r["features"].toArray()
            want = [np.mean([stop_here(t, x, d, s) for t in found[:n]]) for n, d, s in grid.nested()]
            assert np.allclose(r["predictions"], want)
    whole = [r["prediction"] for r in forest.transform(df).collect()]
    assert np.allclose([r["predictions"][grid.nested().index((6, 100, 2))] for r in rows], whole)


def test_a_search_goes_on_where_it_stopped(spark, noisy, tmp_path, monkeypatch):
    df, log = table(spark, *noisy), str(tmp_path / "log")
    grid = forest_grid.Grid(trees=(2, 4), depth=(2, 4), least_split=(2, 20), least_leaf=(1, 10))
    fits = []
    fit = RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, rows: (fits.append(1), fit(self, rows))[1])
    monkeypatch.setattr(forest_grid, "append_run", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")) if len(fits) == 4 else reports.append_run(*a))
    with pytest.raises(RuntimeError):
        forest_grid.forest_scores(df, grid, "search", log, folds=3)
    assert len(fits) == 4 and reports.read_runs(spark, log).count() == 3 * 8
    monkeypatch.setattr(forest_grid, "append_run", reports.append_run)
    scores = forest_grid.forest_scores(df, grid, "search", log, folds=3)
    assert len(fits) == 4 + 3 and scores.count() == 3 * 16
    assert {forest_grid.name(r["trees"], r["depth"], r["least_split"], r["least_leaf"]) for r in scores.collect()} == set(grid.names())
    best = forest_grid.best_combination(scores).first()
    assert best["folds"] == 3 and best["rmse"] == pytest.approx(scores.groupBy("trees", "depth", "least_split", "least_leaf").agg(F.avg("rmse").alias("m")).agg(F.min("m")).first()[0])
    forest_grid.forest_scores(df, grid, "search", log, folds=3)
    assert len(fits) == 7


def test_huber_beats_absolute_loss_on_clean_data_and_squares_on_outliers(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(-1, 1, (400, 2))
    clean = 10 * x[:, 0] + 3 * np.sign(x[:, 1])
    df = table(spark, x, clean)
    model = huber.fit_huber(df, rounds=8, depth=3, rate=0.4)
    error = lambda rows: rows.agg(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0]
    absolute = GBTRegressor(lossType="absolute", maxIter=8, maxDepth=3, stepSize=0.4).fit(trees.unnamed(df))
    assert error(model.transform(df)) < error(absolute.transform(trees.unnamed(df)))
    spoilt = clean.copy()
    spoilt[::20] += 1000
    model = huber.fit_huber(table(spark, x, spoilt), rounds=8, depth=3, rate=0.4, least_rows=10)
    squared = GBTRegressor(maxIter=8, maxDepth=3, stepSize=0.4, minInstancesPerNode=10).fit(trees.unnamed(table(spark, x, spoilt)))
    assert error(model.transform(df)) < error(squared.transform(trees.unnamed(df)))


def test_huber_rounds_are_the_plain_ones(spark):
    rng = np.random.default_rng(6)
    x, y = (rng.integers(0, 2, 300)[:, None]).astype(float), rng.integers(0, 40, 300).astype(float)
    y += 15 * x[:, 0]
    low = lambda v, p: sorted(v)[max(math.ceil(len(v) * p), 1) - 1]
    rest = y - low(y, 0.5)
    points = []
    for _ in range(3):
        d = low(np.abs(rest), 0.9)
        points.append(d)
        for side in (0, 1):
            own = x[:, 0] == side
            m = low(rest[own], 0.5)
            rest[own] -= 0.3 * (m + np.clip(rest[own] - m, -d, d).mean())
    df = table(spark, x, y)
    model = huber.fit_huber(df, rounds=3, depth=1, rate=0.3)
    assert model.turning_points == pytest.approx(points)
    assert np.allclose(model.predict(x), y - rest)
    empty = huber.fit_huber(df.limit(0))
    assert empty.trees == [] and huber.fit_huber(df.withColumn("label", F.lit(4.0)), rounds=5).predict(x[:2]).tolist() == [4.0, 4.0]
    with_null = df.limit(1).withColumn("features", F.when(F.lit(False), F.col("features")))
    assert model.transform(with_null).first()["prediction"] is None


def test_few_huber_nodes_are_an_expression(spark, noisy, monkeypatch):
    df = table(spark, *noisy)
    settled = []
    settle = huber.settle
    monkeypatch.setattr(huber, "settle", lambda rows: (settled.append(1), settle(rows))[1])
    model = huber.fit_huber(df, rounds=5, depth=3, rate=0.3)
    assert len(model.trees) == 5 and not settled  # the last round leaves no residuals behind
    odd = df.limit(2).withColumn("features", F.when(F.lit(False), F.col("features")))
    rows = df.unionByName(odd)
    found = model.transform(rows)
    assert "Arrow" not in found._jdf.queryExecution().toString()
    got = [r["prediction"] for r in found.collect()]
    monkeypatch.setattr(huber, "FEW_NODES", 0)
    assert got == [r["prediction"] for r in model.transform(rows).collect()] and got[-2:] == [None, None]
    tree = trees.Tree(np.array([0, -1, -1]), np.array([1.0, 0, 0]), np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([0.0, 5.0, 7.0]), np.zeros(3))
    nan = spark.createDataFrame([([float("nan")],), ([1.0],)], "x array<double>").select(tree.expression(F.col("x")))
    assert [r[0] for r in nan.collect()] == [7.0, 5.0]


def test_scores_of_both_sides_and_their_run_row(spark, noisy, tmp_path):
    df = table(spark, *noisy)
    scores = crossval.cross_validated_sides({"line": models.ridge_log_cost(penalty=0.0, solver="normal")}, df, folds=5)
    got = {(r["fold"], r["side"]): r for r in scores.collect()}
    swept = {r["fold"]: r for r in sweep.fold_sweep(df, {"ridge": [0.0]}).collect()}
    assert len(got) == 10
    for (k, side), r in got.items():
        assert math.sqrt(r["mse"]) == pytest.approx(swept[k]["rmse" if side == "test" else "train_rmse"], rel=1e-5)
    reports.append_run(crossval.run_of(scores, "line", "test", df, "label", [], ["x0"], "v1", 7), str(tmp_path / "log"))
    row = reports.read_runs(spark, str(tmp_path / "log")).first()
    assert row["rmse_cv"] == pytest.approx([swept[k]["rmse"] for k in range(5)], rel=1e-5) and row["n_folds"] == 5
    assert row["rmse_cv_mean"] == pytest.approx(np.mean(row["rmse_cv"])) and row["dataset_rows"] == 600 and row["run_at"] is not None
    with pytest.raises(ValueError):
        reports.run_rows(spark, [{"no_such_field": 1}])
