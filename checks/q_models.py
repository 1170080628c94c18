"""Encoders, models and their inspection (ENC, MOD, XAI)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixtures import sql_list
from checks.registry import check
from costlake.functions.text import ENGLISH_STOP_WORDS
from costlake.operators import boosting, crossval, encode, forest_grid, huber, merged_forest, metrics, models, splits, sweep
from costlake.operators.cleaning import fill_categories
from costlake.plans import layers, training
from costlake.session import scratch_path, settle
from costlake.sources import reports
from costlake.sources.models import load_model

POLICY = training.Policy(low=100.0, high=1_000_000.0, train=fx.TRAIN, validation=fx.VALIDATION, test_from=fx.TEST_FROM)
TEXT_POLICY = training.Policy(low=1.0, high=1_000_000.0, train=fx.TRAIN, validation=fx.VALIDATION,
                              test_from=fx.TEST_FROM, only_source="revised_cost")
CATEGORIES = ["zone", "category", "segment", "adu"]


def _category_jobs(spark, sf):
    return fill_categories(fx.jobs(spark, sf), CATEGORIES)


def _encoded(spark, sf):
    rows = _category_jobs(spark, sf)
    stages, columns = encode.structured_stages(CATEGORIES, ["existing_stories", "proposed_units"], quantile_error=0, train=rows)
    return models.fit_stages([*stages, encode.assembler(columns)], rows).transform(rows)


_INDEX = f"""WITH {fx.JOBS}, c AS (SELECT coalesce(adu, '__MISSING__') AS adu, count(*) AS rows FROM jobs GROUP BY 1),
 i AS (SELECT adu, rows, CAST(row_number() OVER (ORDER BY rows DESC, adu) - 1 AS DOUBLE) AS index FROM c)"""


@check("enc_01_frequency_index", f"{_INDEX} SELECT adu, rows, index FROM i")
def _(spark, sf):
    return _encoded(spark, sf).groupBy("adu", F.col("adu__idx").alias("index")).agg(F.count(F.lit(1)).alias("rows"))


@check("enc_01_distributed_index", f"{_INDEX} SELECT adu, rows, index FROM i")
def _(spark, sf):
    rows = _category_jobs(spark, sf)
    return (encode.indexer(rows, ["adu"], ["index"], most=1).fit(rows).transform(rows)
            .groupBy("adu", "index").agg(F.count(F.lit(1)).alias("rows")))


@check("enc_02_one_hot", f"{_INDEX} SELECT adu, CAST(index AS INTEGER) AS slot, CAST((SELECT count(*) FROM i) + 1 AS INTEGER) AS slots FROM i")
def _(spark, sf):
    slots = vector_to_array("adu__ohe")
    return _encoded(spark, sf).select("adu", (F.array_position(slots, 1.0) - 1).cast("int").alias("slot"),
                                      F.size(slots).alias("slots")).distinct()


@check("enc_03_median_imputation", f"""WITH {fx.JOBS} SELECT record_id,
 coalesce(existing_stories, (SELECT quantile_disc(existing_stories, 0.5) FROM jobs)) AS existing_stories,
 CAST(coalesce(proposed_units, (SELECT quantile_disc(proposed_units, 0.5) FROM jobs)) AS INTEGER) AS proposed_units FROM jobs""")
def _(spark, sf):
    return _encoded(spark, sf).select("record_id", F.col("existing_stories__imp").alias("existing_stories"),
                                      F.col("proposed_units__imp").cast("int").alias("proposed_units"))


@check("enc_04_assembled_vector", f"""WITH {fx.JOBS} SELECT CAST(count(DISTINCT zone) + count(DISTINCT category)
 + count(DISTINCT segment) + count(DISTINCT coalesce(adu, '__MISSING__')) + 4 + 2 AS INTEGER) AS slots, count(*) AS rows FROM jobs""")
def _(spark, sf):
    return (_encoded(spark, sf).groupBy(F.size(vector_to_array("features")).alias("slots"))
            .agg(F.count(F.lit(1)).alias("rows")))


@check("enc_05_standardized", f"""WITH {fx.JOBS}, f AS (SELECT record_id, segment,
  coalesce(existing_units, (SELECT quantile_disc(existing_units, 0.5) FROM jobs)) AS u,
  coalesce(proposed_stories, (SELECT quantile_disc(proposed_stories, 0.5) FROM jobs)) AS s FROM jobs),
 m AS (SELECT avg(u) AS mu, stddev_pop(u) AS su, avg(s) AS ms, stddev_pop(s) AS ss FROM f)
 SELECT record_id, round((u - mu) / su, 6) AS units, round((s - ms) / ss, 6) AS stories,
  CASE WHEN segment = (SELECT min(segment) FROM jobs) THEN 0.0E0 ELSE 1.0E0 END AS set_slots FROM f, m""")
def _(spark, sf):
    rows = fx.jobs(spark, sf)
    stages = encode.standardized_stages(rows, ["existing_units", "proposed_stories", "segment"])
    v = vector_to_array("features")
    return models.fit_stages(stages, rows).transform(rows).select(
        "record_id", F.round(v[0], 6).alias("units"), F.round(v[1], 6).alias("stories"),
        F.aggregate(F.slice(v, 3, F.size(v) - 2), F.lit(0.0), lambda a, x: a + x).alias("set_slots"))


# ------------------------------------------------------------- models

@check("mod_01_median_baseline", f"""WITH {fx.TARGETS}, m AS (SELECT quantile_disc(target_cost, 0.5) AS m FROM targets WHERE split = 'train')
 SELECT record_id, m AS prediction_cost, round(log10(m), 6) AS prediction FROM targets, m WHERE split <> 'train'""")
def _(spark, sf):
    rows = fx.split_jobs(spark, sf)
    out = models.median_baseline(rows.filter(F.col("split") == "train"), rows.filter(F.col("split") != "train"),
                                 "target_cost", exact=True)
    return out.select("record_id", "prediction_cost", F.round("prediction", 6).alias("prediction"))


@check("src_09_training_summary", f"""WITH {fx.TARGETS}, kept AS (SELECT * FROM targets
  WHERE target_cost BETWEEN greatest(100, (SELECT quantile_disc(target_cost, 0.01) FROM targets))
  AND least(1000000, (SELECT quantile_disc(target_cost, 0.99) FROM targets)))
 SELECT split, count(*) AS rows, 100.0E0 AS minimum_cost, 'linear_regression' AS best_model, 4 AS scores, true AS same_rmse FROM kept WHERE split IS NOT NULL GROUP BY split""")
def _(spark, sf):
    path = scratch_path(spark, "training")
    result = training.compare_structured(_ready(spark, sf), POLICY, fx.JOB_TABLE, estimators={"linear_regression": models.ridge_log_cost(iterations=60)})
    training.write_training_reports(result, path)
    read = reports.read_summary_json(spark, f"{path}/results")
    own = F.filter("metrics", lambda m: (m["model"] == F.col("selection.best_model")) & (m["split"] == "validation"))[0]["rmse"]
    sizes = F.array(*[F.struct(F.lit(s).alias("split"), F.col(f"split_rows.{s}").alias("rows")) for s in splits.SPLITS])
    return read.select(F.inline(sizes), F.col("training_policy.minimum_cost").alias("minimum_cost"), F.col("selection.best_model").alias("best_model"),
                       F.size("metrics").alias("scores"), (own == F.col("selection.best_validation_rmse")).alias("same_rmse"))


def _line_items(spark, sf, *keep):
    """One feature against the price, on scales of about one."""
    rows = fx.table(spark, sf, "lineitem").select(
        (F.col("l_quantity") / 10).alias("x"), (F.col("l_extendedprice") / 10000).alias("label"), *keep)
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)


@check("mod_02_linear_regression", """SELECT round(regr_slope(l_extendedprice / 10000, l_quantity / 10), 6) AS slope,
 round(regr_intercept(l_extendedprice / 10000, l_quantity / 10), 6) AS intercept FROM lineitem""")
def _(spark, sf):
    fitted = models.ridge_log_cost(penalty=0.0, solver="normal").fit(_line_items(spark, sf))
    return spark.createDataFrame([(float(fitted.coefficients[0]), float(fitted.intercept))], "slope double, intercept double").select(
        F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


def _ready(spark, sf):
    # computed once, as the feature layer of a real run would be written once
    return settle(layers.feature_rows(fx.flagged_jobs(spark, sf), fx.JOB_TABLE, exact_bounds=True))


# rows every model must predict, by split; and no model may be far worse than the spread of the target
_PREDICTED = f"""WITH {fx.TARGETS}, kept AS (SELECT split FROM targets
  WHERE target_cost BETWEEN greatest(100, (SELECT quantile_disc(target_cost, 0.01) FROM targets))
  AND least(1000000, (SELECT quantile_disc(target_cost, 0.99) FROM targets)))
 SELECT model, split, count(*) AS rows, true AS error_bounded FROM kept, (VALUES {{models}}) m(model) GROUP BY model, split"""


def _vectors(spark, sf):
    """Split rows of the jobs with an encoded feature vector."""
    rows = training.training_rows(_ready(spark, sf), POLICY, fx.JOB_TABLE)
    train = rows.filter(F.col("split") == "train")
    stages, columns = encode.structured_stages(["zone", "category", "segment"],
                                               ["permit_creation_month", "proposed_stories", "proposed_units"])
    fitted = models.fit_stages([*stages, encode.assembler(columns)], train)
    return fitted.transform(rows).select("record_id", "split", "target_cost", "label", "features")


def _fit_and_measure(spark, sf, estimators, parallelism=1):
    vectors = _vectors(spark, sf).persist()
    _, scored = models.compare(estimators, vectors.filter(F.col("split") == "train"), vectors,
                               ["split", "target_cost", "label"], parallelism)
    measured = settle(metrics.log_metrics(scored, "label", "prediction", ["model", "split"]))
    vectors.unpersist()
    return measured.select("model", "split", "rows", (F.col("log_r2") > -1).alias("error_bounded"))


@check("mod_03_random_forest", _PREDICTED.format(models="('random_forest')"))
def _(spark, sf):
    return _fit_and_measure(spark, sf, {"random_forest": merged_forest.MergingForest(models.random_forest())})


@check("mod_04_boosted_trees", _PREDICTED.format(models="('gradient_boosted_trees')"))
def _(spark, sf):
    return _fit_and_measure(spark, sf, {"gradient_boosted_trees": models.boosted_trees()})


@check("mod_05_penalised_linear", """WITH s AS (SELECT count(*) AS n, covar_pop(l_extendedprice / 10000, l_quantity / 10) AS c,
  var_pop(l_quantity / 10) AS v FROM lineitem)
 SELECT 'lasso' AS model, round(greatest(c - 0.5, 0) / v, 4) AS slope FROM s UNION ALL
 SELECT 'ridge', round(c / (v + 500.0 / n), 4) FROM s UNION ALL
 SELECT 'elastic_net', round(greatest(c - 0.4 * 0.3, 0) / (v + 0.4 * 0.7), 4) FROM s""")
def _(spark, sf):
    rows = _line_items(spark, sf).persist()
    fitted = {"lasso": models.lasso(rows, 0.5, tolerance=1e-9), "ridge": models.ridge(rows, 500.0, tolerance=1e-9),
              "elastic_net": models.penalised_linear(rows, 0.4, 0.3, tolerance=1e-9)}
    slopes = [(name, float(e.fit(rows).coefficients[0])) for name, e in fitted.items()]
    rows.unpersist()
    return spark.createDataFrame(slopes, "model string, slope double").withColumn("slope", F.round("slope", 4))


@check("mod_06_quadratic_kernel_ridge")
def _(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select(
        (F.col("l_quantity") / 10).alias("a"), (F.col("l_discount") * 10).alias("b"),
        (F.col("l_tax") * 10).alias("c"), (F.col("l_extendedprice") / 10000).alias("label"))
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    fitted = models.fit_quadratic_ridge(rows, "features", 3)
    scored = fitted.transform(models.quadratic_features(rows, "features", 3, 0.05, 1.0))
    return metrics.log_metrics(scored.withColumn("model", F.lit("quadratic")), "label", "prediction", ["model"])


# with one feature the normal equations are three, solved here by Cramer's rule
@check("mod_06_one_feature", """WITH l AS (SELECT l_quantity / 10 AS x, l_extendedprice / 10000 AS y FROM lineitem),
 c AS (SELECT 0.05 AS g, sqrt(0.1) AS r),
 e AS (SELECT any_value(g) AS g, any_value(r) AS r, any_value(g * g) * sum(pow(x, 4)) + 0.5 AS a, any_value(g * r) * sum(pow(x, 3)) AS b,
  any_value(g) * sum(x * x) AS d, any_value(r * r) * sum(x * x) + 0.5 AS f, any_value(r) * sum(x) AS h, count(*) + 0.5 AS k,
  any_value(g) * sum(x * x * y) AS u, any_value(r) * sum(x * y) AS v, sum(y) AS w FROM l, c),
 t AS (SELECT *, a * (f * k - h * h) - b * (b * k - h * d) + d * (b * h - f * d) AS det FROM e),
 s AS (SELECT g, r, (u * (f * k - h * h) - b * (v * k - h * w) + d * (v * h - f * w)) / det AS p,
  (a * (v * k - h * w) - u * (b * k - h * d) + d * (b * w - v * d)) / det AS q,
  (a * (f * w - v * h) - b * (b * w - v * d) + u * (b * h - f * d)) / det AS o FROM t)
 SELECT x, count(*) AS rows, round(any_value(p * g * x * x + q * r * x + o), 5) AS prediction FROM l, s GROUP BY x""")
def _(spark, sf):
    rows = _line_items(spark, sf)
    fitted = models.fit_quadratic_ridge(rows, "features", 1)
    scored = fitted.transform(models.quadratic_features(rows, "features", 1, 0.05, 1.0))
    return scored.groupBy("x").agg(F.count(F.lit(1)).alias("rows"), F.round(F.first("prediction"), 5).alias("prediction"))


@check("mod_07_boosted_variants", _PREDICTED.format(models="('absolute_loss'), ('sampled_columns'), ('shallow')"))
def _(spark, sf):
    return _fit_and_measure(spark, sf, {
        "absolute_loss": boosting.CompactBoosting(models.robust_boosted_trees()),
        "sampled_columns": boosting.CompactBoosting(models.column_sampled_boosted_trees()),
        "shallow": boosting.CompactBoosting(models.shallow_boosted_trees())}, parallelism=3)


@check("mod_08_train_compare_select", """SELECT * FROM (VALUES ('median_baseline'), ('linear_regression'), ('random_forest'),
 ('gradient_boosted_trees')) m(model), (VALUES ('validation'), ('test')) s(split)""")
def _(spark, sf):
    result = training.compare_structured(_ready(spark, sf), POLICY, fx.JOB_TABLE)
    return result.metrics.filter(F.col("rmse") > 0).select("model", "split")


def _folded(spark, sf, folds):
    return splits.fold_column(_vectors(spark, sf), "record_id", folds, seed=3)


# Huber boosting: with one feature of two values every round splits there, so two rounds have a closed form
_HUBER = """q AS (SELECT CASE WHEN l_linenumber <= 2 THEN 1.0E0 ELSE 0.0E0 END AS x,
  l_quantity + CASE WHEN l_linenumber <= 2 THEN 20 ELSE 0 END + CASE WHEN l_partkey % 50 = 0 THEN 5000 ELSE 0 END AS y FROM lineitem),
 r0 AS (SELECT x, y, y - (SELECT quantile_disc(y, 0.5) FROM q) AS r FROM q)"""


def _huber_round(n):
    """CTEs that take the residuals r{n-1} to r{n}."""
    before = f"r{n - 1}"
    return f"""d{n} AS (SELECT quantile_disc(abs(r), 0.9) AS d FROM {before}),
 m{n} AS (SELECT x, quantile_disc(r, 0.5) AS m FROM {before} GROUP BY x),
 v{n} AS (SELECT x, any_value(m) + avg(greatest(-d, least(d, r - m))) AS v FROM {before} JOIN m{n} USING (x), d{n} GROUP BY x),
 r{n} AS (SELECT x, y, r - 0.5 * v AS r FROM {before} JOIN v{n} USING (x))"""


@check("mod_07_huber_rounds", f"""WITH {_HUBER}, {_huber_round(1)}, {_huber_round(2)}
 SELECT x, count(*) AS rows, round(avg(y - r), 6) AS prediction FROM r2 GROUP BY x""")
def _(spark, sf):
    rows = fx.table(spark, sf, "lineitem").selectExpr(
        "CASE WHEN l_linenumber <= 2 THEN 1.0D ELSE 0.0D END AS x",
        "CAST(l_quantity + CASE WHEN l_linenumber <= 2 THEN 20 ELSE 0 END + CASE WHEN l_partkey % 50 = 0 THEN 5000 ELSE 0 END AS DOUBLE) AS label")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    scored = huber.fit_huber(rows, rounds=2, depth=1, rate=0.5).transform(rows)
    return scored.groupBy("x").agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("prediction"), 6).alias("prediction"))


def _folded(spark, sf, folds):
    return splits.fold_column(_vectors(spark, sf), "record_id", folds, seed=3)


@check("mod_09_cross_validation", """SELECT model, CAST(fold AS INTEGER) AS fold, side, true AS scored FROM (VALUES ('ridge'), ('forest')) m(model),
 range(5) f(fold), (VALUES ('train'), ('test')) s(side)""")
def _(spark, sf):
    scores = crossval.cross_validated_sides({"ridge": models.ridge_log_cost(), "forest": merged_forest.MergingForest(models.random_forest())}, _folded(spark, sf, 5), folds=5)
    return scores.select("model", "fold", "side", ((F.col("mse") > 0) & (F.col("r2") < 1)).alias("scored"))


# with one feature the line of every fold has a closed form
_FOLD_LINES = """l AS (SELECT l_quantity / 10 AS x, l_extendedprice / 10000 AS y, CAST(l_orderkey % 5 AS INTEGER) AS own FROM lineitem),
 f AS (SELECT CAST(k AS INTEGER) AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM l JOIN range(5) r(k) ON own <> k GROUP BY k),
 p AS (SELECT fold, CASE WHEN own = fold THEN 'test' ELSE 'train' END AS side, y, a + b * x AS p FROM l, f),
 e AS (SELECT fold, side, 1 - avg(pow(y - p, 2)) / var_pop(y) AS r2, avg(pow(y - p, 2)) AS mse, avg(pow(ln(1 + y) - ln(1 + p), 2)) AS msle,
  avg(abs((y - p) / y)) * 100 AS mape, 1 - var_pop(y - p) / var_pop(y) AS explained_variance FROM p GROUP BY fold, side)"""


def _line_scores(spark, sf):
    rows = _line_items(spark, sf, (F.col("l_orderkey") % 5).cast("int").alias("fold"))
    return rows, crossval.cross_validated_sides({"line": models.ridge_log_cost(penalty=0.0, solver="normal")}, rows, folds=5)


@check("mod_09_two_sided_scores", f"""WITH {_FOLD_LINES} SELECT fold, side, round(r2, 6) AS r2, round(mse, 6) AS mse, round(msle, 6) AS msle,
 round(mape, 4) AS mape, round(explained_variance, 6) AS explained_variance FROM e""")
def _(spark, sf):
    _, scores = _line_scores(spark, sf)
    return scores.select("fold", "side", *[F.round(c, 4 if c == "mape" else 6).alias(c) for c in ("r2", "mse", "msle", "mape", "explained_variance")])


@check("mod_09_run_row", f"""WITH {_FOLD_LINES}, t AS (SELECT *, sqrt(mse) AS rmse FROM e WHERE side = 'test')
 SELECT 'one feature' AS experiment, 'line' AS model, (SELECT count(*) FROM lineitem) AS dataset_rows, 5 AS n_folds, fold, round(rmse, 6) AS rmse,
  round(r2, 6) AS r2, round(sqrt(msle), 6) AS rmsle, round(mape, 4) AS mape, round(explained_variance, 6) AS evs,
  round((SELECT avg(rmse) FROM t), 6) AS rmse_cv_mean, round((SELECT stddev_pop(rmse) FROM t), 6) AS rmse_cv_std FROM t""")
def _(spark, sf):
    rows, scores = _line_scores(spark, sf)
    path = scratch_path(spark, "runs")
    reports.append_run(crossval.run_of(scores, "line", "one feature", rows, "label", [], ["x"], random_state=0), path)
    logged = reports.read_runs(spark, path)
    arrays = F.arrays_zip("rmse_cv", "r2_cv", "rmsle_cv", "mape_cv", "evs_cv")
    per_fold = logged.drop("fold").select("*", F.posexplode(arrays).alias("fold", "s"))
    rounded = [F.round(F.col(f"s.{c}_cv"), 4 if c == "mape" else 6).alias(c) for c in ("rmse", "r2", "rmsle", "mape", "evs")]
    return per_fold.select("experiment", "model", "dataset_rows", "n_folds", "fold", *rounded,
                           F.round("rmse_cv_mean", 6).alias("rmse_cv_mean"), F.round("rmse_cv_std", 6).alias("rmse_cv_std"))


# as many combinations as the library's default grid (300 trees, depth 100), but smaller forests
GRID = forest_grid.Grid(trees=(3, 6, 12), depth=(3, 6, 12))


def _grid(spark, sf):
    return forest_grid.forest_scores(_folded(spark, sf, 5), GRID, "forest grid", scratch_path(spark, "runs"), folds=5, parallelism=5, key="record_id")


@check("mod_10_grid_search", f"""SELECT trees, depth, least_split, least_leaf, 5 AS folds, true AS scored FROM (SELECT unnest([3, 6, 12]) AS trees),
 (SELECT unnest([3, 6, 12]) AS depth), (SELECT unnest([4, 8, 12]) AS least_split), (SELECT unnest([1, 2, 10]) AS least_leaf)
 UNION ALL SELECT NULL, NULL, NULL, NULL, 5, true""")
def _(spark, sf):
    scores = settle(_grid(spark, sf))
    keys = ["trees", "depth", "least_split", "least_leaf"]
    each = scores.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("folds"), (F.min("rmse") > 0).alias("scored"), F.avg("rmse").alias("rmse"))
    least = each.agg(F.min("rmse")).scalar()
    best = forest_grid.best_combination(scores).select(*[F.lit(None).cast("int").alias(k) for k in keys], F.col("folds").cast("int").alias("folds"),
                                                       (F.abs(F.col("rmse") - least) <= 1e-9).alias("scored"))
    return each.drop("rmse").unionByName(best)


# The penalties that are compared.
LASSO_PENALTIES = [0.001, 0.0005, 0.0001, 0.00005]
RIDGE_PENALTIES = [0.05, 0.1, 0.3, 1.0, 3.0, 5.0, 10.0, 15.0, 30.0, 50.0, 75.0]


# with one feature the slope of every fold has a closed form: soft threshold for the lasso, shrunken for ridge
@check("mod_11_penalty_sweep", f"""WITH l AS (SELECT l_quantity / 10 AS x, l_extendedprice / 10000 AS y, l_orderkey % 5 AS fold FROM lineitem),
 f AS (SELECT k, count(*) AS n, covar_pop(y, x) AS c, var_pop(x) AS v, avg(x) AS mx, avg(y) AS my
  FROM l JOIN range(5) r(k) ON fold <> k GROUP BY k),
 p AS (SELECT 'lasso' AS model, unnest({LASSO_PENALTIES}::DOUBLE[]) AS alpha UNION ALL SELECT 'ridge', unnest({RIDGE_PENALTIES}::DOUBLE[])),
 m AS (SELECT model, alpha, k, mx, my, CASE model WHEN 'lasso' THEN sign(c) * greatest(abs(c) - alpha, 0) / v
  ELSE c / (v + alpha / n) END AS b FROM f, p),
 e AS (SELECT model, alpha, k, sqrt(avg(pow(y - my - b * (x - mx), 2))) AS rmse FROM m JOIN l ON fold = k GROUP BY model, alpha, k)
 SELECT model, alpha, round(avg(rmse), 5) AS rmse FROM e GROUP BY model, alpha""")
def _(spark, sf):
    rows = _line_items(spark, sf, (F.col("l_orderkey") % 5).cast("int").alias("fold"))
    found = sweep.penalty_sweep(rows, {"lasso": LASSO_PENALTIES, "ridge": RIDGE_PENALTIES})
    return found.select("model", "alpha", F.round("rmse", 5).alias("rmse"))


@check("mod_12_batch_scoring", f"""WITH {fx.JOBS} SELECT count(*) AS rows, count(*) AS in_domain FROM jobs""")
def _(spark, sf):
    path = scratch_path(spark, "scoring")
    training.compare_structured(_ready(spark, sf), POLICY, fx.JOB_TABLE, model_dir=path, estimators={
        "linear_regression": models.ridge_log_cost(iterations=60)})
    from costlake.plans.permits import scoring_schema

    rows = fx.jobs(spark, sf).withColumns({
        "description": F.lit(""), "district_cat": F.col("district").cast("string")})
    scored = models.score(load_model(f"{path}/best"), rows, scoring_schema(fx.JOB_TABLE), 100.0, 1_000_000.0)
    return scored.agg(F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col("prediction_cost").between(100.0, 1_000_000.0)).alias("in_domain"))


@check("mod_13_residuals", f"""WITH {fx.PREDICTIONS} SELECT model, record_id, round(log_p - log_y, 6) AS residual_log10,
 round(pow(10, log_p), 4) AS predicted_cost, round(pow(10, log_p) - pow(10, log_y), 4) AS residual_cost FROM predictions""")
def _(spark, sf):
    out = metrics.residuals(fx.predictions(spark, sf), "log_y", "log_p")
    return out.select("model", "record_id", F.round("residual_log10", 6).alias("residual_log10"),
                      F.round("predicted_cost", 4).alias("predicted_cost"),
                      F.round("residual_cost", 4).alias("residual_cost"))


@check("mod_14_feature_importances")
def _(spark, sf):
    rows = training.training_rows(_ready(spark, sf), POLICY, fx.JOB_TABLE)
    stages, columns = encode.structured_stages(["zone"], ["proposed_stories", "proposed_units"])
    encoded = models.fit_stages([*stages, encode.assembler(columns)], rows).transform(rows)
    return models.feature_importances(models.random_forest(trees=6, depth=5).fit(encoded), encoded)


@check("mod_14_importance_totals", f"""WITH {fx.TARGETS} SELECT CAST(count(DISTINCT zone) + count(DISTINCT category) + count(DISTINCT segment) + 3 + 3 AS BIGINT) AS slots,
 1.0E0 AS total, true AS in_range FROM targets WHERE split = 'train' AND target_cost BETWEEN
  greatest(100, (SELECT quantile_disc(target_cost, 0.01) FROM targets)) AND least(1000000, (SELECT quantile_disc(target_cost, 0.99) FROM targets))""")
def _(spark, sf):
    vectors = _vectors(spark, sf)
    found = models.feature_importances(models.random_forest().fit(vectors.filter(F.col("split") == "train")), vectors)
    return found.agg(F.count(F.lit(1)).alias("slots"), F.round(F.sum("importance"), 6).alias("total"),
                     (F.min("importance") >= 0).alias("in_range"))


# -------------------------------------------------- explaining a text model

_TRAIN_TERMS = f"""w AS (SELECT doc_id, {fx.sql_tokens('text', 3)} AS words FROM documents WHERE doc_id % 7 < 5 AND n_chars >= 1),
 o AS (SELECT doc_id, unnest(words) AS term FROM w),
 v AS (SELECT term FROM o WHERE NOT list_contains({sql_list(ENGLISH_STOP_WORDS)}, term) GROUP BY term
 HAVING count(DISTINCT doc_id) >= 20 ORDER BY count(*) DESC, term LIMIT 1500)"""


@check("xai_02_vocabulary_matches_coefficients", f"WITH {_TRAIN_TERMS} SELECT term, true AS has_coefficient FROM v")
def _(spark, sf):
    found = training.explain_text(fx.ready_documents(spark, sf), TEXT_POLICY, fx.JOB_TABLE)
    return found["terms"].select("term", F.col("coefficient_log10").isNotNull().alias("has_coefficient"))


@check("xai_04_companion_quality", """SELECT CASE WHEN doc_id % 7 = 5 THEN 'validation' ELSE 'test' END AS split, count(*) AS rows,
 true AS explains FROM documents WHERE n_chars >= 1 AND doc_id % 7 >= 5 GROUP BY 1""")
def _(spark, sf):
    found = training.explain_text(fx.ready_documents(spark, sf), TEXT_POLICY, fx.JOB_TABLE)
    return found["quality"].select("split", "rows", (F.col("log_r2") > 0).alias("explains"))
