"""Aggregations and rankings (AGG, TOP)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from costlake.functions import features as ff
from costlake.operators import metrics, profile, quantiles, ranking, splits
from costlake.plans.reports import PROBABILITIES, THRESHOLDS
from costlake.sources import tables


def _rounded(df, places, *columns):
    return df.withColumns({c: F.round(c, places) for c in columns})


@check("agg_01_table_shape", "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem")
def _(spark, sf):
    return tables.table_shape(fx.table(spark, sf, "lineitem"))


@check("agg_02_conditional_counts", f"""WITH {fx.JOBS} SELECT count(*) FILTER (WHERE record_id IS NULL) AS missing_record_id,
 count(*) FILTER (WHERE permit_number IS NULL) AS missing_permit_number,
 count(*) FILTER (WHERE estimated_cost > 0) AS valid_estimated_cost,
 count(*) FILTER (WHERE revised_cost > 0) AS valid_revised_cost FROM jobs""")
def _(spark, sf):
    from costlake.plans.layers import quality_metrics

    return quality_metrics(fx.flagged_jobs(spark, sf), fx.JOB_TABLE)


@check("agg_03_duplicates_removed", f"""WITH {fx.VERSIONS} SELECT count(version_key) - count(DISTINCT version_key)
 AS duplicates_removed FROM versions""")
def _(spark, sf):
    return profile.duplicates_removed(fx.versions(spark, sf), "version_key")


@check("agg_04_distribution", """SELECT min(l_extendedprice) AS min, round(avg(l_extendedprice), 4) AS mean,
 round(stddev_samp(l_extendedprice), 4) AS stddev, max(l_extendedprice) AS max FROM lineitem""")
def _(spark, sf):
    return _rounded(profile.distribution(fx.table(spark, sf, "lineitem"), "l_extendedprice"), 4, "mean", "stddev")


@check("agg_05_center", """SELECT min(l_extendedprice) AS min, round(avg(l_extendedprice), 4) AS mean,
 quantile_disc(l_extendedprice, 0.5) AS median, max(l_extendedprice) AS max FROM lineitem""")
def _(spark, sf):
    return _rounded(profile.center(fx.table(spark, sf, "lineitem"), "l_extendedprice", exact=True), 4, "mean")


_PROFILE = " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS probability, quantile_disc(l_extendedprice, {p}) AS quantile FROM lineitem"
    for p in PROBABILITIES)


@check("agg_06_sketch_within_rank_error", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS probability, true AS within_error" for p in PROBABILITIES))
def _(spark, sf):
    rows = fx.table(spark, sf, "lineitem")
    error = 0.001
    bounds = [round(p + d, 6) for p in PROBABILITIES for d in (-error, error)]
    exact = quantiles.exact_quantiles(rows, "l_extendedprice", bounds)
    nearest = F.round("probability", 2).alias("probability")
    limits = exact.groupBy(nearest).agg(F.min("quantile").alias("low"), F.max("quantile").alias("high"))
    sketch = quantiles.sketch_quantiles(rows, "l_extendedprice", list(PROBABILITIES), accuracy=1000)
    return sketch.join(limits, "probability").select(
        "probability", F.col("quantile").between(F.col("low"), F.col("high")).alias("within_error"))


@check("agg_06_quantile_profile", _PROFILE)
def _(spark, sf):
    return quantiles.exact_quantiles(fx.table(spark, sf, "lineitem"), "l_extendedprice", list(PROBABILITIES))


@check("agg_06_quantile_profile_by_key", " UNION ALL ".join(
    f"""SELECT returnflag AS flag, CAST({p} AS DOUBLE) AS probability, round(quantile_cont(l_extendedprice, {p}), 6) AS quantile
 FROM (SELECT l_returnflag AS returnflag, l_extendedprice FROM lineitem) GROUP BY 1""" for p in (0.25, 0.5, 0.9)))
def _(spark, sf):
    lines = fx.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    return _rounded(quantiles.exact_quantiles(lines, "l_extendedprice", [0.25, 0.5, 0.9], ["flag"],
                                              interpolate=True), 6, "quantile")


@check("agg_07_threshold_counts", " UNION ALL ".join(
    f"""SELECT CAST({t} AS INTEGER) AS threshold, count(*) FILTER (WHERE l_extendedprice < {t}) AS rows_below,
 round(count(*) FILTER (WHERE l_extendedprice < {t}) * 100.0 / count(*), 4) AS percentage FROM lineitem"""
    for t in THRESHOLDS))
def _(spark, sf):
    return profile.threshold_counts(fx.table(spark, sf, "lineitem"), "l_extendedprice", list(THRESHOLDS))


def _profile_sql(keys, where=""):
    names = ", ".join(keys)
    return f"""WITH {fx.TARGETS} SELECT {names}, count(*) AS projects, round(avg(target_cost), 4) AS mean_cost,
 quantile_disc(target_cost, 0.5) AS median_cost FROM targets {where} GROUP BY {names}"""


@check("agg_08_group_profile", _profile_sql(["permit_creation_year"]))
def _(spark, sf):
    return _rounded(profile.group_profile(fx.target_jobs(spark, sf), ["permit_creation_year"], "target_cost", exact=True),
                    4, "mean_cost")


@check("agg_08_group_profile_known_keys", _profile_sql(["adu"], "WHERE adu IS NOT NULL"))
def _(spark, sf):
    return _rounded(profile.group_profile(fx.target_jobs(spark, sf), ["adu"], "target_cost",
                                          keep_null_keys=False, exact=True), 4, "mean_cost")


@check("agg_09_group_profile_two_keys", _profile_sql(["zone", "category"]))
def _(spark, sf):
    return _rounded(profile.group_profile(fx.target_jobs(spark, sf), ["zone", "category"], "target_cost", exact=True),
                    4, "mean_cost")


@check("agg_10_group_count", f"WITH {fx.TARGETS} SELECT target_source, count(*) AS rows FROM targets GROUP BY target_source")
def _(spark, sf):
    return profile.group_count(fx.target_jobs(spark, sf), ["target_source"])


@check("agg_11_column_averages", f"""WITH {fx.JOBS} SELECT round(avg(existing_stories), 6) AS avg_existing_stories,
 round(avg(proposed_stories), 6) AS avg_proposed_stories, round(avg(existing_units), 6) AS avg_existing_units,
 round(avg(proposed_units), 6) AS avg_proposed_units FROM jobs""")
def _(spark, sf):
    out = profile.column_averages(fx.jobs(spark, sf), {
        f"avg_{c}": c for c in ("existing_stories", "proposed_stories", "existing_units", "proposed_units")})
    return _rounded(out, 6, *out.columns)


_NULLABLE = ("permit_number", "revised_cost", "existing_stories", "proposed_units", "adu", "zone")


@check("agg_12_null_profile", f"WITH {fx.JOBS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing_rows,
 round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 4) AS missing_percentage FROM jobs""" for c in _NULLABLE))
def _(spark, sf):
    return profile.null_profile(fx.jobs(spark, sf), [*_NULLABLE, "no_such_column"])


@check("agg_13_non_null_counts", f"WITH {fx.JOBS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS non_null FROM jobs""" for c in _NULLABLE))
def _(spark, sf):
    return profile.non_null_counts(fx.jobs(spark, sf), list(_NULLABLE))


@check("agg_14_drift_by_split", f"""WITH {fx.TARGETS} SELECT split, count(*) AS rows, round(avg(target_cost), 4) AS mean,
 quantile_disc(target_cost, 0.5) AS p50, quantile_disc(target_cost, 0.75) AS p75,
 quantile_disc(target_cost, 0.9) AS p90, quantile_disc(target_cost, 0.95) AS p95 FROM targets GROUP BY split""")
def _(spark, sf):
    return _rounded(profile.drift(fx.split_jobs(spark, sf), "target_cost", exact=True), 4, "mean")


@check("agg_15_source_by_split", _profile_sql(["split", "target_source"]))
def _(spark, sf):
    return _rounded(profile.group_profile(fx.split_jobs(spark, sf), ["split", "target_source"], "target_cost", exact=True),
                    4, "mean_cost")


@check("agg_16_category_drift", f"""WITH {fx.TARGETS}, c AS (SELECT split, zone, count(*) AS rows FROM targets GROUP BY split, zone),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY rows DESC, zone) AS INTEGER) AS rank,
  round(rows * 100.0 / sum(rows) OVER (PARTITION BY split), 6) AS share_percent FROM c)
 SELECT split, zone, rows, rank, share_percent FROM r WHERE rank <= 8""")
def _(spark, sf):
    return _rounded(profile.category_drift(fx.split_jobs(spark, sf), "zone"), 6, "share_percent")


@check("agg_17_text_coverage", """SELECT lang, count(*) AS rows, count(*) FILTER (WHERE length(trim(text)) > 0) AS with_text,
 round(count(*) FILTER (WHERE length(trim(text)) > 0) * 100.0 / count(*), 6) AS percent FROM documents GROUP BY lang""")
def _(spark, sf):
    return _rounded(profile.text_coverage(fx.table(spark, sf, "documents"), "text", ["lang"]), 6, "percent")


@check("agg_18_split_sizes", f"WITH {fx.TARGETS} SELECT split, count(*) AS rows FROM targets GROUP BY split")
def _(spark, sf):
    return splits.split_sizes(fx.split_jobs(spark, sf))


@check("agg_19_regression_metrics", f"""WITH {fx.METRIC_ROWS} SELECT model, split, rows, round(mae, 4) AS mae,
 round(rmse, 4) AS rmse, round(r2, 6) AS r2, round(mape, 4) AS mape FROM metric_rows""")
def _(spark, sf):
    out = metrics.regression_metrics(fx.predictions(spark, sf), "y", "p", ["model", "split"])
    return _rounded(_rounded(out, 4, "mae", "rmse", "mape"), 6, "r2")


@check("agg_20_log_metrics", f"""WITH {fx.METRIC_ROWS} SELECT model, split, round(log_mae, 6) AS log_mae,
 round(log_rmse, 6) AS log_rmse, round(log_r2, 6) AS log_r2 FROM metric_rows""")
def _(spark, sf):
    out = fx.metric_rows(spark, sf).select("model", "split", "log_mae", "log_rmse", "log_r2")
    return _rounded(out, 6, "log_mae", "log_rmse", "log_r2")


_FOLDS = """SELECT model, fold, 1 - avg((log_y - log_p) * (log_y - log_p)) / var_pop(log_y) AS r2,
 avg((log_y - log_p) * (log_y - log_p)) AS mse, avg(pow(ln(1 + log_y) - ln(1 + log_p), 2)) AS msle,
 avg(abs((log_y - log_p) / log_y)) * 100 AS mape, 1 - var_pop(log_y - log_p) / var_pop(log_y) AS explained_variance
 FROM predictions GROUP BY model, fold"""


@check("agg_21_fold_scores", f"""WITH {fx.PREDICTIONS}, f AS ({_FOLDS}) SELECT model, fold, round(r2, 6) AS r2, round(mse, 6) AS mse,
 round(msle, 6) AS msle, round(mape, 6) AS mape, round(explained_variance, 6) AS explained_variance FROM f""")
def _(spark, sf):
    out = metrics.fold_scores(fx.predictions(spark, sf), "log_y", "log_p", ["model", "fold"])
    return _rounded(out, 6, "r2", "mse", "msle", "mape", "explained_variance")


@check("agg_22_score_summary", f"""WITH {fx.PREDICTIONS}, f AS ({_FOLDS}) SELECT model, round(avg(r2), 6) AS r2_mean,
 round(stddev_pop(r2), 6) AS r2_std, round(avg(mse), 6) AS mse_mean, round(stddev_pop(mse), 6) AS mse_std FROM f GROUP BY model""")
def _(spark, sf):
    scores = metrics.fold_scores(fx.predictions(spark, sf), "log_y", "log_p", ["model", "fold"])
    return _rounded(metrics.score_summary(scores, ["r2", "mse"], ["model"]), 6, "r2_mean", "r2_std", "mse_mean", "mse_std")


@check("agg_23_constant_mean_rmse", f"""WITH {fx.JOBS}, y AS (SELECT record_id % 5 AS fold, revised_cost AS y FROM jobs WHERE revised_cost IS NOT NULL)
 SELECT fold, round(sqrt(avg(pow(y - (SELECT avg(y) FROM y), 2))), 4) AS rmse FROM y GROUP BY fold""")
def _(spark, sf):
    rows = fx.jobs(spark, sf).filter(F.col("revised_cost").isNotNull()).withColumn("fold", F.col("record_id") % 5)
    return _rounded(metrics.constant_mean_rmse(rows, "revised_cost"), 4, "rmse")


@check("agg_24_improvement", f"""WITH {fx.METRIC_ROWS} SELECT a.split, a.model, round(a.rmse, 4) AS rmse, round(b.rmse, 4) AS baseline,
 round((b.rmse - a.rmse) / b.rmse * 100, 6) AS improvement_percent FROM metric_rows a JOIN metric_rows b ON a.split = b.split
 WHERE b.model = 'median_baseline' AND a.model <> 'median_baseline'""")
def _(spark, sf):
    out = metrics.improvement(fx.metric_rows(spark, sf), "median_baseline")
    return _rounded(_rounded(out, 4, "rmse", "baseline"), 6, "improvement_percent")


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@check("agg_25_absolute_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(abs(corr({a}, {b})), 6) AS abs_correlation FROM lineitem"
    for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1:]))
def _(spark, sf):
    return _rounded(profile.absolute_correlations(fx.table(spark, sf, "lineitem"), list(_MEASURES)), 6, "abs_correlation")


@check("agg_26_histogram", """SELECT floor(l_extendedprice / 5000) * 5000.0 AS bin, l_returnflag, count(*) AS rows
 FROM lineitem GROUP BY 1, 2""".replace("* 5000.0", "* CAST(5000 AS DOUBLE)"))
def _(spark, sf):
    return profile.histogram(fx.table(spark, sf, "lineitem"), "l_extendedprice", 5000.0, "l_returnflag")


@check("agg_26_yearly_histogram", f"""WITH {fx.JOBS}, s AS (SELECT created, CASE WHEN proposed_stories < 3 THEN '0-2 stories'
 WHEN proposed_stories < 5 THEN '3-4 stories' WHEN proposed_stories IS NOT NULL THEN '5 and more stories' END AS stories FROM jobs)
 SELECT CAST(date_part('year', created) AS INTEGER) AS year, stories, count(*) AS rows FROM s GROUP BY 1, 2""")
def _(spark, sf):
    rows = fx.jobs(spark, sf).withColumn("stories", ff.coarse_story_range(ff.story_range(F.col("proposed_stories"))))
    return profile.yearly_histogram(rows, "created", "stories")


@check("agg_27_display_trim", """SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT quantile_cont(o_totalprice, 0.075) FROM orders)
 AND o_totalprice < (SELECT quantile_cont(o_totalprice, 0.925) FROM orders)""")
def _(spark, sf):
    return profile.display_trim(fx.table(spark, sf, "orders"), "o_totalprice").select("o_orderkey")


@check("agg_28_trailing_counts", f"WITH {fx.JOBS} " + " UNION ALL ".join(
    [f"""SELECT '{y}y' AS range, count(*) FILTER (WHERE created >= (SELECT max(created) FROM jobs) - INTERVAL '{y} years') AS rows FROM jobs"""
     for y in (1, 5, 10, 20, 30)] + ["SELECT 'all', count(*) FROM jobs"]))
def _(spark, sf):
    return profile.trailing_counts(fx.jobs(spark, sf), "created", [1, 5, 10, 20, 30])


@check("agg_29_checksum", "SELECT count(*) AS row_count, CAST(sum(l_partkey) AS BIGINT) AS checksum FROM lineitem")
def _(spark, sf):
    return tables.checksum(fx.table(spark, sf, "lineitem"), "l_partkey")


# ------------------------------------------------------------------ rankings

@check("top_01_largest_groups", f"""{_profile_sql(["zone", "segment"])} ORDER BY projects DESC, zone, segment LIMIT 20""")
def _(spark, sf):
    groups = profile.group_profile(fx.target_jobs(spark, sf), ["zone", "segment"], "target_cost", exact=True)
    return _rounded(ranking.top_rows(groups, "projects", 20, ["zone", "segment"]), 4, "mean_cost")


@check("top_02_sorted_by_key", _profile_sql(["permit_creation_year", "permit_creation_month"]))
def _(spark, sf):
    keys = ["permit_creation_year", "permit_creation_month"]
    groups = profile.group_profile(fx.target_jobs(spark, sf), keys, "target_cost", exact=True)
    return _rounded(groups, 4, "mean_cost").orderBy(*keys)


@check("top_03_signed_extremes", f"""WITH {fx.TERMS}
 (SELECT term, coefficient_log10 FROM terms WHERE coefficient_log10 > 0 ORDER BY coefficient_log10 DESC, term LIMIT 30)
 UNION ALL (SELECT term, coefficient_log10 FROM terms WHERE coefficient_log10 < 0 ORDER BY coefficient_log10, term LIMIT 30)""")
def _(spark, sf):
    return ranking.signed_extremes(fx.terms(spark, sf), "coefficient_log10", "term", 30).select("term", "coefficient_log10")


@check("top_04_head_ascending", """SELECT l_partkey, n AS rows FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey
 ORDER BY n DESC, l_partkey LIMIT 10)""")
def _(spark, sf):
    counts = profile.group_count(fx.table(spark, sf, "lineitem"), ["l_partkey"])
    return ranking.head_ascending(counts, "rows", 10, ["l_partkey"])


@check("top_05_best_row", f"""WITH {fx.METRIC_ROWS} SELECT model, round(rmse, 4) AS rmse FROM metric_rows
 WHERE split = 'validation' AND model <> 'median_baseline' ORDER BY metric_rows.rmse, model LIMIT 1""")
def _(spark, sf):
    rows = fx.metric_rows(spark, sf).filter(F.col("split") == "validation")
    return _rounded(ranking.best_row(rows, "rmse", "model", exclude=["median_baseline"]), 4, "rmse")


@check("top_06_leaderboard", f"""WITH {fx.METRIC_ROWS} SELECT model, split, rows, round(rmse, 4) AS rmse FROM metric_rows
 WHERE split = 'test'""")
def _(spark, sf):
    board = ranking.leaderboard(fx.metric_rows(spark, sf), "test")
    return _rounded(board.select("model", "split", "rows", "rmse"), 4, "rmse")


@check("top_07_since_year", _profile_sql(["permit_creation_year"], "WHERE permit_creation_year >= 1998"))
def _(spark, sf):
    trend = profile.group_profile(fx.target_jobs(spark, sf), ["permit_creation_year"], "target_cost", exact=True)
    return _rounded(profile.since(trend, "permit_creation_year", 1998), 4, "mean_cost")
