"""Sources and sinks (SRC)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import check
from costlake.operators import metrics, models, profile, ranking
from costlake.session import scratch_path
from costlake.sources import geo, reports, tables
from costlake.sources.models import load_model, save_model


@check("src_01_read_csv_raw", f"""WITH {fx.JOBS} SELECT CAST(record_id AS VARCHAR) AS record_id,
 CASE WHEN record_id % 13 = 0 THEN 'unknown'
      ELSE '94' || lpad(CAST(record_id % 158 AS VARCHAR), 3, '0') || '-0000' END AS zipcode,
 'Job ' || record_id || ', "quoted"' || chr(10) || 'second line' AS description FROM jobs""")
def _(spark, sf):
    path = scratch_path(spark, "raw")
    (fx.raw_jobs(spark, sf).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    back = tables.read_csv_raw(spark, path)
    return back.select(F.col("Record ID").alias("record_id"), F.col("Zipcode").alias("zipcode"),
                       F.col("Description").alias("description"))


@check("src_02_stamp_ingest", """SELECT o_orderkey, 'order book' AS source, 'ob-1' AS dataset_id,
 true AS stamped FROM orders""")
def _(spark, sf):
    stamped = tables.stamp_ingest(fx.table(spark, sf, "orders"), "order book", "ob-1")
    return stamped.select("o_orderkey", F.col("_source").alias("source"),
                          F.col("_dataset_id").alias("dataset_id"),
                          F.col("_ingested_at").isNotNull().alias("stamped"))


@check("src_03_write_columnar", f"""WITH {fx.JOBS} SELECT record_id, created, revised_cost, zone FROM jobs""")
def _(spark, sf):
    path = scratch_path(spark, "columnar")
    tables.write_table(fx.jobs(spark, sf).select("record_id", "created", "revised_cost", "zone"), path)
    return tables.read_table(spark, path)


@check("src_04_read_columnar", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
 CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""")
def _(spark, sf):
    return tables.read_table(spark, f"{sf}/orders.parquet").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date"))


@check("src_05_write_verified", "SELECT count(*) AS rows, sum(l_quantity) AS quantity FROM lineitem")
def _(spark, sf):
    written = tables.write_verified(fx.table(spark, sf, "lineitem"), scratch_path(spark, "verified"))
    return written.agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))


@check("src_06_file_count", "SELECT 8 AS files, count(*) AS rows FROM orders")
def _(spark, sf):
    written = tables.write_verified(fx.table(spark, sf, "orders"), scratch_path(spark, "files"), files=8)
    per_file = written.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).cast("int").alias("files"), F.sum("n").alias("rows"))


@check("src_07_number_range", """SELECT count(*) AS row_count, count(*) * (count(*) - 1) AS checksum
 FROM lineitem""")
def _(spark, sf):
    # the rows of the table are numbered, so all of them are read and shuffled
    numbered = ranking.global_row_number(fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"),
                                         [F.col("l_orderkey"), F.col("l_linenumber")], "id")
    return tables.checksum(tables.row_signals(numbered, "id"), "metric")


_BY_ZONE = """SELECT zone, count(*) AS projects, round(avg(target_cost), 4) AS mean_cost,
 quantile_disc(target_cost, 0.5) AS median_cost FROM targets GROUP BY zone"""


def _zone_profile(spark, sf):
    found = profile.group_profile(fx.target_jobs(spark, sf), ["zone"], "target_cost", exact=True)
    return found.withColumn("mean_cost", F.round("mean_cost", 4))


@check("src_08_report_csv", f"""WITH {fx.TARGETS}, z AS ({_BY_ZONE})
 SELECT zone, CAST(projects AS VARCHAR) AS projects FROM z""")
def _(spark, sf):
    path = scratch_path(spark, "report")
    reports.write_report_csv(_zone_profile(spark, sf), path)
    return tables.read_csv_raw(spark, path).select("zone", "projects")


@check("src_09_summary_json", f"""WITH {fx.TARGETS} SELECT count(*) AS dataset_row_count,
 min(target_cost) AS cost_min, max(target_cost) AS cost_max, round(avg(target_cost), 4) AS cost_mean,
 round(stddev_samp(target_cost), 4) AS cost_stddev FROM targets""")
def _(spark, sf):
    path = scratch_path(spark, "summary")
    rows = fx.target_jobs(spark, sf)
    reports.write_summary_json({"dataset": tables.table_shape(rows),
                                "cost": profile.distribution(rows, "target_cost")}, path)
    flat = reports.flatten_structs(reports.read_summary_json(spark, path))
    return flat.select("dataset_row_count", "cost_min", "cost_max",
                       F.round("cost_mean", 4).alias("cost_mean"),
                       F.round("cost_stddev", 4).alias("cost_stddev"))


@check("src_10_reload_reports", f"WITH {fx.TARGETS} {_BY_ZONE}")
def _(spark, sf):
    path = scratch_path(spark, "reload")
    reports.write_report_csv(_zone_profile(spark, sf), path)
    return reports.read_report_csv(
        spark, path, "zone string, projects bigint, mean_cost double, median_cost double")


@check("src_11_pruned_read", """SELECT l_returnflag, count(*) AS rows, round(sum(l_quantity), 4) AS quantity
 FROM lineitem GROUP BY l_returnflag""")
def _(spark, sf):
    narrow = tables.read_table(spark, f"{sf}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return narrow.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"),
                                              F.round(F.sum("l_quantity"), 4).alias("quantity"))


@check("src_12_append_run", f"""WITH {fx.PREDICTIONS},
 folds AS (SELECT model, fold, sqrt(avg((log_y - log_p) * (log_y - log_p))) AS rmse
   FROM predictions GROUP BY model, fold)
 SELECT model, CAST(count(*) AS INTEGER) AS n_folds, round(avg(rmse), 6) AS rmse_cv_mean,
  round(stddev_pop(rmse), 6) AS rmse_cv_std FROM folds GROUP BY model""")
def _(spark, sf):
    path = scratch_path(spark, "runs")
    scores = metrics.fold_scores(fx.predictions(spark, sf), "log_y", "log_p", ["model", "fold"])
    runs = (scores.withColumn("rmse", F.sqrt("mse")).groupBy("model")
            .agg(F.avg("rmse").alias("rmse_cv_mean"), F.stddev_pop("rmse").alias("rmse_cv_std"),
                 F.collect_list("rmse").alias("rmse_cv"), F.collect_list("r2").alias("r2_cv"))
            .withColumns({"run_at": F.current_timestamp(), "n_folds": F.size("rmse_cv")}))
    for models_of_run in (["structured"], ["structured_text", "median_baseline"]):
        reports.append_run(runs.filter(F.col("model").isin(models_of_run)), path)
    return reports.read_runs(spark, path).select(
        "model", F.size("rmse_cv").alias("n_folds"), F.round("rmse_cv_mean", 6).alias("rmse_cv_mean"),
        F.round("rmse_cv_std", 6).alias("rmse_cv_std"))


@check("src_13_snapshot", f"""WITH {fx.JOBS} SELECT record_id, estimated_cost,
 DATE '2024-02-01' AS snapshot_date FROM jobs""")
def _(spark, sf):
    path = scratch_path(spark, "snapshots")
    rows = fx.jobs(spark, sf)
    reports.write_snapshot(rows.select("record_id", F.lit(0.0).alias("estimated_cost")), path, "2024-02-01")
    reports.write_snapshot(rows.select("record_id", F.lit(1.0).alias("estimated_cost")), path, "2024-01-01")
    reports.write_snapshot(rows.select("record_id", "estimated_cost"), path, "2024-02-01")
    return reports.read_snapshot(spark, path)


@check("src_14_export_points", f"""WITH {fx.PLACES} SELECT street AS address, x, y,
 'POINT (' || CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR) || ')' AS point FROM places""")
def _(spark, sf):
    return geo.export_points(fx.places(spark, sf), scratch_path(spark, "points"), "x", "y", "street")


@check("src_15_read_polygons", """SELECT CAST(n_nationkey AS VARCHAR) AS polygon_id, 1 AS rings, 5 AS vertices,
 CAST(n_nationkey AS DOUBLE) AS first_x FROM nation WHERE n_nationkey % 6 <> 5""")
def _(spark, sf):
    path = scratch_path(spark, "features")
    k = F.col("n_nationkey")
    ring = F.format_string("[[%1$s,0],[%2$s,0],[%2$s,1],[%1$s,1],[%1$s,0]]", k, k + 1)
    multi = k % 6 == 5
    (fx.table(spark, sf, "nation").select(F.format_string(
        '{"type":"Feature","properties":{"id":"%s"},"geometry":{"type":"%s","coordinates":%s}}',
        k, F.when(multi, "MultiPolygon").otherwise("Polygon"),
        F.when(multi, F.concat(F.lit("[[["), ring, F.lit("]]]"))).otherwise(
            F.concat(F.lit("["), ring, F.lit("]")))).alias("value")).write.text(path))
    found = geo.simple_polygons(geo.read_feature_lines(spark, path), "id")
    return found.select("polygon_id", F.size("rings").alias("rings"),
                        F.size(F.col("rings")[0]).alias("vertices"), F.col("rings")[0][0]["x"].alias("first_x"))


@check("src_16_save_and_load_model", """SELECT count(*) AS rows, count(*) AS identical FROM lineitem""")
def _(spark, sf):
    rows = fx.table(spark, sf, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    fitted = models.fit_stages([VectorAssembler(inputCols=["l_quantity"], outputCol="features"),
                                LinearRegression()], rows)
    path = scratch_path(spark, "model")
    save_model(fitted, path)
    first = fitted.transform(rows).withColumnRenamed("prediction", "before").drop("features")
    both = load_model(path).transform(first)
    return both.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.col("before") == F.col("prediction")).alias("identical"))
