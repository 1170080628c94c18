"""Ready flows end to end."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.q_models import TEXT_POLICY
from checks.registry import check
from costlake.operators.cleaning import TypePlan
from costlake.plans import layers, reports, training
from costlake.session import scratch_path, settle
from costlake.sources import reports as report_files
from costlake.sources import tables

RAW_TABLE = dataclasses.replace(
    fx.JOB_TABLE,
    newest=("ingested_at",), creation_date="permit_creation_date", differences={},
    types=TypePlan(dates=("permit_creation_date",), integers=("existing_units",),
                   amounts=("revised_cost", "estimated_cost"), zips=("zipcode",)),
    feature_columns=("record_id", "permit_number", "target_cost", "target_source", "permit_creation_year",
                     "zipcode", "existing_units", "is_adu"))


@check("flow_raw_to_features", f"""WITH {fx.TARGETS} SELECT CAST(record_id AS VARCHAR) AS record_id, permit_number, target_cost,
 target_source, CASE WHEN record_id % 17 <> 0 AND record_id % 23 <> 0 THEN permit_creation_year END AS permit_creation_year,
 CASE WHEN record_id % 13 <> 0 THEN '94' || lpad(CAST(record_id % 158 AS VARCHAR), 3, '0') END AS zipcode,
 CAST(CASE WHEN record_id % 2 = 0 THEN existing_units * 1000 ELSE existing_units END AS INTEGER) AS existing_units,
 CASE WHEN record_id % 6 IN (0, 2) THEN 1 WHEN record_id % 6 IN (1, 3) THEN 0 END AS is_adu
 FROM targets WHERE target_cost BETWEEN (SELECT quantile_disc(target_cost, 0.01) FROM targets)
 AND (SELECT quantile_disc(target_cost, 0.99) FROM targets)""")
def _(spark, sf):
    source, out = scratch_path(spark, "csv"), scratch_path(spark, "layers")
    rows = fx.raw_jobs(spark, sf)
    # every record arrives twice; the layers must keep one of each
    (rows.unionByName(rows).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(source))
    return layers.build_layers(spark, source, out, "order book", "ob-1", RAW_TABLE, exact_bounds=True).ready


@check("flow_reports", f"""WITH {fx.TARGETS} SELECT count(*) AS rows, min(target_cost) AS low, max(target_cost) AS high FROM targets
 WHERE target_cost BETWEEN (SELECT quantile_disc(target_cost, 0.01) FROM targets)
 AND (SELECT quantile_disc(target_cost, 0.99) FROM targets)""")
def _(spark, sf):
    out = scratch_path(spark, "reports")
    ready = tables.write_verified(layers.feature_rows(fx.flagged_jobs(spark, sf), fx.JOB_TABLE, exact_bounds=True), f"{out}/ready")
    reports.write_reports(ready, out, fx.JOB_TABLE)
    return report_files.read_summary_json(spark, f"{out}/summary").select(
        F.col("dataset.rows").alias("rows"), F.col("cost_statistics.min").alias("low"),
        F.col("cost_statistics.max").alias("high"))


# the feature layer: targets inside their 1 % and 99 % quantiles
READY = fx.TARGETS + """, ready AS (SELECT * FROM targets WHERE target_cost BETWEEN (SELECT quantile_disc(target_cost, 0.01) FROM targets)
 AND (SELECT quantile_disc(target_cost, 0.99) FROM targets))"""


def _report(spark, sf, name, schema):
    """One report of the set, written and read back."""
    out = scratch_path(spark, "reports")
    ready = settle(layers.feature_rows(fx.flagged_jobs(spark, sf), fx.JOB_TABLE, exact_bounds=True))
    reports.write_reports(ready, out, fx.JOB_TABLE, exact=True, only={name})
    return report_files.read_report_csv(spark, f"{out}/{name}", schema).withColumn("mean_cost", F.round("mean_cost", 4))


def _register_report(name, keys, present, top):
    group = ", ".join(keys)
    kept = f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in present)}" if present else ""
    sql = f"""WITH {READY} SELECT {group}, count(*) AS projects, round(avg(target_cost), 4) AS mean_cost,
 quantile_disc(target_cost, 0.5) AS median_cost FROM ready {kept} GROUP BY {group}{f' ORDER BY projects DESC, {group} LIMIT {top}' if top else ''}"""
    kinds = {"permit_creation_year": "int", "district": "int"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in keys) + ", projects bigint, mean_cost double, median_cost double"
    check(f"flow_report_{name}", sql)(lambda spark, sf: _report(spark, sf, name, schema))


for _name, (_keys, _present, _top) in fx.JOB_TABLE.profiles.items():
    _register_report(_name, _keys, _present, _top)


_CHECKED = fx.JOB_TABLE.null_checked[:-1]  # the last one is derived


@check("flow_report_summary", f"""WITH {READY}, t AS (SELECT unnest({list(reports.THRESHOLDS)}) AS limit_)
 SELECT 'dataset' AS section, 'rows' AS field, CAST(count(*) AS DOUBLE) AS value FROM ready
 UNION ALL SELECT 'cost_statistics', unnest(['min', 'mean', 'stddev', 'max']), unnest([min(target_cost), round(avg(target_cost), 4),
  round(stddev_samp(target_cost), 4), max(target_cost)]) FROM ready
 UNION ALL SELECT 'cost_quantiles', unnest([{', '.join(f"'p{int(round(p * 100)):02d}'" for p in reports.PROBABILITIES)}]),
  unnest(quantile_disc(target_cost, {list(reports.PROBABILITIES)})) FROM ready
 UNION ALL SELECT 'low_cost_diagnostic', CAST(limit_ AS VARCHAR), CAST(count(*) FILTER (target_cost < limit_) AS DOUBLE) FROM ready, t GROUP BY limit_
 UNION ALL SELECT 'null_rates', unnest({list(_CHECKED)}), CAST(unnest([{', '.join(f'count(*) - count({c})' for c in _CHECKED)}]) AS DOUBLE) FROM ready
 UNION ALL SELECT 'project_scale', 'avg_proposed_units', round(avg(proposed_units), 4) FROM ready""")
def _(spark, sf):
    out = scratch_path(spark, "reports")
    ready = settle(layers.feature_rows(fx.flagged_jobs(spark, sf), fx.JOB_TABLE, exact_bounds=True))
    reports.write_reports(ready, out, fx.JOB_TABLE, exact=True, only={"summary"})
    row = report_files.read_summary_json(spark, f"{out}/summary")
    fields = [("dataset", "rows", F.col("dataset.rows"))]
    fields += [("cost_statistics", c, F.round(f"cost_statistics.{c}", 4)) for c in ("min", "mean", "stddev", "max")]
    fields += [("cost_quantiles", c, F.col(f"cost_quantiles.{c}")) for c in row.schema["cost_quantiles"].dataType.names]
    fields += [("low_cost_diagnostic", str(t), F.col(f"low_cost_diagnostic.`{t}`.rows_below")) for t in reports.THRESHOLDS]
    fields += [("null_rates", c, F.col(f"null_rates.{c}.missing_rows")) for c in _CHECKED]
    fields += [("project_scale", "avg_proposed_units", F.round("project_scale.avg_proposed_units", 4))]
    return row.select(F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(f).alias("field"), c.cast("double").alias("value")) for s, f, c in fields])))


def _drift(spark, sf, name, schema):
    """One drift report, written with the others and read back."""
    out = scratch_path(spark, "drift")
    reports.write_drift_reports(fx.split_jobs(spark, sf), "zone", out, fx.JOB_TABLE, exact=True)
    return report_files.read_report_csv(spark, f"{out}/{name}", schema)


@check("flow_drift_target", f"""WITH {fx.TARGETS} SELECT split, count(*) AS rows, round(avg(target_cost), 4) AS mean, quantile_disc(target_cost, 0.5) AS p50,
 quantile_disc(target_cost, 0.75) AS p75, quantile_disc(target_cost, 0.9) AS p90, quantile_disc(target_cost, 0.95) AS p95 FROM targets WHERE split IS NOT NULL GROUP BY split""")
def _(spark, sf):
    found = _drift(spark, sf, "target_drift", "split string, rows bigint, mean double, p50 double, p75 double, p90 double, p95 double")
    return found.withColumn("mean", F.round("mean", 4))


@check("flow_drift_source", f"""WITH {fx.TARGETS} SELECT split, target_source, count(*) AS projects, round(avg(target_cost), 4) AS mean_cost,
 quantile_disc(target_cost, 0.5) AS median_cost FROM targets WHERE split IS NOT NULL GROUP BY split, target_source""")
def _(spark, sf):
    found = _drift(spark, sf, "source_by_split", "split string, target_source string, projects bigint, mean_cost double, median_cost double")
    return found.withColumn("mean_cost", F.round("mean_cost", 4))


@check("flow_drift_years", f"""WITH {fx.TARGETS} SELECT permit_creation_year, count(*) AS projects, round(avg(target_cost), 4) AS mean_cost,
 quantile_disc(target_cost, 0.5) AS median_cost FROM targets WHERE split IS NOT NULL GROUP BY permit_creation_year""")
def _(spark, sf):
    found = _drift(spark, sf, "year_distribution", "permit_creation_year int, projects bigint, mean_cost double, median_cost double")
    return found.withColumn("mean_cost", F.round("mean_cost", 4))


@check("flow_drift_categories", f"""WITH {fx.TARGETS}, c AS (SELECT split, zone, count(*) AS rows FROM targets WHERE split IS NOT NULL GROUP BY split, zone),
 t AS (SELECT *, sum(rows) OVER (PARTITION BY split) AS total, row_number() OVER (PARTITION BY split ORDER BY rows DESC, zone) AS rank FROM c)
 SELECT split, zone, rows, CAST(rank AS INTEGER) AS rank, round(rows * 100.0 / total, 6) AS share_percent FROM t WHERE rank <= 8""")
def _(spark, sf):
    found = _drift(spark, sf, "category_drift", "split string, zone string, rows bigint, rank int, share_percent double")
    return found.withColumn("share_percent", F.round("share_percent", 6))


@check("flow_compare_with_text", """SELECT model, CASE WHEN doc_id % 7 = 5 THEN 'validation' ELSE 'test' END AS split, count(*) AS rows
 FROM documents, (VALUES ('median_baseline'), ('structured'), ('structured_text')) m(model)
 WHERE doc_id % 7 >= 5 GROUP BY 1, 2""")
def _(spark, sf):
    result = training.compare_with_text(fx.ready_documents(spark, sf), TEXT_POLICY, fx.JOB_TABLE)
    return result.metrics.select("model", "split", "rows")
