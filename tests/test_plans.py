"""Ready flows on the smallest data set, down to the files they leave."""

import os

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.q_models import TEXT_POLICY
from costlake.plans import layers, reports, training
from costlake.plans.permits import PERMITS, scoring_schema
from costlake.sources import reports as files

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_report_set_has_the_published_shape(spark, tmp_path):
    ready = layers.feature_rows(fx.flagged_jobs(spark, SF), fx.JOB_TABLE).cache()
    reports.write_reports(ready, str(tmp_path), fx.JOB_TABLE)
    summary = files.read_summary_json(spark, f"{tmp_path}/summary").first()
    assert summary["dataset"]["rows"] == ready.count() and summary["dataset"]["columns"] == len(ready.columns)
    assert set(summary.asDict()) == {"dataset", "cost_statistics", "cost_quantiles", "low_cost_diagnostic",
                                     "project_scale", "null_rates"}
    assert summary["low_cost_diagnostic"]["500000"]["rows_below"] == ready.filter("target_cost < 500000").count()
    assert summary["cost_quantiles"]["p50"] is not None
    assert summary["null_rates"]["is_adu"]["missing_rows"] == ready.filter("is_adu IS NULL").count()
    trend = files.read_report_csv(spark, f"{tmp_path}/annual_trend",
                                  "permit_creation_year int, projects bigint, mean_cost double, median_cost double")
    assert trend.agg(F.sum("projects")).first()[0] == ready.count()
    drift = reports.drift_reports(fx.split_jobs(spark, SF), "zone", fx.JOB_TABLE)
    assert {name: table.count() > 0 for name, table in drift.items()} == dict.fromkeys(drift, True)
    ready.unpersist()


def test_text_flow_leaves_model_and_reports(spark, tmp_path):
    ready = fx.ready_documents(spark, SF)
    compared = training.compare_with_text(ready, TEXT_POLICY, fx.JOB_TABLE, model_dir=f"{tmp_path}/model", text_features=256)
    found = training.explain_text(ready, TEXT_POLICY, fx.JOB_TABLE, size=200, min_documents=5, top=5)
    training.write_training_reports(compared, f"{tmp_path}/training")
    training.write_explanation(found, compared, f"{tmp_path}/explained")
    assert compared.best in ("structured", "structured_text", training.BASELINE)
    assert spark.read.option("header", True).csv(f"{tmp_path}/training/metrics").count() == 6
    assert spark.read.option("header", True).csv(f"{tmp_path}/explained/text_ablation").count() == 2
    signs = {r["direction"]: r["n"] for r in found["strongest"].groupBy("direction").agg(F.count("term").alias("n")).collect()}
    assert max(signs.values()) <= 5


def test_scoring_schema_of_the_permit_table():
    schema = scoring_schema(PERMITS)
    assert len(schema) == 21
    assert [f.name for f in schema if not f.nullable] == ["permit_creation_year", "permit_creation_month", "description"]
    assert len(PERMITS.feature_columns) == 29
