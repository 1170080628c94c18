"""Small report tables, nested summaries, experiment logs and dated snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One row per cross-validated run; list-valued scores keep one entry per fold. A row with a ``fold`` is
# one fold of a run that can be resumed.
RUN_SCHEMA = (
    "run_at timestamp, experiment string, model string, rmse_cv_mean double, rmse_cv_std double, "
    "dataset_version string, dataset_rows bigint, dataset_columns int, target_variable string, "
    "features_cat array<string>, features_num array<string>, random_state bigint, n_folds int, "
    "rmse_cv array<double>, r2_cv array<double>, rmsle_cv array<double>, mape_cv array<double>, "
    "evs_cv array<double>, fold int"
)


def write_report_csv(df: DataFrame, path: str, order: list | None = None) -> None:
    """One CSV file with a header, for report-sized tables (already aggregated).

    The rows are shuffled into the one file, so the aggregation before it stays parallel.
    """
    rows = df.repartition(1)
    if order:
        rows = rows.sortWithinPartitions(*order)
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_report_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_summary_json(sections: dict[str, DataFrame], path: str) -> None:
    """One JSON document: each one-row section becomes a nested object under its name.

    A section whose only column is called ``values`` (a map, say) is that object itself.
    """
    summary = None
    for name, section in sections.items():
        whole = F.col("values") if section.columns == ["values"] else F.struct(*section.columns)
        nested = section.select(whole.alias(name))
        if summary is None:
            summary = nested
        else:
            summary = summary.withColumn(name, nested.scalar())
    summary.coalesce(1).write.mode("overwrite").json(path)


def read_summary_json(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def flatten_structs(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested fields as top-level columns named ``outer_inner``."""
    flat = []
    for field in df.schema.fields:
        if isinstance(field.dataType, StructType):
            flat += [F.col(f"`{field.name}`.`{inner}`").alias(f"{field.name}{separator}{inner}")
                     for inner in field.dataType.names]
        else:
            flat.append(F.col(f"`{field.name}`"))
    return df.select(*flat)


def run_rows(spark: SparkSession, runs: list[dict]) -> DataFrame:
    """Typed rows of the experiment log from dicts; absent fields are NULL, unknown ones are refused. ``run_at`` is now."""
    schema = spark.createDataFrame([], RUN_SCHEMA).schema
    unknown = {field for run in runs for field in run} - set(schema.names)
    if unknown:
        raise ValueError(f"not in the log: {sorted(unknown)}")
    now = datetime.now()
    return spark.createDataFrame([tuple(({"run_at": now} | run).get(field) for field in schema.names) for run in runs], schema)


def append_run(df: DataFrame, path: str) -> None:
    """Add run rows to the experiment log; columns are matched by name."""
    df.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def _dates(path: str) -> str:
    """Where a snapshot table names its dates; readers of the table skip names with an underscore."""
    return f"{path.rstrip('/')}/_dates"


def write_snapshot(df: DataFrame, path: str, snapshot_date) -> None:
    """Keep one dated copy. Writing the same date again replaces only that copy.

    When the copy is complete its date is appended to the table's list of dates, as one small file that appears
    at once or not at all; until then readers see the latest copy before it.
    """
    dated = df.withColumn("snapshot_date", F.lit(snapshot_date).cast("date"))
    (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_date").parquet(path))
    named = df.sparkSession.range(0, 1, 1, 1).select(F.lit(snapshot_date).cast("date").alias("snapshot_date"))
    named.write.mode("append").json(_dates(path))


def latest_snapshot(spark: SparkSession, path: str):
    """The latest date a snapshot table names, or None where it names none (as tables from before the list do)."""
    try:
        return spark.read.schema("snapshot_date date").json(_dates(path)).agg(F.max("snapshot_date")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_snapshot(spark: SparkSession, path: str, snapshot_date=None) -> DataFrame:
    """The copy of one date, or the latest, which is looked up in the list of dates: no other copy is listed or opened."""
    if snapshot_date is None:
        latest = latest_snapshot(spark, path)
        if latest is not None:
            return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/snapshot_date={latest}")
    table = spark.read.parquet(path)
    if snapshot_date is not None:
        return table.filter(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
    newest = table.agg(F.max("snapshot_date")).scalar()
    return table.filter(F.col("snapshot_date") == newest)
