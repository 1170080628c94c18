"""Raw text, columnar layers and verified writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class VerificationError(RuntimeError):
    """What was read back is not what was written."""


def read_csv_raw(spark: SparkSession, path: str | list[str], multiline: bool = True,
                 escape: str = '"') -> DataFrame:
    """CSV with every column a string and names taken from the header.

    ``multiline`` keeps quoted line breaks but makes each file one task, so large
    sources should arrive as many files; pass ``False`` where records never break.
    """
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("multiLine", multiline).option("escape", escape).csv(path))


def stamp_ingest(df: DataFrame, source: str, dataset_id: str, prefix: str = "_") -> DataFrame:
    return df.withColumns({
        f"{prefix}ingested_at": F.current_timestamp(),
        f"{prefix}source": F.lit(source),
        f"{prefix}dataset_id": F.lit(dataset_id),
    })


def stamp_processed(df: DataFrame, name: str = "_processed_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def with_file_count(df: DataFrame, files: int | None = None) -> DataFrame:
    """``files`` output files, or sizes left to adaptive execution when None."""
    return df.hint("rebalance") if files is None else df.repartition(files)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Columnar read; with ``columns`` the scan touches only those."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def write_verified(df: DataFrame, path: str, files: int | None = None,
                   allow_empty: bool = False) -> DataFrame:
    """Write once, counting rows on the way, then compare with the row count on disk.

    The count rides along with the write (no second pass over the source) and the
    read-back count comes from file footers. Returns the written table.
    """
    seen = Observation()
    # after the repartition: a map stage run again would count its rows twice
    dealt = df if files is None else df.repartition(files)
    write_table(dealt.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    expected = seen.get["rows"]
    written = df.sparkSession.read.parquet(path)
    actual = written.count()
    if actual != expected:
        raise VerificationError(f"row count mismatch: wrote {expected}, read back {actual}")
    if actual == 0 and not allow_empty:
        raise VerificationError("the table holds no rows")
    return written


def number_range(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    """Deterministic rows ``id`` with a linear and a quadratic signal."""
    ids = spark.range(0, rows, 1, partitions)
    return ids.select("id", (F.col("id") * 2).alias("metric"),
                      (F.col("id") * F.col("id")).alias("signal"))


def row_signals(df: DataFrame, number: str) -> DataFrame:
    """``df`` with the linear and the quadratic signal of a number column, for smoke checks on a table's own rows."""
    n = F.col(number)
    return df.withColumns({"metric": n * 2, "signal": n * n})


def checksum(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(column).alias("checksum"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)))
