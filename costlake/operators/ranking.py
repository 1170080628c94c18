"""Top-k, arg-min and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.session import settle


def top_rows(df: DataFrame, by: str, n: int, ties: list[str], ascending: bool = False) -> DataFrame:
    """First ``n`` rows by one column; ``ties`` settle equal values. Planned as a top-k."""
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *ties).limit(n)


def head_ascending(df: DataFrame, by: str, n: int, ties: list[str]) -> DataFrame:
    """The top ``n`` of a ranking, listed from low to high."""
    return top_rows(df, by, n, ties).orderBy(F.col(by).asc(), *[F.col(t).desc() for t in ties])


def signed_extremes(df: DataFrame, value: str, label: str, n: int) -> DataFrame:
    """The ``n`` largest positive and ``n`` smallest negative values."""
    highest = top_rows(df.filter(F.col(value) > 0), value, n, [label])
    lowest = top_rows(df.filter(F.col(value) < 0), value, n, [label], ascending=True)
    return highest.unionByName(lowest)


def top_k_per_group(df: DataFrame, group: list[str], by: str, k: int, ties: list[str]) -> DataFrame:
    """``k`` rows per group; each map task forwards at most ``k`` rows per group."""
    window = Window.partitionBy(*group).orderBy(F.col(by).desc_nulls_last(), *ties)
    return (df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k))


def best_row(df: DataFrame, score: str, label: str, group: list[str] | None = None,
             exclude: list[str] | None = None) -> DataFrame:
    """Label with the lowest score (ties by label), optionally per group."""
    rows = df.filter(~F.col(label).isin(*exclude)) if exclude else df
    best = F.min(F.struct(F.col(score).alias(score), F.col(label).alias(label))).alias("__best")
    rows = rows.filter(F.col(score).isNotNull())
    picked = rows.groupBy(*group).agg(best) if group else rows.agg(best)
    return picked.select(*(group or []), f"__best.{label}", f"__best.{score}")


def leaderboard(df: DataFrame, split: str, score: str = "rmse", label: str = "model") -> DataFrame:
    return df.filter(F.col("split") == split).orderBy(F.col(score).asc_nulls_last(), label)


def global_row_number(df: DataFrame, order: list[Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers over a total order without sorting everything in one task.

    Rows are range-partitioned and numbered inside their partition; the partition's
    offset comes from a table with one row per partition. The sorted rows are written
    to reliable storage first, so a recomputed task cannot move a partition boundary.
    """
    parts = settle(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (parts.withColumn(name, within)
            .join(F.broadcast(offsets), "__part")
            .withColumn(name, (F.col(name) + F.col("__offset") + (start - 1)).cast("bigint"))
            .drop("__part", "__offset"))
