"""Train / validation / test labels and folds as one column, stable under repartitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")


class EmptySplitError(RuntimeError):
    """A split that must hold rows holds none."""


def year_split(df: DataFrame, year: str, train: tuple[int, int], validation: int, test_from: int,
               out: str = "split") -> DataFrame:
    """Label rows by year and drop those outside all three ranges."""
    y = F.col(year)
    label = (F.when(y.between(*train), "train").when(y == validation, "validation")
             .when(y >= test_from, "test"))
    return df.withColumn(out, label).filter(F.col(out).isNotNull())


def hash_split(df: DataFrame, key: str, train_percent: int = 80, seed: int = 0,
               out: str = "split") -> DataFrame:
    """Random split decided by each row's key, so it never depends on row order or partitions."""
    bucket = F.pmod(dealt_by(df, key, seed), F.lit(100))
    return df.withColumn(out, F.when(bucket < train_percent, "train").otherwise("test"))


def fold_column(df: DataFrame, key: str, folds: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Fold number decided by each row's key."""
    return df.withColumn(out, F.pmod(dealt_by(df, key, seed), F.lit(folds)).cast("int"))


def dealt_by(df: DataFrame, key: str, seed: int) -> Column:
    """Hash of the key; rows without one are dealt by their other columns, so they spread as well."""
    rest = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.when(F.col(key).isNull(), F.xxhash64(*rest, F.lit(seed))).otherwise(F.xxhash64(F.col(key), F.lit(seed)))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))


def require_rows(df: DataFrame, split: str = "split", names=SPLITS) -> dict[str, int]:
    """Row count per split; raises when one of the named splits is empty."""
    found = {row[split]: row["rows"] for row in split_sizes(df, split).filter(
        F.col(split).isin(*names)).collect()}
    empty = [n for n in names if not found.get(n)]
    if empty:
        raise EmptySplitError(f"no rows in split: {', '.join(empty)}")
    return found
