"""Latest version per key, drop-duplicates with a repeatable survivor, row-set unions."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Columns that say when rows were loaded or processed, unless a caller names its own; they must not decide between
# equal versions.
STAMPS = ("_ingested_at", "ingested_at", "_processed_at", "processed_at")


def _full_order(df: DataFrame, newest: list[str], stamps: Collection[str]) -> list[Column]:
    """Named columns first; rows equal in all of them are ordered by a hash of the row without its stamps.

    The hash is the same on every run, on every load date and under every partitioning, and
    costs far less to sort by than the columns themselves.
    """
    hashed = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant") and f.name not in stamps]
    return [*[F.col(c).desc_nulls_last() for c in newest], F.xxhash64(*hashed).desc()]


def latest_version(df: DataFrame, key: str, newest: list[str], stamps: Collection[str] = STAMPS) -> DataFrame:
    """One row per key: the highest by ``newest`` (NULLs last); rows without a key all stay.

    Columns in ``stamps`` don't decide between rows that are equal otherwise.

    ``row_number() <= 1`` lets Spark cut every key to one row per map task before the
    shuffle, so a key with very many versions never travels whole. Rows without a key are
    kept apart, so they neither collapse nor meet in one partition.
    """
    window = Window.partitionBy(key).orderBy(*_full_order(df, newest, stamps))
    keyed = (df.filter(F.col(key).isNotNull())
             .withColumn("__rank", F.row_number().over(window))
             .filter(F.col("__rank") == 1).drop("__rank"))
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def drop_duplicates(df: DataFrame, keys: list[str], newest: list[str] | None = None,
                    collapse_null_keys: bool = False, stamps: Collection[str] = STAMPS) -> DataFrame:
    """One row per key combination with a repeatable survivor; ``stamps`` as in :func:`latest_version`.

    A row with NULL in any key is kept as it is, unless ``collapse_null_keys`` lets NULLs
    compare equal as a plain ``dropDuplicates`` would.
    """
    window = Window.partitionBy(*keys).orderBy(*_full_order(df, list(newest or []), stamps))

    def survivors(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")

    if collapse_null_keys:
        return survivors(df)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return survivors(df.filter(complete)).unionByName(df.filter(~complete))


def concat_rows(*frames: DataFrame) -> DataFrame:
    """Stack row sets by column name; columns one of them lacks become NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
