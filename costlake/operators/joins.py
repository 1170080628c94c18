"""Joins: size-checked lookups, price index, gazetteer fallback, row-key attach."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from costlake.session import settle

# A table of at most this many rows and bytes may be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64_000_000


def key_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
             null_safe: bool = True) -> DataFrame:
    """Equi-join keeping the left keys; by default NULL keys match each other, so no row is lost."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    pairs = [(left[k], renamed[f"__{k}"]) for k in keys]
    condition = reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def is_small(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a computed table may be broadcast: few rows, and few bytes (nested values weigh what they do as text)."""
    parts = []
    for field in table.schema:
        kind = field.dataType
        if isinstance(kind, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)))
    weight = reduce(lambda a, b: a + b, parts, F.lit(8 * len(table.columns))).cast("long")
    # one row more than allowed tells that there are too many
    rows, size = table.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(weight)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(df: DataFrame, table: DataFrame, keys: list[str], how: str = "left",
                null_safe: bool = False, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``df`` with a derived table that is usually small.

    The table is computed once and measured. If it is small (:func:`is_small`) it is broadcast
    and ``df`` is not shuffled; else it is an ordinary shuffle join, where adaptive execution
    splits hot keys.
    """
    table = settle(table)
    small = is_small(table, max_rows)
    return key_join(df, F.broadcast(table) if small else table, keys, how, null_safe)


def inflation_adjust(df: DataFrame, index: DataFrame, amount: str, year: str, target_year: int,
                     out: str, index_year: str = "year", index_value: str = "index") -> DataFrame:
    """``amount * index[target_year] / index[year]``; NULL where the year has no index.

    Of several index rows for a year the largest value counts.
    """
    target = index.filter(F.col(index_year) == target_year).agg(F.max(index_value)).scalar()
    yearly = index.groupBy(F.col(index_year).cast("int").alias(year)).agg(F.max(index_value).alias("__value"))
    factors = yearly.select(year, F.try_divide(target, F.col("__value")).alias("__factor"))
    return (lookup_join(df, factors, [year])
            .withColumn(out, F.col(amount) * F.col("__factor")).drop("__factor"))


def geocode(df: DataFrame, gazetteer: DataFrame, address: str, fallback_address: str,
            gazetteer_address: str = "address", x: str = "x", y: str = "y",
            max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Coordinates by full address, else by the address without its suffix.

    Rows that match neither keep NULL coordinates; see :func:`with_coordinates`.
    Of several gazetteer rows for an address the one with the least coordinates counts.
    """
    found = F.min(F.struct(F.col(x).alias("x"), F.col(y).alias("y")))
    unique = settle(gazetteer.groupBy(F.col(gazetteer_address).alias("__address")).agg(found.alias("__place")))
    small = is_small(unique, max_rows)
    out = df
    for key, tag in ((address, "1"), (fallback_address, "2")):
        places = unique.select(F.col("__address").alias(key), F.col("__place").alias(f"__p{tag}"))
        out = key_join(out, F.broadcast(places) if small else places, [key], "left", null_safe=False)
    place = F.coalesce(F.col("__p1"), F.col("__p2"))
    return out.withColumns({x: place["x"], y: place["y"]}).drop("__p1", "__p2")


def with_coordinates(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())


def without_coordinates(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    return df.filter(F.col(x).isNull() | F.col(y).isNull())


def keep_matching(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur in ``other``; its keys are made distinct before they travel."""
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def keep_unmatched(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def attach_by_key(df: DataFrame, columns: DataFrame, keys: list[str]) -> DataFrame:
    """Add columns computed elsewhere for the same row keys."""
    return df.join(columns, keys, "left")


def attach_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Put the values of a one-row table on every row.

    The one row enters as a scalar subquery, so there is no join at all.
    """
    packed = totals.select(F.struct(*totals.columns)).scalar()
    return df.withColumns({name: packed[name] for name in totals.columns})
