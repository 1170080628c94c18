"""Quantiles that hold at any size.

``sketch_quantiles`` is one pass with a bounded sketch per map task, merged in one task per
group. ``exact_quantiles`` brackets every wanted rank by such a sketch, counts what lies below the
bracket and then counts values or buckets inside it: no task ever holds a whole distribution,
whichever group has most of the rows. NULL and NaN are no values in either.
"""

from __future__ import annotations

import sys
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, FloatType, IntegralType,
                               NumericType, StructType)

from costlake.operators.joins import lookup_join
from costlake.session import settle

# Rank error of the sketch is 1 / accuracy.
DEFAULT_ACCURACY = 10_000

# Buckets an interval is cut into, and the rows it may hold before its values are counted one by one.
BUCKETS = 1024
SORT_ROWS = 50_000

# Accuracy of the sketch that brackets exact quantiles, and how far off (as a share) it is taken to be.
BRACKET_ACCURACY = 2_000
BRACKET_SHARE = 2.5 / BRACKET_ACCURACY


def quantile_label(p: float) -> str:
    return f"p{int(round(p * 100)):02d}"


def _number(df: DataFrame, value: str) -> tuple[Column, DataType]:
    """The column with NULL for NaN and its type; integers and decimals stay what they are, all else is a double."""
    kind = df.select(value).schema[0].dataType
    if isinstance(kind, NumericType) and not isinstance(kind, (FloatType, DoubleType)):
        return F.col(value), kind
    double = F.col(value).cast("double")
    return F.when(~F.isnan(double), double), DoubleType()


def known_number(df: DataFrame, value: str) -> Column:
    """The column as quantiles see it: NaN is NULL."""
    return _number(df, value)[0]


def sketch_quantiles(df: DataFrame, value: str, probs: list[float],
                     accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Rows ``probability, quantile`` from one bounded sketch."""
    sketched = df.agg(F.percentile_approx(_number(df, value)[0], list(probs), accuracy).alias("q"))
    entries = F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.col("q")[i].alias("quantile"))
                        for i, p in enumerate(probs)])
    return sketched.select(F.inline(entries))


def _intervals(rows: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows repeated once per distinct search interval of their key that holds their value."""
    spans = targets.groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi")).alias("__spans"))
    if keys:
        probed = lookup_join(rows, spans, keys, how="inner", null_safe=True)
    else:
        probed = rows.withColumn("__spans", spans.scalar())
    holding = F.filter("__spans", lambda s: (F.col("v") >= s["lo"]) & (F.col("v") <= s["hi"]))
    return probed.select(*keys, "v", F.inline(holding))


def _literals(spark, found: list, schema: StructType) -> DataFrame:
    """A handful of rows as literals, so that using them costs no job."""
    fields = [(f.name, f.dataType.simpleString()) for f in schema]
    # str() of a double reads back as the same double
    rows = [", ".join(f"'{name}', cast('{row[name]}' AS {kind})" for name, kind in fields) for row in found]
    table = spark.range(0, 1, 1, 1)
    if not rows:
        return table.select(F.inline(F.array().cast(ArrayType(schema))))
    return table.select(F.expr("inline(array(" + ", ".join(f"named_struct({row})" for row in rows) + "))"))


def _pinned(targets: DataFrame, keys: list[str]) -> DataFrame:
    """The target table, computed. Without keys it is two rows per probability: literals do."""
    return settle(targets) if keys else _literals(targets.sparkSession, targets.collect(), targets.schema)


def _narrowed(rows: DataFrame, targets: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    """Move every target to the bucket of its interval that holds its rank.

    Buckets are counted where the rows are, so only bucket totals are shuffled; the running
    total then runs over the buckets of one interval.
    """
    span = [*keys, "lo", "hi"]
    counted = (_intervals(rows, targets, keys).groupBy(*span, bucket.alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("first"), F.max("v").alias("last")))
    running = (Window.partitionBy(*span).orderBy("bucket")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = counted.withColumn("before", F.sum("n").over(running) - F.col("n")).alias("found")
    wanted = targets.alias("wanted")
    same = [F.col(f"wanted.{c}").eqNullSafe(F.col(f"found.{c}")) for c in span]
    inside = ((F.col("wanted.rank") >= F.col("found.before"))
              & (F.col("wanted.rank") < F.col("found.before") + F.col("found.n")))
    return wanted.join(found, reduce(lambda a, b: a & b, same) & inside).select(
        *[F.col(f"wanted.{k}").alias(k) for k in keys], "wanted.which", "wanted.part", "wanted.fraction",
        (F.col("wanted.rank") - F.col("found.before")).alias("rank"),
        F.col("found.first").alias("lo"), F.col("found.last").alias("hi"), F.col("found.n").alias("n"))


def _bracketed(rows: DataFrame, keys: list[str], probs: list[float], interpolate: bool, sort_rows: int) -> DataFrame:
    """Every wanted rank with an interval that holds it: ``keys, lo, hi, n, which, part, fraction, rank``.

    ``n`` counts the interval's rows and ``rank`` is counted from its start. A sketch gives the interval, a
    second pass counts what is below and inside; where the sketch missed (as it may beyond the 53 bits it computes
    with), and where there are few rows anyway, the interval is the whole range.
    """
    edges = [x for p in probs for x in (max(0.0, p - BRACKET_SHARE), min(1.0, p + BRACKET_SHARE))]
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("least"), F.max("v").alias("most"),
        F.percentile_approx("v", edges, BRACKET_ACCURACY).alias("edges")).filter("rows > 0")
    if keys:
        stats = settle(stats)
        crowded = (stats.agg(F.max("rows")).first()[0] or 0) > sort_rows
    else:
        found = stats.collect()
        crowded = bool(found) and found[0]["rows"] > sort_rows
        ends = [F.lit(e).cast(stats.schema["least"].dataType) for e in found[0]["edges"]] if crowded else []
        single = StructType([f for f in stats.schema if f.name != "edges"])
        stats = _literals(rows.sparkSession, found, single)
    if not crowded:
        known = stats.withColumns({"edges": F.lit(None).cast(ArrayType(stats.schema["least"].dataType)), "counts": F.lit(None).cast("array<bigint>")})
    elif keys:
        probed = lookup_join(rows, stats.select(*keys, "edges"), keys, how="inner", null_safe=True)
        counts = probed.groupBy(*keys).agg(F.array(*_sides([F.col("edges")[i] for i in range(len(edges))])).alias("counts"))
        known = lookup_join(stats, counts, keys, how="inner", null_safe=True)
    else:
        counted = rows.agg(*_sides(ends)).first()
        known = stats.withColumns({"edges": F.array(*ends), "counts": F.lit(list(counted))})
    n, p, at = F.col("rows"), F.col("probability"), 2 * F.col("which")
    position = (n - 1) * p if interpolate else F.greatest(n - F.floor(n - n * p), F.lit(1)) - 1
    wanted = known.select("*", F.posexplode(F.array(*[F.lit(float(x)) for x in probs])).alias("which", "probability"))
    placed = wanted.withColumn("position", position.cast("double"))
    ranked = placed.select("*", (F.col("position") - F.floor("position")).alias("fraction"),
                           F.posexplode(F.array(F.floor("position"), F.ceil("position"))).alias("part", "rank"))
    below, upto = F.get("counts", at), F.get("counts", at + 1)
    held = F.coalesce((below <= F.col("rank")) & (F.col("rank") < upto), F.lit(False))
    return ranked.select(
        *keys, F.when(held, F.get("edges", at)).otherwise(F.col("least")).alias("lo"),
        F.when(held, F.get("edges", at + 1)).otherwise(F.col("most")).alias("hi"),
        F.when(held, upto - below).otherwise(n).alias("n"), "which", "part", "fraction",
        F.when(held, F.col("rank") - below).otherwise(F.col("rank")).alias("rank"))


def _sides(edges: list[Column]) -> list[Column]:
    """How many values lie below each lower edge and up to each upper edge."""
    return [F.count_if(F.col("v") < e if i % 2 == 0 else F.col("v") <= e) for i, e in enumerate(edges)]


def _bucket(kind: DataType) -> Column:
    """The number of the bucket that ``v`` falls in between ``lo`` and ``hi``; never less for a larger value."""
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    if isinstance(kind, (IntegralType, DecimalType)):
        exact = f"decimal(38,{kind.scale if isinstance(kind, DecimalType) else 0})"
        share = F.try_divide((v.cast(exact) - lo.cast(exact)).cast("double"), (hi.cast(exact) - lo.cast(exact)).cast("double"))
        return F.coalesce(F.least(F.lit(BUCKETS - 1), F.floor(share * BUCKETS)), F.lit(0))
    largest = F.lit(sys.float_info.max)
    low, high = (F.greatest(-largest, F.least(largest, c)) / 2 for c in (lo, hi))
    finite = F.least(F.lit(BUCKETS - 1), F.floor(F.try_divide(v / 2 - low, high - low) * BUCKETS))
    # infinities have buckets of their own
    return F.coalesce(F.when(v < -largest, -1).when(v > largest, BUCKETS).otherwise(finite), F.lit(0))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] | None = None,
                    interpolate: bool = False, sort_rows: int = SORT_ROWS) -> DataFrame:
    """Rows ``keys..., probability, quantile`` with exact quantiles of the values; NULL and NaN are none.

    ``interpolate`` gives the linearly interpolated quantile (the pandas default) as a double; otherwise it is
    the smallest value whose cumulative share reaches the probability, in the column's own type for
    integers and decimals (so nothing is lost beyond 2^53), else as a double. Infinities count as they are.

    A sketch brackets each rank and a second pass counts below and inside the bracket. Inside, values are counted
    one by one; where more than ``sort_rows`` rows are left, the interval is first cut into equal buckets as often as
    needed. All steps run when this is called, over the keys and the value, which are kept meanwhile so that
    the input is computed once.
    """
    keys = list(keys or [])
    number, kind = _number(df, value)
    rows = df.select(*keys, number.alias("v")).filter("v IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        targets = _pinned(_bracketed(rows, keys, probs, interpolate, sort_rows), keys)
        left = None
        while (most := targets.filter("lo < hi").agg(F.max("n")).first()[0] or 0) > sort_rows and most != left:
            targets, left = _pinned(_narrowed(rows, targets, keys, _bucket(kind)), keys), most
        values = _narrowed(rows, targets, keys, F.col("v"))
        pairs = values.groupBy(*keys, "which").agg(
            F.max(F.when(F.col("part") == 0, F.col("lo"))).alias("first"),
            F.max(F.when(F.col("part") == 1, F.col("lo"))).alias("second"), F.max("fraction").alias("fraction"))
        labels = F.array(*[F.lit(float(p)) for p in probs])
        quantile = F.col("first")
        if interpolate:
            first, second = F.col("first").cast("double"), F.col("second").cast("double")
            # between two infinities, or at a rank itself, there is nothing to interpolate
            quantile = F.when((F.col("fraction") == 0) | (first == second), first).otherwise(first + (second - first) * F.col("fraction"))
        return settle(pairs.select(*keys, labels[F.col("which")].alias("probability"), quantile.alias("quantile")))
    finally:
        rows.unpersist()


def exact_quantiles_wide(df: DataFrame, value: str, probs: list[float], names: list[str],
                         keys: list[str] | None = None, interpolate: bool = False) -> DataFrame:
    """One row per key, one column per exact quantile."""
    long = exact_quantiles(df, value, probs, keys, interpolate)
    return long.groupBy(*(keys or [])).agg(
        *[F.max(F.when(F.col("probability") == float(p), F.col("quantile"))).alias(name)
          for p, name in zip(probs, names)])


def quantiles_row(df: DataFrame, value: str, probs: list[float], exact: bool = False,
                  interpolate: bool = False, accuracy: int = DEFAULT_ACCURACY,
                  names: list[str] | None = None) -> DataFrame:
    """The quantiles as one row, one column each (``p01``, ``p50``, ... unless named)."""
    names = names or [quantile_label(p) for p in probs]
    if not exact:
        picked = df.agg(F.percentile_approx(_number(df, value)[0], list(probs), accuracy).alias("q"))
        return picked.select(*[F.col("q")[i].alias(name) for i, name in enumerate(names)])
    return exact_quantiles_wide(df, value, probs, names, interpolate=interpolate)


def quantile_range(df: DataFrame, value: str, low: float, high: float, exact: bool = False,
                   interpolate: bool = False, inclusive: bool = True,
                   accuracy: int = DEFAULT_ACCURACY) -> Column:
    """Condition "between these two quantiles", the bounds entering as a scalar subquery."""
    row = quantiles_row(df, value, [low, high], exact, interpolate, accuracy, ["lo", "hi"])
    bounds = row.select(F.struct("lo", "hi")).scalar()
    col = F.col(value)
    if inclusive:
        return (col >= bounds["lo"]) & (col <= bounds["hi"])
    return (col > bounds["lo"]) & (col < bounds["hi"])


def trim_to_quantiles(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99,
                      exact: bool = False, interpolate: bool = False, inclusive: bool = True,
                      accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Keep rows whose value lies between two quantiles of its own column."""
    return df.filter(quantile_range(df, value, low, high, exact, interpolate, inclusive, accuracy))
