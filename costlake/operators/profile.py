"""Descriptive statistics. Every profile is one pass over its input."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions.features import has_text
from costlake.operators.joins import key_join
from costlake.operators.quantiles import (DEFAULT_ACCURACY, exact_quantiles_wide, quantile_label,
                                          quantiles_row, trim_to_quantiles)
from costlake.operators.ranking import top_k_per_group


def _rows() -> Column:
    return F.count(F.lit(1))


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def duplicates_removed(df: DataFrame, key: str) -> DataFrame:
    """Rows a keep-one-per-key pass removes; rows without a key are never removed."""
    per_key = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(_rows().alias("n")))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed"))


def distribution(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.min(value).alias("min"), F.avg(value).alias("mean"),
                  F.stddev_samp(value).alias("stddev"), F.max(value).alias("max"))


def center(df: DataFrame, value: str, accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    if exact:
        median = quantiles_row(df, value, [0.5], exact=True).scalar()
    else:
        median = F.percentile_approx(value, 0.5, accuracy)
    stats = [F.min(value).alias("min"), F.avg(value).alias("mean"), F.max(value).alias("max")]
    if exact:
        return df.agg(*stats).withColumn("median", median)
    return df.agg(*stats, median.alias("median"))


def long_rows(one_row: DataFrame, groups: dict[str, dict[str, Column]], label: str) -> DataFrame:
    """Turn one wide row into one row per label: ``{label_value: {column: expression}}``."""
    entries = [F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in columns.items()])
               for name, columns in groups.items()]
    return one_row.select(F.inline(F.array(*entries)))


def threshold_counts(df: DataFrame, value: str, thresholds: list[float]) -> DataFrame:
    """Rows strictly below each threshold with their share in percent."""
    row = df.agg(_rows().alias("n"), *[F.count_if(F.col(value) < t).alias(f"b{i}")
                                       for i, t in enumerate(thresholds)])
    return long_rows(row, {
        t: {"rows_below": F.col(f"b{i}"),
            "percentage": F.round(F.try_divide(F.col(f"b{i}") * 100.0, F.col("n")), 4)}
        for i, t in enumerate(thresholds)}, "threshold")


def group_profile(df: DataFrame, keys: list[str], value: str, accuracy: int = DEFAULT_ACCURACY,
                  keep_null_keys: bool = True, exact: bool = False) -> DataFrame:
    """Row count, mean and median of a value per group.

    The median comes from a sketch in the same pass; ``exact`` counts for it, which takes a few more.
    """
    rows = df if keep_null_keys else df.dropna(subset=keys)
    if exact:
        medians = exact_quantiles_wide(rows, value, [0.5], ["median_cost"], keys)
        counts = rows.groupBy(*keys).agg(_rows().alias("projects"), F.avg(value).alias("mean_cost"))
        return key_join(counts, medians, keys, "left")
    return rows.groupBy(*keys).agg(
        _rows().alias("projects"), F.avg(value).alias("mean_cost"),
        F.percentile_approx(value, 0.5, accuracy).alias("median_cost"))


def group_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(_rows().alias("rows"))


def column_averages(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row of averages; ``columns`` maps output names to columns."""
    return df.agg(*[F.avg(c).alias(name) for name, c in columns.items()])


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing rows and percent for each listed column the table has."""
    present = [c for c in columns if c in df.columns]
    row = df.agg(_rows().alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    return long_rows(row, {
        c: {"missing_rows": F.col(c),
            "missing_percentage": F.round(F.try_divide(F.col(c) * 100.0, F.col("__n")), 4)}
        for c in present}, "column")


def non_null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    row = df.agg(*[F.count(c).alias(c) for c in columns])
    return long_rows(row, {c: {"non_null": F.col(c)} for c in columns}, "column")


def columns_with_values(df: DataFrame, columns: list[str]) -> list[str]:
    """The listed columns that hold at least one value. Runs one aggregate: model shape depends on it."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return []
    row = df.agg(*[F.count(c).alias(c) for c in present]).first()
    return [c for c in present if row[c] > 0]


def drift(df: DataFrame, value: str, split: str = "split", probs: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95),
          accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """Rows, mean and quantiles of a value per split."""
    labels = [quantile_label(p) for p in probs]
    stats = [_rows().alias("rows"), F.avg(value).alias("mean")]
    if exact:
        wide = exact_quantiles_wide(df, value, list(probs), labels, [split])
        return key_join(df.groupBy(split).agg(*stats), wide, [split], "left")
    summary = df.groupBy(split).agg(*stats, F.percentile_approx(value, list(probs), accuracy).alias("q"))
    return summary.select(split, "rows", "mean", *[F.col("q")[i].alias(n) for i, n in enumerate(labels)])


def share_of_total(counts: DataFrame, count: str, group: list[str], out: str = "share_percent") -> DataFrame:
    """Each row's percent of its group's total, totals joined back so no group sits in one task."""
    totals = counts.groupBy(*group).agg(F.sum(count).alias("__total"))
    return (key_join(counts, totals, group)
            .withColumn(out, F.try_divide(F.col(count) * 100.0, F.col("__total"))).drop("__total"))


def category_drift(df: DataFrame, category: str, split: str = "split", k: int = 8) -> DataFrame:
    """The ``k`` largest categories of each split with their percent of the split's rows."""
    counts = group_count(df, [split, category])
    top = top_k_per_group(counts, [split], "rows", k, [F.col(category).asc_nulls_last()])
    totals = counts.groupBy(split).agg(F.sum("rows").alias("__total"))
    return (key_join(top, totals, [split])
            .withColumn("share_percent", F.col("rows") * 100.0 / F.col("__total")).drop("__total"))


def text_coverage(df: DataFrame, text: str, group: list[str]) -> DataFrame:
    covered = F.count_if(has_text(F.col(text)))
    return (df.groupBy(*group).agg(_rows().alias("rows"), covered.alias("with_text"))
            .withColumn("percent", F.col("with_text") * 100.0 / F.col("rows")))


def absolute_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Absolute Pearson correlation of every column pair, in one pass."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.abs(F.corr(a, b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                        F.col(f"c{i}").alias("abs_correlation")) for i, (a, b) in enumerate(pairs)]
    return row.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, value: str, width: float, category: str) -> DataFrame:
    """Counts per equal-width bin and category; the bin is named by its lower edge."""
    edge = F.floor(F.col(value) / width) * F.lit(width)
    return df.groupBy(edge.alias("bin"), category).agg(_rows().alias("rows"))


def yearly_histogram(df: DataFrame, date: str, category: str) -> DataFrame:
    return (df.filter(F.col(date).isNotNull())
            .groupBy(F.year(date).alias("year"), category).agg(_rows().alias("rows")))


def display_trim(df: DataFrame, value: str, low: float = 0.075, high: float = 0.925) -> DataFrame:
    """Strictly inside the interpolated quantile range, for plotting."""
    return trim_to_quantiles(df, value, low, high, exact=True, interpolate=True, inclusive=False)


def trailing_counts(df: DataFrame, date: str, years: list[int]) -> DataFrame:
    """Rows in the last n years up to the newest date, and in all."""
    newest = df.agg(F.max(date)).scalar()
    counts = [F.count_if(F.col(date) >= F.add_months(newest, -12 * y)).alias(f"y{y}") for y in years]
    row = df.filter(F.col(date).isNotNull()).agg(_rows().alias("all"), *counts)
    ranges = {f"{y}y": {"rows": F.col(f"y{y}")} for y in years}
    return long_rows(row, {**ranges, "all": {"rows": F.col("all")}}, "range")


def since(df: DataFrame, column: str, first) -> DataFrame:
    return df.filter(F.col(column) >= first)
