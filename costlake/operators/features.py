"""Feature tables: targets, eligibility, rare categories, codes, imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions import features as fx
from costlake.operators.joins import lookup_join
from costlake.operators.quantiles import quantile_range
from costlake.operators.ranking import global_row_number


def choose_target(df: DataFrame, choices: list[tuple[str, str]], target: str = "target_cost",
                  source: str = "target_source") -> DataFrame:
    """First positive amount wins. ``choices`` lists (amount column, flag column) in priority order."""
    value, label = fx.first_valid([(amount, F.col(amount), F.col(flag)) for amount, flag in choices])
    return df.withColumns({target: value, source: label})


def positive_only(df: DataFrame, target: str = "target_cost") -> DataFrame:
    return df.filter(F.col(target) > 0)


def eligible_rows(df: DataFrame, target: str, low: float, high: float, year: str, first_year: int,
                  required: list[str] | None = None, source: str | None = None,
                  only_source: str | None = None) -> DataFrame:
    """Training population: amount domain, first year, required columns, optional source."""
    keep = F.col(target).between(low, high) & (F.col(year) >= first_year)
    for column in required or []:
        keep = keep & F.col(column).isNotNull()
    if only_source is not None:
        keep = keep & (F.col(source) == only_source)
    return df.filter(keep)


def population(df: DataFrame, permit_type: str, status: str, use: str, amount: str,
               uses: list[str], below_type: int = 3, done: str = "complete") -> DataFrame:
    """Completed work of the given uses with a known amount."""
    return df.filter((F.col(permit_type) < below_type) & (F.col(status) == done)
                     & F.col(use).isin(*uses) & F.col(amount).isNotNull())


def trim_outliers(df: DataFrame, quantile_columns: list[str], low: float = 0.01, high: float = 0.99,
                  caps: dict[str, float] | None = None) -> DataFrame:
    """Rows inside the interpolated quantile range of every column and under every cap.

    All bounds are taken on the untrimmed table, and a NULL fails its test.
    """
    keep = F.lit(True)
    for column in quantile_columns:
        keep = keep & quantile_range(df, column, low, high, exact=True, interpolate=True)
    for column, cap in (caps or {}).items():
        keep = keep & (F.col(column) <= cap)
    return df.filter(keep)


def fold_rare(df: DataFrame, column: str, minimum: int, label: str, out: str | None = None) -> DataFrame:
    """Categories with fewer than ``minimum`` rows, and NULL, become ``label``."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    known = counts.filter(F.col("__n") >= minimum)
    folded = F.when(F.col("__n").isNotNull(), F.col(column).cast("string")).otherwise(F.lit(label))
    return lookup_join(df, known, [column]).withColumn(out or f"{column}_", folded).drop("__n")


def first_appearance_codes(df: DataFrame, column: str, order_key: str, out: str | None = None) -> DataFrame:
    """Codes 0, 1, 2, ... in order of first appearance; NULL gets -1."""
    firsts = (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.min(order_key).alias("__first")))
    codes = global_row_number(firsts, [F.col("__first"), F.col(column)], "__code").drop("__first")
    coded = lookup_join(df, codes, [column])
    return coded.withColumn(out or f"{column}_code", F.coalesce(F.col("__code"), F.lit(-1))).drop("__code")


def mean_imputed_box_cox(df: DataFrame, columns: list[str], lam: float = 0.1,
                         suffix: str = "_bct") -> DataFrame:
    """Box-Cox of ``1 + x`` after filling NULL with the column mean; one pass for all means."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    return df.withColumns({f"{c}{suffix}": fx.box_cox_1p(F.coalesce(F.col(c), means[c]), lam)
                           for c in columns})


def repair_stories(df: DataFrame, column: str, text: str, out: str | None = None,
                   legacy: bool = False) -> DataFrame:
    return df.withColumn(out or f"{column}_",
                         fx.repaired_story_count(F.col(column), F.col(text), legacy=legacy))


def area_costs(df: DataFrame, area: str, storeys: str, cost: str) -> DataFrame:
    with_area = df.withColumn("total_area_m2", fx.total_area(F.col(area), F.col(storeys)))
    return with_area.withColumn("cost_per_m2", fx.cost_per_area(F.col(cost), F.col("total_area_m2")))


def category_text(df: DataFrame, column: str, out: str) -> DataFrame:
    """A numeric category as text, so encoders treat it as a label."""
    return df.withColumn(out, F.col(column).cast("string"))


