"""The descriptive report set of a feature table, and the drift diagnostics."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.operators import profile, quantiles, ranking
from costlake.plans.permits import PERMITS, CostTable
from costlake.sources import reports

# Quantiles and thresholds the cost report lists.
PROBABILITIES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
THRESHOLDS = (10, 100, 500, 1_000, 5_000, 10_000, 50_000, 100_000, 500_000)


def group_reports(ready: DataFrame, table: CostTable = PERMITS, value: str = "target_cost",
                  accuracy: int = quantiles.DEFAULT_ACCURACY, exact: bool = False, only: set[str] | None = None) -> dict[str, DataFrame]:
    """The profile reports of a table by name, or those named in ``only``; ``exact`` medians instead of sketched ones."""
    out = {}
    for name, (keys, present, top) in table.profiles.items():
        if not set(keys) <= set(ready.columns) or only is not None and name not in only:
            continue
        rows = ready.dropna(subset=list(present)) if present else ready
        found = profile.group_profile(rows, list(keys), value, accuracy, exact=exact)
        out[name] = found if top is None else ranking.top_rows(found, "projects", top, list(keys))
    return out


def summary_row(ready: DataFrame, table: CostTable = PERMITS, value: str = "target_cost", accuracy: int = 1000,
                exact: bool = False) -> DataFrame:
    """The nested summary as one row, one field a section, from one aggregate over the table: one scan, one shuffle.

    ``exact`` quantiles are counted instead of sketched, which reads the column again.
    """
    v, n = F.col(value), F.col("n")
    scale = {name: c for name, c in table.scale_averages.items() if c in ready.columns}
    checked = [c for c in table.null_checked if c in ready.columns]
    labels = [quantiles.quantile_label(p) for p in PROBABILITIES]
    row = ready.agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("min"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"), F.max(v).alias("max"),
        F.percentile_approx(quantiles.known_number(ready, value), list(PROBABILITIES), accuracy).alias("q"),
        *[F.count_if(v < t).alias(f"below{i}") for i, t in enumerate(THRESHOLDS)], *[F.avg(c).alias(f"mean{i}") for i, c in enumerate(scale.values())],
        *[F.count_if(F.col(c).isNull()).alias(f"missing{i}") for i, c in enumerate(checked)])
    if exact:
        wide = quantiles.quantiles_row(ready, value, list(PROBABILITIES), exact=True, names=labels)
        row = row.withColumn("q", wide.select(F.array(*labels)).scalar())

    def shares(names: list, counted: str, rows: str, percent: str):
        return F.map_from_entries(F.array(*[F.struct(F.lit(str(name)), F.struct(
            F.col(f"{counted}{i}").alias(rows), F.round(F.try_divide(F.col(f"{counted}{i}") * 100.0, n), 4).alias(percent)))
            for i, name in enumerate(names)]))

    return row.select(
        F.struct(n.alias("rows"), F.lit(len(ready.columns)).alias("columns")).alias("dataset"),
        F.struct("min", "mean", "stddev", "max").alias("cost_statistics"),
        F.struct(*[F.col("q")[i].alias(label) for i, label in enumerate(labels)]).alias("cost_quantiles"),
        shares(list(THRESHOLDS), "below", "rows_below", "percentage").alias("low_cost_diagnostic"),
        *([F.struct(*[F.col(f"mean{i}").alias(name) for i, name in enumerate(scale)]).alias("project_scale")] if scale else []),
        *([shares(checked, "missing", "missing_rows", "missing_percentage").alias("null_rates")] if checked else []))


def write_reports(ready: DataFrame, out: str, table: CostTable = PERMITS, exact: bool = False, only: set[str] | None = None) -> None:
    """The summary (called ``summary``) and every profile report, or those named in ``only``."""
    if only is None or "summary" in only:
        summary_row(ready, table, exact=exact).coalesce(1).write.mode("overwrite").json(f"{out}/summary")
    for name, report in group_reports(ready, table, exact=exact, only=only).items():
        keys = table.profiles[name][0]
        order = list(keys) if table.year in keys else [F.desc("projects"), *keys]
        reports.write_report_csv(report, f"{out}/{name}", order)


def drift_reports(split_rows: DataFrame, category: str, table: CostTable = PERMITS, value: str = "target_cost",
                  source: str = "target_source", exact: bool = False) -> dict[str, DataFrame]:
    """How target, target source, volume and categories move between the splits."""
    return {
        "target_drift": profile.drift(split_rows, value, exact=exact),
        "source_by_split": profile.group_profile(split_rows, ["split", source], value, exact=exact),
        "year_distribution": profile.group_profile(split_rows, [table.year], value, exact=exact).orderBy(table.year),
        "category_drift": profile.category_drift(split_rows, category),
    }


def write_drift_reports(split_rows: DataFrame, category: str, out: str, table: CostTable = PERMITS, exact: bool = False) -> None:
    """Every drift report as a CSV file of its name; the rows are computed once for all of them."""
    rows = split_rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, report in drift_reports(rows, category, table, exact=exact).items():
            reports.write_report_csv(report, f"{out}/{name}")
    finally:
        rows.unpersist()
