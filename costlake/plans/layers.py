"""Raw -> cleaned -> feature-ready layers. Each layer is written once and verified."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.functions import cleaning as fc
from costlake.functions import features as fx
from costlake.operators import cleaning, dedupe, features, profile
from costlake.operators.quantiles import trim_to_quantiles
from costlake.plans.permits import PERMITS, CostTable
from costlake.sources import tables


@dataclass(frozen=True)
class Layers:
    raw: DataFrame
    cleaned: DataFrame
    ready: DataFrame


def ingest(spark: SparkSession, source: str | list[str], target: str, source_name: str,
           dataset_id: str, multiline: bool = True) -> DataFrame:
    raw = tables.read_csv_raw(spark, source, multiline)
    return tables.write_verified(tables.stamp_ingest(raw, source_name, dataset_id), target)


def cleaned_rows(raw: DataFrame, table: CostTable = PERMITS) -> DataFrame:
    """Names, blanks, types, flags, one row per key, calendar parts."""
    typed = cleaning.apply_types(cleaning.null_tokens(cleaning.snake_case_columns(raw)), table.types)
    flagged = cleaning.quality_flags(typed, table.quality)
    latest = dedupe.latest_version(flagged, table.key, [c for c in table.newest if c in flagged.columns])
    dated = cleaning.calendar_parts(latest, table.creation_date, table.year, table.month)
    return tables.stamp_processed(dated)


def quality_metrics(cleaned: DataFrame, table: CostTable = PERMITS) -> DataFrame:
    missing = {f"missing_{c}": ~F.col(flag) for flag, c in table.quality.present.items()}
    valid = {f"valid_{c}": F.col(flag) for flag, c in table.quality.positive.items()}
    return profile.conditional_counts(cleaned, {**missing, **valid})


def with_targets(cleaned: DataFrame, table: CostTable = PERMITS) -> DataFrame:
    return features.positive_only(features.choose_target(cleaned, list(table.amounts)))


def feature_rows(cleaned: DataFrame, table: CostTable = PERMITS, low: float = 0.01, high: float = 0.99,
                 exact_bounds: bool = False, collapse_null_keys: bool = False) -> DataFrame:
    """Target, outlier trim, derived numbers, yes/no flags, the wanted columns, one row per key.

    ``collapse_null_keys`` keeps a single row for all rows without a key.
    """
    trimmed = trim_to_quantiles(with_targets(cleaned, table), "target_cost", low, high,
                                exact=exact_bounds, accuracy=1000)
    derived = {"target_cost_log10": F.log10("target_cost")}
    derived.update({out: fx.zero_filled_difference(F.col(a), F.col(b))
                    for out, (a, b) in table.differences.items()
                    if a in trimmed.columns and b in trimmed.columns})
    derived.update({out: fc.yes_flag(F.col(c)) for out, c in table.yes_no.items() if c in trimmed.columns})
    wanted = cleaning.project_present(trimmed.withColumns(derived), list(table.feature_columns))
    return dedupe.drop_duplicates(wanted, [table.key], collapse_null_keys=collapse_null_keys)


def build_layers(spark: SparkSession, source: str | list[str], out: str, source_name: str,
                 dataset_id: str, table: CostTable = PERMITS, multiline: bool = True,
                 files: int | None = None, exact_bounds: bool = False) -> Layers:
    """The whole path from CSV to the feature table below ``out``."""
    raw = ingest(spark, source, f"{out}/raw", source_name, dataset_id, multiline)
    cleaned = tables.write_verified(cleaned_rows(raw, table), f"{out}/cleaned")
    ready = tables.write_verified(feature_rows(cleaned, table, exact_bounds=exact_bounds),
                                  f"{out}/ready", files)
    return Layers(raw, cleaned, ready)
