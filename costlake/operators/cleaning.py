"""Whole-table cleaning: names, blank tokens, types, quality flags, calendar parts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from costlake.functions import cleaning as fc


@dataclass(frozen=True)
class TypePlan:
    """Which text columns become which type. Columns a table lacks are skipped."""

    dates: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    amounts: tuple[str, ...] = ()
    zips: tuple[str, ...] = ()


@dataclass(frozen=True)
class QualityPlan:
    """Quality flags: flag name -> column that must be present / must be positive."""

    present: dict[str, str] = field(default_factory=dict)
    positive: dict[str, str] = field(default_factory=dict)


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = [fc.snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after renaming: {clashes}")
    return df.toDF(*names)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def null_tokens(df: DataFrame, tokens=fc.NULL_TOKENS) -> DataFrame:
    """Trim every string column and turn "no value" spellings into NULL, in one select."""
    texts = set(string_columns(df))
    return df.select(*[fc.null_if_token(F.col(c), tokens).alias(c) if c in texts else F.col(c)
                       for c in df.columns])


def apply_types(df: DataFrame, plan: TypePlan) -> DataFrame:
    parsers = [(plan.dates, fc.parse_date), (plan.integers, fc.parse_int),
               (plan.amounts, fc.parse_money), (plan.zips, fc.extract_zip)]
    typed: dict[str, Column] = {}
    for names, parse in parsers:
        typed.update({c: parse(F.col(c)) for c in names if c in df.columns})
    return df.withColumns(typed) if typed else df


def quality_flags(df: DataFrame, plan: QualityPlan) -> DataFrame:
    """Boolean flags that are never NULL."""
    flags = {flag: F.col(c).isNotNull() for flag, c in plan.present.items()}
    flags.update({flag: F.coalesce(F.col(c) > 0, F.lit(False)) for flag, c in plan.positive.items()})
    return df.withColumns(flags)


def calendar_parts(df: DataFrame, date: str, year: str, month: str | None = None) -> DataFrame:
    if date not in df.columns:
        return df
    parts = {year: F.year(date)}
    if month is not None:
        parts[month] = F.month(date)
    return df.withColumns(parts)


def coerce_named_dates(df: DataFrame, word: str = "date") -> DataFrame:
    """Every text column with ``word`` in its name becomes a timestamp, NULL if malformed."""
    named = {c: fc.parse_timestamp(F.col(c)) for c in string_columns(df) if word in c.lower()}
    return df.withColumns(named) if named else df


def project_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def fill_categories(df: DataFrame, columns: list[str], sentinel: str = "__MISSING__") -> DataFrame:
    return df.fillna(sentinel, subset=list(columns))


def fill_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna("", subset=list(columns))
