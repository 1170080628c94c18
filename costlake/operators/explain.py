"""Which words move a text model's prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.functions.features import is_numeric_text
from costlake.operators.ranking import top_rows


def checked_pairs(terms: list[str], coefficients: list[float]) -> list[tuple[str, float]]:
    if len(terms) != len(coefficients):
        raise ValueError(f"{len(terms)} terms but {len(coefficients)} coefficients")
    return [(term, float(c)) for term, c in zip(terms, coefficients)]


def coefficient_rows(spark: SparkSession, terms: list[str], coefficients: list[float]) -> DataFrame:
    """A fitted model's coefficients as a table (one row per vocabulary term)."""
    return spark.createDataFrame(checked_pairs(terms, coefficients), "term string, coefficient_log10 double")


def term_effects(df: DataFrame, coefficient: str = "coefficient_log10") -> DataFrame:
    """Add the factor a term puts on the predicted amount, and its direction."""
    return df.withColumns({
        "prediction_multiplier": F.pow(F.lit(10.0), F.col(coefficient)),
        "direction": F.when(F.col(coefficient) > 0, "higher").otherwise("lower"),
    })


def display_terms(df: DataFrame, n: int = 12, coefficient: str = "coefficient_log10",
                  ascending: bool = False) -> DataFrame:
    """The first ``n`` terms that are not plain numbers."""
    words = df.filter(~is_numeric_text(F.col("term")))
    return top_rows(words, coefficient, n, ["term"], ascending)
