"""Feature-encoding stages, fitted on training rows only."""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import (ElementwiseProduct, Imputer, OneHotEncoder, SQLTransformer, StandardScaler,
                                StringIndexer, VectorAssembler)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from costlake.operators.joins import lookup_join
from costlake.operators.quantiles import exact_quantiles
from costlake.operators.ranking import global_row_number
from costlake.session import settle

# Labels of a column up to which StringIndexer, which sends them all to the driver, may index it.
MOST_LABELS = 100_000


class LabelIndexer(Estimator):
    """Numbers labels as ``StringIndexer`` does, but in a table: no label is sent to the driver.

    Labels are counted, ranked by range partition with per-partition offsets, and joined back; small tables are
    broadcast, large ones shuffled. ``order`` is ``frequencyDesc`` (ties alphabetically) or ``alphabetDesc``.
    """

    def __init__(self, columns: list[str], outputs: list[str], order: str = "frequencyDesc", unseen: str = "keep"):
        super().__init__()
        if order not in ("frequencyDesc", "alphabetDesc") or unseen not in ("keep", "error"):
            raise ValueError("order is frequencyDesc or alphabetDesc, unseen keep or error")
        self.columns, self.outputs, self.order, self.unseen = columns, outputs, order, unseen

    def _fit(self, dataset: DataFrame) -> LabelIndex:
        tables = []
        for column in self.columns:
            label = F.col(column).cast("string")
            counts = dataset.select(label.alias("__label")).filter("__label IS NOT NULL").groupBy("__label").agg(F.count(F.lit(1)).alias("__n"))
            order = [F.col("__label").desc()] if self.order == "alphabetDesc" else [F.col("__n").desc(), F.col("__label")]
            tables.append(settle(global_row_number(counts, order, "__code").select("__label", "__code")))
        return LabelIndex(self.columns, self.outputs, tables, self.unseen)


class LabelIndex(Model):
    """The code tables of :class:`LabelIndexer`. NULL and labels that weren't fitted get the next number, or raise."""

    def __init__(self, columns: list[str], outputs: list[str], tables: list[DataFrame], unseen: str):
        super().__init__()
        self.columns, self.outputs, self.tables, self.unseen = columns, outputs, tables, unseen
        self.sizes = [table.count() for table in tables]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, out, table, size in zip(self.columns, self.outputs, self.tables, self.sizes):
            joined = lookup_join(dataset.withColumn("__label", F.col(column).cast("string")), table, ["__label"])
            other = F.lit(size) if self.unseen == "keep" else F.raise_error(F.lit(f"a label of {column} is NULL or was not fitted"))
            code = F.coalesce(F.col("__code"), other.cast("bigint")).cast("double")
            # the number of codes, so that encoders need not look for it
            described = {"ml_attr": {"type": "nominal", "name": out, "num_vals": size + (self.unseen == "keep")}}
            dataset = joined.withColumn(out, code).drop("__label", "__code").withMetadata(out, described)
        return dataset


def indexer(train: DataFrame, columns: list[str], outputs: list[str], order: str = "frequencyDesc", unseen: str = "keep",
            most: int = MOST_LABELS) -> Estimator:
    """``StringIndexer`` where each column has at most ``most`` labels (by an approximate count), else :class:`LabelIndexer`."""
    counts = train.agg(*[F.approx_count_distinct(c) for c in columns]).first()
    if max(counts, default=0) * 1.1 <= most:
        return StringIndexer(inputCols=columns, outputCols=outputs, stringOrderType=order, handleInvalid=unseen)
    return LabelIndexer(columns, outputs, order, unseen)


def median_stage(train: DataFrame, columns: list[str], outputs: list[str]) -> SQLTransformer:
    """Fill NULL and NaN with the exact medians of ``train``, which ``Imputer`` takes from a sketch.

    A median is the smallest value that half of the values don't exceed. All columns are counted in one go.
    """
    entries = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])
    medians = {r["at"]: r["quantile"] for r in exact_quantiles(train.select(F.inline(entries)), "value", [0.5], ["at"]).collect()}
    empty = [c for i, c in enumerate(columns) if i not in medians]
    if empty:
        raise ValueError(f"no median: {', '.join(empty)} have no values")
    filled = []
    for i, (column, out) in enumerate(zip(columns, outputs)):
        kind = train.schema[column].dataType.simpleString()
        median = f"CAST(CAST('{medians[i]!r}' AS DOUBLE) AS {kind})"
        filled.append(f"CASE WHEN `{column}` IS NULL OR isnan(`{column}`) THEN {median} ELSE `{column}` END AS `{out}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")


def structured_stages(categorical: list[str], numeric: list[str],
                      quantile_error: float = 0.001, train: DataFrame | None = None) -> tuple[list, list[str]]:
    """Index by frequency, one-hot, median-impute. Returns the stages and their output columns.

    Unseen categories get a slot of their own. All categories are indexed in one fit; given the training rows,
    :func:`indexer` picks a way that never sends very many labels to the driver, and a ``quantile_error`` of 0
    takes exact medians (:func:`median_stage`).
    """
    indexed = [f"{c}__idx" for c in categorical]
    encoded = [f"{c}__ohe" for c in categorical]
    imputed = [f"{c}__imp" for c in numeric]
    stages = []
    if categorical:
        stages += [
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep",
                          stringOrderType="frequencyDesc") if train is None else indexer(train, categorical, indexed),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep", dropLast=True),
        ]
    if numeric and train is not None and quantile_error == 0:
        stages.append(median_stage(train, numeric, imputed))
    elif numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=imputed, strategy="median",
                              relativeError=quantile_error))
    return stages, encoded + imputed


def assembler(columns: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid="keep")


def columns_by_kind(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names, decided by the schema."""
    numeric = [c for c in features if isinstance(df.schema[c].dataType, NumericType)]
    return numeric, [c for c in features if c not in numeric]


def standardized_stages(df: DataFrame, features: list[str], strategy: str = "median",
                        out: str = "features") -> list:
    """Impute (medians are exact) and standardise numbers (population deviation), one-hot the rest dropping the first.

    Spark divides by the sample deviation; the constant factor sqrt(n / (n - 1)) turns that
    into the population one. Categories are indexed Z-A, so the slot ``dropLast`` removes is
    the alphabetically first category.
    """
    numeric, categorical = columns_by_kind(df, features)
    stages, parts = [], []
    if numeric:
        n = df.count()
        factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
        imputed = [f"{c}__imp" for c in numeric]
        stages += [
            median_stage(df, numeric, imputed) if strategy == "median"
            else Imputer(inputCols=numeric, outputCols=imputed, strategy=strategy),
            VectorAssembler(inputCols=imputed, outputCol="__numbers", handleInvalid="keep"),
            StandardScaler(inputCol="__numbers", outputCol="__scaled", withMean=True, withStd=True),
            ElementwiseProduct(inputCol="__scaled", outputCol="__standard",
                               scalingVec=Vectors.dense([factor] * len(numeric))),
        ]
        parts.append("__standard")
    if categorical:
        indexed = [f"{c}__idx" for c in categorical]
        encoded = [f"{c}__ohe" for c in categorical]
        stages += [
            indexer(df, categorical, indexed, "alphabetDesc", "error"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
        parts += encoded
    return stages + [assembler(parts, out)]
