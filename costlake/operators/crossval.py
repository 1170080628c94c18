"""Cross-validation with scores on both sides, and its row in the run log."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.operators.metrics import fold_scores
from costlake.session import settle
from costlake.sources.reports import run_rows

#: What a run says of a score that can't be computed.
NO_SCORE = -99.0


def fold_models(models: dict[str, Estimator | Callable[[DataFrame], Estimator]], df: DataFrame, fold: str = "fold",
                folds: int = 4) -> dict[tuple[str, int], Model]:
    """Every model fitted without each fold. A model is an estimator, or makes one from the rows it is fitted on."""
    fitted = {}
    for i in range(folds):
        train = df.filter(F.col(fold) != i)
        for name, estimator in models.items():
            fitted[name, i] = (estimator if isinstance(estimator, Estimator) else estimator(train)).fit(train)
    return fitted


def two_sided(fitted: dict[tuple[str, int], Model], df: DataFrame, label: str = "label", fold: str = "fold") -> DataFrame:
    """(model, fold, side, label, prediction): every row predicted by every fold's model, ``test`` in the fold and ``train`` outside.

    The models follow one another over the same rows, so the rows are read once. Rows without a fold are left out.
    """
    rows, columns = df.filter(F.col(fold).isNotNull()), []
    for n, ((name, i), model) in enumerate(fitted.items()):
        columns.append((name, i, f"__prediction{n}"))
        rows = _predicting(model, f"__prediction{n}").transform(rows).select(*df.columns, *[c for *_, c in columns])
    entries = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(i).alias("fold"), F.col(c).alias("prediction")) for name, i, c in columns])
    stacked = rows.select(F.col(fold).alias("__own"), F.col(label).alias("label"), F.explode(entries).alias("e"))
    return stacked.select("e.model", "e.fold", F.when(F.col("__own") == F.col("e.fold"), "test").otherwise("train").alias("side"), "label", "e.prediction")


def _predicting(model: Model, out: str) -> Model:
    copied = model.copy()
    last = copied.stages[-1] if isinstance(copied, PipelineModel) else copied
    last.setPredictionCol(out)
    return copied


def cross_validated_sides(models: dict, df: DataFrame, label: str = "label", fold: str = "fold", folds: int = 4) -> DataFrame:
    """(model, fold, side, r2, mse, msle, mape, explained_variance) on both sides of every fold."""
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stacked = two_sided(fold_models(models, cached, fold, folds), cached, label, fold)
        return settle(fold_scores(stacked, "label", "prediction", ["model", "fold", "side"]))
    finally:
        cached.unpersist()


def run_of(scores: DataFrame, model: str, experiment: str, df: DataFrame, label: str, categories: list[str], numbers: list[str],
           dataset_version: str | None = None, random_state: int | None = None, side: str = "test") -> DataFrame:
    """The run-log row of one cross-validated model: mean and deviation of its error, and every score as one entry per fold.

    Scores without a value are entered as -99; the deviation is the population's. ``df`` is the table the model was fitted on.
    """
    found = scores.filter((F.col("model") == model) & (F.col("side") == side)).orderBy("fold").collect()
    if not found:
        raise ValueError(f"no scores of {model}")
    rmse = [math.sqrt(r["mse"]) for r in found]
    mean = sum(rmse) / len(rmse)
    listed = lambda values: [NO_SCORE if v is None or math.isnan(v) else float(v) for v in values]
    return run_rows(scores.sparkSession, [dict(
        experiment=experiment, model=model, rmse_cv_mean=mean, rmse_cv_std=math.sqrt(sum((x - mean) ** 2 for x in rmse) / len(rmse)),
        dataset_version=dataset_version, dataset_rows=df.count(), dataset_columns=len(df.columns), target_variable=label,
        features_cat=categories, features_num=numbers, random_state=random_state, n_folds=len(found), rmse_cv=rmse,
        r2_cv=listed(r["r2"] for r in found), rmsle_cv=listed(None if r["msle"] is None else math.sqrt(r["msle"]) for r in found),
        mape_cv=listed(r["mape"] for r in found), evs_cv=listed(r["explained_variance"] for r in found))])
