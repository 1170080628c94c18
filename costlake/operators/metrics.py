"""Regression quality in one aggregate per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.operators.joins import key_join


def _error_metrics(y: Column, p: Column, prefix: str = "") -> dict[str, Column]:
    error = y - p
    squared = error * error
    spread = F.var_pop(F.when(error.isNotNull(), y))
    return {
        f"{prefix}mae": F.avg(F.abs(error)),
        f"{prefix}rmse": F.sqrt(F.avg(squared)),
        f"{prefix}r2": F.when(spread > 0, 1 - F.avg(squared) / spread),
    }


def _mape(y: Column, p: Column) -> Column:
    """Percent; rows with a zero actual are left out."""
    return F.avg(F.abs(F.try_divide(y - p, y))) * 100.0


def regression_metrics(df: DataFrame, actual: str, predicted: str, group: list[str],
                       log_actual: str | None = None, log_predicted: str | None = None) -> DataFrame:
    """rows, mae, rmse, r2, mape (and log_mae, log_rmse, log_r2) per group.

    r2 is NULL where the actual values do not vary.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    out = _error_metrics(y, p)
    out["mape"] = _mape(y, p)
    if log_actual is not None:
        out.update(_error_metrics(F.col(log_actual).cast("double"), F.col(log_predicted).cast("double"),
                                  "log_"))
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"),
                                  *[c.alias(n) for n, c in out.items()])


def log_metrics(df: DataFrame, log_actual: str, log_predicted: str, group: list[str]) -> DataFrame:
    """rows, log_rmse, log_r2 per group."""
    found = _error_metrics(F.col(log_actual), F.col(log_predicted), "log_")
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"),
                                  found["log_rmse"].alias("log_rmse"), found["log_r2"].alias("log_r2"))


def fold_scores(df: DataFrame, actual: str, predicted: str, group: list[str]) -> DataFrame:
    """r2, mse, msle, mape (a percentage) and explained variance per fold."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error, log_error = y - p, F.log1p(y) - F.log1p(p)
    spread = F.var_pop(F.when(error.isNotNull(), y))
    return df.groupBy(*group).agg(
        F.when(spread > 0, 1 - F.avg(error * error) / spread).alias("r2"),
        F.avg(error * error).alias("mse"),
        F.avg(log_error * log_error).alias("msle"),
        _mape(y, p).alias("mape"),
        F.when(spread > 0, 1 - F.var_pop(error) / spread).alias("explained_variance"))


def score_summary(scores: DataFrame, columns: list[str], group: list[str]) -> DataFrame:
    """Mean and (population) standard deviation over folds."""
    stats = [f(c).alias(f"{c}_{name}") for c in columns
             for name, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return scores.groupBy(*group).agg(*stats)


def constant_mean_rmse(df: DataFrame, actual: str, fold: str = "fold") -> DataFrame:
    """RMSE per fold of always predicting the overall mean."""
    mean = df.agg(F.avg(actual)).scalar()
    gap = F.col(actual) - mean
    return df.groupBy(fold).agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))


def improvement(metrics: DataFrame, baseline: str, score: str = "rmse",
                group: list[str] | None = None) -> DataFrame:
    """Percent by which each model's score is below the baseline's, per group."""
    group = group or ["split"]
    base = metrics.filter(F.col("model") == baseline).select(*group, F.col(score).alias("baseline"))
    return (key_join(metrics.filter(F.col("model") != baseline), base, group)
            .withColumn("improvement_percent",
                        F.try_divide(F.col("baseline") - F.col(score), F.col("baseline")) * 100.0)
            .select(*group, "model", score, "baseline", "improvement_percent"))


def ablation(metrics: DataFrame, without: str, with_: str, group: str = "split") -> DataFrame:
    """Two models side by side per split and the RMSE reduction the second one brings."""

    def value(model: str, column: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(column)))

    pairs = [(f"{tag}_{column}", value(model, column)) for column in ("rmse", "r2", "log_r2")
             for tag, model in (("structured", without), ("text_structured", with_))]
    wide = (metrics.filter(F.col("model").isin(without, with_)).groupBy(group)
            .agg(*[c.alias(n) for n, c in pairs]))
    reduction = F.try_divide(F.col("structured_rmse") - F.col("text_structured_rmse"),
                             F.col("structured_rmse")) * 100.0
    return wide.withColumn("rmse_reduction_percent", reduction)


def residuals(df: DataFrame, log_actual: str, log_predicted: str) -> DataFrame:
    """Predictions and residuals on the log and on the amount scale."""
    y, p = F.col(log_actual), F.col(log_predicted)
    return df.withColumns({
        "residual_log10": p - y,
        "predicted_cost": F.pow(F.lit(10.0), p),
        "actual_cost": F.pow(F.lit(10.0), y),
        "residual_cost": F.pow(F.lit(10.0), p) - F.pow(F.lit(10.0), y),
    })
