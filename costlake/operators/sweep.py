"""Penalised linear models over many penalties and folds from one pass over the rows.

The rows are reduced to a count, a mean vector and a matrix of centred products per fold. The training side of a
fold is the sum of the others, so every penalty is a small solve, and the held-out error follows from the fold's
own moments: the rows are read once, whatever the number of penalties and folds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Widest feature vector: the matrices of all folds are held by the driver.
WIDEST = 1024


@dataclass(frozen=True)
class Moments:
    """Count, means and centred products of rows of (features, label); the label comes last."""

    count: float
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        count = self.count + other.count
        if not count:
            return self
        apart = other.mean - self.mean
        return Moments(count, self.mean + apart * (other.count / count),
                       self.products + other.products + np.outer(apart, apart) * (self.count * other.count / count))

    def errors(self, weights: np.ndarray, intercept: float) -> tuple[float, float]:
        """(mean squared error, coefficient of determination) of a linear model on these rows."""
        line = np.append(-weights, 1.0)
        squared = float(line @ self.products @ line) / self.count + (float(line @ self.mean) - intercept) ** 2
        spread = float(self.products[-1, -1]) / self.count
        return max(squared, 0.0), (1 - squared / spread if spread > 0 else float("nan"))


def fold_moments(df: DataFrame, features: str = "features", label: str = "label", fold: str = "fold") -> dict[int, Moments]:
    """The moments of each fold, in one pass; rows with a NULL label, vector or fold take no part.

    Every task sums its own rows around their own mean; what leaves it is one matrix a fold, row by row, and the
    rows of all tasks are merged by fold and row number. The driver gets one matrix a fold.
    """
    rows = df.select(F.col(fold).cast("int").alias("fold"), F.array_append(F.when(F.col(features).isNotNull(), vector_to_array(features)), F.col(label).cast("double")).alias("x"))
    rows = rows.filter(F.col("fold").isNotNull() & F.col("x").isNotNull() & F.get("x", F.size("x") - 1).isNotNull())
    schema = pa.schema([("fold", pa.int32()), ("at", pa.int32()), ("count", pa.float64()), ("mean", pa.list_(pa.float64())), ("row", pa.list_(pa.float64()))])

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Moments] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            if x.shape[1] > WIDEST + 1:
                raise ValueError(f"more than {WIDEST} features: fit the penalties one by one")
            for k in np.unique(of).tolist():
                part = x[of == k]
                mean = part.mean(axis=0)
                own = Moments(float(len(part)), mean, (part - mean).T @ (part - mean))
                found[k] = found[k] + own if k in found else own
        for k, m in found.items():
            size = len(m.mean)
            for low in range(0, size, 64):
                at = np.arange(low, min(size, low + 64), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(np.full(len(at), m.count)),
                    pa.array([m.mean] * len(at), schema.field(3).type), pa.array(list(m.products[at]), schema.field(4).type)], schema=schema)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        at = int(group["at"].iloc[0])
        count, mean, row = float(group["count"].iloc[0]), np.array(group["mean"].iloc[0]), np.array(group["row"].iloc[0])
        for n, m, r in zip(group["count"].iloc[1:], group["mean"].iloc[1:], group["row"].iloc[1:]):
            total = count + n
            apart = np.asarray(m) - mean
            row = row + np.asarray(r) + apart * (apart[at] * count * n / total)
            mean, count = mean + apart * (n / total), total
        return pd.DataFrame({"fold": [group["fold"].iloc[0]], "at": [at], "count": [count], "mean": [mean.tolist()], "row": [row.tolist()]})

    kind = "fold int, at int, count double, mean array<double>, row array<double>"
    merged = rows.mapInArrow(partial, kind).groupBy("fold", "at").applyInPandas(merge, kind)
    table: dict[int, list] = {}
    for r in merged.toLocalIterator():
        table.setdefault(r["fold"], []).append((r["at"], r["count"], r["mean"], r["row"]))
    return {k: Moments(parts[0][1], np.array(parts[0][2]), np.array([p[3] for p in parts]))
            for k, parts in ((k, sorted(p, key=lambda e: e[0])) for k, p in sorted(table.items()))}


def solve(train: Moments, alpha: float, l1_ratio: float, tolerance: float = 1e-10, rounds: int = 10_000) -> tuple[np.ndarray, float]:
    """(weights, intercept) of ``|y - Xw|^2 / 2n + alpha * (l1_ratio * |w| + (1 - l1_ratio) / 2 * |w|^2)``.

    Without an L1 part this is one linear system, else coordinate descent on the products. A feature that
    doesn't vary gets weight 0.
    """
    products, toward = train.products[:-1, :-1] / train.count, train.products[:-1, -1] / train.count
    shrink, cut = alpha * (1 - l1_ratio), alpha * l1_ratio
    own = np.diag(products)
    weights = np.zeros(len(toward))
    free = np.flatnonzero(own > 0)
    if cut == 0:
        square = products[np.ix_(free, free)] + shrink * np.eye(len(free))
        # the least-norm solution where features depend on each other and nothing is penalised
        weights[free] = np.linalg.lstsq(square, toward[free], rcond=None)[0] if shrink == 0 else np.linalg.solve(square, toward[free])
    else:
        rest = toward.copy()  # toward - products @ weights
        scale = np.sqrt(max(float(train.products[-1, -1]) / train.count, 1e-300))
        for _ in range(rounds):
            moved = 0.0
            for j in free:
                pull = rest[j] + own[j] * weights[j]
                new = np.sign(pull) * max(abs(pull) - cut, 0.0) / (own[j] + shrink)
                if new != weights[j]:
                    rest -= products[j] * (new - weights[j])
                    moved = max(moved, abs(new - weights[j]) * np.sqrt(own[j]))
                    weights[j] = new
            if moved <= tolerance * scale:
                break
    return weights, float(train.mean[-1] - weights @ train.mean[:-1])


def fold_sweep(df: DataFrame, penalties: dict[str, list[float]], features: str = "features", label: str = "label", fold: str = "fold") -> DataFrame:
    """(model, alpha, fold, rows, rmse, r2, train_rmse, train_r2): every penalty fitted without each fold and scored on it.

    ``penalties`` lists values by model: ``ridge`` means the penalty on the sum of squares, ``lasso`` the one on the
    halved mean square, as in :func:`costlake.operators.models.ridge` and :func:`~costlake.operators.models.lasso`.
    With fewer than two folds there is no training side and no row.
    """
    moments = fold_moments(df, features, label, fold)
    rows = []
    for k, held in moments.items():
        others = [m for other, m in moments.items() if other != k]
        if not others:
            continue
        train = others[0]
        for m in others[1:]:
            train = train + m
        for model, alphas in penalties.items():
            for alpha in alphas:
                if model == "ridge":
                    weights, intercept = solve(train, alpha / train.count, 0.0)
                elif model == "lasso":
                    weights, intercept = solve(train, alpha, 1.0)
                else:
                    raise ValueError(f"no such model: {model}")
                (mse, r2), (train_mse, train_r2) = held.errors(weights, intercept), train.errors(weights, intercept)
                rows.append((model, float(alpha), k, int(held.count), mse ** 0.5, r2, train_mse ** 0.5, train_r2))
    return df.sparkSession.createDataFrame(rows, "model string, alpha double, fold int, rows bigint, rmse double, r2 double, train_rmse double, train_r2 double")


def penalty_sweep(df: DataFrame, penalties: dict[str, list[float]], features: str = "features", label: str = "label", fold: str = "fold") -> DataFrame:
    """(model, alpha, rmse): the mean over the folds of the held-out error of each penalty, by :func:`fold_sweep`."""
    return fold_sweep(df, penalties, features, label, fold).groupBy("model", "alpha").agg(F.avg("rmse").alias("rmse"))
