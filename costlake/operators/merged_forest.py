"""Random forests on merged rows, for tables in which many rows share their feature vector.

Trees then grow on the unlike vectors. Every row is drawn for every tree by itself, as in any bagged forest; a vector enters a tree
with the number of its drawn rows as weight and their mean label. How labels vary within a vector is the same on either side of any
split, so the best splits of the vectors are those of the rows. Predictions are made once for each vector and joined back.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.operators.joins import lookup_join
from costlake.operators.models import random_forest
from costlake.session import settle

#: Rows for each unlike vector from which on merging them pays.
WORTH = 12
#: Unlike vectors up to which their predictions (16 bytes each) are broadcast.
MOST_BROADCAST = 2_000_000
#: Rows that are drawn for all trees at a time.
SLICE = 4000
#: Unlike vectors that make a partition worth having: a tree passes over all of them once for each level.
PART = 50_000


class MergingForest(Estimator):
    """``forest`` on merged rows where there are at least ``worth`` rows for each unlike vector, else as it is.

    Draws depend on each row's ``key`` only (rows without one are drawn by their other columns), so not on partitions.
    ``parallelism`` trees are under way at a time.
    """

    def __init__(self, forest: RandomForestRegressor | None = None, key: str = "record_id", worth: float = WORTH, parallelism: int = 8):
        super().__init__()
        self.forest, self.key, self.worth, self.parallelism = forest or random_forest(), key, worth, parallelism

    def _fit(self, dataset: DataFrame) -> Model:
        features = self.forest.getFeaturesCol()
        rows, vectors = dataset.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(features))).first()
        if self.forest.getNumTrees() == 1 or rows < self.worth * vectors:
            return self.forest.fit(dataset)
        drawn = drawn_vectors(dataset, self.key, features, self.forest.getLabelCol(), self.forest.getNumTrees(),
                              self.forest.getSubsamplingRate(), self.forest.getSeed())
        drawn = drawn.coalesce(max(dataset.sparkSession.sparkContext.defaultParallelism, vectors // PART)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            totals = drawn.agg(*[F.sum(F.get("weights", i)) for i in range(self.forest.getNumTrees())]).first()
            pool = ThreadPool(self.parallelism)
            try:
                grown = pool.map(inheritable_thread_target(dataset.sparkSession)(lambda i: self._grown(drawn, i, totals[i])), range(len(totals)), 1)
            finally:
                pool.close()
        finally:
            drawn.unpersist()
        return MergedForest(grown, features, self.forest.getPredictionCol())

    def _grown(self, drawn: DataFrame, tree: int, total: float) -> RandomForestRegressionModel:
        features, label, weight = self.forest.getFeaturesCol(), self.forest.getLabelCol(), F.get("weights", tree)
        rows = drawn.filter(weight > 0).select(features, (F.get("labels", tree) / weight).alias(label), weight.alias("weight"))
        # weights are whole numbers, so half a row less is the same limit; from half of all rows on it allows no split
        least = (self.forest.getMinInstancesPerNode() - 0.5) / total if total else 0.5
        one = self.forest.copy().setNumTrees(1).setBootstrap(False).setSubsamplingRate(1.0).setWeightCol("weight")
        one = one.setMinInstancesPerNode(1).setSeed(self.forest.getSeed() + tree)
        one = one.setMinWeightFractionPerNode(least) if least < 0.5 else one.setMaxDepth(0)
        return one.fit(rows)


class MergedForest(Model):
    """The trees of :class:`MergingForest`; they predict each unlike vector once."""

    def __init__(self, grown: list[RandomForestRegressionModel], features: str, prediction: str):
        super().__init__()
        self.grown, self.features, self.prediction = grown, features, prediction

    def setPredictionCol(self, name: str) -> MergedForest:
        self.prediction = name
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vectors, cell = unlike_vectors(dataset, self.features)
        columns = [f"__tree{i}" for i in range(len(self.grown))]
        scored = reduce(lambda df, each: each[0].copy().setPredictionCol(each[1]).transform(df), zip(self.grown, columns), vectors)
        mean = reduce(Column.__add__, map(F.col, columns)) / float(len(columns))
        known = scored.select("__cell", mean.alias(self.prediction))
        return lookup_join(dataset.withColumn("__cell", cell), known, ["__cell"], max_rows=MOST_BROADCAST).drop("__cell")


def unlike_vectors(df: DataFrame, features: str) -> tuple[DataFrame, Column]:
    """((features, __cell) of all unlike vectors, the expression that gives a row's cell): a hash under which no two of them meet."""
    vectors = settle(df.select(features).distinct())
    several = vectors.count()
    for seed in itertools.count():
        cell = F.xxhash64(F.col(features), F.lit(seed))
        if vectors.select(cell.alias("c")).distinct().count() == several:
            return vectors.withColumn("__cell", cell), cell


def drawn_vectors(df: DataFrame, key: str, features: str, label: str, trees: int, rate: float, seed: int) -> DataFrame:
    """(features, weights, labels): for each unlike vector how many of its rows are drawn for each tree, and the sum of their labels.

    A row is drawn as often as a Poisson number with mean ``rate`` says.
    """
    vectors, cell = unlike_vectors(df, features)
    rest = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    dealt = F.when(F.col(key).isNull(), F.xxhash64(*rest, F.lit(seed))).otherwise(F.xxhash64(F.col(key), F.lit(seed)))
    rows = df.select(cell.alias("__cell"), dealt.alias("__dealt"), F.col(label).cast("double").alias("__label"))
    met = rows.repartition("__cell").sortWithinPartitions("__cell").mapInArrow(_drawn(trees, rate), "__cell bigint, weights array<double>, labels array<double>")
    joined = vectors.join(met, "__cell").drop("__cell")
    return joined.withMetadata(features, df.schema[features].metadata)


def poisson_steps(rate: float) -> np.ndarray:
    """Up to which uniform number a Poisson number is at most 0, 1, 2, ..."""
    chances = [math.exp(-rate)]
    while len(chances) < rate or chances[-1] > 1e-18:
        chances.append(chances[-1] * rate / len(chances))
    return np.cumsum(chances)


def draws(dealt: np.ndarray, trees: int, steps: np.ndarray) -> np.ndarray:
    """(rows, trees): how often each row is drawn for each tree, by the hash of its key (splitmix64)."""
    x = dealt.view(np.uint64)[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    uniform = (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    return np.searchsorted(steps, uniform.reshape(-1), side="right").reshape(uniform.shape).astype(np.float64)


def _drawn(trees: int, rate: float):
    """Weights and sums of labels of each cell of (cell, dealt, label) rows, which come cell by cell."""
    steps = poisson_steps(rate)
    schema = pa.schema([("__cell", pa.int64()), ("weights", pa.list_(pa.float64())), ("labels", pa.list_(pa.float64()))])

    def record(cells: np.ndarray, weights: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
        ends = pa.array(np.arange(len(cells) + 1) * trees, pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(v).reshape(-1))) for v in (weights, labels)]
        return pa.RecordBatch.from_arrays([pa.array(cells), *lists], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the cell that may go on
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                cell, dealt, label = (c.to_numpy(zero_copy_only=False) for c in batch.slice(low, SLICE).columns)
                weight = draws(np.ascontiguousarray(dealt), trees, steps)
                starts = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1])
                cells, weights, labels = cell[starts], np.add.reduceat(weight, starts), np.add.reduceat(weight * label[:, None], starts)
                if last is not None and last[0][0] == cells[0]:
                    weights[0] += last[1][0]
                    labels[0] += last[2][0]
                elif last is not None:
                    yield record(*last)
                if len(cells) > 1:
                    yield record(cells[:-1], weights[:-1], labels[:-1])
                last = cells[-1:].copy(), weights[-1:].copy(), labels[-1:].copy()
        if last is not None:
            yield record(*last)

    return run
