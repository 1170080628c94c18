"""Grid search over random forests from few fits.

A forest of the most trees, the greatest depth and a given least leaf holds all smaller ones: fewer trees are its first
trees, a smaller depth or a greater least split cuts its trees off higher up. So one fit for each least leaf and fold is
followed by every row once, and all other combinations are read off on the way. Scores go to the run log as they
come, and a search that is started again goes on from there. Where rows share their vectors, the rows are drawn for all trees once, and
each tree of all folds grows in one task on the unlike vectors.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.operators.cells import TREE, Grower, columns_of, fits, packed, unlike_cells, unpacked
from costlake.operators.merged_forest import draws, poisson_steps
from costlake.operators.splits import dealt_by
from costlake.operators.trees import Tree, forest_trees, unnamed, with_arrays
from costlake.session import scratch_path, settle
from costlake.sources.reports import append_run, read_runs, run_rows

#: The greatest depth that Spark grows; a greater one in a grid means this one.
DEEPEST = 30
#: Nodes that are sent to the workers at a time.
MOST_NODES = 3_000_000
#: Rows for each unlike vector from which on trees grow on the vectors.
WORTH = 2
#: Rows times trees that are drawn at a time.
DRAWN = 2_000_000


@dataclass(frozen=True)
class Grid:
    """Values of each setting; every combination is scored."""

    trees: tuple[int, ...] = (50, 100, 300)
    depth: tuple[int, ...] = (10, 25, 100)
    least_split: tuple[int, ...] = (4, 8, 12)
    least_leaf: tuple[int, ...] = (1, 2, 10)

    def nested(self) -> list[tuple[int, int, int]]:
        """(trees, depth, least_split) of all combinations that one forest holds."""
        return list(itertools.product(sorted(self.trees), sorted(self.depth), sorted(self.least_split)))

    def names(self) -> list[str]:
        """How each combination is called in the log."""
        return [name(t, d, s, leaf) for leaf in self.least_leaf for t, d, s in self.nested()]


def name(trees: int, depth: int, least_split: int, least_leaf: int) -> str:
    return json.dumps({"depth": depth, "least_leaf": least_leaf, "least_split": least_split, "trees": trees})


def stopped(tree: Tree, x: np.ndarray, depths: np.ndarray, least_splits: np.ndarray) -> np.ndarray:
    """(rows, depths, least splits): what the tree predicts where it is cut off at each depth and least split."""
    node, out = np.zeros(len(x), np.int64), np.empty((len(x), len(depths), len(least_splits)))
    open_ = np.ones(out.shape, bool)
    for level in itertools.count():
        stop = ((tree.feature[node] < 0)[:, None, None] | (depths <= level)[None, :, None]
                | (tree.count[node][:, None, None] < least_splits[None, None, :])) & open_
        out = np.where(stop, tree.value[node][:, None, None], out)
        open_ &= ~stop
        going = np.flatnonzero(open_.any(axis=(1, 2)))
        if not len(going):
            return out
        at = node[going]
        node[going] = np.where(x[going, tree.feature[at]] <= tree.threshold[at], tree.left[at], tree.right[at])


def parts_of(trees: list[Tree], counts: list[int]) -> list[tuple[int, list[Tree]]]:
    """(segment, trees): the trees in order, cut where a count ends and where too many nodes would travel at once."""
    parts: list[tuple[int, list[Tree]]] = []
    for segment, (low, high) in enumerate(zip([0, *counts], counts)):
        held, nodes = [], 0
        for tree in trees[low:high]:
            if held and nodes + len(tree.feature) > MOST_NODES:
                parts.append((segment, held))
                held, nodes = [], 0
            held.append(tree)
            nodes += len(tree.feature)
        parts.append((segment, held))
    return parts


def nested_predictions(trees: list[Tree], grid: Grid, df: DataFrame, features: str = "features", out: str = "predictions") -> DataFrame:
    """``df`` with an array: the prediction of each of ``grid.nested()``, in order. NULL vectors give NULL."""
    counts, depths, splits = sorted(grid.trees), np.minimum(sorted(grid.depth), DEEPEST), np.array(sorted(grid.least_split))
    if len(trees) < counts[-1]:
        raise ValueError("the forest has fewer trees than the grid asks for")
    wide = len(depths) * len(splits)
    parts = parts_of(trees, counts)
    sc = df.sparkSession.sparkContext
    for i, (_, part) in enumerate(parts):
        shared = sc.broadcast(part)  # MOST_NODES nodes at most, or one tree

        def total(x: np.ndarray, shared=shared) -> pa.Array:
            found = sum(stopped(tree, x, depths, splits) for tree in shared.value)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * wide, pa.int32()), pa.array(found.reshape(-1)))

        df = with_arrays(df, features, T.StructField(f"__part{i}", T.ArrayType(T.DoubleType())), total)
        if i + 1 < len(parts):
            df = settle(df)
            shared.destroy()
    sums = [[F.lit(0.0)] * wide]
    for segment in range(len(counts)):
        own = [i for i, (s, _) in enumerate(parts) if s == segment]
        sums.append([sum((F.get(f"__part{i}", k) for i in own), before) for k, before in enumerate(sums[-1])])
    means = [value / float(n) for n, values in zip(counts, sums[1:]) for value in values]
    known = F.col("__part0").isNotNull()
    return df.withColumn(out, F.when(known, F.array(*means))).drop(*[f"__part{i}" for i in range(len(parts))])


def forest_scores(df: DataFrame, grid: Grid, experiment: str, log: str, features: str = "features", label: str = "label", fold: str = "fold",
                  folds: int = 5, seed: int = 0, dataset_version: str | None = None, parallelism: int = 1, key: str | None = None, **params) -> DataFrame:
    """(trees, depth, least_split, least_leaf, fold, rmse): the error on each fold of forests fitted on the others.

    ``log`` is the run log; what ``experiment`` has there already isn't fitted again. ``params`` go to the forest.
    ``parallelism`` fits are under way at a time. With a ``key``, rows that share their vectors are drawn by it and trees grow on the
    vectors (:class:`CellForests`). Depths over 30 mean 30. Rows with a NULL label, vector or fold take no part; an empty fold has no scores.
    """
    spark = df.sparkSession
    dealt = [] if key is None else [dealt_by(df, key, seed).alias("__dealt")]
    rows = unnamed(df, features).select(features, F.col(label).cast("double").alias(label), F.col(fold).cast("int").alias(fold), *dealt).dropna()
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    settings = dict(subsamplingRate=1.0, featureSubsetStrategy="all", maxBins=64, maxMemoryInMB=1024) | params
    forests = None
    try:
        done = _logged(spark, log, experiment)
        open_ = [(leaf, k) for leaf, k in itertools.product(grid.least_leaf, range(folds))
                 if not all((name(t, d, s, leaf), k) in done for t, d, s in grid.nested())]

        def errors_of(unit: tuple[int, int]) -> list[float] | None:
            leaf, k = unit
            train, held = rows.filter(F.col(fold) != k), rows.filter(F.col(fold) == k)
            if held.isEmpty() or train.isEmpty():
                return None
            forest = RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=max(grid.trees), maxDepth=min(DEEPEST, max(grid.depth)),
                                           minInstancesPerNode=leaf, seed=seed, **settings).fit(train)
            path = scratch_path(spark, "forest")
            forest.write().overwrite().save(path)
            scored = nested_predictions(forest_trees(spark.read.parquet(f"{path}/data")), grid, held, features)
            gap = lambda i: F.get("predictions", i) - F.col(label)
            return list(scored.agg(*[F.sqrt(F.avg(gap(i) * gap(i))) for i in range(len(grid.nested()))]).first())

        rounds: Iterable[tuple[list[tuple[int, int]], Callable]] = [(open_, errors_of)]
        if open_ and key is not None and max(grid.trees) > 1 and set(params) <= {"subsamplingRate", "featureSubsetStrategy", "maxBins", "maxMemoryInMB"}:
            several, vectors, one = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(features)), F.first(features)).first()
            if several and several >= WORTH * vectors and fits(int(vectors * 1.2), len(one), settings["maxBins"]):
                forests = CellForests(rows, grid, features, label, fold, folds, seed, settings)
                rounds = ((units, forests.errors_of(leaf, [k for _, k in units]))
                          for leaf, units in ((leaf, list(units)) for leaf, units in itertools.groupby(open_, key=lambda unit: unit[0])))
        pool = ThreadPool(parallelism) if parallelism > 1 else None
        # one after another into the log, which takes one writer at a time
        for (leaf, k), errors in itertools.chain.from_iterable(
                zip(units, pool.imap(inheritable_thread_target(spark)(of), units) if pool else map(of, units)) for units, of in rounds):
            if errors is not None:
                append_run(run_rows(spark, [dict(experiment=experiment, model=name(t, d, s, leaf), fold=k, n_folds=folds, rmse_cv=[e], rmse_cv_mean=e,
                                                 random_state=seed, target_variable=label, dataset_version=dataset_version)
                                            for (t, d, s), e in zip(grid.nested(), errors)]), log)
        if pool:
            pool.close()
    finally:
        if forests is not None:
            forests.close()
        rows.unpersist()
    found = read_runs(spark, log).filter((F.col("experiment") == experiment) & F.col("fold").isNotNull())
    part = lambda field: F.get_json_object("model", f"$.{field}").cast("int").alias(field)
    return found.groupBy("model", "fold").agg(F.max("rmse_cv_mean").alias("rmse")).select(
        part("trees"), part("depth"), part("least_split"), part("least_leaf"), "fold", "rmse")


class CellForests:
    """Forests of a grid search on unlike vectors: each row is drawn once for each tree, by its hash, and a tree of every fold grows in one task.

    A fold's forest is that of the draws of all other folds' rows. Errors are those of all held rows: a vector's mean label is compared
    with what is predicted for it, and how its labels vary is added.
    """

    def __init__(self, rows: DataFrame, grid: Grid, features: str, label: str, fold: str, folds: int, seed: int, settings: dict):
        self.rows, self.grid, self.features, self.fold, self.folds, self.seed = rows, grid, features, fold, folds, seed
        cells, vectors, cell = unlike_cells(rows, features, settings["maxBins"])
        self.columns = columns_of(settings["featureSubsetStrategy"], len(cells.cuts), max(grid.trees))
        sc = rows.sparkSession.sparkContext
        self.cells = sc.broadcast(cells)  # MOST_BINS bytes at most and 8 for each cell
        drawn = rows.select(cell.alias("c"), fold, "__dealt", label).repartition("c").sortWithinPartitions("c", fold)
        self.blocks = drawn.mapInArrow(_drawn_blocks(self.cells, max(grid.trees), settings["subsamplingRate"], folds), BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
        held = rows.groupBy(cell.alias("__cell"), fold).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean"), (F.var_pop(label) * F.count(F.lit(1))).alias("spread"))
        self.held = settle(vectors.select("__cell", features).join(held, "__cell").drop("__cell").repartition(4 * sc.defaultParallelism))
        self.sizes = {r[fold]: r["n"] for r in self.held.groupBy(fold).agg(F.sum("n").alias("n")).collect()}

    def errors_of(self, leaf: int, open_: list[int]) -> Callable[[tuple[int, int]], list[float] | None]:
        """What gives the errors of a (least leaf, fold); the forests of all open folds are grown before."""
        trees, depth = max(self.grid.trees), min(DEEPEST, max(self.grid.depth))
        grown = self.blocks.repartitionById(trees, "tree").mapInArrow(
            _grown(self.cells, open_, self.folds, depth, leaf, self.columns, self.seed), f"tree int, fold int, {TREE}")
        grown = settle(grown)

        def errors(unit: tuple[int, int]) -> list[float] | None:
            k = unit[1]
            if not self.sizes.get(k) or self.sizes[k] == sum(self.sizes.values()):
                return None
            forest = [unpacked(r) for r in grown.filter(F.col("fold") == k).toArrow().sort_by("tree").to_pylist()]
            scored = nested_predictions(forest, self.grid, self.held.filter(F.col(self.fold) == k), self.features)
            gap = lambda i: F.get("predictions", i) - F.col("mean")
            return list(scored.agg(*[F.sqrt(F.sum(F.col("n") * gap(i) * gap(i) + F.col("spread")) / F.sum("n")) for i in range(len(self.grid.nested()))]).first())

        return errors

    def close(self) -> None:
        self.blocks.unpersist()
        self.cells.destroy()


#: Drawn rows of a tree: (cell, fold) in one number, how often its rows are drawn, and the sum of their labels.
BLOCK = "tree int, place binary, weight binary, total binary"


def _drawn_blocks(cells, trees: int, rate: float, folds: int):
    """Blocks of (cell, fold, dealt, label) rows. Folds that are never held are one, the last."""
    steps = poisson_steps(rate)
    schema = pa.schema([("tree", pa.int32()), ("place", pa.binary()), ("weight", pa.binary()), ("total", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, DRAWN // trees)
            for low in range(0, batch.num_rows, step):
                cell, fold, dealt, label = (c.to_numpy() for c in batch.slice(low, step).columns)
                place = np.searchsorted(cells.value.names, cell) * (folds + 1) + np.where((fold >= 0) & (fold < folds), fold, folds)
                starts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
                weight = draws(np.ascontiguousarray(dealt), trees, steps)
                total = np.add.reduceat(weight * label[:, None], starts).T
                weight, place = np.add.reduceat(weight, starts).T, place[starts]
                some = [np.flatnonzero(w) for w in weight]
                columns = [[c.tobytes() for c in of] for of in ([place[at] for at in some], [w[at] for w, at in zip(weight, some)], [t[at] for t, at in zip(total, some)])]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees, dtype=np.int32)), *(pa.array(c, pa.binary()) for c in columns)], schema=schema)

    return run


def _grown(cells, open_: list[int], folds: int, depth: int, leaf: int, columns: int, seed: int):
    """The trees of the blocks that a task has, one for each open fold."""
    schema = pa.schema([("tree", pa.int32()), ("fold", pa.int32()), *((c.split()[0], pa.binary()) for c in TREE.split(", "))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        size = len(cells.value.names) * (folds + 1)
        for batch in batches:
            for tree, place, weight, total in zip(*(batch.column(i).to_pylist() for i in range(4))):
                sums = held.setdefault(tree, (np.zeros(size), np.zeros(size)))
                at = np.frombuffer(place, np.int64)
                for own, values in zip(sums, (weight, total)):
                    np.add.at(own, at, np.frombuffer(values, np.float64))
        grower = Grower(cells.value) if held else None
        for tree, sums in sorted(held.items()):
            by_fold = [own.reshape(-1, folds + 1) for own in sums]
            for k in open_:
                weight, total = (np.delete(own, k, axis=1).sum(axis=1) for own in by_fold)
                found, _ = grower.grow(weight, total, depth, leaf, columns, np.random.default_rng([seed % 2**32, tree, k]))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, [tree, k, *packed(found)]))], schema=schema)

    return run


def _logged(spark, log: str, experiment: str) -> set[tuple[str, int]]:
    """(model, fold) that the log has; a grid's worth, so the driver can hold them."""
    try:
        rows = read_runs(spark, log)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {(r["model"], r["fold"]) for r in rows.filter((F.col("experiment") == experiment) & F.col("fold").isNotNull()).select("model", "fold").collect()}


def best_combination(scores: DataFrame) -> DataFrame:
    """The combination with the least mean error over the folds, as one row; ties go to the smaller settings."""
    keys = ["trees", "depth", "least_split", "least_leaf"]
    mean = scores.groupBy(*keys).agg(F.avg("rmse").alias("rmse"), F.count("*").alias("folds"))
    return mean.orderBy("rmse", *keys).limit(1)
