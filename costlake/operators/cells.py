"""Trees grown inside tasks, on the unlike feature vectors of a table and the bins of their values.

Rows that share their vector end in the same leaf of any tree, so a tree needs of them only how many there are and the sum
of what it is fitted to. A vector with its bins (a byte for each feature) is a cell. Cells up to a fixed size travel to a task, which
grows whole trees level by level without a Spark job for each; larger tables are left to the fits of ``pyspark.ml``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.operators.trees import Tree
from costlake.session import settle

#: Bytes of the bins of all cells up to which they travel to a task.
MOST_BINS = 100_000_000
#: Entries (nodes of a level times bins) that are looked at together for a split.
ENTRIES = 4_000_000
#: Cells that are looked at together.
SLICE = 500_000
#: How a tree is sent home.
TREE = "feature binary, threshold binary, left binary, right binary, value binary, count binary"
_KINDS = {"feature": np.int64, "threshold": np.float64, "left": np.int64, "right": np.int64, "value": np.float64, "count": np.float64}


@dataclass(frozen=True)
class Cells:
    """The unlike vectors of a table: their names, sorted, the bin of each of their values, and where the bins of a feature part."""

    names: np.ndarray
    bins: np.ndarray
    cuts: list[np.ndarray]


def fits(vectors: int, features: int, most_bins: int) -> bool:
    """Whether so many cells may travel to a task: a byte for each value."""
    return most_bins <= 256 and vectors * features <= MOST_BINS


def unlike_cells(df: DataFrame, features: str, most_bins: int) -> tuple[Cells, DataFrame, Column]:
    """(cells, their table (features, rows, __cell), the expression that names a row's cell) of rows whose vectors are known."""
    vectors = settle(df.groupBy(F.col(features).alias(features, metadata={})).agg(F.count(F.lit(1)).alias("rows")))
    several = vectors.count()
    for seed in itertools.count():
        cell = F.xxhash64(F.col(features), F.lit(seed))
        vectors = vectors.withColumn("__cell", cell)
        if vectors.select("__cell").distinct().count() == several:
            break
    flat = vectors.select("__cell", "rows", vector_to_array(features).alias("x"))
    counted = flat.select("rows", "x").mapInArrow(_values, "feature int, value double, n bigint").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    table = counted.orderBy("feature", "value").toArrow()
    of, value, n = (table.column(c).to_numpy() for c in ("feature", "value", "n"))
    width = int(of[-1]) + 1 if len(of) else 0
    cuts = [parting(value[of == f], n[of == f], most_bins) for f in range(width)]

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), batch.num_rows)
            made = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8) if width else np.zeros((len(x), 0), np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in made], pa.binary())], names=["c", "b"])

    home = flat.select("__cell", "x").mapInArrow(binned, "c bigint, b binary").toArrow()
    names = home.column("c").to_numpy()
    bins = np.frombuffer(b"".join(home.column("b").to_pylist()), np.uint8).reshape(len(names), width)
    order = np.argsort(names)
    return Cells(names[order], bins[order], cuts), vectors, cell


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, value, n) of (rows, x): how many rows have which value."""
    for batch in batches:
        x, weight = _matrix(batch.column(1), batch.num_rows), batch.column(0).to_numpy()
        for f in range(x.shape[1]):
            values, at = np.unique(x[:, f], return_inverse=True)
            n = np.bincount(at, weight, len(values)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), f, np.int32)), pa.array(values), pa.array(n)], names=["feature", "value", "n"])


def parting(values: np.ndarray, n: np.ndarray, most_bins: int) -> np.ndarray:
    """Thresholds between the sorted values that n rows each have: all of them, or those nearest to equal shares of the rows.

    A value belongs to the left side where it is at most the threshold; NaN belongs to no left side.
    """
    known = ~np.isnan(values)
    values, n = values[known], n[known]
    at = np.arange(len(values) - 1)
    if len(values) > most_bins:
        at = np.unique(np.searchsorted(np.cumsum(n), n.sum() * np.arange(1, most_bins) / most_bins))
        at = at[at < len(values) - 1]
    low, high = values[at], values[at + 1]
    with np.errstate(invalid="ignore", over="ignore"):
        middle = low / 2 + high / 2
    return np.where((low <= middle) & (middle < high) & np.isfinite(middle), middle, low)


class Grower:
    """Grows trees on cells. Of each feature the bin of most cells isn't listed: its rows are those of a node that no listed bin has."""

    def __init__(self, cells: Cells):
        self.bins, self.cuts = cells.bins, cells.cuts
        counts = np.array([len(c) + 1 for c in cells.cuts], np.int64)
        self.starts = np.cumsum(counts) - counts
        self.slots = int(counts.sum())
        self.feature = np.repeat(np.arange(len(counts)), counts)
        usual = np.array([np.bincount(self.bins[:, f], minlength=1).argmax() for f in range(len(counts))], np.int64)
        self.usual = self.starts + usual
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))]
        for low in range(0, len(self.bins), SLICE):
            part = self.bins[low:low + SLICE]
            row, of = np.nonzero(part != usual)
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            parts.append((row + low, nth.astype(np.int32), (self.starts[of] + part[row, of]).astype(np.int32)))
        row, nth, slot = (np.concatenate(p) for p in zip(*parts))
        #: the listed slots of each cell, filled up with one that is none
        self.listed = np.full((len(self.bins), int(nth.max(initial=-1)) + 1), self.slots, np.int32)
        self.listed[row, nth] = slot

    def grow(self, weight: np.ndarray, total: np.ndarray, depth: int, least: float, columns: int, rng: np.random.Generator) -> tuple[Tree, np.ndarray]:
        """(tree, the leaf of each cell) of a tree that is fitted to the means total / weight, with their weights.

        A node is split where that lessens the squared error most, among ``columns`` features drawn for it and with weights of ``least`` on either side.
        """
        grown, noise = float(weight.sum()), 1e-15 * float(np.abs(total).sum())
        own, sums, made = np.array([grown]), np.array([float(total.sum())]), 1
        levels = [(np.array([-1]), np.zeros(1), np.array([-1]), np.array([-1]), sums / own if grown else np.zeros(1), own.copy())]
        node = np.zeros(len(weight), np.int32)
        place = np.zeros(len(weight), np.int32)  # a cell's node among those that may be split, or -1
        here = np.zeros(1, np.int64)
        before = None  # what is known of the level above: histograms, the node above each node, and which of two has fewer cells
        for level in range(depth):
            if not len(here) or not self.slots:
                break
            allowed = None
            if columns < len(self.starts):
                draw = rng.random((len(own), len(self.starts)))
                allowed = draw <= np.partition(draw, columns - 1, axis=1)[:, columns - 1:columns]
            step, found, held = max(1, ENTRIES // self.slots), [], None
            if len(own) <= step:
                held = self._histograms(place, len(own), weight, total, own, sums, before)
                found.append(self._best(*held, own, sums, least, allowed, noise))
            else:
                for low in range(0, len(own), step):
                    some = slice(low, low + step)
                    inside = np.where((place >= low) & (place < low + step), place - low, -1)
                    part = self._histograms(inside, len(own[some]), weight, total, own[some], sums[some], None)
                    found.append(self._best(*part, own[some], sums[some], least, allowed if allowed is None else allowed[some], noise))
            split, at, left_weight, left_sum = (np.concatenate(c) for c in zip(*found))
            which = np.flatnonzero(split)
            if not len(which):
                break
            at, left_weight, left_sum = at[which], left_weight[which], left_sum[which]
            child_weight = np.stack([left_weight, own[which] - left_weight], axis=1).reshape(-1)
            child_sum = np.stack([left_sum, sums[which] - left_sum], axis=1).reshape(-1)
            feature = self.feature[at]
            bin_ = at - self.starts[feature]
            children = made + np.arange(2 * len(which))
            above = levels[-1]
            spot = here[which] - (made - len(above[0]))
            above[0][spot], above[2][spot], above[3][spot] = feature, children[::2], children[1::2]
            above[1][spot] = [self.cuts[f][b] for f, b in zip(feature.tolist(), bin_.tolist())]
            none = np.full(len(children), -1)
            levels.append((none, np.zeros(len(none)), none.copy(), none.copy(), child_sum / child_weight, child_weight))
            # cells go to the children of their nodes
            order = np.full(len(here), -1, np.int32)
            order[which] = np.arange(len(which))
            moving = np.flatnonzero(place >= 0)
            to = order[place[moving]]
            if len(which) < len(here):
                place[moving[to < 0]] = -1
                moving, to = moving[to >= 0], to[to >= 0]
            flat = moving * self.bins.shape[1]
            flat += feature[to]
            child = 2 * to
            child += self.bins.reshape(-1)[flat] > bin_.astype(np.uint8)[to]
            node[moving] = child + np.int32(made)
            may = child_weight >= 2 * least
            place[moving] = np.where(may, np.cumsum(may) - 1, -1).astype(np.int32)[child]
            if held is not None:
                several = np.bincount(child, minlength=len(children)).reshape(-1, 2)
                fewer = np.zeros(several.shape, bool)
                fewer[np.arange(len(several)), several.argmin(axis=1)] = True
                both = may.reshape(-1, 2).all(axis=1)  # else there's nothing to be saved
                fewer[~both] = True
                before = (held, np.repeat(which, 2)[may], fewer.reshape(-1)[may])
            else:
                before = None
            here, own, sums = children[may], child_weight[may], child_sum[may]
            made += len(children)
        return Tree(*(np.concatenate(c).astype(k) for c, k in zip(zip(*levels), _KINDS.values()))), node

    def _histograms(self, place, several, weight, total, own, sums, before) -> list[np.ndarray]:
        """Weights and sums (nodes, slots) of the nodes; of two with one node above only that of fewer cells is counted, the other is what is left."""
        counted = np.arange(several) if before is None else np.flatnonzero(before[2])
        which = np.full(several + 1, -1, np.int32)  # the last is for cells without a node
        which[counted] = np.arange(len(counted))
        wide = self.slots + 1
        found = [np.zeros(len(counted) * wide) for _ in range(2)]
        for low in range(0, len(place), SLICE):
            to = which[place[low:low + SLICE]]
            cells = np.flatnonzero(to >= 0)
            key = self.listed[cells + low] + (to[cells].astype(np.int64) * wide)[:, None]
            for held, values in zip(found, (weight, total)):
                held += np.bincount(key.reshape(-1), np.repeat(values[cells + low], key.shape[1]), len(held))
        made = []
        for i, (held, all_) in enumerate(zip(found, (own, sums))):
            held = np.ascontiguousarray(held.reshape(-1, wide)[:, :-1])
            held[:, self.usual] = all_[counted, None] - np.add.reduceat(held, self.starts, axis=1)
            if before is None:
                made.append(held)
                continue
            of, rest = np.zeros((several, self.slots)), np.flatnonzero(~before[2])
            of[counted] = held
            # its sibling is next to it
            beside = np.where((rest > 0) & (before[1][rest - 1] == before[1][rest]), rest - 1, rest + 1)
            of[rest] = before[0][i][before[1][rest]] - of[beside]
            made.append(of)
        return made

    def _best(self, w, s, own, sums, least, allowed, noise) -> tuple[np.ndarray, ...]:
        """(whether it is split, at which slot, weight and sum on the left side) for each node."""
        lefts = []
        for held in (w, s):
            run = np.cumsum(held, axis=1)
            lefts.append(run - (run[:, self.starts] - held[:, self.starts])[:, self.feature])
        lw, ls = lefts
        rw, rs = own[:, None] - lw, sums[:, None] - ls
        fit = (lw >= least) & (rw >= least)
        if allowed is not None:
            fit &= allowed[:, self.feature]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fit, ls * ls / lw + rs * rs / rw, -np.inf)
        best = gain.argmax(axis=1)
        each = np.arange(len(own))
        mean = np.abs(sums) / np.maximum(own, 1e-300)
        return gain[each, best] - mean * np.abs(sums) > 1e-12 * mean * np.abs(sums) + noise * mean, best, lw[each, best], ls[each, best]


def columns_of(strategy: str, width: int, trees: int) -> int:
    """How many of so many features are drawn for a node, as ``featureSubsetStrategy`` of ``pyspark.ml`` says."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": width, "onethird": np.ceil(width / 3), "sqrt": np.ceil(np.sqrt(width)), "log2": max(1, np.ceil(np.log2(max(width, 1))))}
    if strategy in named:
        return int(named[strategy])
    whole = strategy.isdigit()
    return max(1, min(width, int(strategy) if whole else int(np.ceil(float(strategy) * width))))


def packed(tree: Tree) -> list[bytes]:
    """A tree as the values of ``TREE``."""
    return [np.ascontiguousarray(getattr(tree, c), k).tobytes() for c, k in _KINDS.items()]


def unpacked(row: dict[str, bytes]) -> Tree:
    return Tree(*(np.frombuffer(row[c], k) for c, k in _KINDS.items()))
