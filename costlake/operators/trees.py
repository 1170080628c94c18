"""Regression trees as plain arrays: read from fitted models, and followed by many rows at once."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that follow a tree at a time.
SLICE = 2000


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder: a row goes left where its feature is at most the threshold; leaves have feature -1.

    ``value`` is what a node predicts if a row stops there, ``count`` the (weighted) training rows of a node.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    count: np.ndarray

    def with_leaf_values(self, values: np.ndarray) -> Tree:
        """The same tree with other predictions, leaf by leaf in preorder."""
        changed = self.value.copy()
        changed[self.feature < 0] = values
        return Tree(self.feature, self.threshold, self.left, self.right, changed, self.count)

    def expression(self, x: Column, node: int = 0) -> Column:
        """What the tree predicts for the array ``x``; NaN goes right, as in :meth:`leaves`."""
        if self.feature[node] < 0:
            return F.lit(float(self.value[node]))
        low, high = self.expression(x, int(self.left[node])), self.expression(x, int(self.right[node]))
        return F.when(x[int(self.feature[node])] <= float(self.threshold[node]), low).otherwise(high)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row of ``x`` ends in."""
        node = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(self.feature[node] >= 0)).size:
            at = node[inner]
            node[inner] = np.where(x[inner, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return node


def unnamed(df: DataFrame, features: str = "features") -> DataFrame:
    """``df`` with a feature vector without slot descriptions, so that trees compare every slot with thresholds."""
    return df.withColumn(features, F.col(features).alias(features, metadata={}))


def from_debug_string(text: str) -> Tree:
    """A tree from the ``toDebugString`` of a fitted tree whose features are all continuous."""
    feature, threshold, value, right = [], [], [], []
    waiting = []  # inner nodes whose right side is yet to come
    for line in text.splitlines():
        line = line.strip()
        if line.startswith("Else"):
            right[waiting.pop()] = len(feature)
        elif line.startswith("If"):
            found = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line)
            if found is None:
                raise ValueError(f"not a threshold: {line}")
            waiting.append(len(feature))
            feature.append(int(found[1]))
            threshold.append(float(found[2]))
            value.append(float("nan"))
            right.append(-1)
        elif line.startswith("Predict:"):
            feature.append(-1)
            threshold.append(0.0)
            value.append(float(line.removeprefix("Predict:")))
            right.append(-1)
    number = np.arange(len(feature))
    kind = np.array(feature)
    return Tree(kind, np.array(threshold), np.where(kind >= 0, number + 1, -1), np.array(right), np.array(value), np.zeros(len(feature)))


def forest_trees(saved: DataFrame) -> list[Tree]:
    """The trees of a saved forest, in order, from its node table (treeID, nodeData).

    Node ids count in preorder. Features have to be continuous, see :func:`unnamed`.
    """
    node = F.col("nodeData")
    rows = saved.select("treeID", node["id"].alias("id"), node["prediction"].alias("value"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
                        node["impurityStats"][0].alias("count"), node["split"]["featureIndex"].alias("feature"),
                        node["split"]["numCategories"].alias("kinds"), F.get(node["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"))
    table = rows.orderBy("treeID", "id").toArrow()
    if any(k not in (None, -1) for k in table.column("kinds").unique().to_pylist()):
        raise ValueError("a tree has a categorical split; remove the slot descriptions of the features")
    at = {c: table.column(c).to_numpy() for c in table.column_names}
    starts = np.append(np.flatnonzero(np.diff(at["treeID"], prepend=-1)), len(at["treeID"]))
    made = []
    for a, b in zip(starts[:-1], starts[1:]):
        inner = at["left"][a:b] >= 0
        made.append(Tree(np.where(inner, at["feature"][a:b], -1).astype(np.int64), np.where(inner, np.nan_to_num(at["threshold"][a:b].astype(float)), 0.0),
                         at["left"][a:b].astype(np.int64), at["right"][a:b].astype(np.int64), at["value"][a:b], at["count"][a:b]))
    return made


def summed(trees: list[Tree], start: float, rate: float, x: np.ndarray) -> np.ndarray:
    """``start + rate * (what the trees predict, summed)`` for each row of ``x``."""
    out = np.full(len(x), start)
    for tree in trees:
        out += rate * tree.value[tree.leaves(x)]
    return out


def with_arrays(df: DataFrame, features: str, out: T.StructField, compute) -> DataFrame:
    """``df`` with a column ``out`` that ``compute(matrix of features)`` gives as an Arrow array; NULL vectors give NULL."""
    schema = T.StructType([*df.schema, out])
    at = len(df.columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                x = part.column(at)
                known = np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False))
                found = compute(x.flatten().to_numpy(zero_copy_only=False).reshape(len(known), -1)) if len(known) else None
                place = np.full(part.num_rows, -1)
                place[known] = np.arange(len(known))
                column = pa.nulls(part.num_rows, _arrow(out.dataType)) if found is None else found.take(pa.array(place, mask=place < 0))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], column], names=[*part.schema.names[:at], out.name])

    return df.withColumn("__features", F.when(F.col(features).isNotNull(), vector_to_array(features))).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
