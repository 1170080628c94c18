"""Hard negatives by exact inner-product search with coordinate pruning in length buckets.

Rows are dealt into chunks, and a chunk is laid out in buckets of descending vector length. Each bucket keeps, for
every coordinate of its unit vectors, the sorted list of values. An anchor that needs a score of at least t from a
bucket needs a cosine of at least c = t / (its length * the bucket's greatest length). With c > 1 the bucket is
skipped; else the angle to the anchor is at most arccos(c), so in each coordinate f the value has to lie in
[cos(a + arccos c), cos(a - arccos c)], a being the anchor's own angle to axis f. The ranges of the few
coordinates in which the anchor is largest (its focus) are cut out of the sorted lists, the candidates are what all of
them share, and their inner products are computed in whole numbers. The bar t rises as results come in.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import record, stow

#: Components that a chunk of rows and a block of anchors hold, roughly; rows of a bucket; blocks that one task compares with a chunk.
CHUNK_CELLS, BLOCK_CELLS, BUCKET, BLOCKS_A_TASK = 1 << 19, 1 << 15, 512, 16
#: Coordinates whose lists are searched for an anchor.
FOCUS = 4
#: Whole-number components are held within this; inner products beyond a long become the nearest long.
MOST = 1 << 62
#: Bars that every score passes.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
#: What a cosine may be off by rounding, angles included.
SLACK = 1e-7


@dataclass
class Bucket:
    """Rows of similar length: their vectors, and each coordinate's values in order with every row's rank in them."""

    ids: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    whole: np.ndarray
    longest: float
    lists: np.ndarray
    ranks: np.ndarray


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of whole-number rows, exact wherever they fit a long."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 2 ** 62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), LOWEST, HIGHEST).astype(np.int64)


def buckets(ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, whole: np.ndarray, size: int = BUCKET) -> list[Bucket]:
    """A chunk's buckets, longest vectors first."""
    length = np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    made = []
    for low in range(0, len(order), size):
        rows = order[low:low + size]
        unit = whole[rows] / np.maximum(length[rows], 1e-300)[:, None]
        by = np.argsort(unit, axis=0, kind="stable")
        ranks = np.empty(by.shape, np.uint16)
        np.put_along_axis(ranks, by, np.arange(len(rows), dtype=np.uint16)[:, None], axis=0)
        made.append(Bucket(ids[rows], keys[rows], labels[rows], whole[rows], float(length[rows[0]]) if len(rows) else 0.0,
                           np.take_along_axis(unit, by, axis=0).T.copy(), ranks.T.copy()))
    return made


def candidates(unit: np.ndarray, focus: np.ndarray, least_cosine: np.ndarray, bucket: Bucket) -> np.ndarray:
    """Which rows of a bucket can reach each anchor's least cosine: those in the feasible range of all its focus coordinates."""
    spread = np.arccos(np.clip(least_cosine, -1, 1))
    shared = np.ones((len(unit), len(bucket.ids)), bool)
    for k in range(focus.shape[1]):
        f = focus[:, k]
        angle = np.arccos(np.clip(unit[np.arange(len(unit)), f], -1, 1))
        low = np.cos(np.minimum(np.pi, angle + spread)) - SLACK
        high = np.cos(np.maximum(0, angle - spread)) + SLACK
        for axis in np.unique(f):
            of = np.flatnonzero(f == axis)
            first = np.searchsorted(bucket.lists[axis], low[of], "left")
            last = np.searchsorted(bucket.lists[axis], high[of], "right")
            rank = bucket.ranks[axis][None, :]
            shared[of] &= (rank >= first[:, None]) & (rank < last[:, None])
    return shared


class Search:
    """The best rows so far for each anchor of a block, in each of its score bands."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, whole: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.keys, self.labels, self.whole, self.low, self.high, self.k, self.same = keys, labels, whole, low, high, k, same
        self.length = np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1))
        self.unit = whole / np.maximum(self.length, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        self.bar = low.copy()  # (anchors, bands): a row has to score at least this to count
        none = np.zeros(0, np.int64)
        self.found = [(none, none, none, none)] * low.shape[1]  # per band: anchor, score, id, key

    def add(self, bucket: Bucket) -> None:
        """Take the rows of a bucket into account."""
        wanted = self.bar <= self.high
        bar = np.where(wanted, self.bar, HIGHEST).min(axis=1).astype(np.float64)
        reach = self.length * bucket.longest
        # below zero, shorter vectors may be at wider angles, so every angle will do
        least = np.where(bar < 0, -1.0, np.where(reach > 0, bar / np.maximum(reach, 1e-300), np.where(bar > 0, 2.0, 0.0)))
        open_ = np.flatnonzero(wanted.any(axis=1) & (least <= 1 + SLACK))
        if not len(open_):
            return
        fit = candidates(self.unit[open_], self.focus[open_], least[open_] - SLACK, bucket)
        alike = self.labels[open_, None] == bucket.labels[None, :]
        fit &= (alike & (self.keys[open_, None] != bucket.keys[None, :])) if self.same else ~alike
        used = np.flatnonzero(fit.any(axis=1))
        if not len(used):
            return
        rows, fit = open_[used], fit[used]
        scores = inner(self.whole[rows], bucket.whole)
        for band in range(self.low.shape[1]):
            a, b = np.nonzero(fit & (scores >= self.bar[rows, band, None]) & (scores <= self.high[rows, band, None]))
            if len(a):
                self.take(band, rows[a], scores[a, b], bucket.ids[b], bucket.keys[b])

    def take(self, band: int, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        """Keep each anchor's first ``k`` by score, then id, and raise its bar to the score of the last of them."""
        anchor, score, ids, keys = (np.concatenate([x, y]) for x, y in zip(self.found[band], (anchor, score, ids, keys)))
        order = np.lexsort((keys, ids, ~score, anchor))
        anchor, score, ids, keys = anchor[order], score[order], ids[order], keys[order]
        start = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        place = np.arange(len(anchor)) - np.repeat(start, np.diff(np.append(start, len(anchor))))
        kept = place < self.k
        self.found[band] = (anchor[kept], score[kept], ids[kept], keys[kept])
        last = place == self.k - 1
        self.bar[anchor[last], band] = np.maximum(self.bar[anchor[last], band], score[last])


def best_in_bands(index: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(key, band, rank, id, other, score): for each anchor and band the first ``k`` rows of the index by score, then id.

    ``index`` is (id, key, label, dims, whole), ``anchors`` (key, label, dims, whole, bands) with bands an array of
    (low, high). With ``same`` the rows bear the anchor's label and aren't itself, else they bear another. Rows are
    dealt into chunks by hash and anchors into blocks; every block visits every chunk, a task holds one of each at a
    time, and a chunk is repeated where very many blocks visit it. A visit gives at most ``k`` rows an anchor and
    band, and Spark takes the best of them.
    """
    n_chunks, n_blocks = parts(index, CHUNK_CELLS), parts(anchors, BLOCK_CELLS)
    turns = -(-n_blocks // BLOCKS_A_TASK)
    block = F.pmod(F.xxhash64("key", F.lit(7)), F.lit(n_blocks)).cast("int")
    asked = anchors.select("dims", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"), F.pmod(block, F.lit(turns)).alias("turn"),
                           block.alias("block"), F.col("key").alias("id"), "key", "label", "whole", "bands")
    held = index.select("dims", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(n_chunks)).cast("int").alias("chunk"),
                        F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"), F.lit(-1).alias("block"),
                        "id", "key", "label", "whole", F.lit(None).cast("array<struct<low:bigint,high:bigint>>").alias("bands"))
    at = ["dims", "chunk", "turn"]
    both = held.unionByName(asked).repartition(*at).sortWithinPartitions(*at, "block", "key")
    schema = pa.schema([("key", pa.int64()), ("band", pa.int32()), ("id", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, layout = None, []
        for place, part in whole_groups(batches, 4):
            ids, keys, labels = (part.column(c).to_numpy() for c in ("id", "key", "label"))
            whole = matrix(part.column("whole").combine_chunks(), place[0])
            if place[3] == -1:
                where, layout = place[:3], buckets(ids, keys, labels, whole)
                continue
            if where != place[:3]:
                continue  # anchors without a chunk of rows
            bands = part.column("bands").combine_chunks()
            limits = bands.flatten()
            count = len(limits) // max(1, len(bands))
            low, high = (limits.field(i).to_numpy(zero_copy_only=False).reshape(-1, count).astype(np.int64) for i in (0, 1))
            search = Search(keys, labels, whole, low, high, k, same)
            for bucket in layout:
                search.add(bucket)
            for band, (anchor, score, found, other) in enumerate(search.found):
                yield record(schema, keys[anchor], np.full(len(anchor), band, np.int32), found, other, score)

    hits = both.mapInArrow(run, "key bigint, band int, id bigint, other bigint, score bigint")
    first = Window.partitionBy("key", "band").orderBy(F.desc("score"), "id", "other")
    return hits.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def parts(rows: DataFrame, cells: int) -> int:
    """How many parts of about so many components the rows make, one at least."""
    return max(1, -(-(rows.agg(F.sum("dims")).first()[0] or 0) // cells))


def matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """The rows of a list column as a matrix of longs."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), dims)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """(key values, rows) of complete groups of a partition that is sorted by its first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        cuts = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:]):
            key = tuple(columns[:, low].tolist())
            if held and key != now:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(low, high - low))
    if held:
        yield now, pa.Table.from_batches(held)


def mine(vectors: DataFrame, positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90), every: int = 100, scale: int = 256,
         id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of each anchor's positives.

    A vector's components become ``floor(scale * x)``, and scores are their inner products. Anchors are the rows whose
    id is divisible by ``every``; their positives the first ``positives`` rows of the same label, their negatives for
    each positive the first ``negatives`` rows of another label that score from ``band[0]`` to ``band[1]`` percent of
    the positive's score. Higher scores come first, ties by the smaller id. A row without id, label or vector, or with
    a component that is NULL or not finite, takes no part; rows with different numbers of components never meet.
    Rows that are the same in id, label and vector are one row; rows that share only the id are different rows, of which an
    anchor's own is the one with its vector. Labels that aren't integers are told apart by a 64-bit hash. Components are held within 2^62 and scores within a long. An anchor whose
    positive has no negative gives no row for it. Extra columns are left behind.
    """
    if not (positives > 0 and negatives > 0 and every > 0):
        raise ValueError("counts have to be positive")
    values = F.col(vector_col).cast("array<double>")
    fit = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
           & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    held = lambda x: F.floor(F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), x * scale))).cast("long")
    label = F.col(label_col).cast("long") if isinstance(vectors.schema[label_col].dataType, T.IntegralType) else F.xxhash64(label_col)
    rows = vectors.filter(fit).select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.transform(values, held).alias("whole"))
    rows = rows.withColumns({"dims": F.size("whole"), "key": F.xxhash64("id", "label", "whole")}).dropDuplicates(["id", "key"])
    index = stow(rows, "negatives-index")
    anchors = index.filter(F.col("id") % every == 0).select("id", "key", "label", "dims", "whole")

    everything = F.array(F.struct(F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")))
    near = best_in_bands(index, anchors.withColumn("bands", everything), positives, True)
    least = F.ceil(F.col("score").cast("decimal(38,0)") * band[0] / 100).cast("long")
    most = F.floor(F.col("score").cast("decimal(38,0)") * band[1] / 100).cast("long")
    pairs = near.select("key", F.struct(F.col("rank"), least.alias("low"), most.alias("high"), F.col("id").alias("positive_id"),
                                        F.col("score").alias("positive_score")).alias("pair"))
    listed = stow(anchors.join(pairs.groupBy("key").agg(F.sort_array(F.collect_list("pair")).alias("pairs")), "key"), "negatives-positives")
    # every anchor has as many bands; one that can't be filled is empty
    empty = F.struct(F.lit(1).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    bands = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.when(
        i <= F.size("pairs"), F.struct(F.get("pairs", i - 1)["low"].alias("low"), F.get("pairs", i - 1)["high"].alias("high"))).otherwise(empty))
    far = best_in_bands(index, listed.select("key", "label", "dims", "whole", bands.alias("bands")), negatives, False)
    named = listed.select("key", F.col("id").alias("anchor_id"), F.posexplode("pairs").alias("band", "pair"))
    return far.withColumnRenamed("id", "negative_id").join(named, ["key", "band"]).select(
        "anchor_id", F.col("pair.positive_id").alias("positive_id"), "rank", "negative_id",
        F.col("pair.positive_score").alias("positive_score"), F.col("score").alias("negative_score"))
