"""Embedding near-dedup by collision counting over sorted one-dimensional projections.

Unit vectors are projected on random directions. For a query vector a projection's window is all values
within a half-width of its own; another vector collides where its value is inside. Values are sorted, so a
window is a range of ranks and a collision one comparison of ranks. Pairs with enough collisions are verified by
their cosine in double precision. Half-width and count follow from the wanted recall at the threshold itself;
closer pairs collide more often.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import components, forest, stow

PROJECTIONS = 24
#: Half-width of a window, in deviations of the difference that a pair at the threshold has.
HALF_WIDTH = 2.0
#: Chance that a pair at the threshold is found.
RECALL = 0.99999
#: Vectors of a block; two blocks meet in one task.
BLOCK = 2048


def calibrate(projections: int = PROJECTIONS, half_width: float = HALF_WIDTH, recall: float = RECALL) -> int:
    """The largest count of collisions that a pair at the threshold reaches with the wanted chance."""
    hit = math.erf(half_width / math.sqrt(2))
    chance, needed = 0.0, projections + 1
    while chance < recall and needed > 0:
        needed -= 1
        chance += math.comb(projections, needed) * hit ** needed * (1 - hit) ** (projections - needed)
    return needed


def collisions(queries: np.ndarray, values: np.ndarray, half_width: float) -> np.ndarray:
    """How many columns of each row of ``values`` lie in the window around each row of ``queries``."""
    counts = np.zeros((len(queries), len(values)), np.uint8)
    for p in range(queries.shape[1]):
        order = np.argsort(values[:, p], kind="stable")
        line = values[order, p]
        rank = np.empty(len(order), np.uint16)
        rank[order] = np.arange(len(order), dtype=np.uint16)
        low = np.searchsorted(line, queries[:, p] - half_width, "left").astype(np.uint16)
        wide = np.searchsorted(line, queries[:, p] + half_width, "right").astype(np.uint16) - low
        for at in range(0, len(queries), 64):  # a strip stays in the cache
            part = slice(at, at + 64)
            counts[part] += (rank[None, :] - low[part, None]) < wide[part, None]
    return counts


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", projections: int = PROJECTIONS, half_width: float = HALF_WIDTH, block: int = BLOCK,
                    seed: int = 11) -> DataFrame:
    """(id column, n_links, component, kept) of every row.

    Vectors of one label (and one length) link when their cosine is at least ``threshold``. Vectors that are
    NULL, zero, or hold a NULL or non-finite component, and those without a label, link with nothing.
    Equal vectors of a label are one node with a count; their links among each other are counted, not listed.
    ``component`` is the least id reachable, a row's own included; NULL ids never name one. A label is cut
    into blocks by hash and blocks meet pairwise, so no task holds a label; what leaves a pair of blocks is a
    count for each node and a spanning forest, never more than its rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a positive cosine")
    values = F.col(vector_col).cast("array<double>")
    fit = (F.col(vector_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector_col) > 0)
           & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(values, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), values.alias("vector"), F.coalesce(fit, F.lit(False)).alias("fit"))
    name = F.concat(F.hex(F.xxhash64("label", "vector")), F.lit("-"), F.hex(F.xxhash64("vector", "label")))
    rows = stow(rows.withColumn("node", F.when(F.col("fit"), name)), "vectors")
    nodes = rows.filter("fit").groupBy("node").agg(F.first("label").alias("label"), F.first("vector").alias("vector"),
                                                   F.count("*").alias("copies"), F.min("id").alias("least"))
    nodes = nodes.withColumn("dims", F.size("vector"))
    sizes = nodes.groupBy("label", "dims").agg(F.ceil(F.count("*") / block).cast("int").alias("cuts"))
    dealt = (nodes.join(sizes, ["label", "dims"]).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
             .select("label", "dims", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "vector", "copies"))
    needed, reach = calibrate(projections, half_width), half_width * math.sqrt(max(2 - 2 * threshold, 1e-6))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        unit = np.stack(group["vector"].to_list())
        unit /= np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        lines = (unit @ np.random.default_rng(seed).standard_normal((unit.shape[1], projections))).astype(np.float32)
        first = group["mine"].to_numpy() == group["i"].iloc[0]
        same = group["i"].iloc[0] == group["j"].iloc[0]
        left, right = np.flatnonzero(first), np.flatnonzero(first if same else ~first)
        copies, node = group["copies"].to_numpy(), group["node"].to_numpy()
        links, ones, others = np.zeros(len(group), np.int64), [], []
        for low in range(0, len(left), 1024):
            strip = left[low:low + 1024]
            a, b = np.nonzero(collisions(lines[strip], lines[right], reach) >= needed)
            a, b = strip[a], right[b]
            if same:
                a, b = a[a < b], b[a < b]
            for at in range(0, len(a), 100_000):
                x, y = a[at:at + 100_000], b[at:at + 100_000]
                near = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
                x, y = x[near], y[near]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                ones.append(x)
                others.append(y)
        child, root = forest(np.concatenate(ones), np.concatenate(others)) if ones else (np.zeros(0, int), np.zeros(0, int))
        linked = np.flatnonzero(links)
        return pd.DataFrame({"node": np.concatenate([node[linked], node[child]]),
                             "links": np.concatenate([links[linked], np.zeros(len(child), np.int64)]),
                             "peer": np.concatenate([np.full(len(linked), None, object), node[root]])})

    met = stow(dealt.groupBy("label", "dims", "i", "j").applyInPandas(meet, "node string, links bigint, peer string"), "vector-links")
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(met.filter("peer IS NOT NULL").select(F.col("node").alias("a"), F.col("peer").alias("b")))
    named = (nodes.select("node", "copies", "least").join(counts, "node", "left").join(joined, "node", "left")
             .select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root")))
    roots = named.groupBy("root").agg(F.min("least").alias("found"))
    of = named.join(roots, "root").select("node", "n_links", "found")
    out = rows.select("id", "node").join(of, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("found")).alias("component"))
    return out.withColumn("kept", F.col("component").eqNullSafe(F.col(id_col)))
