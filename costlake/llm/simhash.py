"""SimHash near-dedup with anchor points of a covering code.

The 64 bits are cut into three segments. In two of 23 bits the anchors are the words of the perfect
Golay code, whose covering radius is 3; in the last of 18 bits every word is an anchor (radius 0). The
distance is shared out so that a pair within it is within the segment's part in at least one segment:
(t1+1) + (t2+1) + (t3+1) > distance. A fingerprint is at home at the anchor within the covering radius
and is copied to every anchor within radius plus t; a pair within t in a segment then meets at the home of
either. Nothing is missed, at whatever distance the parts allow.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import LOWER, UPPER, arrow_type, byte_slices, components, forest, record, stow, texts

#: The Golay code's generator polynomial, length, check bits and covering radius.
GOLAY, BITS, CHECK_BITS, RADIUS = 0b101011100011, 23, 11, 3
#: (first bit, bits) of the segments.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Rows of a cell that meet in one task at most, roughly; larger cells are cut into blocks.
BLOCK = 4096

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """Bit majority of the XXH64 of all word shingles of a UTF-8 text; 0 without words."""
    words = text.translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda at, n: at + n + 1))
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, n, 8192):
        span = zip(starts[low:min(n, low + 8192)], last[low:low + 8192])
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in span), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id column, rid, fp bigint) of every row; NULL text counts as empty and gets 0."""
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("id", arrow_type(kind)), ("rid", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in byte_slices(batches, "text"):
            raw = data.tobytes()
            made = np.array([fingerprint(raw[a:b], width) for a, b in itertools.pairwise(offsets.tolist())], np.uint64)
            yield record(schema, batch.column(0), batch.column(1), pa.array(made.view(np.int64)))

    slim = texts(docs, id_col, text_col).select("id", "rid", "text")
    out = T.StructType([T.StructField("id", kind), T.StructField("rid", T.LongType()), T.StructField("fp", T.LongType())])
    return slim.mapInArrow(run, out).withColumnRenamed("id", id_col)


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def shares(distance: int) -> tuple[int, ...]:
    """What each segment is searched within, so that every pair within ``distance`` is within one of them."""
    parts = [0] * len(SEGMENTS)
    for turn in range(distance + 1 - len(SEGMENTS)):
        parts[turn % len(SEGMENTS)] += 1
    return tuple(parts)


def _syndromes(words: np.ndarray) -> np.ndarray:
    """The remainder of each 23-bit word by the generator polynomial."""
    rest = words.copy()
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        hit = (rest >> bit) & 1
        rest ^= hit * (GOLAY << (bit - CHECK_BITS))
    return rest


def _patterns(weight: int, bits: int) -> np.ndarray:
    """All bit patterns of at most this weight, light ones first."""
    return np.array([sum(1 << b for b in which) for w in range(weight + 1)
                     for which in itertools.combinations(range(bits), w)], np.int64)


def anchor_finder(segment: int, within: int):
    """f(words) -> (row, anchor, is home) for every anchor within radius plus ``within`` of each word."""
    bits = SEGMENTS[segment][1]
    if bits != BITS:
        near = _patterns(within, bits)

        def trivial(words: np.ndarray):
            return (np.repeat(np.arange(len(words)), len(near)), (words[:, None] ^ near).ravel(),
                    np.tile(near == 0, len(words)))

        return trivial
    errors = _patterns(RADIUS + within, bits)
    light = np.bitwise_count(errors) <= RADIUS
    of = _syndromes(errors)
    order = np.argsort(of, kind="stable")
    errors, light = errors[order], light[order]
    first = np.searchsorted(of[order], np.arange((1 << CHECK_BITS) + 1))

    def golay(words: np.ndarray):
        found = _syndromes(words)
        count = first[found + 1] - first[found]
        row = np.repeat(np.arange(len(words)), count)
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[found], count)
        return row, words[row] ^ errors[at], light[at]

    return golay


def replicas(fps: DataFrame, distance: int) -> DataFrame:
    """(seg, cell, fp, home) for every anchor that each fingerprint is sent to."""
    schema = pa.schema([("seg", pa.int8()), ("cell", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])
    parts = shares(distance)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [anchor_finder(s, t) for s, t in enumerate(parts)]
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for seg, ((low, bits), find) in enumerate(zip(SEGMENTS, finders)):
                row, cell, home = find((fp >> low) & ((1 << bits) - 1))
                yield record(schema, np.full(len(row), seg, np.int8), cell.astype(np.int32), fp[row], home)

    return fps.select("fp").mapInArrow(run, "seg tinyint, cell int, fp bigint, home boolean")


def links(fps: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """(a, b) fingerprints that join all those within ``distance`` of each other, directly or in steps.

    Within an anchor, its home fingerprints are compared with all that were sent there. An anchor with more
    than ``block`` rows is cut into blocks of either side that meet pairwise, each meeting a task of its own.
    Of what links within a slice of work, only a spanning forest leaves it: never more links than rows.
    """
    rows = replicas(fps, distance)
    sizes = rows.groupBy("seg", "cell").agg(F.count("*").alias("size")).filter(F.col("size") > block)
    cuts = sizes.select("seg", "cell", F.ceil(F.col("size") / block).cast("int").alias("cuts"))
    cut = rows.join(cuts, ["seg", "cell"], "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    every = F.sequence(F.lit(0), F.col("cuts") - 1)
    whole = cut.filter("cuts IS NULL").select("seg", "cell", F.lit(0).alias("hb"), F.lit(0).alias("ab"), "fp",
                                              F.when(F.col("home"), 3).otherwise(1).alias("role"))
    large = cut.filter("cuts IS NOT NULL")
    sent = large.select("seg", "cell", F.explode(every).alias("hb"), mine.alias("ab"), "fp", F.lit(1).alias("role"))
    homes = large.filter("home").select("seg", "cell", mine.alias("hb"), F.explode(every).alias("ab"), "fp", F.lit(2).alias("role"))
    keys = ["seg", "cell", "hb", "ab"]
    dealt = whole.unionByName(sent).unionByName(homes).repartition(*keys).sortWithinPartitions(*keys)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fp, role, starts in whole_groups(batches):
            for a, b in _close(fp.view(np.uint64), role, starts, distance):
                yield record(schema, a.view(np.int64), b.view(np.int64))

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def whole_groups(batches: Iterable[pa.RecordBatch], keys: int = 4) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(fp, role, starts) of complete groups of a partition that is sorted by its first ``keys`` columns."""
    held: list[np.ndarray] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if batch.num_rows:
                held.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            if sum(map(len, held)) < 20_000:
                continue
        if not held:
            continue
        rows = np.concatenate(held)
        new = np.flatnonzero((rows[1:, :keys] != rows[:-1, :keys]).any(axis=1)) + 1
        starts = np.concatenate([[0], new])
        end = len(rows) if batch is None else int(starts[-1])  # the last group may go on
        held = [rows[end:]] if end < len(rows) else []
        if end:
            yield np.ascontiguousarray(rows[:end, keys]), rows[:end, keys + 1], np.append(starts[starts < end], end)


def _close(fp: np.ndarray, role: np.ndarray, starts: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning forests of the pairs within the distance, home against all, group by group."""
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    small = sizes <= 32
    left, right = [], []
    for step in range(1, int(sizes[small].max(initial=1))):  # small groups all at once, by distance in the order
        i = np.flatnonzero((group[:-step] == group[step:]) & small[group[:-step]]) if step < len(fp) else np.zeros(0, int)
        j = i + step
        near = (np.bitwise_count(fp[i] ^ fp[j]) <= distance) & ((role[i] | role[j]) >= 2)
        left.append(fp[i[near]])
        right.append(fp[j[near]])
    for g in np.flatnonzero(~small):
        part = slice(starts[g], starts[g + 1])
        every, home = fp[part][(role[part] & 1) > 0], fp[part][role[part] >= 2]
        for low in range(0, len(home), 256):
            i, j = np.nonzero(np.bitwise_count(home[low:low + 256, None] ^ every[None, :]) <= distance)
            left.append(home[low + i])
            right.append(every[j])
            if sum(map(len, left)) > 1_000_000:
                a, b = forest(np.concatenate(left), np.concatenate(right))
                left, right = [a], [b]
    if left:
        a, b = forest(np.concatenate(left), np.concatenate(right))
        if len(a):
            yield a, b


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4,
                    width: int = 4) -> DataFrame:
    """(id column, rid, fp bigint, root, component): the least id reachable through fingerprints within ``distance``.

    Equal fingerprints are one node, so copies cost nothing past the first aggregation. Texts without words
    share fingerprint 0 and are linked like any other. NULL ids belong to their component but never name it;
    a component of NULL ids only has a NULL name. Repeated rows each get a row. ``root`` is the
    component's least fingerprint.
    """
    rows = stow(fingerprints(docs, id_col, text_col, width), "simhash")
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    joined = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    named = nodes.join(joined, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    of = named.select("fp", "root").join(names, "root").select("fp", "root", "component")
    return rows.join(of, "fp").select(id_col, "rid", "fp", "root", "component")
