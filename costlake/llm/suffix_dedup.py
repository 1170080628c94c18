"""Removal of long repeated byte strings with run-length indexes.

A corpus is far too long for one index, so it is first cut where equal strings must meet. In every window of
``length`` bytes the gram with the least hash, leftmost among equals, is its anchor: equal windows have equal
anchors at equal places. Windows that follow each other with one anchor form an occurrence of it, and its
context is the bytes those windows cover. Anchors that occur once are out. Where all contexts of an
anchor are the same, all its windows are repeated. The distinct contexts of the other anchors are indexed: the
Burrows-Wheeler transform of their concatenation (the anchor itself being one symbol) is run-compressed,
suffixes are sampled at the ends of its runs, and from the samples the matching statistics of every position
against all other contexts are streamed in the order of the text.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import arrow_type, byte_slices, mix, record, stow, texts

LENGTH, GRAM = 200, 64
#: Unlike contexts beyond which an anchor is resolved window by window instead of in one index.
HOT = 4096
#: Symbols of an index, roughly.
INDEX_SYMBOLS = 1_000_000
#: Bytes handled at a time, so few that all that is computed from them stays in the cache.
SLICE = 500_000
UNIFORM, MIXED, CROWDED = 0, 1, 2

_PLACE_BITS = np.uint64(28)
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    if (base, size) not in _POWERS:
        made = np.full(size, base, np.uint64)
        made[0] = 1
        _POWERS[base, size] = np.cumprod(made)
    return _POWERS[base, size]


class Rolling:
    """Hashes of byte ranges of a buffer, from one pass over it."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        size = 1 << max(20, n.bit_length())  # a power of two, so that few are ever made
        powers, self.back = _powers(_BASE, size)[:n], _powers(pow(_BASE, -1, 1 << 64), size)[:n]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * powers[:-1])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of each range."""
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def grams(self, width: int) -> np.ndarray:
        """The hash of every range of this width."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.back[:n] + np.uint64(width))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every run of ``width``."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[:len(values) - (width - span)], values[width - span:]) if width > span else values


def occurrences(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, anchor, first, last, hash, rolling): the anchors of all windows inside the texts of a buffer.

    ``first`` and ``last`` are the starts of the first and last window with the anchor.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, np.zeros(0, np.uint64), None
    rolling = Rolling(data)
    hashes = rolling.grams(gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    low_bits = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    least = sliding_min((hashes & ~low_bits) | places, length - gram + 1) & low_bits
    inside = np.zeros(len(least) + 1, np.int32)
    long = np.diff(offsets) >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    anchor = least[starts].astype(np.int64)
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1] if len(new) else none
    anchor = anchor[new]
    return np.searchsorted(offsets, anchor, "right") - 1, anchor, first, last, hashes[anchor], rolling


def repeated_keys(rows: DataFrame, keys, hot: int) -> DataFrame:
    """(rid, found array<struct<h, kind>>): of each row the sketch keys that occur more than once in all rows.

    ``keys(batches)`` yields (h, x, rid) records, x being a hash of the content. A key is of kind UNIFORM if all
    its contents are the same, CROWDED if it has more than ``hot`` different ones, else MIXED. Keys are
    counted on their own first, so the rows of unique keys travel once. Groups are written before they meet the rows
    again, as adaptive execution splits a hot key only in a join whose sides come straight from a shuffle.
    """
    made = rows.select("rid", "text").mapInArrow(keys, "h bigint, x bigint, rid bigint")
    same = F.when(F.col("low") == F.col("high"), UNIFORM).otherwise(MIXED)
    groups = (made.groupBy("h").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
              .filter("n > 1").select("h", "n", same.cast("tinyint").alias("kind")))
    return listed_keys(stow(made.join(stow(groups, "sketch-groups"), "h"), "repeated-keys"), hot)


def listed_keys(again: DataFrame, hot: int) -> DataFrame:
    """The result of :func:`repeated_keys` from the written (h, x, rid, n, kind) of all keys that occur more than once, n times."""
    # only a key with very many rows can have very many contents; there are few such keys
    large = again.filter((F.col("n") > hot) & (F.col("kind") == MIXED)).groupBy("h", "x").agg(F.count("*").alias("n"))
    large = large.groupBy("h").agg(F.count("*").alias("contents")).filter(F.col("contents") > hot).select("h", F.lit(True).alias("large"))
    large = stow(large, "crowded-keys")
    kind = F.when(F.col("large"), CROWDED).otherwise(F.col("kind")).cast("tinyint").alias("kind")
    found = again.select("h", "rid", "kind").join(large, "h", "left").groupBy("rid").agg(F.collect_set(F.struct("h", kind)).alias("found"))
    return stow(found, "repeated-keys")


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks of all suffixes by their first 1, 2, 4, ... symbols); every suffix must be unlike."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    levels = [rank.astype(np.int32)]
    span = 1
    while True:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:len(rank) - span] = rank[span:] + 1
        key = rank * (len(rank) + 1) + ahead
        order = np.argsort(key)
        line = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(line[1:] != line[:-1])])
        levels.append(rank.astype(np.int32))
        if rank[order[-1]] == len(rank) - 1:
            return order, levels
        span *= 2


def common_prefix(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The length of the common prefix of the suffixes a and b, pairwise."""
    a, b, n = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    size = len(levels[0])
    for level in reversed(range(len(levels))):
        within = (a < size) & (b < size)
        same = np.zeros(len(a), bool)
        same[within] = levels[level][a[within]] == levels[level][b[within]]
        step = same * (1 << level)
        a, b, n = a + step, b + step, n + step
    return n


def matching_statistics(symbols: np.ndarray) -> np.ndarray:
    """For every position, the length of its longest match with another position.

    Where two suffixes that follow each other are preceded by the same symbol, their match goes one
    symbol further back. So matches have to be measured at the ends of the transform's runs only; from the
    samples there, a pass in text order gives the others, each one shorter than that of the position before.
    """
    order, levels = suffix_order(symbols)
    before = np.where(order > 0, symbols[order - 1], -1)
    ends = np.flatnonzero(before[1:] != before[:-1])  # a run ends here, the next begins at ends + 1
    measured = common_prefix(order[ends], order[ends + 1], levels)
    n = len(symbols)
    best = np.zeros(n, np.int64)
    for sampled, first in ((order[ends + 1], order[0]), (order[ends], order[-1])):  # with the suffix before, and after
        value = np.full(n, -1, np.int64)
        value[sampled] = measured
        value[first] = 0  # it has no such neighbour
        at = np.maximum.accumulate(np.where(value >= 0, np.arange(n), 0))
        best = np.maximum(best, value[at] - (np.arange(n) - at))
    return best


def repeated_windows(group: np.ndarray, left: list[bytes], right: list[bytes], times: np.ndarray, need: int) -> list[list[int]]:
    """For each context the ranges [from, to, from, to, ...] of its windows that occur elsewhere."""
    sizes = np.array([len(a) + len(b) + 2 for a, b in zip(left, right)])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.frombuffer(b"".join(itertools.chain.from_iterable((a, b"\0", b, b"\0") for a, b in zip(left, right))), np.uint8).astype(np.int64)
    lead = np.array([len(a) for a in left])
    symbols[starts[:-1] + lead] = 256 + group
    symbols[starts[1:] - 1] = 256 + int(group.max()) + 1 + np.arange(len(left))
    long = matching_statistics(symbols) >= need
    ranges = []
    for begin, a, b, n in zip(starts.tolist(), left, right, times.tolist()):
        windows = len(a) + len(b) + 1 - need + 1
        if n > 1:
            ranges.append([0, windows - 1])
            continue
        edge = np.flatnonzero(np.diff(long[begin:begin + windows].astype(np.int8), prepend=0, append=0))
        edge[1::2] -= 1
        ranges.append(edge.tolist())
    return ranges


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """(id column, rid, kb, n_bytes, n_removed, spans array<struct<start, end>>, kept binary) of every row.

    Every byte of the UTF-8 text that lies in a string of ``length`` bytes which also starts anywhere else, in
    another row or at another place of the same one, is removed; overlaps count and all strings are
    judged on the input. NULL text counts as empty, shorter texts lose nothing, repeated rows are each other's
    repeats. ``kept`` is what remains, in order; it may cut a character, so it is binary.

    Only an anchor's occurrences meet in a task, pre-aggregated to distinct contexts; an anchor with more than
    ``hot`` unlike contexts is resolved by counting a hash of each of its windows.
    """
    rows = texts(docs, id_col, text_col)

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("x", pa.int64()), ("rid", pa.int64())])
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            text, _, first, last, hashes, rolling = occurrences(data, offsets, length, gram)
            if len(text):
                yield record(schema, hashes.view(np.int64), rolling.of(first, last + length).view(np.int64),
                             batch.column(0).to_numpy(zero_copy_only=False)[text])

    found = repeated_keys(rows, keys, hot)
    met = rows.join(found, "rid", "left").select("rid", "kb", "id", "text", "found")
    contexts = met.mapInArrow(_emit(length, gram, MIXED), "h bigint, x bigint, lead binary, tail binary, rid bigint, kb bigint, first int")
    distinct = contexts.groupBy("h", "x", "lead", "tail").agg(F.count("*").alias("n"))
    indexed = distinct.repartition("h").sortWithinPartitions("h", "x").mapInArrow(_index(length - gram + 1), "h bigint, x bigint, ranges array<int>")
    hits = contexts.select("h", "x", "rid", "kb", "first").join(indexed, ["h", "x"]).select("rid", "kb", "first", "ranges")
    if not found.filter(F.exists("found", lambda f: f["kind"] == CROWDED)).isEmpty():
        windows = met.mapInArrow(_emit(length, gram, CROWDED), "h bigint, x bigint, rid bigint, kb bigint, first int")
        again = windows.groupBy("h", "x").agg(F.count("*").alias("n")).filter("n > 1").select("h", "x")
        hits = hits.unionByName(windows.join(again, ["h", "x"]).select("rid", "kb", "first", F.array(F.lit(0), F.lit(0)).alias("ranges")))
    # rows that are the same have the same marks, so each is taken once
    marks = hits.groupBy("rid").agg(F.collect_set(F.struct("kb", "first", "ranges")).alias("marks"))
    kind = docs.schema[id_col].dataType
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    out = T.StructType([T.StructField("id", kind), T.StructField("rid", T.LongType()), T.StructField("kb", T.LongType()),
                        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", span),
                        T.StructField("kept", T.BinaryType())])
    cut = met.join(marks, "rid", "left").select("rid", "kb", "id", "text", "found", "marks")
    return cut.mapInArrow(_cut(length, gram, arrow_type(kind)), out).withColumnRenamed("id", id_col)


def _of_kind(batch: pa.RecordBatch, text: np.ndarray, hashes: np.ndarray, kind: int) -> np.ndarray:
    """Which occurrences' anchors their rows list with this kind."""
    column = batch.column(batch.schema.get_field_index("found"))
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    listed = flat.field("h").to_numpy(zero_copy_only=False)[flat.field("kind").to_numpy(zero_copy_only=False) == kind]
    owner = np.repeat(np.arange(len(sizes)), sizes)[flat.field("kind").to_numpy(zero_copy_only=False) == kind]
    pairs = np.zeros(len(listed), [("t", np.int64), ("h", np.int64)])
    pairs["t"], pairs["h"] = owner, listed
    mine = np.zeros(len(text), pairs.dtype)
    mine["t"], mine["h"] = text, hashes.view(np.int64)
    keys = mix(pairs["t"].astype(np.uint64)) ^ pairs["h"].view(np.uint64) if len(pairs) else np.zeros(0, np.uint64)
    return np.isin(mix(mine["t"].astype(np.uint64)) ^ np.ascontiguousarray(mine["h"]).view(np.uint64), keys)


def _emit(length: int, gram: int, kind: int):
    """Contexts of mixed anchors, or windows of crowded ones."""
    whole = pa.schema([("h", pa.int64()), ("x", pa.int64()), ("lead", pa.binary()), ("tail", pa.binary()), ("rid", pa.int64()),
                       ("kb", pa.int64()), ("first", pa.int32())])
    single = pa.schema([f for f in whole if f.name not in ("lead", "tail")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            text, anchor, first, last, hashes, rolling = occurrences(data, offsets, length, gram)
            if not len(text):
                continue
            of = _of_kind(batch, text, hashes, kind)
            text, anchor, first, last, hashes = (c[of] for c in (text, anchor, first, last, hashes))
            if not len(text):
                continue
            if kind == CROWDED:  # one record for every window
                count = last - first + 1
                at = np.repeat(np.arange(len(text)), count)
                first = np.repeat(first, count) + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                text, anchor, hashes, last = text[at], anchor[at], hashes[at], first
            rid, kb = (batch.column(i).to_numpy(zero_copy_only=False)[text] for i in (0, 1))
            x = rolling.of(first, last + length).view(np.int64)
            place = (first - offsets[text]).astype(np.int32)
            if kind == CROWDED:
                yield record(single, hashes.view(np.int64), x, rid, kb, place)
                continue
            raw = data.tobytes()
            lead = [raw[a:b] for a, b in zip(first.tolist(), anchor.tolist())]
            tail = [raw[a:b] for a, b in zip((anchor + gram).tolist(), (last + length).tolist())]
            yield record(whole, hashes.view(np.int64), x, lead, tail, rid, kb, place)

    return run


def _index(need: int):
    """Index whole anchors of a sorted partition, some at a time."""
    schema = pa.schema([("h", pa.int64()), ("x", pa.int64()), ("ranges", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows:
                held.append(batch)
            if not held or batch is not None and sum(b.nbytes for b in held) < INDEX_SYMBOLS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h = table.column("h").to_numpy()
            end = len(h) if batch is None else int(np.searchsorted(h, h[-1], "left"))  # the last anchor may go on
            held = table.slice(end).to_batches() if end < len(h) else []
            if not end:
                continue
            done = table.slice(0, end)
            group = np.unique(h[:end], return_inverse=True)[1]
            lead, tail = done.column("lead").to_pylist(), done.column("tail").to_pylist()
            times = done.column("n").to_numpy()
            size = np.cumsum([len(a) + len(b) + 2 for a, b in zip(lead, tail)])
            low = 0
            while low < end:  # a batch of Spark may be many indexes long
                high = int(np.searchsorted(size, (size[low - 1] if low else 0) + INDEX_SYMBOLS, "right"))
                high = end if high >= end else max(int(np.searchsorted(group, group[high], "left")), low)
                if high <= low:  # a single anchor is longer
                    high = int(np.searchsorted(group, group[low], "right"))
                ranges = repeated_windows(group[low:high] - group[low], lead[low:high], tail[low:high], times[low:high], need)
                part = done.slice(low, high - low)
                yield record(schema, part.column("h").to_numpy(), part.column("x").to_numpy(), ranges)
                low = high

    return run


def _cut(length: int, gram: int, id_type: pa.DataType):
    """Remove what the marks and the anchors with like contexts cover."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("id", id_type), ("rid", pa.int64()), ("kb", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", spans_type), ("kept", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            text, _, first, last, hashes, _ = occurrences(data, offsets, length, gram)
            edges = np.zeros(len(data) + 1, np.int32)
            if len(text):
                of = _of_kind(batch, text, hashes, UNIFORM)
                np.add.at(edges, first[of], 1)
                np.add.at(edges, last[of] + length, -1)
            kb = batch.column(1).to_pylist()
            for at, marks in enumerate(batch.column(5).to_pylist()):
                for mark in marks or ():
                    if mark["kb"] == kb[at]:
                        begin = int(offsets[at]) + mark["first"]
                        for a, b in itertools.batched(mark["ranges"], 2):
                            edges[begin + a] += 1
                            edges[begin + b + length] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            removed, spans, kept = [], [], []
            for a, b in itertools.pairwise(offsets.tolist()):
                part = gone[a:b]
                turn = np.flatnonzero(np.diff(part.astype(np.int8), prepend=0, append=0))
                spans.append([{"start": s, "end": e} for s, e in turn.reshape(-1, 2).tolist()])
                removed.append(int(part.sum()))
                kept.append(data[a:b][~part].tobytes())
            yield record(schema, batch.column(2), batch.column(0), batch.column(1), np.diff(offsets), removed, spans, kept)

    return run
