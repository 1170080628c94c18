"""Near-duplicate passages by compact windows around prefix shingles.

A text's shingles of a few words are hashed. Passages that are near-duplicates share most of their shingles, so of the
least few of each, its prefix, they share some: this holds for every pair, not by chance. A shingle that is in the
prefix of passages makes a window of them, in which no equal shingle comes before it. Windows that share the
shingle meet; a passage is a candidate where enough of its prefix has a partner, and is then verified by the
Jaccard similarity of shingles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import LOWER, UPPER, arrow_type, byte_slices, components, forest, mix, record, stow, texts
from costlake.llm.suffix_dedup import CROWDED, MIXED, SLICE, UNIFORM, Rolling, listed_keys, sliding_min

#: Words of a shingle and of a passage; the least similarity of near-duplicates.
SHINGLE, PASSAGE, SIMILARITY = 5, 50, 0.8
#: Prefix shingles that near-duplicates have to share; more of them need longer prefixes and let fewer candidates pass.
ENOUGH = 3
#: Unlike contents beyond which a hash is dealt out as pairs of blocks of half as many.
HOT = 4096
#: Contents of a hash that are compared pair by pair, those of many hashes at once; of more, those that share shingles are looked up.
FEW = 12
#: Pairs of contents that are compared at a time, whose passages are counted, and that are looked at; cells of a table of contents and shingles.
BATCH, SOME, PAIRS, DENSE = 64, 1024, 65_536, 8_000_000
#: One row in so many tells which shingles are frequent, those that come this often in its rows; and how many of them are kept in mind.
SAMPLED, OFTEN, FREQUENT = 32, 16, 100_000
#: Contents that a task remembers to have sent before it forgets them all.
RECENT_CONTENTS = 100_000

_JUDGED = "h bigint, x bigint, first int, last int, class_id bigint, node bigint"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[ord(c) for c in UPPER]] = [ord(c) for c in LOWER]


class Shingles:
    """The hashed shingles of the texts of a buffer, text after text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE):
        folded = _FOLD[data]
        blank = np.append(_SPACE[folded], True)
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True  # words end with their text
        begins = np.flatnonzero(~blank[:-1] & (np.concatenate([[True], blank[:-2]]) | cut[:-1])) if len(data) else np.zeros(0, np.int64)
        stops = np.flatnonzero(~blank[:-1] & (blank[1:] | cut[1:])) + 1 if len(data) else np.zeros(0, np.int64)
        words = Rolling(folded).of(begins, stops)
        self.words = np.diff(np.searchsorted(begins, offsets))  # of each text
        counts = np.maximum(0, self.words - width + 1)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        first_word = np.concatenate([[0], np.cumsum(self.words)])[:-1]
        self.text = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(self.text)) - self.starts[self.text]
        at = first_word[self.text] + place
        total = np.zeros(len(at), np.uint64)
        for k in range(width):
            total = mix(total + words[at + k])
        self.hashes = total
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(total))])


def smaller_before(values: np.ndarray, owner: np.ndarray, strict: bool) -> np.ndarray:
    """For each entry the nearest one before it, of the same owner, that is smaller (or equal, unless strict); or -1.

    Pointers jump over everything that is larger; the pointers are the parents in the Cartesian tree or lead there.
    """
    before = np.arange(len(values)) - 1
    open_ = np.arange(len(values))
    while len(open_):
        at = before[open_]
        mine = (at >= 0) & (owner[at] == owner[open_])
        larger = values[at] >= values[open_] if strict else values[at] > values[open_]
        before[open_[~mine]] = -1
        open_ = open_[mine & larger]
        before[open_] = before[before[open_]]
    return before


def compact_windows(hashes: np.ndarray, text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(c, l, r) of all compact windows of at least ``width`` shingles, l and r inclusive."""
    none = np.zeros(0, np.int64)
    if len(hashes) < width:
        return none, none, none
    places = np.arange(len(hashes), dtype=np.uint64)
    low_bits = np.uint64((1 << 28) - 1)
    least = (sliding_min((hashes & ~low_bits) | places, width) & low_bits).astype(np.int64)
    first = np.arange(len(least))
    centre = np.unique(least[text[first] == text[first + width - 1]])
    value, owner = (hashes[centre] & ~low_bits) | places[centre], text[centre]
    before = smaller_before(value, owner, False)
    after = len(centre) - 1 - smaller_before(value[::-1], owner[::-1], True)[::-1]
    left = np.where(before >= 0, centre[before] + 1, starts[owner])
    right = np.where(after < len(centre), centre[np.minimum(after, len(centre) - 1)] - 1, starts[owner + 1] - 1)
    return centre, left, right


def same_before(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each entry the nearest equal one before it in its text, or -1."""
    order = np.argsort(hashes, kind="stable")
    same = (hashes[order[1:]] == hashes[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    before = np.full(len(hashes), -1)
    before[order[1:][same]] = order[:-1][same]
    return before


def _again(before: np.ndarray, width: int, values: np.ndarray) -> np.ndarray:
    """For the passage that begins at each entry the sum of the values of its entries that have an equal one before them in it."""
    again = np.flatnonzero((before >= 0) & (np.arange(len(before)) - before < width))
    total = np.zeros(len(before) + 1, values.dtype)
    np.add.at(total, np.maximum(again - width + 1, 0), values[again])
    np.subtract.at(total, before[again] + 1, values[again])
    return np.cumsum(total[:-1], dtype=values.dtype)


def looped_passages(hashes: np.ndarray, text: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, hash): passages that have the same shingles as an overlapping one of their text, and a hash of these.

    Such passages can have all their prefix shingles, and so their windows, in common: no windows meet there.
    """
    n = len(hashes) - width + 1
    values = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    held = mix(total[width:] - total[:n] - _again(before, width, values)[:n])
    looped = np.flatnonzero((_again(before, width, np.ones(len(before), np.int64))[:n] > 0) & (text[:n] == text[width - 1:]))
    order = looped[np.lexsort((held[looped], text[looped]))]
    near = (held[order[1:]] == held[order[:-1]]) & (text[order[1:]] == text[order[:-1]]) & (order[1:] - order[:-1] < width + SHINGLE - 1)
    begin = order[np.append(near, False) | np.append(False, near)] if len(order) else order
    return begin, held[begin]


def prefix_windows(hashes: np.ndarray, text: np.ndarray, starts: np.ndarray, before: np.ndarray, width: int, similarity: float) -> tuple[np.ndarray, ...]:
    """(c, first, last): the shingles that are in the prefix of a passage, its least unlike ones, in which no equal one precedes them.

    The passages with c in their prefix begin in ``first``..``last``; others there have it, too, not always in the
    prefix. A shingle that comes again within a passage's width counts once at most, so prefixes are never too short.
    """
    n = len(hashes)
    place = np.arange(n)
    counts = (before < 0) | (place - before >= width)
    length = prefix_lengths(width - _again(before, width, np.ones(n, np.int64)), width, similarity).astype(np.int8)
    rank = (hashes >> np.uint64(32)).astype(np.uint32)  # equal ones are not smaller
    after = np.zeros((width, n), np.int8)  # smaller shingles among so many after each
    for step in range(1, width):
        after[step] = after[step - 1]
        after[step, :n - step] += (rank[step:] < rank[:n - step]) & counts[step:]
    most = np.minimum(place - np.maximum(starts[text], before + 1), width - 1).astype(np.int8)
    fewest = np.maximum(place + width - starts[text + 1], 0).clip(max=width).astype(np.int8)
    smaller = np.zeros(n, np.int8)
    far, near = np.full(n, -1, np.int8), np.full(n, -1, np.int8)
    for step in range(width):  # the passage begins so many before
        if step:
            smaller[step:] += (rank[:n - step] < rank[step:]) & counts[:n - step]
        fits = smaller[step:] + after[width - 1 - step, step:] < length[:n - step]
        fits &= fewest[step:] <= step
        fits &= most[step:] >= step
        at = np.flatnonzero(fits) + step
        near[at] = np.where(near[at] < 0, step, near[at])
        far[at] = step
    centre = np.flatnonzero(far >= 0)
    return centre, centre - far[centre], centre - near[centre]


def frequent_shingles(rows: DataFrame, sampled: int = SAMPLED, often: int = OFTEN) -> np.ndarray:
    """The hashes, sorted, of the ``FREQUENT`` most frequent shingles that a sample of the rows has ``often``.

    They come last in the order of shingles, so that lines which are in very many texts hardly make windows. Whatever is
    in the list, near-duplicates share prefix shingles: it changes the work, not what is found.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("s", pa.int64()), ("n", pa.int64())])
        for _, data, offsets in byte_slices(batches, "text", SLICE):
            yield record(schema, *np.unique(Shingles(data, offsets).hashes.view(np.int64), return_counts=True))

    counts = rows.filter(F.pmod("rid", F.lit(sampled)) == 0).select("text").mapInArrow(count, "s bigint, n bigint")
    most = counts.groupBy("s").agg(F.sum("n").alias("n")).filter(F.col("n") >= often).orderBy(F.desc("n"), "s").limit(FREQUENT)
    return np.sort(np.array([r.s for r in most.collect()], np.int64).view(np.uint64))


def windows(data: np.ndarray, offsets: np.ndarray, width: int, similarity: float, frequent: np.ndarray):
    """(shingles, text, low, high, h, x) of the windows around the prefix shingles of passages of ``width`` shingles.

    ``low``..``high`` are the shingles of the passages that have the prefix shingle h; x is their hash. Frequent shingles
    come last in the order that makes prefixes. Passages that loop make a window of their own with the hash of their shingles.
    """
    shingles = Shingles(data, offsets)
    hashes = mix(shingles.hashes + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
    if len(frequent):
        last = frequent[np.minimum(np.searchsorted(frequent, shingles.hashes), len(frequent) - 1)] == shingles.hashes
        hashes |= last.astype(np.uint64) << np.uint64(63)
    if len(hashes) < width:
        none = np.zeros(0, np.int64)
        return shingles, none, none, none, none.view(np.uint64), none.view(np.uint64)
    before = same_before(hashes, shingles.text)
    centre, low, last = prefix_windows(hashes, shingles.text, shingles.starts, before, width, similarity)
    high = last + width - 1
    x = mix(shingles.sums[high + 1] - shingles.sums[low] + np.uint64(3) * shingles.hashes[low] + np.uint64(5) * shingles.hashes[high]
            + (high - low).astype(np.uint64) * np.uint64(7) + (centre - low).astype(np.uint64) * np.uint64(11))
    begin, held = looped_passages(hashes, shingles.text, before, width)
    low, high = np.append(low, begin), np.append(high, begin + width - 1)
    return shingles, shingles.text[low], low, high, np.append(mix(hashes[centre]), held), np.append(x, held)


def prefix_lengths(unlike: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """The least shingles of passages with so many unlike ones that have to be looked at.

    Of a passage's unlike shingles at least the part ``similarity`` is in any near-duplicate. The first shared
    ones in the order of hashes come after no more than all the others, in either passage. So near-duplicates without
    repeated shingles share ``ENOUGH`` of them, also with one that has repeated ones; two of these share one.
    """
    least = lambda of: np.ceil(of * similarity - 1e-9).astype(np.int64)
    return np.minimum(unlike, np.maximum(unlike - least(unlike) + 1, unlike - least(np.int64(width)) + ENOUGH))


def near_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage_words: int = PASSAGE,
                  similarity: float = SIMILARITY, hot: int = HOT, sampled: int = SAMPLED, often: int = OFTEN) -> DataFrame:
    """(id column, start_word, end_word, class_id, class_ids) of every passage that has a near-duplicate elsewhere.

    A passage is ``passage_words`` words in a row (white space parts words, A-Z count as a-z); overlapping ones are
    joined into one row. Its near-duplicates, in any row or elsewhere in its own, share at least
    ``similarity`` of their 5-word shingles. ``class_ids`` lists all
    classes of the passages in a row, each a connected component: rows that share one have near-duplicates in each other or
    are joined by a chain of them. ``class_id`` is the least. None is missed:
    near-duplicates always share prefix shingles, and whatever shares one is compared.
    NULL and shorter texts have no passages; repeated rows are each other's duplicates.
    """
    rows = texts(docs, id_col, text_col)
    width = passage_words - SHINGLE + 1
    frequent = frequent_shingles(rows, sampled, often)

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("x", pa.int64()), ("rid", pa.int64())])
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            _, text, _, _, h, x = windows(data, offsets, width, similarity, frequent)
            if len(text):
                yield record(schema, h.view(np.int64), x.view(np.int64), batch.column(0).to_numpy(zero_copy_only=False)[text])

    # one pass over the texts and one shuffle: keys are counted where they lie sorted, a frequent one spills
    each = Window.partitionBy("h")
    same = F.when(F.min("x").over(each) == F.max("x").over(each), UNIFORM).otherwise(MIXED).cast("tinyint").alias("kind")
    made = rows.select("rid", "text").mapInArrow(keys, "h bigint, x bigint, rid bigint")
    again = made.select("h", "x", "rid", F.count(F.lit(1)).over(each).alias("n"), same).filter("n > 1")
    found = listed_keys(stow(again, "repeated-keys"), hot)
    met = rows.join(found, "rid").select("rid", "kb", "id", "text", "found")
    kind = docs.schema[id_col].dataType
    fields = "rid bigint, kb bigint, h bigint, x bigint, kind tinyint, low int, size int, content binary"
    seen = stow(met.mapInArrow(_emit(width, similarity, frequent, arrow_type(kind)), f"id {kind.simpleString()}, {fields}"), "seen-windows")
    contents = seen.filter("content IS NOT NULL").select(
        "h", F.lit(-1).alias("a"), F.lit(-1).alias("b"), "x", F.lit(False).alias("later"), "rid", "low", "content", F.lit(1).alias("n"), "kind")
    mixed = contents.filter(F.col("kind") == MIXED).drop("kind").repartition("h").sortWithinPartitions("h", "x")
    judged = mixed.mapInArrow(_verify(width, similarity), _JUDGED).drop("node")
    crowded = contents.filter(F.col("kind") == CROWDED)
    if not crowded.isEmpty():
        judged = judged.unionByName(_blocks(crowded, hot, width, similarity))
    whole = (F.lit(0).alias("first"), (F.col("size") - width).alias("last"), F.xxhash64("h", "x").alias("class_id"))
    slim = seen.select("id", "rid", "kb", "h", "x", "kind", "low", "size")
    known = slim.join(judged.withColumnsRenamed({"first": "from", "last": "to", "class_id": "of"}), ["h", "x"], "left")
    known = known.filter((F.col("kind") == UNIFORM) | F.col("of").isNotNull()).select("id", "rid", "kb", "low", "from", "to", "of", *whole)
    spans = known.select("id", "rid", "kb", "low", *[F.coalesce(a, b).alias(b) for a, b in (("from", "first"), ("to", "last"), ("of", "class_id"))])
    spans = spans.select("rid", "kb", "id", (F.col("low") + F.col("first")).alias("start"),
                         (F.col("low") + F.col("last") + width + SHINGLE - 1).alias("end"), "class_id")
    # within a row, overlapping spans are one passage; it is named by its least class and lists all
    runs = spans.repartition("rid", "kb").sortWithinPartitions("rid", "kb", "start", "end", "class_id")
    passages = "start_word int, end_word int, class_id bigint, class_ids array<bigint>"
    return runs.mapInArrow(_passages(arrow_type(kind)), f"id {kind.simpleString()}, {passages}").withColumnRenamed("id", id_col)


def _passages(id_type: pa.DataType):
    """The passages of (rid, kb, id, start, end, class_id) rows, which are sorted but for the id: spans of a row that overlap are one passage."""
    schema = pa.schema([("id", id_type), ("start_word", pa.int32()), ("end_word", pa.int32()), ("class_id", pa.int64()), ("class_ids", pa.list_(pa.int64()))])

    def unlike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # repeated rows have the same spans
            columns = [batch.column(i).to_numpy() for i in (0, 1, 3, 4, 5)]
            new = np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)) if batch.num_rows else np.zeros(0, bool)
            yield batch.filter(pa.array(new))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(unlike(batches), 2):
            rid, kb, start, end, of = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1, 3, 4, 5))
            row = np.cumsum(np.append(False, (rid[1:] != rid[:-1]) | (kb[1:] != kb[:-1]))) * (int(end.max()) + 1)
            reached = np.maximum.accumulate(end + row)
            first = np.flatnonzero(np.append(True, start[1:] + row[1:] >= reached[:-1]))
            passage = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(row))))
            order = np.lexsort((of, passage))
            passage, named = passage[order], of[order]
            unlike_ = np.append(True, (passage[1:] != passage[:-1]) | (named[1:] != named[:-1]))
            passage, named = passage[unlike_], named[unlike_]
            at = np.searchsorted(passage, np.arange(len(first) + 1))
            yield record(schema, batch.column(2).take(pa.array(first)), start[first].astype(np.int32), np.maximum.reduceat(end, first).astype(np.int32),
                         named[at[:-1]], pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(named)))

    return run


def _blocks(crowded: DataFrame, hot: int, width: int, similarity: float) -> DataFrame:
    """(h, x, first, last, class_id) for hashes with more contents than one task should compare.

    The contents of a hash are dealt into blocks, and every pair of blocks is a group of its own, so all
    contents meet whatever their number; work grows with its square. Classes of the groups are joined afterwards.
    """
    said = F.struct("rid", "low", "content")
    one = crowded.groupBy("h", "x").agg(F.min(said).alias("said"), F.least(F.count("*"), F.lit(2)).cast("int").alias("n"))
    one = stow(one, "crowded-contents")
    blocks = stow(one.groupBy("h").agg(F.ceil(F.count("*") / max(1, hot // 2)).cast("int").alias("blocks")), "crowded-blocks")
    dealt = one.join(blocks, "h").withColumn("block", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("h", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "x",
                         (F.col("block") > F.col("other")).alias("later"), "said.*", "n")
    judged = stow(dealt.repartition("h", "a", "b").sortWithinPartitions("h", "a", "b", "x").mapInArrow(_verify(width, similarity), _JUDGED), "crowded-judged")
    named = components(judged.filter("node IS NOT NULL").select(F.col("node").alias("a"), F.col("class_id").alias("b")))
    known = judged.filter("node IS NULL").join(named.withColumnRenamed("node", "class_id"), "class_id", "left")
    return known.select("h", "x", "first", "last", F.coalesce("component", "class_id").alias("class_id")).distinct()


def _partnered(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, width: int, similarity: float, frequent: np.ndarray):
    """(shingles, text, low, high, h, x, kind) of the windows with passages of which enough prefix shingles have a partner."""
    shingles, text, low, high, h, x = windows(data, offsets, width, similarity, frequent)
    kind = _kinds(batch, text, h)
    of = kind >= 0
    text, low, high, h, x, kind = (c[of] for c in (text, low, high, h, x, kind))
    # passages begin in low..high - width + 1; count the shingles that have a partner for each beginning
    edges = np.zeros(len(shingles.hashes) + 2, np.int32)
    np.add.at(edges, low, 1)
    np.add.at(edges, high - width + 2, -1)
    agree = np.cumsum(edges[:-1]) >= _expected(shingles, width, similarity)
    enough = np.concatenate([[0], np.cumsum(agree)])
    of = enough[high - width + 2] > enough[low]
    return shingles, *(c[of] for c in (text, low, high, h, x, kind))


def _expected(shingles: Shingles, width: int, similarity: float) -> np.ndarray:
    """For every passage how many prefix shingles it shares at least with a near-duplicate: one where shingles repeat in it."""
    n = len(shingles.hashes)
    order = np.argsort(shingles.hashes, kind="stable")
    near = (shingles.hashes[order[1:]] == shingles.hashes[order[:-1]]) & (order[1:] - order[:-1] < width)
    again = np.zeros(n + width + 1, np.int64)
    again[order[1:][near]] = 1
    total = np.concatenate([[0], np.cumsum(again)])
    return np.where(total[width:n + width + 1] > total[:n + 1], 1, min(ENOUGH, int(np.ceil(width * similarity - 1e-9))))


def _emit(width: int, similarity: float, frequent: np.ndarray, id_type: pa.DataType):
    """The windows of a row that have a partner.

    A window whose hash has unlike contents carries its content, but a task sends one at most twice while it remembers it: twice says repeated.
    """
    schema = pa.schema([("id", id_type), ("rid", pa.int64()), ("kb", pa.int64()), ("h", pa.int64()), ("x", pa.int64()), ("kind", pa.int8()),
                        ("low", pa.int32()), ("size", pa.int32()), ("content", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[tuple[int, int], int] = {}
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            shingles, text, low, high, h, x, kind = _partnered(batch, data, offsets, width, similarity, frequent)
            if not len(text):
                continue
            small = (shingles.hashes >> np.uint64(32)).astype(np.uint32)
            if len(sent) > RECENT_CONTENTS:
                sent = {}
            content: list[bytes | None] = [None] * len(text)
            mixed = np.flatnonzero(kind != UNIFORM)
            for at, *key, a, b in zip(mixed.tolist(), h[mixed].tolist(), x[mixed].tolist(), low[mixed].tolist(), (high[mixed] + 1).tolist()):
                times = sent.get(tuple(key), 0)
                if times < 2:
                    sent[tuple(key)] = times + 1
                    content[at] = small[a:b].tobytes()
            rid, kb = (batch.column(i).to_numpy(zero_copy_only=False)[text] for i in (0, 1))
            yield record(schema, batch.column(2).take(pa.array(text)), rid, kb, h.view(np.int64), x.view(np.int64), kind.astype(np.int8),
                         (low - shingles.starts[text]).astype(np.int32), (high - low + 1).astype(np.int32), content)

    return run


def _kinds(batch: pa.RecordBatch, text: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The kind that a window's row lists for its hash, or -1."""
    column = batch.column(4)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    listed = mix(owner.astype(np.uint64)) ^ flat.field("h").to_numpy(zero_copy_only=False).view(np.uint64)
    kind = flat.field("kind").to_numpy(zero_copy_only=False)
    order = np.argsort(listed)
    mine = mix(text.astype(np.uint64)) ^ h
    at = np.minimum(np.searchsorted(listed[order], mine), len(listed) - 1)
    return np.where(listed[order][at] == mine, kind[order][at], -1) if len(listed) else np.full(len(text), -1)


def _whole_groups(batches: Iterable[pa.RecordBatch], named: int = 3) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, parted only between groups, which the first ``named`` columns name."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(named)])
        ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if len(ends):
            yield pa.concat_batches([*held, batch.slice(0, ends[-1])])
            held = [batch.slice(ends[-1])]
        elif batch.num_rows:
            held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _verify(width: int, similarity: float):
    """Compare the contents of a hash with each other; of two blocks of contents, those of one with those of the other.

    Takes (h, a, b, x, later, rid, low, content, n), sorted by group (h, a, b) and content x. Yields the passages that have a
    near-duplicate as (h, x, first, last, class_id), and for each content of a group in blocks (first, last) = (-1, -1) and
    ``node``, the content's name, if it belongs to a class of another name.
    """
    schema = pa.schema([("h", pa.int64()), ("x", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("class_id", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            h, a, b, x, later, rid, low = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            new = np.append(True, (h[1:] != h[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            at = np.flatnonzero(new | np.append(True, x[1:] != x[:-1]))  # the first of the rows with the same content
            repeats = np.add.reduceat(batch.column(8).to_numpy(), at) > 1
            h, a, b, x, later, rid, low = (c[at] for c in (h, a, b, x, later, rid, low))
            group = np.cumsum(new)[at] - 1
            contents = Contents(width, similarity)
            contents.extend(*_cells(batch.column(7).take(pa.array(at)), width), repeats, later, rid, low)
            sizes = np.bincount(group)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            few = sizes <= FEW
            contents.resolve_few(np.where(few[group], group, -1), a != b)
            for which in np.flatnonzero(~few).tolist():
                start, end = int(bounds[which]), int(bounds[which + 1])
                if end - start > 1:
                    contents.resolve(bool(a[start] != b[start]), start, end)
            names = mix((x ^ h).view(np.uint64)).view(np.int64)
            least = names.copy()
            np.minimum.at(least, contents.label, names)
            name = least[contents.label]
            edges = np.diff(np.pad(contents.marked & contents.inside, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            of, first = np.nonzero(edges == 1)
            last = np.nonzero(edges == -1)[1] - 1
            other = np.flatnonzero((b >= 0) & (name != names))
            none = np.full(len(other), -1)
            yield record(schema, np.append(h[of], h[other]), np.append(x[of], x[other]), np.append(first, none).astype(np.int32), np.append(last, none).astype(np.int32),
                         np.append(name[of], name[other]), pa.array(np.append(names[of], names[other]), mask=np.arange(len(of) + len(other)) < len(of)))

    return run


def _cells(contents: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of shingles for each content, filled up with zeros, and their sizes."""
    _, starts, data = contents.buffers()
    starts = np.frombuffer(starts, np.int32)[contents.offset:contents.offset + len(contents) + 1].astype(np.int64) // 4
    sizes = np.diff(starts)
    cells = np.zeros((len(sizes), 2 * width - 1), np.uint32)
    cells[np.arange(cells.shape[1]) < sizes[:, None]] = np.frombuffer(data, np.uint32, len(data) // 4)[starts[0]:starts[-1]]
    return cells, sizes


def sliding_sum(cells: np.ndarray, width: int, axis: int) -> np.ndarray:
    """The sum of every run of ``width`` along the axis, by sums of runs of 1, 2, 4, ..."""
    cut = lambda array, low, high: array[(slice(None),) * axis + (slice(low, high),)]
    count = cells.shape[axis] - width + 1
    total, done, span = None, 0, 1
    while True:
        if width & span:
            part = cut(cells, done, done + count)
            total = part if total is None else total + part
            done += span
        if 2 * span > width:
            return total
        cells = cut(cells, 0, -span) + cut(cells, span, None)
        span *= 2


class Contents:
    """Unlike contents of hashes: which of their passages have a near-duplicate in another one of the hash, and their classes.

    Two contents are compared unless neither could gain: where they can hold near-duplicates at all, both are marked
    already, and both are of one class. So every passage is marked and every link counts, in any order of the contents.
    """

    def __init__(self, width: int, similarity: float):
        self.width = width
        # shingles that passages of so many, both together, share at least when they are near-duplicates
        self.need = np.ceil(np.arange(2 * width + 1) * similarity / (1 + similarity) - 1e-9).astype(np.float32)
        self.cells = np.zeros((0, 2 * width - 1), np.uint32)  # the shingles, filled up with zeros
        place, start = np.arange(2 * width - 1, dtype=np.int16), np.arange(width, dtype=np.int16)[:, None]
        self.own = ((place >= start) & (place < start + width))[None]  # which shingles are a passage's own
        self.firsts = self.own  # and the first of their kind in it: without repeats, and for each content with repeats
        self.case = np.zeros(0, np.int64)  # a content's place in there
        self.unlike = np.zeros((0, width), np.int16)  # unlike shingles of the passages
        self.sizes = self.rid = self.low = self.label = self.least = np.zeros(0, np.int64)
        self.repeats = self.later = self.plain = np.zeros(0, bool)
        self.inside = self.marked = np.zeros((0, width), bool)  # passages that are there; that have a near-duplicate

    def add(self, key: int, shingles: np.ndarray, repeats: bool, later: bool, rid: int, low: int) -> None:
        cells = np.zeros((1, self.cells.shape[1]), np.uint32)
        cells[0, :len(shingles)] = shingles
        self.extend(cells, *(np.array([v]) for v in (len(shingles), repeats, later, rid, low)))

    def extend(self, cells: np.ndarray, sizes: np.ndarray, repeats: np.ndarray, later: np.ndarray, rid: np.ndarray, low: np.ndarray) -> None:
        """Add contents: whether they repeat, whether they are of the later block, a row of theirs and their place there."""
        width = self.width
        inside = np.arange(width) <= (sizes - width)[:, None]
        line = np.sort(cells, axis=1)
        plain = (line[:, 1:] == line[:, :-1]).sum(axis=1) == np.maximum(cells.shape[1] - sizes - 1, 0)
        odd = np.flatnonzero(~plain)
        order = np.argsort(cells[odd], axis=1, kind="stable")
        again, where = np.nonzero(np.diff(np.take_along_axis(cells[odd], order, axis=1), axis=1) == 0)
        before = np.full((len(odd), 1, cells.shape[1]), -1, np.int16)  # where the same shingle is before, or -1
        before[again, 0, order[again, where + 1]] = order[again, where]
        firsts = (before < np.arange(width, dtype=np.int16)[:, None]) & self.own
        case, unlike = np.zeros(len(sizes), np.int64), np.full(inside.shape, width, np.int16)
        case[odd], unlike[odd] = len(self.firsts) + np.arange(len(odd)), firsts.sum(axis=2)
        least = np.where(inside, unlike, width).min(axis=1, initial=width).astype(np.int64)
        label = np.arange(len(self.sizes), len(self.sizes) + len(sizes))
        for name, more in (("cells", cells), ("firsts", firsts), ("case", case), ("unlike", unlike), ("sizes", sizes), ("repeats", repeats), ("later", later), ("rid", rid), ("low", low), ("inside", inside),
                           ("marked", repeats[:, None] & inside), ("plain", plain), ("least", least), ("label", label)):
            setattr(self, name, np.concatenate([getattr(self, name), more]))

    def resolve_few(self, group: np.ndarray, between: np.ndarray) -> None:
        """Compare the contents of each group of up to ``FEW``, of all groups at once; contents of group -1 are left."""
        links = [np.zeros((2, 0), np.int64)]
        for step in range(1, min(FEW, len(group))):
            a = np.flatnonzero((group[step:] == group[:-step]) & (group[step:] >= 0))
            a = a[~between[a] | (self.later[a] != self.later[a + step])]
            plain = self.plain[a] & self.plain[a + step]
            for some in (a[plain], a[~plain]):
                links.append(self._compare(some, some + step))
        self._link(np.concatenate(links, axis=1), 0, len(group))

    def resolve(self, between: bool, start: int = 0, end: int | None = None) -> None:
        """Compare all contents from ``start`` to ``end``, or those of the earlier block among them with those of the later one."""
        end = len(self.sizes) if end is None else end
        for a, b, may, too in self._candidates(between, start, end):
            quota = 1
            while True:
                some = (may & ~self.marked[a]).any(axis=1) | (too & ~self.marked[b]).any(axis=1) | (self.label[a] != self.label[b])
                a, b, may, too = a[some], b[some], may[some], too[some]
                if not len(a):
                    break
                turn = np.arange(len(a)) - np.searchsorted(a, a) < quota  # the next few of each content
                quota *= 2
                plain = turn & self.plain[a] & self.plain[b]
                for of in (plain, turn & ~plain):
                    self._link(self._compare(a[of], b[of]), start, end)
                a, b, may, too = a[~turn], b[~turn], may[~turn], too[~turn]

    def _candidates(self, between: bool, start: int, end: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(a, b, may, too): contents a before b that share enough shingles, and the passages of each that share enough with the other."""
        n = end - start
        there = np.arange(self.cells.shape[1]) < self.sizes[start:end, None]
        _, at, times = np.unique(self.cells[start:end][there], return_inverse=True, return_counts=True)
        often = np.cumsum(times > 1) - 1  # the others are shared with none
        values = int(often[-1]) + 1
        ids = np.full(there.shape, values)
        ids[there] = np.where(times[at] > 1, often[at], values)
        dense = n * values <= DENSE
        if dense:
            held = np.zeros((n, values + 1), np.float32)
            held[np.arange(n)[:, None], ids] = 1
            held[:, values] = 0
            sign = held.astype(np.int8)
        else:
            pairs = np.unique(ids * n + np.arange(n)[:, None])
            having, bounds = pairs % n, np.searchsorted(pairs // n, np.arange(values + 1)).tolist()
        least, later = self.least[start:end], self.later[start:end]
        step = max(1, PAIRS // n)
        for low in range(0, n, step):
            rows = np.arange(low, min(low + step, n))
            if dense:
                common = held[rows] @ held.T
            else:
                common = np.stack([np.bincount(np.concatenate([having[:0], *(having[bounds[v]:bounds[v + 1]] for v in set(ids[r].tolist()) if v < values)]), minlength=n)
                                   for r in rows.tolist()])
            fit = (common >= self.need[least[rows, None] + least]) & (np.arange(n) > rows[:, None])
            if between:
                fit &= later != later[rows, None]
            a, b = np.nonzero(fit)
            a += low
            may, too = (self._may(u + start, v + start, sign[v[:, None], ids[u]] if dense else self._shared(u + start, v + start)) for u, v in ((a, b), (b, a)))
            both = may.any(axis=1) & too.any(axis=1)
            yield a[both] + start, b[both] + start, may[both], too[both]

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which shingles of each content a its content b has."""
        found = [np.zeros((0, self.cells.shape[1]), np.int8)]
        for low in range(0, len(a), BATCH):
            found.append(self._same(a[low:low + BATCH], b[low:low + BATCH]).any(axis=2).astype(np.int8))
        return np.concatenate(found)

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which shingles of each content a (rows) equal which of its content b (columns)."""
        theirs = np.where(np.arange(self.cells.shape[1]) < self.sizes[b, None], self.cells[b], 1)  # filled up unlike the others
        return self.cells[a][:, :, None] == theirs[:, None, :]

    def _may(self, a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Which passages of each content a have enough unlike shingles that its content b has."""
        found = sliding_sum(shared, self.width, 1)
        odd = np.flatnonzero(~self.plain[a])
        for some in np.split(odd, range(SOME, len(odd), SOME)):
            found[some] = np.einsum("pij,pj->pi", self.firsts[self.case[a[some]]].view(np.int8), shared[some])
        return (found >= self.need[self.unlike[a] + self.least[b][:, None]]) & self.inside[a]

    def _compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The pairs of contents that hold near-duplicates; these are marked."""
        links = [np.zeros((2, 0), np.int64)]
        for low in range(0, len(a), BATCH):
            u, v = a[low:low + BATCH], b[low:low + BATCH]
            near = self.near(u, v)
            mine, its = near.any(axis=2), near.any(axis=1)
            np.logical_or.at(self.marked, u, mine)
            np.logical_or.at(self.marked, v, its)
            found = mine.any(axis=1)
            links.append(np.stack([u[found], v[found]]))
        return np.concatenate(links, axis=1)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of contents which passages of a (rows) are near-duplicates of which of b (columns), by Jaccard of their shingles.

        Where no shingle comes again, every equal place is a shared shingle; else those count that are the first in their passage.
        """
        width, same = self.width, self._same(a, b)
        if self.plain[a].all() and self.plain[b].all():
            common = sliding_sum(sliding_sum(same.view(np.int8), width, 1), width, 2)
            near = common >= np.int8(self.need[2 * width])
        else:
            mine, its = (self.firsts[self.case[c]].astype(np.float32) for c in (a, b))
            common = mine @ same.astype(np.float32) @ its.transpose(0, 2, 1)
            near = common >= self.need[self.unlike[a][:, :, None] + self.unlike[b][:, None, :]]
        near &= self.inside[a][:, :, None]
        near &= self.inside[b][:, None, :]
        own = np.flatnonzero((self.rid[a] == self.rid[b]) & ~self.repeats[a] & ~self.repeats[b])
        if len(own):
            alike = (common[own] == self.unlike[a[own]][:, :, None]) & (common[own] == self.unlike[b[own]][:, None, :])
            near[own] &= self._apart(a[own], b[own]) | alike
        return near

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which passages of contents of one row don't overlap: a passage a few words on is no other one, unless it is the same again."""
        places = np.arange(self.width)
        return np.abs((self.low[a] - self.low[b])[:, None, None] + places[:, None] - places) >= self.width + SHINGLE - 1

    def _link(self, links: np.ndarray, start: int, end: int) -> None:
        """Join the classes of linked contents, all from ``start`` to ``end``."""
        named = np.arange(start, end)
        child, least = forest(self.label[links[0]], self.label[links[1]])
        named[child - start] = least
        self.label[start:end] = named[self.label[start:end] - start]


def near_places(mine: np.ndarray, other: np.ndarray, width: int, similarity: float) -> np.ndarray:
    """Which passages of ``mine`` (rows) are near-duplicates of which of ``other`` (columns)."""
    pair = Contents(width, similarity)
    for at, shingles in enumerate((mine, other)):
        pair.add(at, shingles, False, False, at, 0)
    return pair.near(np.array([0]), np.array([1]))[0, :len(mine) - width + 1, :len(other) - width + 1]
