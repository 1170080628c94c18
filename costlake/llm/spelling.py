"""Spelling variants by partition-and-enumerate signatures of letter multisets.

A word's letters with their occurrence numbers, (e, 1), (e, 2), ..., are the ones of a binary vector. One inserted or
deleted letter changes one of its bits and a replaced one at most two, so words within one edit are within Hamming
distance 2. The bits are dealt into first-level parts; of two vectors within distance k some part is within
k' = k div (first-level parts). Each first-level part is dealt again into second-level parts, and for every way to leave out
k' of these the rest is a signature. Two words within distance k share a signature exactly, so an equi-join on
signatures finds all candidates; the edit itself is then verified on the letters in order.

One edit leaves the first three or the last three letters as they are where both words have seven or more, so such words'
signatures also hold their first or their last letters: two keys for each signature, and far fewer words to a key.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import ascii_lower, mix, record, stow

#: Runs of ASCII and Latin-1 letters.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
#: Hamming distance of words one edit apart, first-level parts, second-level parts of each.
DISTANCE, FIRST, SECOND = 2, 1, 5
#: Letters at either end that a key holds, and the length from which on one of the ends outlives an edit.
EDGE, LONG = 3, 7
#: Words of a signature that meet in one task at most, roughly; larger groups are cut into blocks.
BLOCK = 2048
#: Crowded signatures are broadcast up to this number.
MOST_BROADCAST = 10_000
#: Words up to this length are compared as rows of a matrix, longer ones one pair at a time.
WIDE = 48
#: Letters in descending order of frequency, so that neighbours in the order fall into different parts.
ORDER = "enairtsoludhcgmpbvfkzwyjqx"


def ways(first: int = FIRST, second: int = SECOND, distance: int = DISTANCE) -> list[tuple[int, ...]]:
    """The part numbers of every signature: all ways to leave out second-level parts, for each first-level part."""
    left_out = distance // first
    if not (0 <= left_out < second and first * second <= 16):
        raise ValueError("too few second-level parts for the distance, or too many in all")
    return [tuple(f * second + p for p in kept) for f in range(first) for kept in itertools.combinations(range(second), second - left_out)]


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words one after another, starts)."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "".join(words.to_pylist())
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def part_hashes(codes: np.ndarray, starts: np.ndarray, parts: int = FIRST * SECOND) -> np.ndarray:
    """A hash of each word's bits in each part: a sum over the bits, so the letters' order doesn't matter."""
    word = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((codes, word))
    w, c = word[order], codes[order].astype(np.int64)
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1])
    begin = np.flatnonzero(new)
    number = np.arange(len(w)) - np.repeat(begin, np.diff(np.append(begin, len(w))))
    rank = np.arange(512, dtype=np.int64)
    rank[[ord(x) for x in ORDER]] = np.arange(len(ORDER))
    place = np.where(c < 512, rank[np.minimum(c, 511)], c)
    part = (place + 3 * number) % parts
    made = np.zeros((len(starts) - 1) * parts, np.uint64)
    np.add.at(made, w * parts + part, mix((c * 65_537 + number + 1).astype(np.uint64)))
    return made.reshape(-1, parts)


def signatures(hashes: np.ndarray, kept: list[tuple[int, ...]]) -> np.ndarray:
    """One number for each word and way; equal where all kept parts are."""
    salted = mix(hashes + mix(np.arange(1, hashes.shape[1] + 1, dtype=np.uint64)))
    return np.stack([mix(salted[:, list(way)].sum(axis=1, dtype=np.uint64) + np.uint64(i)) for i, way in enumerate(kept)], axis=1)


def edges(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last :data:`EDGE` letters of each word as a number; 0 for words shorter than :data:`LONG`."""
    made = np.zeros((2, len(starts) - 1), np.uint64)
    long = np.flatnonzero(np.diff(starts) >= LONG)
    for end, begin in enumerate((starts[:-1][long], starts[1:][long] - EDGE)):
        for k in range(EDGE):
            made[end, long] = (made[end, long] << np.uint64(21)) | codes[begin + k]
    return made[0], made[1]


def keys_of(codes: np.ndarray, starts: np.ndarray, kept: list[tuple[int, ...]], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, way, key) of every key that the words are joined by.

    Ways 0, 1, ... are plain signatures, which words shorter than ``LONG`` have and those of just that length, as they
    may be near a shorter one; the following are signatures with the first letters, then those with the last.
    """
    length, number = np.diff(starts), np.arange(len(starts) - 1)
    signed = signatures(part_hashes(codes, starts, parts), kept)
    words, kinds, keys = [], [], []
    for kind, (at, edge) in enumerate(((number[length <= LONG], None), *((number[length >= LONG], e) for e in edges(codes, starts)))):
        own = signed[at] if edge is None else mix(signed[at] + mix(mix(edge[at]) + np.uint64(kind))[:, None])
        words.append(np.repeat(at, len(kept)))
        kinds.append(np.tile(np.arange(len(kept), dtype=np.int32) + kind * len(kept), len(at)))
        keys.append(own.ravel())
    return np.concatenate(words), np.concatenate(kinds), np.concatenate(keys)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced between two words."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[i + 1:] == b[i + (len(a) == len(b)):]


def edits(codes: np.ndarray, starts: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """:func:`one_edit` of many pairs of words given by their numbers."""
    length = np.diff(starts)
    near = np.zeros(len(i), bool)
    long = np.maximum(length[i], length[j]) > WIDE
    for k in np.flatnonzero(long):
        x, y = (codes[starts[w]:starts[w + 1]].tobytes().decode("utf-32-le") for w in (i[k], j[k]))
        near[k] = one_edit(x, y)
    short = np.flatnonzero(~long)
    column = np.arange(WIDE)
    for low in range(0, len(short), 20_000):
        at = short[low:low + 20_000]
        big, small = np.where(length[i[at]] >= length[j[at]], (i[at], j[at]), (j[at], i[at]))
        n, m = length[big], length[small]
        one = codes[np.minimum(starts[big][:, None] + column, len(codes) - 1)]
        two = codes[np.minimum(starts[small][:, None] + column, len(codes) - 1)]
        within = column < m[:, None]
        apart = (one != two) & within
        ahead = np.where(apart.any(axis=1), apart.argmax(axis=1), m)  # letters in common from the front
        # from the back: with one letter more in the longer word its places are shifted by one
        shifted = codes[np.minimum(starts[big][:, None] + column + 1, len(codes) - 1)]
        tail_apart = (shifted != two) & within
        last = np.where(tail_apart.any(axis=1), WIDE - tail_apart[:, ::-1].argmax(axis=1), 0)
        near[at] = np.where(n == m, apart.sum(axis=1) == 1, (n == m + 1) & (last <= ahead))
    return near


def pairs_of(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of all pairs within groups, some at a time."""
    sizes = np.diff(starts)
    small = sizes <= 64
    group = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, int(sizes[small].max(initial=1))):
        i = np.flatnonzero((group[:-step] == group[step:]) & small[group[:-step]])
        if len(i):
            yield i, i + step
    for g in np.flatnonzero(~small):
        members = np.arange(starts[g], starts[g + 1])
        for low in range(0, len(members), 64):
            i, j = np.meshgrid(members[low:low + 64], members[low:], indexing="ij")
            yield i[i < j], j[i < j]


def close_pairs(words: DataFrame, first: int = FIRST, second: int = SECOND, block: int = BLOCK) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of words one edit apart, each once; ``words`` is (word, n) with distinct words.

    A pair that shares several keys is taken under the first of them. A key with over ``block`` words is cut into
    blocks of them that meet in pairs, a task holding two of them.
    """
    kept = ways(first, second)
    schema = pa.schema([("way", pa.int32()), ("sig", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                at, way, sig = keys_of(*letters(part.column(0)), kept, first * second)
                yield record(schema, way, sig.view(np.int64), part.column(0).take(pa.array(at)), part.column(1).take(pa.array(at)))

    signed = words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(sign, "way int, sig bigint, word string, n bigint")
    large = signed.groupBy("sig").agg(F.count("*").alias("size")).filter(F.col("size") > block)
    cuts = stow(large.select("sig", F.ceil(F.col("size") / block).cast("int").alias("cuts")), "spelling-crowded")
    few = cuts.count() <= MOST_BROADCAST
    cut = signed.join(F.broadcast(cuts) if few else cuts, "sig", "left")
    mine = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    whole = cut.filter("cuts IS NULL").select("sig", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("mine"), "way", "word", "n")
    parted = (cut.filter("cuts IS NOT NULL").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
              .select("sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "way", "word", "n"))
    keys = ["sig", "i", "j"]
    dealt = whole.unionByName(parted).repartition(*keys).sortWithinPartitions(*keys)
    out = pa.schema([("a", pa.string()), ("a_n", pa.int64()), ("b", pa.string()), ("b_n", pa.int64())])
    # for each set of parts that agree, as bits: the first way that keeps such parts only
    needs = np.array([sum(1 << p for p in way) for way in kept])
    sets = np.arange(1 << (first * second))
    first_way = ((sets[:, None] & needs) == needs).argmax(axis=1)

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in groups(batches):
            word, n, way, own = part.column("word"), part.column("n"), part.column("way").to_numpy(), part.column("mine").to_numpy()
            crossing = part.column("i").to_numpy() != part.column("j").to_numpy()
            codes, at = letters(word)
            length, hashes = np.diff(at), part_hashes(codes, at, first * second)
            head, _ = edges(codes, at)
            for i, j in pairs_of(starts):
                fit = (np.abs(length[i] - length[j]) <= 1) & ~(crossing[i] & (own[i] == own[j]))
                i, j = i[fit], j[fit]
                agree = (hashes[i] == hashes[j]) @ (1 << np.arange(first * second))
                kind = np.where(np.minimum(length[i], length[j]) < LONG, 0, np.where(head[i] == head[j], 1, 2))
                own_way = (first_way[agree] + kind * len(kept) == way[i]) & (way[i] == way[j])  # else the pair is another key's
                i, j = i[own_way], j[own_way]
                near = edits(codes, at, i, j)
                if near.any():
                    x, y = pa.array(i[near]), pa.array(j[near])
                    yield record(out, word.take(x), n.take(x), word.take(y), n.take(y))

    return dealt.mapInArrow(verify, "a string, a_n bigint, b string, b_n bigint")


def groups(batches: Iterable[pa.RecordBatch], keys: int = 3, rows: int = 20_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, starts) of complete groups with more than one row, of a partition that is sorted by its first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if batch.num_rows:
                held.append(batch)
            if sum(x.num_rows for x in held) < rows:
                continue
        if not held:
            continue
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        key = np.stack([table.column(k).to_numpy() for k in range(keys)])
        new = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        starts = np.concatenate([[0], new])
        end = table.num_rows if batch is None else int(starts[-1])  # the last group may go on
        held = [table.slice(end)] if end < table.num_rows else []
        starts = np.append(starts[starts < end], end)
        size = np.diff(starts)
        several = np.flatnonzero(np.repeat(size > 1, size))
        if len(several):
            yield table.take(pa.array(several)), np.concatenate([[0], np.cumsum(size[size > 1])])


def runs(docs: DataFrame, least: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): every maximal run of letters of at least so many code points, A-Z in lower case, repeats included; NULL texts have none."""
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run")).withColumn("run", ascii_lower(F.col("run")))


def drop_letter(word: Column, at: Column) -> Column:
    """A word without the code point at a place (from 0)."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (word, n), whose words are distinct and not NULL.

    ``n_near`` counts the words that one inserted, deleted or replaced code point makes of it. ``form`` is the near word
    with the largest n (ties: smallest in code-point order) if that is at least ``ratio`` times the word's own n, else
    NULL. ``root`` is where following forms ends; n grows along the way, so it ends. NULL words and counts are left out; an empty
    word is a word; extra columns are left behind.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its variant")
    words = words.select("word", F.col("n").cast("long").alias("n")).filter("word IS NOT NULL AND n IS NOT NULL")
    pairs = stow(close_pairs(words), "spelling-pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = words.join(best, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    named = stow(named.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                              F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    root = roots(named.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return named.join(root, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def roots(steps: DataFrame) -> DataFrame:
    """(word, root): where following ``steps`` (word, root) from each word ends; each round doubles the way that is covered."""
    now = steps
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stow(now.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if now.filter("moved").limit(1).count() == 0:
            return now.select("word", "root")
        now = now.select("word", "root")
