"""Line dedup with sharded cuckoo filters over exact reference counts.

The state of an index is two tables in the shared folder: ``counts`` holds for every line key the number of
documents that have it, and ``filters`` one cuckoo filter a shard over the keys of ``counts``. A batch of
documents first asks the filters which of its keys are new; only those that may be known are looked up in
the counts. A deletion takes the same counts away again and takes keys that fall to zero out of the filter, so
adding and deleting a document leaves the index as it was.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import LOWER, UPPER, arrow_type, ascii_lower, byte_slices, mix, record, stow, texts

BLANKS = " \t\n\x0b\f\r"
#: Slots of a bucket, and the share of slots in use above which a filter is built anew, twice as large.
SLOTS, MOST_FULL = 4, 0.8
KICKS = 400


class CuckooFilter:
    """16-bit fingerprints in buckets of four; each key has two buckets, either found from the other.

    Never says no to a key it holds; says yes to another with a chance of about 1 in 8,000. Keys are
    unsigned 64-bit hashes, all operations take arrays of distinct keys.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """An empty filter with room for so many keys."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * MOST_FULL)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter that holds these keys."""
        made, room = cls.sized(len(keys)), len(keys)
        while not made.insert(keys):
            room = 2 * room + 8
            made = cls.sized(room)
        return made

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashed = mix(keys.astype(np.uint64))
        print_ = (hashed >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = (hashed & np.uint64(len(self.table) - 1)).astype(np.int64)
        return print_, first, self._other(first, print_)

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(print_.astype(np.uint64) + np.uint64(1)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Which keys may be held."""
        print_, one, two = self._places(keys)
        return (self.table[one] == print_[:, None]).any(axis=1) | (self.table[two] == print_[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Add keys; False if they found no room, after which the filter must be built anew."""
        print_, bucket, other = self._places(keys)
        rng = np.random.default_rng(len(keys))
        for kick in range(KICKS):
            if not len(print_):
                return True
            order = np.argsort(bucket, kind="stable")
            print_, bucket, other = print_[order], bucket[order], other[order]
            first = np.searchsorted(bucket, bucket)
            rank = np.arange(len(bucket)) - first
            free = self.table[bucket] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argmax(np.cumsum(free, axis=1) > rank[:, None], axis=1)
            self.table[bucket[fits], slot[fits]] = print_[fits]
            print_, bucket, other, rank = print_[~fits], bucket[~fits], other[~fits], rank[~fits]
            if kick % 2 == 0:  # try the other bucket first
                bucket, other = other, bucket
                continue
            lead = np.concatenate([[True], bucket[1:] != bucket[:-1]])[:len(bucket)]  # one per bucket moves in
            at, into = bucket[lead], rng.integers(0, SLOTS, int(lead.sum()))
            out = self.table[at, into].copy()
            self.table[at, into] = print_[lead]
            print_[lead] = out
            bucket = np.where(lead, self._other(bucket, print_), other)
            other = self._other(bucket, print_)
        return not len(print_)

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were put in."""
        print_, one, two = self._places(keys)
        for p, a, b in zip(print_.tolist(), one.tolist(), two.tolist()):
            for bucket in (a, b):
                slot = np.flatnonzero(self.table[bucket] == p)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def document_keys(docs: DataFrame, text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(k1, k2, n): every line key of at least ``min_chars`` characters, as two hashes, with its documents."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    keys = docs.select(F.explode(F.array_distinct(F.transform(F.split(text, "\n"), line_key))).alias("key"))
    keys = keys.filter(F.char_length("key") >= min_chars)
    return keys.select(*hashes(F.col("key"))).groupBy("k1", "k2").agg(F.count("*").alias("n"))


def hashes(key: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that stand for a key."""
    return F.xxhash64(key).alias("k1"), F.xxhash64(key, F.lit(1)).alias("k2")


@dataclass(frozen=True)
class LineIndex:
    """An index of the lines of a set of documents; every change gives a new index."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int

    @classmethod
    def empty(cls, spark: SparkSession, shards: int = 64, min_chars: int = 1) -> LineIndex:
        """An index of no documents."""
        return cls(spark.createDataFrame([], "shard int, k1 bigint, k2 bigint, n bigint"),
                   spark.createDataFrame([], "shard int, filter binary"), shards, min_chars)

    def insert(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        """The index with the documents added; a repeated row counts again."""
        return self._change(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        """The index with documents taken out that were added before."""
        return self._change(docs, text_col, -1)

    def _change(self, docs: DataFrame, text_col: str, sign: int) -> LineIndex:
        batch = document_keys(docs, text_col, self.min_chars).withColumn("shard", F.pmod("k1", F.lit(self.shards)).cast("int"))
        asked = _ask(batch, self.filters)
        known = asked.filter("known").drop("known").withColumnRenamed("n", "more")
        old = self.counts
        # keys the filters have never seen need no look at the counts
        met = old.join(known, ["shard", "k1", "k2"], "full").select("shard", "k1", "k2", (
            F.coalesce("n", F.lit(0)) + sign * F.coalesce("more", F.lit(0))).alias("n"))
        fresh = asked.filter("NOT known").select("shard", "k1", "k2", (sign * F.col("n")).alias("n"))
        counts = stow(met.unionByName(fresh).filter("n > 0"), "line-counts")
        gone = known.select("shard", "k1", "k2").join(counts, ["shard", "k1", "k2"], "left_anti") if sign < 0 else None
        come = fresh if sign > 0 else None
        filters = stow(_refilter(counts, self.filters, come, gone), "line-filters")
        return LineIndex(counts, filters, self.shards, self.min_chars)

    def repeated(self, min_docs: int) -> DataFrame:
        """(k1, k2) of the keys that at least so many documents have."""
        return self.counts.filter(F.col("n") >= min_docs).select("k1", "k2")


def _ask(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """The batch's keys with ``known``, whether their shard's filter may hold them."""
    if filters.isEmpty():
        return batch.withColumn("known", F.lit(False))

    def ask(keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        hashed = keys["k1"].to_numpy().view(np.uint64)
        known = CuckooFilter.load(held["filter"].iloc[0]).contains(hashed) if len(held) else np.zeros(len(keys), bool)
        return keys.assign(known=known)

    return batch.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(
        ask, "k1 bigint, k2 bigint, n bigint, shard int, known boolean")


def _refilter(counts: DataFrame, filters: DataFrame, come: DataFrame | None, gone: DataFrame | None) -> DataFrame:
    """The filters after new keys came or old ones went; a filter without room is built from the counts.

    Shards are cut so that one holds few keys; keys are distinct, so no shard is hot.
    """

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(np.unique(keys["k1"].to_numpy().view(np.uint64)))
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "filter": [made.dump()]})

    if gone is None or filters.isEmpty():
        return counts.select("shard", "k1").groupBy("shard").applyInPandas(build, "shard int, filter binary")

    def drop(held: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        if held.empty:
            return pd.DataFrame({"shard": pd.Series([], dtype="int32"), "filter": pd.Series([], dtype=object)})
        kept = CuckooFilter.load(held["filter"].iloc[0])
        kept.delete(np.unique(keys["k1"].to_numpy().view(np.uint64)))
        return pd.DataFrame({"shard": [held["shard"].iloc[0]], "filter": [kept.dump()]})

    return filters.groupBy("shard").cogroup(gone.groupBy("shard")).applyInPandas(drop, "shard int, filter binary")


def drop_lines(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1,
               carry: tuple[str, ...] = ()) -> DataFrame:
    """(id column, rid, kb, kept, n_lines, n_dropped, columns of ``carry``) of every row without the lines whose keys are in ``repeated``.

    Texts are split at line feeds; a NULL or empty text is one empty line. The other lines stay as they are,
    in order, joined by line feeds; a text that loses all lines becomes empty. Keys shorter than ``min_chars``
    are never dropped. Only (row, key) pairs are joined; texts meet the keys that they lose.
    """
    rows = texts(docs, id_col, text_col, carry)
    pairs = rows.select("rid", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), line_key))).alias("key"))
    pairs = pairs.filter(F.char_length("key") >= min_chars).select("rid", *hashes(F.col("key")))
    lost = pairs.join(repeated, ["k1", "k2"]).groupBy("rid").agg(F.collect_set("k1").alias("lost"))
    met = rows.join(lost, "rid", "left").select("id", "rid", "kb", "text", "lost", *(["rest"] if carry else []))
    kind = docs.schema[id_col].dataType
    rest = [met.schema["rest"]] if carry else []
    schema = pa.schema([("id", arrow_type(kind)), ("rid", pa.int64()), ("kb", pa.int64()), ("kept", pa.string()),
                        ("n_lines", pa.int64()), ("n_dropped", pa.int64()), *[("rest", arrow_type(f.dataType)) for f in rest]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in byte_slices(batches, "text"):
            raw, kept, n_lines, n_dropped = data.tobytes(), [], [], []
            for (a, b), gone in zip(itertools.pairwise(offsets.tolist()), batch.column(4).to_pylist()):
                text = raw[a:b]
                lines = text.split(b"\n")
                stay = lines
                if gone:
                    gone = set(gone)
                    stay = [x for x in lines if len(key := x.strip(_BLANKS).translate(_FOLD)) == 0 or _signed(key) not in gone]
                kept.append(text.decode() if stay is lines else b"\n".join(stay).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield record(schema, *batch.columns[:3], kept, n_lines, n_dropped, *batch.columns[5:])

    out = T.StructType([T.StructField("id", kind), T.StructField("rid", T.LongType()), T.StructField("kb", T.LongType()),
                        T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), *rest])
    cut = met.mapInArrow(run, out)
    return cut.select(F.col("id").alias(id_col), "rid", "kb", "kept", "n_lines", "n_dropped", *[F.col("rest")[c].alias(c) for c in carry])


_BLANKS = BLANKS.encode()
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def _signed(key: bytes) -> int:
    """The hash that Spark gives a string of these bytes."""
    value = xxhash.xxh64_intdigest(key, 42)
    return value - (1 << 64) if value >> 63 else value
