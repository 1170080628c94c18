"""BPE encoding and decoding through a table of distinct words.

Words are cut at ASCII white space, which the tokenizer drops and across which neither its
normalisation nor its merges reach, so a text's ids are those of its words one after another.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import arrow_type, byte_slices, record, stow, texts

#: The driver and every worker hold at most this many words of at most this many characters.
HEAD_WORDS, HEAD_CHARS = 131_072, 48
#: Words outside the head that a task remembers before it forgets them all.
RECENT_WORDS = 200_000
#: Bytes of text that are split into words at a time, and ids that are decoded at a time.
SLICE, SLICE_IDS = 500_000, 200_000

SPLIT = "[ \\t\\n\\x0B\\f\\r]+"
_TABLE_SCHEMA = pa.schema([("word", pa.string()), ("ids", pa.binary())])


def load(path: str):
    """The tokenizer of a file without truncation and padding, one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode_words(tokenizer, words: list[str]) -> list[bytes]:
    """The ids of each word as 32-bit integers. The words go through the tokenizer as one text, and each id belongs to the word it ends in."""
    coded = tokenizer.encode(" ".join(words), add_special_tokens=False)
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])[:-1]
    inside = np.fromiter((max(a, b - 1) for a, b in coded.offsets), np.int64, len(coded.ids))
    ends = np.cumsum(np.bincount(np.searchsorted(starts, inside, "right") - 1, minlength=len(words))).tolist()
    ids = np.array(coded.ids, np.int32)
    return [ids[a:b].tobytes() for a, b in itertools.pairwise([0, *ends])]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of every distinct word."""
    words = docs.select(F.explode(F.split(F.coalesce(docs[text_col].cast("string"), F.lit("")), SPLIT)).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def word_table(words: DataFrame, path: str) -> DataFrame:
    """(word, ids binary): each word of ``words`` encoded once, its ids as 32-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            yield record(_TABLE_SCHEMA, batch.column(0), encode_words(tokenizer, batch.column(0).to_pylist()))

    return words.select("word").mapInArrow(run, "word string, ids binary")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           head_words: int = HEAD_WORDS) -> DataFrame:
    """(id column, ids array<int>) of every row, the ids as the tokenizer gives them for the whole text.

    Spark counts the distinct words; the most frequent ones, at most ``head_words`` (a fixed bound on number and
    length, so also on what is broadcast), are encoded once each as a table, which is joined back by
    position in every text. Rarer words are encoded where they occur, once per slice of texts: sending them
    through a shuffle would move the whole corpus a second time. NULL and empty texts give an empty list;
    a text that is one very long word is never in the head; repeated rows and NULL ids are kept.
    """
    spark = docs.sparkSession
    counts = stow(word_counts(docs, text_col).filter((F.length("word") <= HEAD_CHARS) & (F.col("n") > 1)), "word-counts")
    table = word_table(counts.filter(F.col("n") >= least_count(counts, head_words)), path).toArrow().combine_chunks()
    shared = spark.sparkContext.broadcast((_column(table, "word", pa.string()), _column(table, "ids", pa.binary())))
    id_type = docs.schema[id_col].dataType
    schema = pa.schema([("id", arrow_type(id_type)), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, recent = load(path), {}
        head, head_ids = shared.value
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            words, starts = split(data, offsets)
            coded = words.dictionary_encode()
            place = pc.index_in(coded.dictionary, value_set=head)
            of = head_ids.take(place).to_pylist()  # None outside the head
            rare_at = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
            distinct = [w.encode() for w in coded.dictionary.take(pa.array(rare_at)).to_pylist()]
            rare = [w for w in distinct if w not in recent]
            if len(recent) + len(rare) > RECENT_WORDS:
                recent, rare = {}, distinct
            for low in range(0, len(rare), 4096):
                part = rare[low:low + 4096]
                recent.update(zip(part, encode_words(tokenizer, [w.decode() for w in part])))
            for k, w in zip(rare_at.tolist(), distinct):
                of[k] = recent[w]
            size = np.fromiter(map(len, of), np.int64, len(of)) // 4
            flat = np.frombuffer(b"".join(of), np.int32)
            index = coded.indices.to_numpy()
            wide, begin = size[index], (np.cumsum(size) - size)[index]
            ends = np.concatenate([[0], np.cumsum(wide)])
            at = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], wide)
            lists = pa.ListArray.from_arrays(pa.array(ends[starts], pa.int32()), pa.array(flat[at]))
            yield record(schema, batch.column(0), lists)

    out = T.StructType([T.StructField("id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return texts(docs, id_col, text_col).select("id", "text").mapInArrow(run, out).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that the tokenizer decodes from the ids (special tokens kept).

    The id-to-piece table is the vocabulary, whose size the file fixes. The file names no decoder, so
    pieces are joined by single spaces; a file with a decoder is refused. Unknown ids are left out, as the
    library does; a NULL list gives NULL, an empty one the empty text.
    """
    tokenizer = load(path)
    if tokenizer.decoder is not None:
        raise ValueError("this tokenizer joins pieces by a rule of its own")
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    pieces = encoded.sparkSession.sparkContext.broadcast([tokenizer.id_to_token(i) for i in range(size)])
    schema = T.StructType(list(encoded.schema) + [T.StructField(out_col, T.StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(pieces.value, pa.string())
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(ends, ends[low] + SLICE_IDS, "right")) - 1)
                part = batch.slice(low, high - low)
                column = part.column(at)
                ids = column.flatten().to_numpy(zero_copy_only=False)  # without what lies under NULL lists
                inside = np.flatnonzero((ids >= 0) & (ids < size))
                found = table.take(pa.array(ids[inside]))  # the join with the id-to-piece table
                named = found.is_valid().to_numpy(zero_copy_only=False)
                bounds = np.searchsorted(inside[named], ends[low:high + 1] - ends[low])
                # beside each other, then NULL where the list is NULL
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found.drop_null()), " ")
                made = pc.if_else(column.is_valid(), joined, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, out_col])
                low = high

    return encoded.mapInArrow(run, schema)


def least_count(counts: DataFrame, head_words: int) -> int:
    """From which count on words are in the head, so that it has at most so many words."""
    by = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(head_words)
    total, least = 0, 1 << 62
    for row in by.toLocalIterator():
        total += row["words"]
        if total > head_words:
            break
        least = row["n"]
    return least


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, starts) of some texts: their words one after another, and where each text's begin."""
    texts_ = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    parts = pc.ascii_split_whitespace(texts_)
    words = parts.flatten()
    filled = np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)])
    starts = filled[np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])]
    return words.filter(pc.greater(pc.binary_length(words), 0)), starts


def _column(table: pa.Table, name: str, kind: pa.DataType) -> pa.Array:
    """A column as one array of the type."""
    column = table.column(name).cast(kind)
    return column.chunk(0) if column.num_chunks else pa.array([], kind)
