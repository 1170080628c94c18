"""Text quality by a factorisation machine.

A text becomes a sparse vector: its hashed words (counts, scaled to length 1), one bin for each statistic of its
structure and one for each number of its metadata. The machine's margin is

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

where v_i are short vectors, so that every pair of features has a weight without a table of pairs. The pair term
is summed in linear time by the identity  sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2) / 2.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import LOWER, UPPER, arrow_type, byte_slices

#: Bound of the training sample: labelled texts with the least hashes of their ids.
MOST_TEXTS = 12_000
#: Slots of hashed words, length of the vectors v, bins of a statistic.
SLOTS, RANK, BINS = 1 << 15, 8, 16
#: Passes over the sample, and steps that a small sample takes all the same.
EPOCHS, LEAST_STEPS = 6, 160
BATCH, RATE, DECAY = 512, 0.05, 3e-3
#: Steps of the vectors against those of the weights: pairs of rare words fit any sample, so they learn slowly.
VECTOR_PACE = 0.25
#: Bytes of text that are scored at a time; one longer text is a slice of its own.
SLICE = 250_000

#: Structure of a text, in the order of :func:`structure`.
STATISTICS = ("upper", "digits", "blanks", "marks", "shouts", "bars", "beyond_ascii", "word_length", "distinct_words", "commonest_word",
              "echoes", "line_length", "distinct_lines", "ended_lines", "length")

#: ASCII letters in lower case; digits and letters beyond ASCII as they are; everything else parts words.
_FOLD = bytes.maketrans(UPPER.encode() + bytes(c for c in range(128) if not chr(c).isalnum()),
                        LOWER.encode() + b" " * sum(not chr(c).isalnum() for c in range(128)))
_CODE = np.arange(256)
_UPPER, _DIGIT = (_CODE >= 65) & (_CODE <= 90), (_CODE >= 48) & (_CODE <= 57)
_BLANK = (_CODE == 32) | ((_CODE >= 9) & (_CODE <= 13))
_MARK = (_CODE > 32) & (_CODE < 127) & ~_DIGIT & ~_UPPER & ~((_CODE >= 97) & (_CODE <= 122))


def structure(text: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """The statistics of a UTF-8 text in the order of :data:`STATISTICS`; all are defined for an empty text."""
    n, seen = max(1, len(text)), np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = text.split(b"\n")
    n_words = max(1, len(words))
    echoes = sum(map(bytes.__eq__, words, itertools.islice(words, 1, None)))
    ended = sum(line.rstrip()[-1:] in (b".", b"!", b"?", b":") for line in lines)
    return [seen[_UPPER].sum() / n, seen[_DIGIT].sum() / n, seen[_BLANK].sum() / n, seen[_MARK].sum() / n, seen[33] / n, seen[124] / n,
            seen[128:].sum() / n, sum(map(len, words)) / n_words, len(counts) / n_words, max(counts.values(), default=0) / n_words,
            echoes / n_words, math.log1p(len(text) / len(lines)), len(set(lines)) / len(lines), ended / len(lines), math.log1p(len(text))]


def describe(text: bytes) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(slots, values, statistics) of a text: every distinct word's slot with its count scaled to length 1.

    Words that share a slot stay two features of the same weights.
    """
    words = text.translate(_FOLD).split()
    counts = Counter(words)
    slots = np.fromiter((crc32(w) & (SLOTS - 1) for w in counts), np.int32, len(counts))
    values = np.fromiter(counts.values(), np.float32, len(counts))
    if len(values):
        values /= np.float32(math.sqrt(float(values.astype(np.float64) @ values)))
    return slots, values, structure(text, words, counts)


@dataclass(frozen=True)
class Machine:
    """Bin edges of each number, then bias, weights and vectors of all slots: words first, then the numbers' bins."""

    edges: list[np.ndarray]
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def bins(self, numbers: np.ndarray) -> np.ndarray:
        """The slot of each number of each row; a number that is missing (NaN) has a bin of its own."""
        slots = [np.where(np.isnan(column), BINS, np.searchsorted(edges, column, "right")) + SLOTS + k * (BINS + 1)
                 for k, (edges, column) in enumerate(zip(self.edges, numbers.T))]
        return np.stack(slots, axis=1).astype(np.int32)


def width(numbers: int) -> int:
    """Slots of a machine with so many numbers."""
    return SLOTS + numbers * (BINS + 1)


def margins(slots: np.ndarray, values: np.ndarray, starts: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The margin of each row; row i is ``slots[starts[i]:starts[i + 1]]``, and none is empty."""
    scaled = vectors[slots] * values[:, None]
    inside = np.add.reduceat(scaled, starts[:-1], axis=0)
    own = np.add.reduceat((scaled * scaled).sum(axis=1), starts[:-1])
    return bias + np.add.reduceat(weights[slots] * values, starts[:-1]) + 0.5 * ((inside * inside).sum(axis=1) - own)


def bin_edges(column: np.ndarray) -> np.ndarray:
    """Where a number's bins part: some at quantiles of the rows, some at quantiles of the distinct values, which tell rare values apart."""
    known = column[~np.isnan(column)]
    if not len(known):
        return np.zeros(0)
    shares = np.arange(1, BINS // 2) / (BINS // 2)
    return np.unique(np.concatenate([np.quantile(known, shares), np.quantile(np.unique(known), shares)]))


def fit(slots: np.ndarray, values: np.ndarray, starts: np.ndarray, labels: np.ndarray, size: int, seed: int = 7) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, weights, vectors) by Adam on the logistic loss, in batches of a fixed random order."""
    rng = np.random.default_rng(seed)
    share = min(max(float(labels.mean()), 1e-3), 1 - 1e-3)
    # one matrix: column 0 the weights, the others the vectors
    table = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.05, (size, RANK))], axis=1)
    bias, first, second = math.log(share / (1 - share)), np.zeros_like(table), np.zeros_like(table)
    bias_first = bias_second = 0.0
    pace = np.array([1.0] + [VECTOR_PACE] * RANK)
    step = 0
    lengths = np.diff(starts)
    for _ in range(max(EPOCHS, math.ceil(LEAST_STEPS / math.ceil(len(labels) / BATCH)))):
        order = rng.permutation(len(labels))
        for low in range(0, len(order), BATCH):
            rows = order[low:low + BATCH]
            n = lengths[rows]
            own = np.concatenate([[0], np.cumsum(n)])
            at = np.arange(own[-1]) - np.repeat(own[:-1] - starts[rows], n)
            s, x = slots[at], values[at].astype(np.float64)
            scaled = table[s, 1:] * x[:, None]
            inside = np.add.reduceat(scaled, own[:-1], axis=0)
            pairs = 0.5 * ((inside * inside).sum(axis=1) - np.add.reduceat((scaled * scaled).sum(axis=1), own[:-1]))
            margin = bias + np.add.reduceat(table[s, 0] * x, own[:-1]) + pairs
            slope = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[rows]) / len(rows)
            per_row = np.repeat(slope, n)
            grown = np.column_stack([per_row * x, (per_row * x)[:, None] * (np.repeat(inside, n, axis=0) - scaled)])
            used, place = np.unique(s, return_inverse=True)
            gradient = np.stack([np.bincount(place, column, len(used)) for column in grown.T], axis=1) + DECAY * table[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * gradient
            second[used] = 0.999 * second[used] + 0.001 * gradient ** 2
            rate = RATE * math.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            table[used] -= rate * pace * first[used] / (np.sqrt(second[used]) + 1e-9)
            bias_first, bias_second = 0.9 * bias_first + 0.1 * slope.sum(), 0.999 * bias_second + 0.001 * slope.sum() ** 2
            bias -= rate * bias_first / (math.sqrt(bias_second) + 1e-9)
    return float(bias), table[:, 0].astype(np.float32), table[:, 1:].astype(np.float32)


def used_in_training(doc_id: Column, holdout: int) -> Column:
    """Whether a row's label may be learnt from: its crc32 as text doesn't leave 0 modulo ``holdout``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(holdout)) != 0


def sample(docs: DataFrame, labels: DataFrame, holdout: int = 5, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", numbers: tuple[str, ...] = ()) -> DataFrame:
    """(text, label, numbers) of the bounded sample: one row for each of the ids with the least hashes.

    An id with several labels counts with their mean, one with several texts with the least text. NULL ids and
    NULL labels are no examples.
    """
    known = labels.filter(used_in_training(F.col(id_col), holdout) & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    known = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(MOST_TEXTS)
    text = docs.select(F.col(id_col).alias("id"), F.struct(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                                                           _numbers(docs, numbers).alias("numbers")).alias("row"))
    return (text.join(F.broadcast(known), "id")  # at most MOST_TEXTS ids
            .groupBy("id").agg(F.min("row").alias("row"), F.first("label").alias("label")).select("row.text", "label", "row.numbers"))


def _numbers(docs: DataFrame, numbers: tuple[str, ...]) -> Column:
    return F.array(*[F.coalesce(docs[c].cast("double"), F.lit(float("nan"))) for c in numbers]).cast("array<double>")


def train(docs: DataFrame, labels: DataFrame, holdout: int = 5, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", numbers: tuple[str, ...] = ()) -> Machine:
    """A machine from a bounded sample of ``docs`` and ``labels``; ``numbers`` names numeric metadata columns.

    With no example, every text scores 0.5; with one kind of label only, all score near it. NULL texts count as empty.
    """
    kind = "slots array<int>, parts array<float>, numbers array<double>, label double"
    schema = pa.schema([("slots", pa.list_(pa.int32())), ("parts", pa.list_(pa.float32())), ("numbers", pa.list_(pa.float64())), ("label", pa.float64())])

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            raw = data.tobytes()
            found = [describe(raw[a:b]) for a, b in itertools.pairwise(offsets.tolist())]
            more = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], schema.field(0).type), pa.array([f[1] for f in found], schema.field(1).type),
                                              pa.array([f[2] + m for f, m in zip(found, more)], schema.field(2).type), batch.column(1)], schema=schema)

    rows = sample(docs, labels, holdout, id_col, text_col, label_col, numbers).mapInArrow(vectors, kind).toArrow().combine_chunks()
    count = len(STATISTICS) + len(numbers)
    if not rows.num_rows:
        return Machine([np.zeros(0)] * count, 0.0, np.zeros(width(count), np.float32), np.zeros((width(count), RANK), np.float32))
    columns = {c: rows.column(c).combine_chunks() for c in rows.column_names}
    table = columns["numbers"].flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, count)
    edges = [bin_edges(column) for column in table.T]
    shape = Machine(edges, 0.0, np.zeros(0), np.zeros(0))
    slots, values, starts = joined(columns["slots"].flatten().to_numpy(), columns["parts"].flatten().to_numpy(),
                                   columns["slots"].value_lengths().to_numpy(), shape.bins(table))
    return Machine(edges, *fit(slots, values, starts, columns["label"].to_numpy(), width(count)))


def joined(slots: np.ndarray, values: np.ndarray, lengths: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, values, starts) of rows that have their words first and then their bins, each with value 1."""
    more = bins.shape[1]
    starts = np.concatenate([[0], np.cumsum(lengths + more)])
    is_word = np.ones(starts[-1], bool)
    tail = (starts[1:, None] - more + np.arange(more)).ravel()
    is_word[tail] = False
    all_slots, all_values = np.empty(starts[-1], np.int32), np.ones(starts[-1], np.float32)
    all_slots[tail] = bins.ravel()
    all_slots[is_word], all_values[is_word] = slots, values
    return all_slots, all_values, starts


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", numbers: tuple[str, ...] = ()) -> DataFrame:
    """(id column, score double) of every row: the share of label 1 that the machine expects.

    Whole texts are read, in slices of rows; NULL texts count as empty and a NULL number has a bin of its own. Rows
    that are the same score the same. Other columns, whatever their names, are neither read nor returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # its size is fixed: SLOTS and bins times RANK + 1
    kind = docs.schema[id_col].dataType
    slim = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), _numbers(docs, numbers).alias("numbers"))
    schema = pa.schema([("id", arrow_type(kind)), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch, data, offsets in byte_slices(batches, "text", SLICE):
            raw = data.tobytes()
            found = [describe(raw[a:b]) for a, b in itertools.pairwise(offsets.tolist())]
            table = np.array([f[2] + m for f, m in zip(found, batch.column(2).to_pylist())], np.float64)
            rows = joined(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]),
                          np.array([len(f[0]) for f in found]), known.bins(table))
            margin = margins(*rows, known.bias, known.weights, known.vectors)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -40, 40))))], schema=schema)

    return slim.mapInArrow(run, T.StructType([T.StructField("id", kind), T.StructField("score", T.DoubleType())])).withColumnRenamed("id", id_col)
