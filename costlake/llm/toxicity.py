"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the words of a text is trained from texts confirmed as toxic (P) and texts of which
nothing is known (U). With the class prior, U's risk as clean texts is corrected by P's share of it; where the
corrected risk goes negative it is set back, which keeps the model from memorising U.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import LOWER, UPPER, byte_slices

#: Bounds of the training sample (the texts with the least hashes of their ids) and of the vocabulary.
MOST_POSITIVE, MOST_UNLABELLED, MOST_WORDS = 4_000, 8_000, 65_536
#: Lengths of the beginnings of words, in bytes.
PREFIXES = (3, 4, 5, 6)
#: A feature has to be in so many sampled texts.
LEAST_TEXTS = 8
EPOCHS, RATE, DECAY = 300, 0.02, 1e-3
#: Bytes of text that are scored at a time; one longer text is a slice of its own.
SLICE = 250_000
#: Deviations by which a feature has to be more frequent in P than in U.
TELLING = 5.0

#: ASCII letters in lower case, everything else of ASCII that parts words as blanks.
_FOLD = bytes.maketrans(UPPER.encode() + bytes(c for c in range(128) if not chr(c).isalnum()),
                        LOWER.encode() + b" " * sum(not chr(c).isalnum() for c in range(128)))


def features(text: bytes) -> set[bytes]:
    """The distinct words of a UTF-8 text and their beginnings of a few lengths, marked by ``^``."""
    words = set(text.translate(_FOLD).split())
    return words.union(*({b"^" + w[:n] for w in words if len(w) > n} for n in PREFIXES))


@dataclass(frozen=True)
class Model:
    """Weights by word; a text's margin is the sum over its distinct words plus the bias."""

    weights: dict[bytes, float]
    bias: float

    def margin(self, text: bytes) -> float:
        get = self.weights.get
        return self.bias + sum(w for w in map(get, features(text)) if w is not None)


def train_rows(docs: DataFrame, labels: DataFrame, holdout: int = 5, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, positive) of the sample that a model is fitted on: bounded, by the least hashes of ids.

    Rows whose crc32 of the id as text leaves 0 modulo ``holdout`` are never used. P are ids with label 1, U
    any ids of documents, labelled or not; the label of a text in U is not looked at. NULL ids are left out.
    """
    used = lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(holdout)) != 0
    known = labels.filter(used(F.col(id_col)) & (F.col(label_col) == 1)).select(F.col(id_col).alias("id")).distinct()
    known = known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    known = known.orderBy(F.xxhash64("id"), "id").limit(MOST_POSITIVE)
    other = docs.filter(used(F.col(id_col))).select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id", F.lit(1)), "id").limit(MOST_UNLABELLED)
    return known.withColumn("positive", F.lit(True)).unionByName(other.withColumn("positive", F.lit(False)))


def class_prior(labels: DataFrame, holdout: int = 5, id_col: str = "doc_id", label_col: str = "toxic") -> float:
    """The share of toxic texts among the labelled rows that training may see."""
    used = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(holdout)) != 0
    share = labels.filter(used).agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    return 0.0 if share is None else float(share)


def fit_non_negative(indices: np.ndarray, starts: np.ndarray, positive: np.ndarray, width: int, prior: float) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise the non-negative risk with the logistic loss, by Adam on all rows.

    Risk: prior * R_P(toxic) + max(0, R_U(clean) - prior * R_P(clean)). Rows are sets of features:
    ``indices[starts[i]:starts[i + 1]]``.
    """
    rows = np.repeat(np.arange(len(positive)), np.diff(starts))
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    weights, bias = np.zeros(width), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    for epoch in range(1, EPOCHS + 1):
        margin = np.bincount(rows, weights[indices], len(positive)) + bias
        toxic = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        loss = np.logaddexp(0, margin)  # of a text taken as clean
        rest = loss[~positive].mean() - prior * loss[positive].mean()
        clean = np.where(positive, -prior / n_p, 1 / n_u) * toxic
        # below zero the corrected risk is only led back up
        grow = -clean if rest < 0 else clean - np.where(positive, prior / n_p, 0.0) * (1 - toxic)
        gradient = np.append(np.bincount(indices, grow[rows], width) + DECAY * weights, grow.sum())
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient ** 2 - second)
        step = RATE * (first / (1 - 0.9 ** epoch)) / (np.sqrt(second / (1 - 0.999 ** epoch)) + 1e-9)
        weights -= step[:-1]
        bias -= float(step[-1])
    return weights, bias


def telling(indices: np.ndarray, starts: np.ndarray, positive: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices, starts) of the features that are clearly more frequent in P than in U; the others only add noise."""
    rows = np.repeat(np.arange(len(positive)), np.diff(starts))
    of_p = positive[rows]
    n_p, n_u = positive.sum(), (~positive).sum()
    in_p, in_u = np.bincount(indices[of_p], minlength=width), np.bincount(indices[~of_p], minlength=width)
    both = (in_p + in_u) / (n_p + n_u)
    apart = (in_p / n_p - in_u / n_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    kept = (apart >= TELLING)[indices]
    return indices[kept], np.concatenate([[0], np.cumsum(np.bincount(rows[kept], minlength=len(positive)))])


def train(docs: DataFrame, labels: DataFrame, holdout: int = 5, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """A model from a bounded sample of ``docs`` and ``labels``.

    Without a toxic example (or without documents) nothing can be learnt and every text scores as the prior
    says. NULL labels are no examples; NULL texts count as empty.
    """
    prior = min(max(class_prior(labels, holdout, id_col, label_col), 1e-3), 0.9)
    sample = train_rows(docs, labels, holdout, id_col, label_col)
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chosen = text.join(F.broadcast(sample), "id").select("text", "positive")  # at most MOST_POSITIVE + MOST_UNLABELLED ids

    def distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in byte_slices(batches, "text"):
            raw = data.tobytes()
            found = [sorted(features(raw[a:b])) for a, b in itertools.pairwise(offsets.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary())), batch.column(1)], names=["words", "positive"])

    rows = chosen.mapInArrow(distinct, "words array<binary>, positive boolean")
    # only words of several sampled texts can carry weight; the others never leave the executors
    seen = rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TEXTS)
    table = [bytes(r[0]) for r in seen.filter(F.length("word") <= 64).orderBy(F.desc("n"), "word").limit(MOST_WORDS).collect()]
    place = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(table)})

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = place.value.get
        for batch in batches:
            found = [[i for i in map(get, row) if i is not None] for row in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["features", "positive"])

    data = rows.mapInArrow(numbered, "features array<int>, positive boolean").toArrow()
    place.destroy()  # scoring needs the weights only
    positive = data.column("positive").to_numpy().astype(bool)
    if not len(positive) or not positive.any() or positive.all():
        return Model({}, float(np.log(prior / (1 - prior))))
    found = data.column("features").combine_chunks()
    starts = np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy())])
    weights, bias = fit_non_negative(*telling(found.flatten().to_numpy(), starts, positive, len(table)), positive, len(table), prior)
    return Model({w: float(x) for w, x in zip(table, weights) if abs(x) > 1e-6}, bias)


def score_rows(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score of each row's whole text; empty and NULL texts score by the bias.

    A column of ``docs`` that is called like ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # at most MOST_WORDS weights
    docs = docs.drop(out_col)
    schema = T.StructType([*docs.schema, T.StructField(out_col, T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for part, data, offsets in byte_slices(batches, text_col, SLICE):
            margins = np.array([known.margin(data[a:b].tobytes()) for a, b in itertools.pairwise(offsets.tolist())])
            scores = pa.array(1 / (1 + np.exp(-np.clip(margins, -40, 40))), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, out_col])

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id column, score double) of every row, by :func:`score_rows`."""
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return score_rows(slim, model).select(id_col, "score")
