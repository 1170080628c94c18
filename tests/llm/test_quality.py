"""The factorisation machine against plain sums, on held-out labels, and on odd rows."""

import itertools
import random
import zlib

import numpy as np

from costlake.llm import quality

DOCS = "doc_id bigint, text string, n_chars bigint, id string, label int, score string"  # clashing names on purpose


def plain_margin(slots, values, bias, weights, vectors):
    own = sum(float(weights[s]) * float(x) for s, x in zip(slots, values))
    pairs = sum(float(vectors[i] @ vectors[j]) * float(x) * float(y) for (i, x), (j, y) in itertools.combinations(zip(slots, values), 2))
    return bias + own + pairs


def test_margins_are_the_sums_over_all_pairs():
    rng = np.random.default_rng(2)
    lengths = [1, 4, 9, 30]
    starts = np.concatenate([[0], np.cumsum(lengths)])
    slots, values = rng.integers(0, 50, starts[-1]), rng.random(starts[-1])
    weights, vectors = rng.normal(size=50), rng.normal(size=(50, 8))
    got = quality.margins(slots, values, starts, 0.3, weights, vectors)
    want = [plain_margin(slots[a:b], values[a:b], 0.3, weights, vectors) for a, b in itertools.pairwise(starts)]
    assert np.allclose(got, want)


def test_pairs_are_learnt_that_no_single_feature_tells():
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2, (2_000, 2))
    slots = (bits + [0, 2]).ravel()  # one slot for each value of either bit; the label is their exclusive or
    labels = (bits[:, 0] ^ bits[:, 1]).astype(float)
    starts = np.arange(0, 2 * len(labels) + 1, 2)
    model = quality.fit(slots, np.ones(len(slots)), starts, labels, 4)
    assert ((quality.margins(slots, np.ones(len(slots)), starts, *model) > 0) == labels).mean() > 0.99


def test_structure_of_a_text():
    found = dict(zip(quality.STATISTICS, quality.describe("AB ab!\nAB ab!\n é12 |".encode())[2]))
    assert found["upper"] == 4 / 21 and found["digits"] == 2 / 21 and found["shouts"] == 2 / 21 and found["bars"] == 1 / 21
    assert found["distinct_words"] == 2 / 5 and found["commonest_word"] == 4 / 5 and found["echoes"] == 3 / 5
    assert found["distinct_lines"] == 2 / 3 and found["ended_lines"] == 2 / 3
    assert all(np.isfinite(quality.describe(b"")[2])) and not len(quality.describe(b"")[0])


def test_quality_is_learnt_and_every_row_scored(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(700):
        good = rng.random() < 0.8
        found = [f"w{rng.randrange(300)}" for _ in range(40)]
        text = " ".join(found) if good else rng.choice([" ".join(found).upper(), " ".join(found[:2] * 20), "!! ".join(found)])
        rows.append((i, text, len(text), "x", 5, "y"))
        labels.append((i, int(good)))
    odd = [(900, None, None, None, None, None), (901, "", 0, None, None, None), (None, "w1 w2", 5, None, None, None),
           (902, "long " * 200_000, None, None, None, None), (3, rows[3][1], rows[3][2], None, None, None)]
    docs = spark.createDataFrame(rows + odd, DOCS).repartition(4)
    known = spark.createDataFrame(labels + [(None, 1), (5, None), (6, labels[6][1])], "doc_id bigint, quality int")
    model = quality.train(docs, known, numbers=("n_chars",))
    got = quality.score(docs, model, numbers=("n_chars",)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    scores = {r.doc_id: r.score for r in got}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((scores[i] >= 0.5) == y for i, y in held) / len(held) > 0.95
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    slots, values, statistics = quality.describe(rows[0][1].encode())
    bins = model.bins(np.array([[*statistics, rows[0][2]]]))[0]
    margin = plain_margin([*slots, *bins], [*values] + [1.0] * len(bins), model.bias, model.weights, model.vectors)
    assert abs(scores[0] - 1 / (1 + np.exp(-margin))) < 1e-4


def test_held_out_labels_are_not_looked_at(spark):
    rows = [(i, "good words here" if i % 2 else "BAD!! BAD!!") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    used = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert len(used) < 200
    made = [quality.train(docs, spark.createDataFrame([(i, i % 2 if i in used else flip) for i, _ in rows], "doc_id bigint, quality int")) for flip in (0, 1)]
    assert all(np.array_equal(a, b) for a, b in zip(made[0].edges, made[1].edges)) and np.array_equal(made[0].vectors, made[1].vectors)


def test_without_examples_or_documents(spark):
    nothing = spark.createDataFrame([], DOCS)
    docs = spark.createDataFrame([(1, "a b", 3, None, None, None)], DOCS)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert [r.score for r in quality.score(docs, quality.train(docs, none)).collect()] == [0.5]
    assert quality.score(nothing, quality.train(nothing, none), numbers=()).count() == 0
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert quality.score(docs, quality.train(docs, one)).first().score > 0.9
