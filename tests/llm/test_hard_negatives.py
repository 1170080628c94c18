"""Hard negatives against brute force, with pruning that bites, and on odd rows."""

import itertools
import math

import numpy as np
import pytest

from costlake.llm import hard_negatives as hard

SCHEMA = "vec_id bigint, embedding array<double>, label int, key string, chunk int, bands string"  # clashing names on purpose


def brute_force(rows, positives=5, negatives=10, every=100):
    seen = {}
    for vec_id, vector, label in rows:
        if vec_id is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            seen[vec_id, label, tuple(math.floor(256 * x) for x in vector)] = None
    out = []
    for a, label, v in seen:
        if a % every:
            continue
        others = [(sum(x * y for x, y in zip(v, w)), i, k, w) for i, k, w in seen if len(v) == len(w) and (i, k, w) != (a, label, v)]
        others.sort(key=lambda r: (-r[0], r[1]))
        for score, i, _, _ in [r for r in others if r[2] == label][:positives]:
            far = [r for r in others if r[2] != label and 30 * score <= 100 * r[0] <= 90 * score][:negatives]
            out += [(a, i, n + 1, r[1], score, r[0]) for n, r in enumerate(far)]
    return sorted(out)


def found(frame, **more):
    return sorted(map(tuple, hard.mine(frame, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(hard, "CHUNK_CELLS", 600)
    monkeypatch.setattr(hard, "BLOCK_CELLS", 40)
    monkeypatch.setattr(hard, "BUCKET", 16)
    monkeypatch.setattr(hard, "BLOCKS_A_TASK", 2)


def make(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("case", ["noise", "clusters", "lengths", "ties"])
def test_is_the_brute_force(spark, small_parts, case):
    rng = np.random.default_rng(7)
    n, dims = 400, 12
    v = rng.standard_normal((n, dims)) / math.sqrt(dims)
    if case == "clusters":
        v = rng.standard_normal((8, dims))[rng.integers(0, 8, n)] + 0.3 * v
    if case == "lengths":
        v *= np.exp(2 * rng.standard_normal((n, 1)))
    if case == "ties":
        v = np.round(v * 2) / 2
    rows = [(int(i * 5), x.tolist(), int(k)) for i, (x, k) in enumerate(zip(v, rng.integers(0, 4, n)))]
    want = brute_force(rows)
    assert want and found(make(spark, rows)) == want


def test_pruning_skips_but_loses_nothing():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((10, 16))
    rows = centres[rng.integers(0, 10, 500)] + 0.1 * rng.standard_normal((500, 16))
    whole = np.floor(256 * rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.int64)
    bucket = hard.buckets(np.arange(500), np.arange(500), np.zeros(500), whole)[0]
    anchors = whole[:40]
    length = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
    unit = anchors / length[:, None]
    scores = hard.inner(anchors, bucket.whole)
    bar = 0.9 * length * length
    got = hard.candidates(unit, np.argsort(-np.abs(unit), axis=1)[:, :hard.FOCUS], bar / (length * bucket.longest), bucket)
    assert got[scores >= bar[:, None]].all() and got.mean() < 0.5


def test_odd_rows(spark, small_parts):
    rng = np.random.default_rng(5)
    rows = [(i * 10, (rng.standard_normal(6)).tolist(), i % 3) for i in range(60)]
    rows += [rows[0], rows[10], (100, (-rng.standard_normal(6)).tolist(), 1), (None, rows[1][1], 1), (5, None, 1), (6, rows[2][1], None),
             (7, [None] * 6, 1), (8, [math.nan] * 6, 1), (9, [math.inf] + [1.0] * 5, 1), (-100, rows[7][1], 2), (700, [1.0, 2.0], 1), (701, [1.0, 2.5], 1),
             (702, [0.5, 1.0], 2), (800, [], 1), (801, [], 1), (802, [], 2), (900, [0.0] * 6, 0), (1000, rows[9][1], 0)]
    assert found(make(spark, rows)) == brute_force(rows)
    assert found(make(spark, rows).limit(0)) == []
    only = [(100 * i, [1.0, float(i)], 0) for i in range(5)]  # one label: no negatives
    assert found(make(spark, only)) == []


def test_very_large_components_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i * 50, (rng.integers(-2 ** 20, 2 ** 20, 4) * 2.0 ** 3).tolist(), i % 2) for i in range(12)]
    assert found(make(spark, rows)) == brute_force(rows)
    big = np.array([[2 ** 40, 3], [-2 ** 41, 5]], np.int64)
    assert hard.inner(big, big).tolist() == [[HIGH := (1 << 63) - 1, -(1 << 63)], [-(1 << 63), HIGH]]


def test_whole_groups_span_batches():
    import pyarrow as pa

    rows = [(a, b, c) for a, b in itertools.product(range(3), range(2)) for c in range(5)]
    table = pa.table({"a": [r[0] for r in rows], "b": [r[1] for r in rows], "c": [r[2] for r in rows]})
    for size in (1, 3, 100):
        got = [(key, part.column("c").to_pylist()) for key, part in hard.whole_groups(table.to_batches(max_chunksize=size), 2)]
        assert got == [((a, b), list(range(5))) for a, b in itertools.product(range(3), range(2))]
