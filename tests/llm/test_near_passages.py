"""What the order of shingles and the way contents are compared must not change in near-duplicate passages."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from costlake.llm import substring_dedup
from costlake.llm.substring_dedup import Shingles


def words(rng, n):
    return [f"w{rng.randrange(9000)}" for _ in range(n)]


def hashed(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])


def test_passages_exactly_at_the_similarity_are_near():
    # 40 unlike shingles and 32 of them
    a, b = (np.array([*range(100, 100 + n), *[100] * (46 - n)], np.uint32) for n in (40, 32))
    assert substring_dedup.near_places(a, b, 46, 0.8).tolist() == [[True]]
    b[31] = 999
    assert substring_dedup.near_places(a, b, 46, 0.8).tolist() == [[False]]


@pytest.mark.parametrize("sampled, often", [(1, 1), (1, 3), (1, 1000)])
def test_frequent_shingles_change_no_result(spark, sampled, often):
    rng = random.Random(5)
    line, rows = words(rng, 14), []
    for i in range(10):
        base = words(rng, 60)
        for j in range(3):
            mine = list(base)
            for _ in range(j):
                mine[rng.randrange(60)] = f"edit{i}x{j}"
            rows.append((3 * i + j, " ".join([*words(rng, 5), *line, *mine, *line])))
    rows += [(90, " ".join(["same"] * 70)), (91, " ".join(line * 6)), (92, " ".join([*words(rng, 60), *line]))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.start_word, r.end_word) for r in substring_dedup.near_passages(frame, sampled=sampled, often=often).collect()}
    assert set(got) == {d for d, _ in rows} - {92}
    assert got[90] == (0, 70) and got[91] == (0, 84)


def test_lines_of_many_texts_make_no_windows():
    rng = random.Random(6)
    line = words(rng, 14)
    texts = [" ".join([*words(rng, 60), *line, *words(rng, 60)]) for _ in range(20)]
    frequent = np.unique(Shingles(*hashed([" ".join(line)])).hashes)
    before, after = (np.unique(substring_dedup.windows(*hashed(texts), 46, 0.8, f)[4], return_counts=True)[1].max() for f in (frequent[:0], frequent))
    assert before == 20 and after == 1


@pytest.mark.parametrize("shift", range(1, 6))
def test_looping_passages_with_the_same_shingles_meet(shift):
    rng = random.Random(shift)
    loop = words(rng, 30 + shift)
    data, offsets = hashed([" ".join(loop * 3)])
    _, _, low, high, h, _ = substring_dedup.windows(data, offsets, 46, 0.8, np.zeros(0, np.uint64))
    # every passage holds all shingles of the loop, so all have a key in common
    begins = {n: set(low[(h == n) & (high - low == 45)].tolist()) for n in np.unique(h)}
    assert set(range(len(loop) * 3 - 49)) in begins.values()


def test_small_groups_with_repeats_are_compared_together(monkeypatch):
    rng = np.random.default_rng(4)
    contents = substring_dedup.Contents(46, 0.8)
    texts = []
    for _ in range(5):  # groups of three: a content with shingles that come again, a near one, another one
        base = rng.integers(1, 1 << 31, 80).astype(np.uint32)
        base[50:60] = base[10:20]
        near = base.copy()
        near[40] = 7
        texts += [base, near, rng.integers(1, 1 << 31, 80).astype(np.uint32)]
    for i, text in enumerate(texts):
        contents.add(i, text, False, False, i, 0)
    monkeypatch.setattr(substring_dedup.Contents, "resolve", lambda *a: pytest.fail("a group by itself"))
    rows = pa.table({"h": np.repeat(np.arange(5), 3), "a": np.full(15, -1, np.int32), "b": np.full(15, -1, np.int32), "x": np.arange(15), "later": [False] * 15, "rid": np.arange(15),
                     "low": np.zeros(15, np.int32), "content": [t.tobytes() for t in texts], "n": np.ones(15, np.int32)})
    rows = rows.set_column(7, "content", rows.column("content").cast(pa.binary()))
    out = pa.Table.from_batches(substring_dedup._verify(46, 0.8)(rows.to_batches(max_chunksize=4)))
    assert set(out.column("x").to_pylist()) == {i for i in range(15) if i % 3 < 2}
    for h in range(5):
        want = substring_dedup.near_places(texts[3 * h], texts[3 * h + 1], 46, 0.8)
        mine = [(r["first"], r["last"]) for r in out.to_pylist() if r["x"] == 3 * h]
        assert sorted(i for a, b in mine for i in range(a, b + 1)) == np.flatnonzero(want.any(axis=1)).tolist()
        assert len({r["class_id"] for r in out.to_pylist() if r["h"] == h}) == 1


def test_spans_of_a_row_that_overlap_are_one_passage():
    rng = np.random.default_rng(5)
    rows = sorted({(int(r), int(k), int(s), int(s + n), int(c)) for r, k, s, n, c in zip(
        rng.integers(0, 12, 400), rng.integers(0, 2, 400), rng.integers(0, 300, 400), rng.integers(1, 20, 400), rng.integers(-50, 50, 400))})
    rows += [rows[-1]] * 3  # repeated rows
    want = []
    for key in sorted({r[:2] for r in rows}):
        done = []
        for _, _, start, end, of in sorted({r for r in rows if r[:2] == key}):
            if done and start < done[-1][1]:
                done[-1] = (done[-1][0], max(done[-1][1], end), done[-1][2] | {of})
            else:
                done.append((start, end, {of}))
        want += [(f"{key}", s, e, min(of), sorted(of)) for s, e, of in done]
    rid, kb, start, end, of = (np.array(c) for c in zip(*rows))
    table = pa.table({"rid": rid, "kb": kb, "id": [f"{r[:2]}" for r in rows], "start": start.astype(np.int32), "end": end.astype(np.int32), "class_id": of})
    for size in (7, 1000):
        got = pa.Table.from_batches(substring_dedup._passages(pa.string())(table.to_batches(max_chunksize=size)))
        assert [tuple(r.values()) for r in got.to_pylist()] == want
