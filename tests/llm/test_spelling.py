"""Spelling variants against brute force, and on odd words."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from costlake.llm import queries, spelling


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def brute_force(counts, ratio=10):
    near = collections.defaultdict(list)
    for a, b in itertools.combinations(counts, 2):
        if abs(len(a) - len(b)) <= 1 and levenshtein(a, b) == 1:
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(out)


def found(spark, counts, **more):
    frame = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()], "word string, n int, root string, sig int").repartition(3)
    return sorted(map(tuple, spelling.group_variants(frame, **more).select("word", "n", "n_near", "form", "form_n", "root").collect()))


def variants(rng, alphabet, number, length):
    words = set()
    while len(words) < number:
        base = "".join(rng.choice(alphabet) for _ in range(rng.randrange(*length)))
        words.add(base)
        for _ in range(4):
            at = rng.randrange(len(base) + 1)
            words.add(base[:at] + rng.choice(["", rng.choice(alphabet)]) + base[at + rng.randrange(2):])
    return sorted(words)


@pytest.mark.parametrize("alphabet,block", [("abcdefghijklmnopqrstuvwxyzéß", 2048), ("ab", 2048), ("abc", 8)])
def test_is_the_brute_force(spark, monkeypatch, alphabet, block):
    rng = random.Random(len(alphabet))
    monkeypatch.setattr(spelling.close_pairs, "__defaults__", (1, 5, block))
    counts = {w: rng.choice([1, 2, 3, 30, 31, 400, 5000]) for w in variants(rng, alphabet, 250, (5, 12))}
    want = brute_force(counts)
    assert sum(r[2] for r in want) > 100 and found(spark, counts) == want


@pytest.mark.parametrize("first,second", [(1, 3), (1, 7), (2, 4), (3, 2)])
def test_signatures_miss_no_pair(first, second):
    rng = random.Random(3)
    words = variants(rng, "abcdefg", 150, (1, 9))
    signed = spelling.signatures(spelling.part_hashes(*spelling.letters(pa.array(words)), first * second), spelling.ways(first, second))
    for i, j in itertools.combinations(range(len(words)), 2):
        if levenshtein(words[i], words[j]) == 1:
            assert (signed[i] == signed[j]).any()
    at, way, key = spelling.keys_of(*spelling.letters(pa.array(words)), spelling.ways(first, second), first * second)
    own = [set(zip(way[at == i].tolist(), key[at == i].tolist())) for i in range(len(words))]
    assert all(own[i] & own[j] for i, j in itertools.combinations(range(len(words)), 2) if levenshtein(words[i], words[j]) == 1)
    with pytest.raises(ValueError):
        spelling.ways(1, 2)


def test_edits_are_single_edits():
    rng = random.Random(4)
    words = [*variants(rng, "abé", 60, (1, 7)), "", "a" * 47, "a" * 48, "a" * 49, "a" * 50, "a" * 48 + "b", "b" + "a" * 48, "é" * 48, "é" * 47 + "a", "ab" * 24, "ba" * 24]
    i, j = (np.array(x) for x in zip(*itertools.combinations(range(len(words)), 2)))
    want = [levenshtein(words[x], words[y]) == 1 for x, y in zip(i, j)]
    assert spelling.edits(*spelling.letters(pa.array(words)), i, j).tolist() == want
    assert [spelling.one_edit(words[x], words[y]) for x, y in zip(i, j)] == want


def test_forms_follow_to_the_last(spark):
    counts = {"letters": 100_000, "lettars": 1_000, "lettarz": 90, "lattarz": 9, "zlattarz": 1, "other": 5}
    got = {r[0]: (r[3], r[5]) for r in found(spark, counts)}
    assert got == {"letters": (None, "letters"), "lettars": ("letters", "letters"), "lettarz": ("lettars", "letters"), "lattarz": ("lettarz", "letters"),
                   "zlattarz": (None, "zlattarz"), "other": (None, "other")}
    tied = {"abcdefg": 1, "abcdefh": 50, "abcdefi": 50, "": 1, "a": 20}
    assert found(spark, tied) == brute_force(tied)


def test_words_without_partner_or_none_at_all(spark):
    frame = spark.createDataFrame([("alone", 3), (None, 5), ("x", None)], "word string, n bigint")
    assert list(map(tuple, spelling.group_variants(frame).collect())) == [("alone", 3, 0, None, None, "alone")]
    assert spelling.group_variants(frame.limit(0)).count() == 0


def test_query_is_the_brute_force(spark, tmp_path):
    rng = random.Random(9)
    base = ["sentence", "Straße", "ÉCLAIRÉE", "garçons", "quality", "letters", "running", "x" * 300, "shorter"]
    rows = []
    for i in range(400):
        parts = [rng.choice(base[:rng.choice([3, 9])]) for _ in range(rng.randrange(12))]
        rows.append((i * 7 - 300, rng.choice([" ", "-", "1", "\n"]).join(x if rng.random() < 0.8 else x[:3] + rng.choice("aeé") + x[4:] for x in parts), "l", 1))
    rows += [(None, "sentence sentence", "l", 1), (5, None, "l", 1), (6, "", "l", 1), (7, "sentence " * 3000, "l", 1), (7, "sentence " * 3000, "l", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, word string, n int").write.parquet(str(tmp_path / "documents.parquet"))
    seen = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    want = brute_force({w: n for w, n in seen.items() if len(w) >= 7 and n >= 2})
    got = queries.QUERIES["op12_spelling"](spark, str(tmp_path)).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got)) == want and sum(r[3] is not None for r in want) > 5
