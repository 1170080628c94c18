"""Hashed TF-IDF vectors against a plain computation."""

import math
import re

from pyspark.sql import functions as F

from costlake.functions.text import ENGLISH_STOP_WORDS
from costlake.operators import text
from costlake.operators.models import fit_stages


def murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3, x86, 32 bits, signed."""
    mask = 0xFFFFFFFF
    turn = lambda x, n: (x << n | x >> 32 - n) & mask
    h = seed
    for i in range(0, len(data), 4):
        word = int.from_bytes(data[i:i + 4], "little")
        h ^= turn(word * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        if i + 4 <= len(data):
            h = (turn(h, 13) * 5 + 0xE6546B64) & mask
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & mask
    return h - (1 << 32) if h >> 31 else h


def test_murmur3_has_its_published_values():
    assert murmur3(b"", 0) == 0 and murmur3(b"", 1) == 0x514E28B7
    assert murmur3(b"test", 0) & 0xFFFFFFFF == 0xBA6BD213 and murmur3(b"Hello, world!", 0) & 0xFFFFFFFF == 0xC0363E43


def test_hashed_vectors_are_the_plain_ones(spark):
    docs = ["Replace the ROOF and re-roof it", "roof roof kitchen remodel", "New kitchen; new bath", "the and of", "", "bath roof été kitchen", "kitchen bath roof"]
    size, least = 64, 2
    rows = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    stages, out = text.hashed_tfidf_stages("text", size, min_length=2, min_documents=least)
    got = {r["id"]: r[out].toArray().tolist() for r in fit_stages(stages, rows).transform(rows).select("id", out).collect()}
    slots = [{murmur3(w.encode()) % size for w in re.split(r"[^A-Za-z0-9_]+", d.lower()) if len(w) >= 2 and w not in ENGLISH_STOP_WORDS} for d in docs]
    for i, own in enumerate(slots):
        want = [0.0] * size
        for s in own:
            documents = sum(s in other for other in slots)
            want[s] = math.log((len(docs) + 1) / (documents + 1)) if documents >= least else 0.0
        assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got[i], want))
    assert rows.filter(F.col("text") == "").count() == 1
