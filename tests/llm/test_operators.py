"""The text operators against brute force, and on rows that are NULL, empty, repeated or alike."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from costlake.llm import (bpe, chat, decontaminate, embedding_dedup, line_dedup, queries, sharding, simhash, substring_dedup,
                          suffix_dedup, toxicity)
from costlake.llm.common import components, forest

DOCS = "doc_id bigint, text string, rid string, kb int, found string"  # clashing names on purpose


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randrange(1, 220), 3000)) for _ in range(40)]
    passage = " ".join(words(rng, 60, 3000))
    for i in (3, 9, 17, 30):
        texts[i] = texts[i] + "\n" + passage + "\n" + texts[i - 1]
    texts += [texts[0], texts[0], "", "   ", "x", "é" * 300, "ab " * 400, "Ä" + texts[4], texts[5].upper()]
    rows = [(i, t, "r", 1, "f") for i, t in enumerate(texts)]
    return rows + [(None, None, None, None, None), (None, texts[1], None, None, None), (7, texts[7], None, None, None), (7, texts[8], None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def plain(values):
    return sorted(values, key=lambda v: tuple((x is None, str(x)) for x in v))


def least_reachable(ids, links):
    parent = list(range(len(ids)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[top(a)] = top(b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[top(i)] = min(x, least.get(top(i), x))
    return [least.get(top(i)) for i in range(len(ids))]


def test_components_join_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(60)] + [(200 + i, 100) for i in range(50)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100} | {200 + i: 100 for i in range(50)}
    child, root = forest(np.array([4, 2, 9]), np.array([2, 1, 8]))
    assert sorted(zip(child.tolist(), root.tolist())) == [(2, 1), (4, 1), (9, 8)]


def slow_fingerprint(text):
    found = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()]
    if not found:
        return 0
    grams = [b" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_is_the_brute_force(docs, corpus, nothing):
    prints = [slow_fingerprint(r[1] or "") for r in corpus]
    links = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if bin(prints[i] ^ prints[j]).count("1") <= 4]
    want = [(r[0], f"{p:016x}", c) for r, p, c in zip(corpus, prints, least_reachable([r[0] for r in corpus], links))]
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits(F.col("fp")), "component").collect()
    assert plain(map(tuple, got)) == plain(want)
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("block", [4096, 64])
def test_anchors_miss_no_pair(spark, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [b ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, rng.integers(1, 9), replace=False).astype(np.uint64)) for b in base for _ in range(4)]
    dense = [base[0] ^ np.uint64(1 << i | 1 << j) for i in range(20) for j in range(i)]
    fps = np.unique(np.concatenate([base, near, dense]).astype(np.uint64))
    links = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 4).tolist() if j > i]
    want = least_reachable(fps.view(np.int64).tolist(), links)
    frame = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp bigint")
    found = {r.node: r.component for r in components(simhash.links(frame, 4, block)).collect()}
    assert [found.get(x, x) for x in fps.view(np.int64).tolist()] == want


def test_covering_code_has_its_radius():
    find = simhash.anchor_finder(0, 1)
    row, anchor, home = find(np.arange(5000, dtype=np.int64) * 1677 % (1 << 23))
    assert np.bincount(row[home]).tolist() == [1] * 5000  # perfect: one anchor within the radius
    assert not simhash._syndromes(anchor).any()


def test_substrings_are_the_brute_force(docs, corpus, nothing):
    for hot in (4096, 2):
        texts = [(r[1] or "").encode() for r in corpus]
        seen = collections.Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
        want = []
        for (doc_id, *_), text in zip(corpus, texts):
            gone = bytearray(len(text))
            for i in range(len(text) - 199):
                if seen[text[i:i + 200]] > 1:
                    gone[i:i + 200] = b"\1" * 200
            kept = bytes(c for c, g in zip(text, gone) if not g)
            spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
            want.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        got = suffix_dedup.remove_repeats(docs, hot=hot).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
        assert plain(map(tuple, got)) == plain(want)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_marks_do_not_grow_with_repeated_rows(spark, monkeypatch):
    most = spark.sparkContext.accumulator(0)
    cut = suffix_dedup._cut

    def counted(length, gram, kind):
        inner = cut(length, gram, kind)

        def run(batches):
            def seen():
                for batch in batches:
                    for marks in batch.column(batch.schema.get_field_index("marks")).to_pylist():
                        most.add(len(marks or []))
                    yield batch

            yield from inner(seen())

        return run

    monkeypatch.setattr(suffix_dedup, "_cut", counted)
    text = " ".join(words(random.Random(31), 100, 5000))
    totals = []
    for copies in (20, 40):
        before = most.value
        got = suffix_dedup.remove_repeats(spark.createDataFrame([(1, text)] * copies, "doc_id bigint, text string")).collect()
        assert [r.n_removed for r in got] == [len(text)] * copies
        totals.append(most.value - before)
    assert totals[1] == 2 * totals[0]


def test_matching_statistics_of_a_repetitive_string():
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(80)) * 3
    symbols = np.array([ord(c) for c in text] + [1])
    want = []
    for i in range(len(symbols)):
        match = 0
        for j in range(len(symbols)):
            k = 0
            while i != j and i + k < len(symbols) and j + k < len(symbols) and symbols[i + k] == symbols[j + k]:
                k += 1
            match = max(match, k)
        want.append(match)
    assert suffix_dedup.matching_statistics(symbols).tolist() == want


def test_passages_are_found_and_clean_texts_are_not(spark, docs, corpus, nothing):
    grams = collections.defaultdict(set)
    for n, r in enumerate(corpus):
        found = (r[1] or "").lower().split()
        for i in range(len(found) - 49):
            grams[" ".join(found[i:i + 50])].add((n, i))
    want = {corpus[n][0] for places in grams.values() if len(places) > 1 for n, _ in places}
    for hot in (4096, 2):
        got = substring_dedup.near_passages(docs, hot=hot).collect()
        assert {r.doc_id for r in got} == want
        for r in got:
            assert r.end_word - r.start_word >= 50
    assert substring_dedup.near_passages(nothing).count() == 0


def test_near_passages_with_edits(spark):
    rng = random.Random(8)
    base = words(rng, 90, 9000)
    rows = []
    for i in range(60):
        mine = list(base)
        if i:
            mine[rng.randrange(90)] = f"edit{i}"
        rows.append((i, " ".join(words(rng, 40, 9000) + mine + words(rng, 40, 9000)) if i < 30 else " ".join(words(rng, 150, 9000))))
    got = {r.doc_id for r in substring_dedup.near_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got <= set(range(30)) and len(got) >= 27


def test_compact_windows_are_those_of_the_tree():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
    text = np.repeat([0, 1, 2], 100)
    got = set(zip(*(a.tolist() for a in substring_dedup.compact_windows(hashes, text, np.array([0, 100, 200, 300]), 12))))
    want = set()
    for c in range(300):
        left = right = c
        while left - 1 >= c // 100 * 100 and hashes[left - 1] > hashes[c]:
            left -= 1
        while right + 1 < (c // 100 + 1) * 100 and hashes[right + 1] > hashes[c]:
            right += 1
        if right - left + 1 >= 12:
            want.add((c, left, right))
    assert got == want


def test_toxicity_learns_from_positive_and_unlabelled(spark, nothing):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = rng.random() < 0.15
        found = words(rng, 60, 200) + (["vile", "scummy"] if toxic else [])
        rng.shuffle(found)
        rows.append((i, " ".join(found), "s", 0, None))
        if i % 2:
            labels.append((i, int(toxic)))
    rows += [(600, None, None, None, None), (None, "vile scummy", None, None, None)]
    documents, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    got = toxicity.score(documents, toxicity.train(documents, known)).collect()
    scores = {r.doc_id: r.score for r in got}
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == 602 and all(0 <= r.score <= 1 for r in got)
    assert sum((scores[i] >= 0.5) == t for i, t in held) / len(held) > 0.95
    assert toxicity.train(documents, known.limit(0)).weights == {}
    assert toxicity.score(nothing, toxicity.train(nothing, known)).count() == 0


def plain_risk(sets, positive, prior, weights, bias):
    """The non-negative risk with the logistic loss, text by text."""
    margin = [bias + sum(weights[f] for f in own) for own in sets]
    mean = lambda loss, of: np.mean([loss(m) for m, p in zip(margin, positive) if p == of])
    toxic, clean = (lambda m: np.log1p(np.exp(-m))), (lambda m: np.log1p(np.exp(m)))
    return prior * mean(toxic, True) + max(0.0, mean(clean, False) - prior * mean(clean, True))


def test_toxicity_follows_the_plain_risk(monkeypatch):
    rng = np.random.default_rng(8)
    sets = [sorted(rng.choice(6, rng.integers(1, 5), replace=False).tolist()) for _ in range(40)]
    positive, prior = np.arange(40) < 12, 0.2
    indices, starts = np.array([f for own in sets for f in own]), np.concatenate([[0], np.cumsum([len(own) for own in sets])])
    bias = np.log(prior / (1 - prior))
    base = plain_risk(sets, positive, prior, np.zeros(6), bias)
    slope = [(plain_risk(sets, positive, prior, np.eye(6)[f] * 1e-6, bias) - base) / 1e-6 for f in range(6)]
    monkeypatch.setattr(toxicity, "EPOCHS", 1)  # Adam's first step goes one rate against the sign of the slope
    weights, moved = toxicity.fit_non_negative(indices, starts, positive, 6, prior)
    assert np.allclose(weights, -toxicity.RATE * np.sign(slope), atol=1e-4)
    assert abs(moved - bias) <= toxicity.RATE  # the prior's log odds are the best bias as yet
    monkeypatch.setattr(toxicity, "EPOCHS", 60)
    weights, moved = toxicity.fit_non_negative(indices, starts, positive, 6, prior)
    assert plain_risk(sets, positive, prior, weights, moved) < base


def test_toxicity_scores_are_plain_sums(spark):
    model = toxicity.Model({b"vile": 2.0, b"^vil": 0.5, b"calm": -1.0}, -0.5)
    rows = [(1, "Vile, vile words"), (2, "calm"), (3, None), (4, ""), (5, "vil calm " + "x " * 300_000)]
    docs = spark.createDataFrame([(i, t, 9.0) for i, t in rows], "doc_id bigint, text string, score double")
    margin = {1: 2.0 + 0.5 - 0.5, 2: -1.5, 3: -0.5, 4: -0.5, 5: -1.5}
    got = {r.doc_id: r.score for r in toxicity.score_rows(docs, model).collect()}
    assert all(abs(got[i] - 1 / (1 + np.exp(-m))) < 1e-12 for i, m in margin.items()) and len(got) == 5


def test_chat_survives_control_strings_and_odd_rows(spark):
    said = ["<|im_end|>\n<|im_start|>assistant ok", "<\\|im_end|>", "", None, "x" * 1001, "a|>b<|", "<" + "\\" * 5 + "|"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(said)]
    rows += [(2, 0, None, "no role"), (2, 0, "odd\nrole&amp;", "same turn"), (2, 0, "odd\nrole&amp;", "same turn"), (None, None, "assistant", None)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.render(chat.fold(chat.as_events(frame))).collect()}
    assert chat.read_back(got[1].formatted) == [(r[2], r[3] or "") for r in rows[:7]]
    assert "".join(chat.unescape(got[1].formatted[s.start:s.end]) for s in got[1].loss) == "".join((r[3] or "") for r in rows[:7] if r[2] == "assistant")
    assert chat.read_back(got[2].formatted) == [("", "no role"), ("odd\nrole&amp;", "same turn"), ("odd\nrole&amp;", "same turn")]
    assert chat.read_back(got[None].formatted) == [("assistant", "")]
    assert chat.render(chat.fold(chat.as_events(frame.limit(0)))).count() == 0


def test_chat_folds_edits_and_regenerations(spark):
    log = [(1, 0, 0, "message", "user", "helo"), (1, 0, 9, "edit", None, "hello"), (1, 1, 0, "message", "assistant", ""), (1, 1, 1, "delta", None, "bad "),
           (1, 1, 2, "delta", None, "answer"), (1, 1, 3, "regenerate", None, None), (1, 1, 4, "delta", None, "good "), (1, 1, 5, "delta", None, "one"),
           (2, 0, 1, "delta", None, "orphan")]
    frame = spark.createDataFrame(log, "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string").repartition(4)
    assert plain(map(tuple, chat.fold(frame).collect())) == plain([(1, 0, "user", "hello"), (1, 1, "assistant", "good one"), (2, 0, None, "orphan")])


def slow_hits(text, items, window=13):
    def cut(t):
        keep = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in keep).split(" ")

    doc = [w for w in cut(text) if w]
    hit, found = set(), set()
    for item, t in items:
        own = [w for w in cut(t) if w]
        n = min(window, len(own))
        spans = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1):
            if tuple(doc[i:i + n]) in spans:
                hit.update(range(i, i + n))
                found.add(item)
    return len(doc), len(hit), sorted(str(f) for f in found if f is not None)


def test_decontamination_is_the_brute_force(spark, docs, corpus, nothing):
    bench = [(1, corpus[3][1]), (2, " ".join(corpus[6][1].split()[:20])), (3, "x"), (4, "w1"), (None, " ".join(corpus[12][1].split()[:14])), (5, None), (6, "—"),
             (7, " ".join(corpus[14][1].split()[2:7])), (1, corpus[6][1]), (8, "é" * 300)]
    items = spark.createDataFrame(bench, "item_id bigint, text string")
    got = decontaminate.decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ","), "contaminated").collect()
    want = []
    for r in corpus:
        n, hit, found = slow_hits(r[1], bench)
        want.append((r[0], n, hit, len(found), ",".join(found), hit > 0 and 20 * hit >= n))
    assert plain(map(tuple, got)) == plain(want)
    assert decontaminate.decontaminate(nothing, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).filter("contaminated OR n_hit > 0").count() == 0


def test_shards_are_even_and_computable(spark, docs, corpus, nothing):
    got = sharding.shard(docs, 4).collect()
    assert sorted(r.row_no for r in got) == list(range(len(corpus)))
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(len([r for r in got if r.shard == s])))
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    key = lambda rows: plain((r.doc_id, r.text_crc32, r.shard, r.slot) for r in rows)
    assert key(sharding.shard(docs.repartition(3), 4).collect()) == key(got)
    assert sharding.shard(nothing).count() == 0
    for n in (1, 2, 3, 10, 257, 4097):
        number = spark.range(n).withColumn("n", F.lit(n).cast("long"))
        placed = number.withColumn("place", sharding.permute(F.col("id"), F.col("n"))).withColumn("back", sharding.permute(F.col("place"), F.col("n"), inverse=True)).collect()
        assert sorted(r.place for r in placed) == list(range(n)) and all(r.back == r.id for r in placed)


def slow_lines(corpus, least):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\f\r"))
    seen = collections.Counter(k for r in corpus for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    out = []
    for r in corpus:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least or not key(x)]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_index_is_exact_and_reversible(spark, nothing):
    rng = random.Random(6)
    lines = [f"Line {i}" for i in range(40)] + ["", " \t", "É line"]
    rows = [(i, "\n".join(rng.choice([x, x.upper(), f" {x}\r"]) for x in rng.choices(lines, k=rng.randrange(9))), "r", 1, "f") for i in range(120)]
    rows += [(None, None, None, None, None), (5, "Line 1\nLine 1", None, None, None), (5, "Line 1\nLine 1", None, None, None)]
    documents = spark.createDataFrame(rows, DOCS)
    old, new = documents.filter("doc_id < 70 OR doc_id IS NULL"), documents.filter("doc_id >= 70")
    index = line_dedup.LineIndex.empty(spark, shards=3).insert(old)
    both = index.insert(new)
    got = line_dedup.drop_lines(documents, both.repeated(20)).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert plain(map(tuple, got)) == plain(slow_lines(rows, 20))
    back = both.delete(new)
    assert plain(map(tuple, back.counts.collect())) == plain(map(tuple, index.counts.collect()))
    assert line_dedup.drop_lines(nothing, both.repeated(2)).count() == 0
    assert line_dedup.LineIndex.empty(spark).insert(nothing).counts.count() == 0


def test_cuckoo_filter_holds_and_forgets():
    keys = np.random.default_rng(9).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    made = line_dedup.CuckooFilter.load(line_dedup.CuckooFilter.of(keys).dump())
    assert made.contains(keys).all()
    other = np.random.default_rng(10).integers(0, 1 << 63, 100_000, dtype=np.uint64)
    assert made.contains(other).mean() < 0.001
    made.delete(keys[:15_000])
    assert made.contains(keys[15_000:]).all() and made.contains(keys[:15_000]).mean() < 0.01


def test_bpe_is_the_library(spark, docs, corpus, nothing):
    path = queries.tokenizer_path()
    library = bpe.load(path)
    odd = ["Hello World's don't <|endoftext|>x 12", "ΑΣ ΣΑ Σ", "é a\x1cb a b a b\u0085c", "<|startoftext|>", "\x00 ﻿", "İ ǅ", "日本語 テキスト", "a" * 5000]
    rows = corpus + [(1000 + i, t, None, None, None) for i, t in enumerate(odd)]
    frame = docs.unionByName(spark.createDataFrame(rows[len(corpus):], DOCS))
    for head in (bpe.HEAD_WORDS, 10):
        got = bpe.decode(bpe.encode(frame, path, head_words=head), path).collect()
        want = [(r[0], e.ids, library.decode(e.ids, skip_special_tokens=False)) for r in rows for e in [library.encode(r[1] or "", add_special_tokens=False)]]
        assert plain((r.doc_id, r.ids, r.decoded) for r in got) == plain(want)
    assert bpe.encode(nothing, path).count() == 0
    lists = spark.createDataFrame([(1, None), (2, []), (3, [1, 99_999, 2])], "i int, ids array<int>")
    assert [r.decoded for r in bpe.decode(lists, path).orderBy("i").collect()] == [None, "", library.decode([1, 99_999, 2])]


def test_embeddings_are_the_brute_force(spark):
    rng = np.random.default_rng(12)
    base = rng.standard_normal((40, 24))
    vectors = np.concatenate([base + rng.standard_normal(base.shape) * s for s in (0.0, 0.1, 0.2, 0.3, 0.35, 0.4)]).astype(np.float32)
    labels = [int(x) if x else None for x in rng.integers(0, 3, len(vectors))]
    rows = [(i, v.tolist(), lab) for i, (v, lab) in enumerate(zip(vectors, labels))]
    rows += [(1000 + i, vectors[0].tolist(), labels[0]) for i in range(5)] + [(0, vectors[0].tolist(), labels[0])]
    odd = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] * 24, [1.0, None] * 12, [1.0, 2.0]]
    rows += [(2000 + i, v, 1) for i, v in enumerate(odd)] + [(None, vectors[3].tolist(), 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    fit = [v is not None and len(v) > 0 and lab is not None and None not in v and np.isfinite(v).all() and np.any(v) for _, v, lab in rows]

    def near(i, j):
        (_, a, x), (_, b, y) = rows[i], rows[j]
        return fit[i] and fit[j] and x == y and len(a) == len(b) and np.dot(np.float64(a), np.float64(b)) / np.linalg.norm(np.float64(a)) / np.linalg.norm(np.float64(b)) >= 0.93

    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if near(i, j)]
    count = collections.Counter(x for pair in links for x in pair)
    want = [(r[0], count[i], c, c == r[0]) for i, (r, c) in enumerate(zip(rows, least_reachable([r[0] for r in rows], links)))]
    for block in (2048, 32):
        got = embedding_dedup.near_duplicates(frame, block=block).select("vec_id", "n_links", "component", "kept").collect()
        assert plain(map(tuple, got)) == plain(want)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def brute_places(a, b, width=46, similarity=0.8):
    sets = [[set(t[i:i + width]) for i in range(len(t) - width + 1)] for t in (a, b)]
    return [[len(x & y) >= similarity * len(x | y) - 1e-9 for y in sets[1]] for x in sets[0]]


@pytest.mark.parametrize("few", [0, 6])
def test_contents_are_compared_in_any_order(monkeypatch, few):
    monkeypatch.setattr(substring_dedup, "FEW", few)
    rng = random.Random(3)
    base = [rng.randrange(1 << 31) for _ in range(91)]
    edit = lambda text, *places: [v + 1000 * (i in places) for i, v in enumerate(text)]
    a, b = base, edit(base, 40, 45, 50)
    c = edit(b, 38, 42, 48)  # a~b, b~c, in the middle not a~c
    apart = [rng.randrange(1 << 31) for _ in range(45)] + [base[45]] + [rng.randrange(1 << 31) for _ in range(45)]
    looped = (base[20:50] * 4)[:91]
    texts = [a, b, c, apart, looped, looped[5:] + base[:5], base[30:] + apart[:30]]
    near = {(i, j): np.array(brute_places(texts[i], texts[j])) for i, j in itertools.combinations(range(len(texts)), 2)}
    want = [np.zeros(46, bool) for _ in texts]
    for (i, j), found in near.items():
        want[i] |= found.any(axis=1)
        want[j] |= found.any(axis=0)
        assert (substring_dedup.near_places(*(np.array(texts[k], np.uint32) for k in (i, j)), 46, 0.8) == found).all()
    linked = least_reachable(list(range(len(texts))), [k for k, found in near.items() if found.any()])
    for order in ([0, 1, 2, 3, 4, 5, 6], [0, 2, 1, 5, 3, 6, 4], [2, 0, 1, 6, 4, 5, 3], [3, 6, 5, 4, 2, 1, 0]):
        group = substring_dedup.Contents(46, 0.8)
        for i in order:
            group.add(i, np.array(texts[i], np.uint32), False, False, i, 0)
        group.resolve(False)
        for at, i in enumerate(order):
            assert (group.marked[at] == want[i]).all()
            assert [linked[j] == linked[i] for j in order] == (group.label == group.label[at]).tolist()


def test_crowded_hashes_keep_near_passages(spark):
    rng = random.Random(15)
    base = words(rng, 60, 9000)
    rows = []
    for i in range(40):  # no two are equal, each has its own surroundings
        mine = [*base]
        mine[rng.choice([20, 30, 40])] = f"edit{i}"
        rows.append((i, " ".join(words(rng, 40, 9000) + mine + words(rng, 40, 9000))))
    frame = spark.createDataFrame(rows + [(99, " ".join(words(rng, 150, 9000)))], "doc_id bigint, text string")
    key = lambda hot: plain((r.doc_id, r.start_word, r.end_word) for r in substring_dedup.near_passages(frame, hot=hot).collect())
    got = key(4)
    assert got == key(4096) and {r[0] for r in got} == set(range(40))


def test_near_passages_are_the_brute_force(spark):
    rng = random.Random(21)
    rows = []
    for i in range(12):
        base = words(rng, rng.randrange(50, 75), 9000)
        for j in range(4):
            mine = list(base)
            for _ in range(j):
                at = rng.choice([rng.randrange(len(mine)), rng.randrange(9), len(mine) - 1 - rng.randrange(9)])
                mine[at:at + rng.randrange(2)] = [f"edit{rng.randrange(10**6)}"]
            rows.append((4 * i + j, " ".join(words(rng, rng.randrange(20), 9000) + mine + words(rng, rng.randrange(20), 9000))))
    loop = words(rng, 70, 9000)
    rows += [(90, " ".join(loop[:20] * 4 + ["odd"] + loop[:20] * 3)), (91, " ".join(loop[:30] + loop[3:40] + loop)), (92, " ".join(loop[5:9] + loop[:30]) + " tail" * 60)]
    grams = {}
    for doc_id, text in rows:
        found = text.split()
        grams[doc_id] = [(i, {" ".join(found[k:k + 5]) for k in range(i, i + 46)}) for i in range(len(found) - 49)]
    want, at_the_edge = collections.defaultdict(set), 0
    for (a, b) in itertools.combinations_with_replacement(grams, 2):
        for (i, x), (j, y) in itertools.product(grams[a], grams[b]):
            common, union = len(x & y), len(x | y)
            if (a < b or i < j and (j - i >= 50 or x == y and union < 46)) and 5 * common >= 4 * union:
                at_the_edge += 10 * common < 9 * union
                want[a].add(i)
                want[b].add(j)
    spans = []
    for doc_id, begins in want.items():
        start = end = None
        for i in sorted(begins):
            if end is None or i >= end:
                spans += [(doc_id, start, end)] if end else []
                start = i
            end = i + 50
        spans.append((doc_id, start, end))
    assert at_the_edge > 100
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert plain((r.doc_id, r.start_word, r.end_word) for r in substring_dedup.near_passages(frame).collect()) == plain(spans)


def test_merged_passages_keep_all_classes(spark):
    rng = random.Random(4)
    for _ in range(4):
        text = words(rng, 150, 9000)
        rows = [(1, " ".join(text[:100])), (2, " ".join(text)), (3, " ".join(text[50:]))]
        got = substring_dedup.near_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert sorted((r.doc_id, r.start_word, r.end_word) for r in got) == [(1, 0, 100), (2, 0, 150), (3, 0, 100)]
        of = {r.doc_id: set(r.class_ids) for r in got}
        assert of[1] & of[2] and of[2] & of[3] and all(r.class_id == min(r.class_ids) for r in got)
