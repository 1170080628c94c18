"""The pipeline on the smallest tables: every stage's decision against a plain version."""

import hashlib
import os

import pytest

import corpus_pipeline as pipeline
from costlake.llm import bpe, queries
from test_operators import plain, slow_fingerprint, slow_hits, slow_lines

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_every_stage_keeps_what_it_should(spark):
    docs = queries.table(spark, SF, "documents")
    kept = []
    for _, stage in pipeline.STAGES:
        docs = pipeline.stow(stage(spark, docs, SF), "stage")
        kept.append([r.asDict() for r in docs.collect()])
    for rows in kept[:-1]:
        assert set(rows[0]) == set(pipeline.COLUMNS)
    assert len(kept[0]) == len(kept[1])
    lines = slow_lines([(r["doc_id"], r["text"]) for r in kept[0]], pipeline.LINE_DOCUMENTS)
    assert plain((r["doc_id"], r["text"]) for r in kept[1]) == plain((r[0], r[3]) for r in lines)
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in kept[1]}
    firsts, seen = set(), {}
    for doc_id in prints:
        stack, group = [doc_id], set()
        while stack and doc_id not in seen:
            at = stack.pop()
            if at not in group:
                group.add(at)
                stack += [o for o in prints if o not in group and (prints[at] ^ prints[o]).bit_count() <= 4]
        seen.update(dict.fromkeys(group, min(group, default=None)))
        firsts.add(seen[doc_id])
    assert {r["doc_id"] for r in kept[2]} == firsts and len(kept[2]) == len(firsts)
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    clean = {r["doc_id"] for r in kept[2] for n, hit, _ in [slow_hits(r["text"], items)] if not (hit and 20 * hit >= n)}
    assert {r["doc_id"] for r in kept[3]} == clean
    library = bpe.load(queries.tokenizer_path())
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in kept[3]}
    assert {r["doc_id"]: r["ids"] for r in kept[4]} == want
    whole = pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in whole.select("doc_id").collect()) == sorted(want)


def test_last_stage_decodes(spark):
    rows = [(1, "Hello World, don't"), (2, ""), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    library = bpe.load(queries.tokenizer_path())
    got = {r.doc_id: (r.ids, r.decoded_sha256) for r in pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i] == (ids, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
