"""The pipeline's stages on documents with planted cases."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
from tests.llm.test_dedup import passage


def test_stages_keep_the_columns_and_survive_awkward_documents(spark, awkward, sf):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert tuple(stage(spark, awkward, sf).columns) == corpus_pipeline.COLUMNS
        stage(spark, awkward, sf).collect()
        assert stage(spark, awkward.limit(0), sf).collect() == []
    assert len(corpus_pipeline.STAGES[-1][1](spark, awkward, sf).collect()) == awkward.count()


def test_decisions_take_effect(spark, sf):
    shared = passage(0, 60)
    rows = [(k, f"{passage(100 + k, 90)}\n{shared}\n{passage(300 + k, 40)}", "en", f"s{k % 3}", 0) for k in range(30)]
    rows += [(100, passage(999, 200), "en", "s0", 0), (101, passage(999, 200) + " more", "en", "s1", 0), (200, "# $ % short", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    by = dict(corpus_pipeline.STAGES)
    good = by["quality rules"](spark, docs, sf)
    assert {r.doc_id for r in good.collect()} == {r[0] for r in rows} - {200}
    deduped = by["line dedup"](spark, docs, sf).collect()
    assert sum(shared in r.text for r in deduped) == 1 and len(deduped) == len(rows)
    assert all(r.n_chars == len(r.text) for r in deduped)
    one = {r.doc_id for r in by["near-dedup"](spark, docs, sf).collect()}
    assert one == {r[0] for r in rows} - {101}
    mixed = Counter(r.doc_id for r in by["mixing"](spark, docs, sf).collect())
    assert max(mixed.values()) <= 2


def test_run_equals_stages_in_turn(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    rows = out.collect()
    assert rows and all(len(r.ids) == r.n_tokens for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert Counter((r.doc_id, tuple(r.ids)) for r in docs.collect()) == Counter((r.doc_id, tuple(r.ids)) for r in rows)


def test_tokens_decode_to_the_text(spark):
    texts = ["the cat sat", "naïve — 日本語 😀", "", "a\tb\n c"]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["tokens"](spark, docs, "").collect()}
    assert [out[k].decoded_sha256 for k in range(4)] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert all(len(r.ids) == r.n_tokens for r in out.values())
