"""Operators 1 and 10 against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import bpe, queries, token_counts

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(rows, library):
    out = Counter()
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        out[i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    return out


def test_query_equals_library(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, queries.op1_bpe(spark, sf).collect())) == expected(docs, library)


def test_awkward_documents(awkward, library):
    got = bpe.decode(bpe.encode(awkward, RANKS, P.PATTERN), RANKS)
    got = got.select("doc_id", "n_tokens", F.sha2("ids_le", 256), F.sha2("decoded", 256))
    rows = awkward.select("doc_id", "text").collect()
    assert Counter(map(tuple, got.collect())) == expected(rows, library)


def test_many_small_blocks(awkward, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 40)
    monkeypatch.setattr(bpe, "SEGMENT", 7)
    got = {(r.doc_id, tuple(r.ids)) for r in bpe.encode(awkward, RANKS, P.PATTERN).collect()}
    assert got == {(r.doc_id, tuple(library.encode_ordinary(r.text or ""))) for r in awkward.collect()}


def test_decoding_null_and_empty(spark):
    ids = spark.createDataFrame([(1, None), (2, []), (None, [32, 33])], "doc_id long, ids array<int>")
    got = {r.doc_id: (r.n_tokens, bytes(r.decoded)) for r in bpe.decode(ids, RANKS).collect()}
    assert got[1] == got[2] == (0, b"") and got[None][0] == 2


def test_empty_tables(empty):
    assert bpe.decode(bpe.encode(empty, RANKS, P.PATTERN), RANKS).collect() == []
    assert token_counts.count(empty, JSON, P.PATTERN).collect() == []


def counted(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    return Counter((r.doc_id, len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False))) for r in rows)


def test_counts_equal_library(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op10_token_counts(spark, sf).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == counted(rows)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


@pytest.mark.parametrize("size", [(token_counts.LONG, token_counts.STEP, token_counts.OVERLAP), (100, 300, 100), (200, 150, 90)])
def test_counts_of_awkward_documents(awkward, size):
    long, step, overlap = size
    got = token_counts.count(awkward, JSON, P.PATTERN, long=long, step=step, overlap=overlap)
    assert Counter(map(tuple, got.collect())) == counted(awkward.select("doc_id", "text").collect())


def test_special_strings_and_spaces_at_chunk_borders(spark):
    text = "".join(f"{'<|endoftext|>' * (k % 3)}w{k}{' ' * (k % 90)}" for k in range(400))
    docs = spark.createDataFrame([(k, text[k:]) for k in range(40)], "doc_id long, text string")
    got = token_counts.count(docs, JSON, P.PATTERN, long=50, step=200, overlap=100)
    assert Counter(map(tuple, got.collect())) == counted(docs.collect())


def test_a_text_above_ten_megabytes_with_chunks_that_must_be_widened(spark):
    """Runs of letters longer than the overlap lie across chunk ends, so neighbours share no start there."""
    from tokenizers import Tokenizer

    words = " ".join(f"w{k % 977} and {k}" for k in range(9000))
    text = "".join(f"{words} {'ab' * 700} " for _ in range(80))
    at = token_counts.STEP * 3 - 600
    text = text[:at] + " " + "xy" * 3000 + " " + text[at:]
    assert len(text) > 10_000_000
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, text[: token_counts.LONG + 1])], "doc_id long, text string")
    library = Tokenizer.from_file(JSON)
    got = {r.doc_id: r.n_tokens for r in token_counts.count(docs, JSON, P.PATTERN).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False)) for i, t in ((r.doc_id, r.text) for r in docs.collect())}


def test_an_id_outside_the_vocabulary_is_an_error(spark):
    with pytest.raises(Exception, match="no such token"):
        bpe.decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>"), RANKS).collect()
