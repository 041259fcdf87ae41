"""Token counts by a tokenizers-library vocabulary, with huge documents cut up and spliced.

Documents of up to LONG characters are counted whole. A longer one is cut, in one pass over its text, into overlapping
chunks, rows of their own that are dealt to all tasks, which the library encodes with offsets. Two neighbours are spliced where both start a pre-token:
from such a place on, both split alike, because a pre-token depends only on what follows its start. The place
must lie MARGIN characters before the left chunk ends, further than any pre-token or special token looks ahead.
Documents with a pair of neighbours that share no such place are cut again with chunks and overlaps WIDEN times
as large, until they fit one chunk.

Cases: null text is empty and has no tokens; special strings inside texts count as the library's default has it;
repeated rows, repeated and null ids give a row each; an empty table gives an empty result; other columns are
ignored. The vocabulary must lie at the same path on every worker, and its added tokens must be plain ones: lstrip, rstrip,
single_word and normalized aren't handled where texts are split at them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.llm.bpe import segments
from saltmarsh.llm.common import materialize, ship

LONG = 65_536
STEP = 32_768
OVERLAP = 512
WIDEN = 8
#: Characters of chunks that leave a task at once.
CHUNK_CHARS = 4_000_000
MARGIN = 64
#: Words whose counts a worker remembers before it starts afresh.
REMEMBERED = 200_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _count_whole(path: str, pattern: str):
    """Counts by pre-token: the library encodes each one that the worker has not met yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        tokenizer, match = _tokenizer(path), regex.compile(pattern).findall
        special = regex.compile("|".join(regex.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()) or r"(?!)")
        known: dict[str, int] = {}
        for batch in batches:
            docs, new = [], {}
            for text in batch.column(1).to_pylist():
                between = special.split(text)
                words = [w for part in between for s in segments(part) for w in match(s)]
                new |= dict.fromkeys(w for w in set(words) if w not in known)
                docs.append((len(between) - 1, words))
                if len(new) > REMEMBERED // 4:
                    _learn(tokenizer, known, new)
                    new = {}
            _learn(tokenizer, known, new)
            n = [k + sum(map(known.__getitem__, words)) for k, words in docs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])
            if len(known) > REMEMBERED:
                known = {}

    return run


def _learn(tokenizer, known: dict[str, int], new: dict[str, None]) -> None:
    words = list(new)
    for at in range(0, len(words), 10_000):
        some = words[at : at + 10_000]
        known.update(zip(some, map(len, tokenizer.encode_batch_fast(some, add_special_tokens=False)), strict=True))


def _cut(step: int, overlap: int):
    """Chunks of each (row, text): every ``step`` characters one of ``step + overlap``, until the text ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_once = max(1, CHUNK_CHARS // (step + overlap))
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                last = max(0, -(-(len(text) - overlap) // step) - 1)
                for first in range(0, last + 1, at_once):
                    ks = range(first, min(first + at_once, last + 1))
                    chunks = [text[k * step : (k + 1) * step + overlap] for k in ks]
                    yield pa.RecordBatch.from_arrays([pa.array([row] * len(ks), pa.int64()), pa.array(ks, pa.int64()), pa.array(chunks, pa.string())], ["row", "k", "text"])

    return run


def _encode_chunks(path: str, step: int, overlap: int):
    """For each chunk its tokens, and its pre-token starts in the zones shared with its neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("row", "k", "total", "left", "left_n", "right", "right_n")}
            for row, k, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                e = tokenizer.encode(text, add_special_tokens=False)
                words = np.array([-1 if w is None else w for w in e.word_ids] or [], np.int64)
                starts = np.flatnonzero(np.diff(words, prepend=-2))  # tokens that start a pre-token
                offsets = e.offsets
                at = np.array([offsets[i][0] for i in starts], np.int64)
                for side, low, high in (("left", 0, overlap), ("right", step, min(step + overlap, len(text)) - MARGIN)):
                    zone = (at >= low) & (at < high)
                    out[side].append((at[zone] + k * step).tolist())
                    out[f"{side}_n"].append(starts[zone].tolist())
                out["row"].append(row)
                out["k"].append(k)
                out["total"].append(len(e))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict(out, pa.schema([(c, pa.int64() if c in ("row", "k", "total") else longs) for c in out]))

    return run


def _splice(documents: DataFrame, path: str, step: int, overlap: int) -> DataFrame:
    """Count by chunks: row, n_tokens (null where some neighbours share no place)."""
    chunks = documents.select("row", "text").mapInArrow(_cut(step, overlap), "row long, k long, text string")
    encoded = chunks.repartition("row", "k").mapInArrow(
        _encode_chunks(path, step, overlap),
        "row long, k long, total long, left array<long>, left_n array<long>, right array<long>, right_n array<long>",
    )
    order = Window.partitionBy("row").orderBy("k")
    last = F.lead("k").over(order).isNull()
    cut = F.array_min(F.array_intersect("right", F.lead("left").over(order)))
    before = lambda side, place: F.get(f"{side}_n", (F.array_position(side, place) - 1).cast("int"))
    counted = (
        encoded.withColumn("last", last)
        .withColumn("cut", cut)
        .withColumn("start", F.lag("cut").over(order))
        .withColumn("from", F.when(F.col("k") == 0, F.lit(0)).otherwise(before("left", F.col("start"))))
        .withColumn("to", F.when(F.col("last"), F.col("total")).otherwise(before("right", F.col("cut"))))
    )
    n = F.sum(F.col("to") - F.col("from"))
    whole = F.count(F.lit(1)) == F.count(F.col("to") - F.col("from"))
    return counted.groupBy("row").agg(F.when(whole, n).alias("n_tokens"))


def count(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    long: int = LONG,
    step: int = STEP,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Return id, n_bytes and n_tokens for every document."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    all_docs = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    id_type = all_docs.schema["id"].dataType.simpleString()
    short = all_docs.where(F.char_length("text") <= long).mapInArrow(_count_whole(path, pattern), f"id {id_type}, n_bytes long, n_tokens long")
    left = materialize(
        all_docs.where(F.char_length("text") > long).withColumn("row", F.monotonically_increasing_id()), "long-documents"
    )
    parts = [short]
    while not left.isEmpty():
        counts = materialize(_splice(left, path, step, overlap), "long-counts")
        parts.append(left.join(counts.where("n_tokens IS NOT NULL"), "row").select("id", "n_bytes", "n_tokens"))
        left = left.join(counts.where("n_tokens IS NULL"), "row", "left_semi")
        step, overlap = step * WIDEN, overlap * WIDEN
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("id", id_col)
