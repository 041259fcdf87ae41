"""Byte-level BPE over a corpus by a global shuffle of distinct words.

Texts are split into pre-tokens. Blocks of whole documents are written once as a table: the block's distinct
words, dealt to buckets by hash, and every pre-token's position as (bucket, rank in the bucket's list). The word
lists are exploded and shuffled by bucket; the task that holds a bucket meets each word of the corpus there and
encodes it once. The ids go back to the blocks, whose table is bucketed by block and so stays where it is, and
documents are put together by position. Only distinct words per block travel, never occurrences, so a word that
every document uses costs one row entry a block.

Decoding meets ids with the token-byte table where they are: the table is the vocabulary, so each task holds it whole, in
order of id, and takes a batch of ids from it at once. A shuffled join would move a row a token.

Cases: null text is empty and has no ids; a text of any length is cut for matching only where a non-space meets
a space, which always starts a pre-token; repeated rows, repeated and null ids give a row each; an empty table
gives an empty result; other columns are ignored. The ranks file must lie at the same path on every worker.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import bucketed, ship

#: Characters of text in a block; a longer document is a block of its own.
BLOCK_CHARS = 6_000_000
#: Characters matched at once.
SEGMENT = 1_000_000
#: Word lists that a block is dealt into, at least and at most; each is one unit of the shuffle.
BUCKETS, MOST_BUCKETS = 256, 65_536
FLUSH_ROWS = 20_000


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


#: Takes a whole pre-token as one piece.
PIECE = r"(?s:.+)"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=PIECE, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> pa.Array:
    """The token-byte table in order of id; null for an id without token."""
    by_id = {i: b for b, i in _ranks(path).items()}
    return pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.large_binary())


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Cut a text where a non-space meets a space: no pre-token spans such a place."""
    import regex

    at, border = 0, regex.compile(r"\S(?=\s)")
    while len(text) - at > size:
        m = border.search(text, at + size)
        if m is None:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


def _pack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _pack_words(words: list[bytes]) -> bytes:
    """Their number, lengths and bytes; nothing for none."""
    sizes = np.fromiter(map(len, words), "<u4", len(words))
    return _pack(np.uint32(len(words)).tobytes() + sizes.tobytes() + b"".join(words)) if words else b""


def _unpack_words(data: bytes) -> list[bytes]:
    raw = _unpack(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends[:-1].tolist()], ends.tolist(), strict=True)]


class _Block:
    """Documents under way to one row of the block table."""

    def __init__(self) -> None:
        self.numbers: defaultdict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids: list = []
        self.counts: list[int] = []
        self.parts: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id, text: str, match) -> None:
        n = 0
        for piece in segments(text):
            found = match(piece)
            self.parts.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
            n += len(found)
        self.ids.append(doc_id)
        self.counts.append(n)
        self.chars += len(text)

    def row(self, block: int, n_buckets: int) -> dict:
        at = np.concatenate([*self.parts, np.empty(0, np.int32)])
        often = np.bincount(at, minlength=len(self.numbers))
        words = [w.encode() for w in self.numbers]
        bucket = np.fromiter((zlib.crc32(w) % n_buckets for w in words), np.int32, len(words))
        order = np.lexsort((-often, bucket))  # in each bucket the frequent words first: small ranks pack well
        size = np.bincount(bucket, minlength=n_buckets)
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order)) - np.repeat(start, size)
        by_bucket = [_pack_words([words[i] for i in order[a:b]]) for a, b in zip(start, start + size, strict=True)]
        r = rank[at]
        planes = (bucket[at].astype("<u2"), (r & 255).astype("u1"), (r >> 8).astype("<u4"))
        return {"block": block, "ids": self.ids, "counts": self.counts, "words": by_bucket} | {
            f"plane{k}": _pack(p.tobytes()) for k, p in enumerate(planes)
        }


def _positions(row: dict) -> tuple[np.ndarray, np.ndarray]:
    b, low, high = (np.frombuffer(_unpack(row[f"plane{k}"]), t) for k, t in enumerate(("<u2", "u1", "<u4")))
    return b.astype(np.int64), low.astype(np.int64) | (high.astype(np.int64) << 8)


def blocks(docs: DataFrame, id_col: str, text_col: str, pattern: str, n_buckets: int) -> DataFrame:
    """Write the block table, bucketed by block, and read it; words are dealt to n_buckets lists."""
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    schema = f"block long, ids array<{id_type}>, counts array<int>, words array<binary>, plane0 binary, plane1 binary, plane2 binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        match, first = regex.compile(pattern).findall, TaskContext.get().partitionId() << 33
        now, arrow = _Block(), None
        for batch in batches:
            arrow = arrow or pa.schema(
                [("block", pa.int64()), ("ids", pa.list_(batch.schema.field(0).type)), ("counts", pa.list_(pa.int32())), ("words", pa.list_(pa.binary()))]
                + [(f"plane{k}", pa.binary()) for k in range(3)]
            )
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                now.add(doc_id.as_py(), text.as_py(), match)
                if now.chars >= BLOCK_CHARS:
                    yield pa.RecordBatch.from_pylist([now.row(first, n_buckets)], arrow)
                    now, first = _Block(), first + 1
        if now.ids:
            yield pa.RecordBatch.from_pylist([now.row(first, n_buckets)], arrow)

    return bucketed(slim.mapInArrow(cut, schema), "block", "bpe_blocks")


def _width(path: str) -> str:
    """The least unsigned integers that hold every id."""
    return "<u2" if max(_ranks(path).values()) < 1 << 16 else "<u4"


def _encode_words(path: str, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, bucket, known = _encoding(path).encode_ordinary, None, {}
        for batch in batches:
            out: dict[str, list] = {"block": [], "bucket": [], "lens": [], "ids": []}
            for block, b, words in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if b != bucket:
                    bucket, known = b, {}
                words = _unpack_words(words)
                for w in words:
                    if w not in known:
                        known[w] = piece(w.decode())
                found = [known[w] for w in words]
                out["block"].append(block)
                out["bucket"].append(b)
                out["lens"].append(_pack(np.fromiter(map(len, found), "<u4", len(found)).tobytes()))
                out["ids"].append(_pack(np.fromiter((i for f in found for i in f), width).tobytes()))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("lens", pa.binary()), ("ids", pa.binary())]))

    return run


def _assemble(n_buckets: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names if n != "ids"}
                found = [x | {c: _unpack(x[c]) for c in ("lens", "ids")} for x in sorted(row["found"], key=lambda x: x["bucket"])]
                lens = np.concatenate([np.frombuffer(x["lens"], "<u4") for x in found] or [np.empty(0, "<u4")]).astype(np.int64)
                ids = np.concatenate([np.frombuffer(x["ids"], width) for x in found] or [np.empty(0, width)]).astype(np.int32)
                first = np.zeros(n_buckets, np.int64)  # each bucket's first word
                total = 0
                for x in found:
                    first[x["bucket"]] = total
                    total += len(x["lens"]) // 4
                starts = np.cumsum(lens) - lens
                bucket, rank = _positions(row)
                upto = np.concatenate([[0], np.cumsum(np.array(row["counts"], np.int64))])
                doc_ids, at, rows, flat = batch.column("ids")[k].values, 0, 0, []
                for d in range(len(row["counts"])):  # some documents at a time: the ids outgrow the positions
                    rows += 1
                    if upto[d + 1] - upto[at] < 500_000 and rows < FLUSH_ROWS and d + 1 < len(row["counts"]):
                        continue
                    word = first[bucket[upto[at] : upto[d + 1]]] + rank[upto[at] : upto[d + 1]]
                    n = lens[word]
                    ends = np.cumsum(n)
                    flat = ids[np.repeat(starts[word] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
                    offsets = np.concatenate([[0], ends])[upto[at : d + 2] - upto[at]].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.slice(at, d + 1 - at), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "ids"]
                    )
                    at, rows = d + 1, 0

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", then=None) -> DataFrame:
    """Return id and ids (array of int) for every document; with ``then``, from DECODED, what it makes of them."""
    ship(docs.sparkSession)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = min(MOST_BUCKETS, max(BUCKETS, n))
    table, width = blocks(docs, id_col, text_col, pattern, n_buckets), _width(ranks_path)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    words = table.select("block", F.posexplode("words").alias("bucket", "words")).where(F.octet_length("words") > 0)
    encoded = (
        words.repartition(n, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_encode_words(ranks_path, width), "block long, bucket int, lens binary, ids binary")
    )
    found = encoded.groupBy("block").agg(F.collect_list(F.struct("bucket", "lens", F.col("ids").alias("ids"))).alias("found"))
    none = F.array().cast("array<struct<bucket: int, lens: binary, ids: binary>>")
    met = table.drop("words").join(found.hint("shuffle_merge"), "block", "left").withColumn("found", F.coalesce("found", none)).drop("block")
    assemble, columns = _assemble(n_buckets, width), "ids array<int>"
    if then is None:
        return met.mapInArrow(assemble, f"id {id_type}, {columns}").withColumnRenamed("id", id_col)
    # in the worker that assembles: a second one a task would need memory of its own
    return met.mapInArrow(lambda batches: then(assemble(batches)), f"id {id_type}, {DECODED}").withColumnRenamed("id", id_col)


DECODED = "n_tokens long, ids_le binary, decoded binary, ids array<int>"


def decoding(ranks_path: str):
    """Batches of id and ids to batches of id and DECODED. An id that the vocabulary lacks is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(ranks_path)
        for batch in batches:
            lists = batch.column(1)
            offsets = np.array(lists.offsets, np.int64)
            flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            offsets -= offsets[0]
            try:
                joined = table.take(flat)
            except pa.ArrowIndexError as error:
                raise ValueError(f"no such token: {error}") from error
            if joined.null_count:
                raise ValueError("no such token: an id lies in a gap of the vocabulary")
            ends = np.concatenate([np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1), [0]])[offsets] if len(joined) else offsets
            data = joined.buffers()[2] if len(joined) else pa.py_buffer(b"")
            raw = pa.py_buffer(np.asarray(flat, dtype="<i4").tobytes())
            columns = [batch.column(0), pa.array(np.diff(offsets)), _binary(offsets * 4, raw), _binary(ends, data), lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_le", "decoded", "ids"])

    return run


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """From id and ids: id, n_tokens, ids_le (ids as little-endian unsigned 32-bit integers) and decoded bytes; ids if asked for.

    A null list decodes to nothing; an id that the vocabulary lacks is an error.
    """
    ship(encoded.sparkSession)
    id_type = encoded.select(id_col).schema[0].dataType.simpleString()
    slim = encoded.select(F.col(id_col).alias("id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    out = slim.mapInArrow(decoding(ranks_path), f"id {id_type}, {DECODED}").withColumnRenamed("id", id_col)
    return out if with_ids else out.drop("ids")


def _binary(offsets: np.ndarray, data: pa.Buffer) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), data]).cast(pa.binary())
