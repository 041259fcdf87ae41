"""Phrase collocations: counts of all short phrases from suffix automata, association scores, subsumption.

Each task feeds its texts, as word numbers with a mark between pieces, to generalised suffix automata, one a language and
SHARD_WORDS words. As only phrases of at most ``max_words`` words are wanted, an automaton is cut off at that depth, and
then sorting gives it at once: its states are the classes of phrases that end at the same places, and the tree of their
suffix links is the tree of reversed phrases, in which a phrase is the child of itself without its first word. Sorting
end places by the word itself, the word before it and so on gives the nodes of that tree with the sizes of their sets of
end places (endpos); a node with as many end places as its parent is in one state with it. ``states`` makes them and
``phrases`` enumerates, state by state, the phrases from the longest down to the one whose suffix link leaves the state.
The root's end places are all words, so its count is ``n``.

Counts are reduced globally: a shard's phrases are dealt by a hash into buckets and packed, a row a shard and bucket, so
some thousands of rows are shuffled where there are a hundred million phrases. A task merges a bucket row by row and
keeps the phrases with ``min_count``; a part of such a phrase is as frequent, so no count that a score needs is lost.
The number of buckets follows the bytes of text. Parts are looked up by joins that leave hot words where they are.
Subsumption follows the same links: what lies inside a candidate is on the chain of suffix links of one of its
beginnings, and the greatest count over all longer candidates is one grouped maximum.

Cases: null text is empty, null language ``und``; repeated rows count each; texts are read in slices of SLICE_BYTES
bytes, so that a long one takes no more memory than its bytes, and a shard may end within one, its last words being
context for the next; a language without candidates has no rows; an empty table gives an empty result; ties go by count,
then phrase; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import join_skewed, materialize, ship

#: What parts pieces, besides U+000A to U+000D.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Words of an automaton, bytes of text taken at once, and bytes of text to a bucket.
SHARD_WORDS, SLICE_BYTES, BUCKET_BYTES = 800_000, 2 << 20, 4 << 20
#: Phrases that a merging task holds unmerged.
PENDING = 1_000_000

_PLAIN = bytes.maketrans(b"\t" + PIECE_ENDS, b" " + b"." * len(PIECE_ENDS))
_BREAK = re.compile(rb"[ .]")
PACKED = "lang string, bucket int, packed binary"
COUNTED = "lang string, phrase string, n long"
_PHRASES = pa.schema([("phrase", pa.large_binary()), ("n", pa.int64())])


def slices(text: bytes) -> Iterator[bytes]:
    """The text in lower case, blanks as spaces and piece ends as full stops, in slices that cut no word."""
    at = 0
    while at < len(text):
        end = at + SLICE_BYTES
        part = text[at:end].lower().translate(_PLAIN)
        while end < len(text) and not _BREAK.match(part[-1:]):
            more = text[end : end + SLICE_BYTES].lower().translate(_PLAIN)
            cut = _BREAK.search(more)
            end += cut.end() if cut else len(more)
            part += more[: cut.end()] if cut else more
        yield part
        at = end


class Shard:
    """Word numbers of a task's texts by language; 0 is the mark between pieces."""

    def __init__(self, max_words: int):
        self.depth, self.words, self.size = max_words, {}, 0
        self.by_lang: dict[bytes, array] = {}
        self.context: dict[bytes, int] = {}  # places at the start that the automaton before this one counted

    def add(self, lang: bytes, text: bytes) -> Iterator[tuple[bytes, pa.Table]]:
        """Take a text; what comes out are the languages and phrases of automata that got full."""
        for part in slices(text):
            ids, number = self.by_lang.setdefault(lang, array("i", [0])), self.words
            read = [number.setdefault(w, len(number) + 1) if w != b"." else 0 for w in part.replace(b".", b" . ").split()]
            ids.extend(read)
            self.size += len(read)
            if self.size >= SHARD_WORDS:
                yield from self.flush(lang)
        if lang in self.by_lang:
            self.by_lang[lang].append(0)

    def flush(self, within: bytes | None = None) -> Iterator[tuple[bytes, pa.Table]]:
        """The phrases of all languages; of the one whose text goes on, the last words stay as context."""
        names = pa.array([b"", *self.words], pa.large_binary())
        hashes = np.fromiter((zlib.crc32(w) for w in (b"", *self.words)), np.uint64, len(self.words) + 1)
        tail = []
        for lang, ids in self.by_lang.items():
            yield lang, pa.concat_tables(phrases(np.frombuffer(ids, np.int32), self.context.get(lang, 0), names, hashes, self.depth, lang))
            if lang == within:
                last = ids[-(self.depth - 1) :] if self.depth > 1 else []
                tail = [names[i].as_py() if i else None for i in last]
        self.words, self.size, self.by_lang, self.context = {}, 0, {}, {}
        if within is not None:
            self.by_lang[within] = array("i", [0] + [self.words.setdefault(w, len(self.words) + 1) if w is not None else 0 for w in tail])
            self.context[within] = len(self.by_lang[within])


def states(ids: np.ndarray, start: int, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The automaton's suffix-link tree, level by level: of each node its first word, parent, endpos count and shortest phrase.

    A node of level d is a phrase of d words, its parent the phrase without the first word. shortest is the least
    number of words of the phrases in its state; only the longest node of a state, which has no child with as many end
    places, stands for it, and its suffix link is the ancestor of shortest - 1 words.
    """
    place = np.flatnonzero(ids[start:]) + start
    node, before = np.zeros(len(place), np.int64), ids.astype(np.int64)
    count, shortest = np.array([len(place)]), np.array([0])
    for d in range(1, depth + 1):
        there = place - d + 1 >= 0
        there[there] = before[place[there] - d + 1] > 0
        place, node = place[there], node[there]
        width = int(before.max(initial=0)) + 1
        keys, node, n = np.unique(node * width + before[place - d + 1], return_inverse=True, return_counts=True)
        parent, first = keys // width, keys % width
        shortest = np.where((n == count[parent]) & (d > 1), shortest[parent], d)
        count = n
        yield first, parent, n, shortest


def phrases(ids: np.ndarray, start: int, names: pa.Array, hashes: np.ndarray, depth: int, lang: bytes) -> Iterator[pa.Table]:
    """h (a hash), phrase and n (the count) of every phrase of an automaton, state by state, and of the root."""
    tree = list(states(ids, start, depth))
    text, mixed = [pa.array([b""], pa.large_binary())], [np.array([zlib.crc32(lang)], np.uint64)]
    for d, (first, parent, _, _) in enumerate(tree):
        word = names.take(pa.array(first))
        text.append(word if d == 0 else pc.binary_join_element_wise(word, text[-1].take(pa.array(parent)), pa.scalar(b" ", pa.large_binary())))
        mixed.append((mixed[-1][parent] * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[first] * np.uint64(0xC2B2AE3D27D4EB4F)))
    yield _rows(mixed[0], text[0], np.array([len(np.flatnonzero(ids[start:]))]))
    for d in range(1, depth + 1):
        n, shortest = tree[d - 1][2:]
        longest = np.ones(len(n), bool)
        if d < depth:
            parent, times = tree[d][1:3]
            longest[parent[times == n[parent]]] = False
        node, size, least = np.flatnonzero(longest), n[longest], shortest[longest]
        for words in range(d, 0, -1):  # along the state: the longest phrase, then without its first word, and so on
            yield _rows(mixed[words][node], text[words].take(pa.array(node)), size)
            on = least < words
            node, size, least = tree[words - 1][1][node[on]], size[on], least[on]


def _rows(mixed: np.ndarray, phrase: pa.Array, n: np.ndarray) -> pa.Table:
    spread = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return pa.table({"h": pa.array((spread >> np.uint64(32)).astype(np.uint32)), "phrase": phrase, "n": pa.array(n.astype(np.int64))})


def _pack(lang: bytes, rows: pa.Table, buckets: int) -> Iterator[pa.RecordBatch]:
    """The phrases of an automaton, a row a bucket."""
    bucket = rows["h"].to_numpy() % np.uint32(buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = rows.drop_columns("h").take(pa.array(order)).combine_chunks()
    for b in np.flatnonzero(np.diff(ends)):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _PHRASES, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows.slice(ends[b], ends[b + 1] - ends[b]))
        yield pa.record_batch({"lang": pa.array([lang.decode()]), "bucket": pa.array([b], pa.int32()), "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _counting(max_words: int, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(max_words)
        for batch in batches:
            for lang, text in zip(*(batch.column(c).cast(pa.binary()) for c in (0, 1)), strict=True):
                for name, full in shard.add(lang.as_py(), text.as_py()):
                    yield from _pack(name, full, buckets)
        for name, full in shard.flush():
            yield from _pack(name, full, buckets)

    return count


def _merged(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("phrase").aggregate([("n", "sum")]).rename_columns(_PHRASES.names)


def _merging(min_count: int):
    def emit(lang: str, tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = _merged(tables)
        rows = rows.filter(pc.or_(pc.greater_equal(rows["n"], min_count), pc.equal(pc.binary_length(rows["phrase"]), 0)))
        for at in range(0, len(rows), 100_000):
            part = rows.slice(at, 100_000)
            phrase = part["phrase"].cast(pa.binary()).cast(pa.string())
            yield from pa.table({"lang": pa.array([lang] * len(part)), "phrase": phrase, "n": part["n"]}).combine_chunks().to_batches()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pending, held = None, [], 0
        for batch in batches:
            for lang, bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if (lang, bucket) != at and pending:
                    yield from emit(at[0], pending)
                    pending, held = [], 0
                at = lang, bucket
                pending.append(pa.ipc.open_stream(packed.as_buffer()).read_all())
                held += len(pending[-1])
                if held > PENDING + 2 * len(pending[0]):  # a merged table comes first, so this stays linear
                    pending = [_merged(pending)]
                    held = len(pending[0])
        if pending:
            yield from emit(at[0], pending)

    return merge


def counts(docs: DataFrame, max_words: int, min_count: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, phrase and n of every phrase of up to ``max_words`` words with ``min_count`` occurrences; the phrase without words counts all."""
    spark = docs.sparkSession
    ship(spark)
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_bytes = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // BUCKET_BYTES))
    packed = slim.mapInArrow(_counting(max_words, buckets), PACKED)
    dealt = packed.repartition(min(buckets, 65_536), "bucket").sortWithinPartitions("bucket", "lang")
    return dealt.mapInArrow(_merging(min_count), COUNTED)


def _words(phrase: Column) -> Column:
    return F.size(F.split(phrase, " "))


def _some(phrase: Column, k: Column) -> Column:
    """The first k words, or the last -k."""
    return F.call_function("substring_index", phrase, F.lit(" "), k)


def _floor_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: counts up to 10 ** 15 keep all products within 38 digits."""
    wide = lambda c: c.cast("decimal(16,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")
    over, under = (million * wide(a) * wide(a)).cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)")
    return F.call_function("div", over, under)


def mine(
    docs: DataFrame, min_words: int = 2, max_words: int = 3, min_count: int = 10, most: int = 2000, cover: int = 50, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``most`` best phrases of each language.

    a is the phrase's count; l and r are those of the parts of its weakest cut. A candidate that lies inside a longer one with
    ``cover`` per cent of its occurrences is dropped.
    """
    known = materialize(counts(docs, max_words, min_count, lang_col, text_col).withColumn("key", F.concat_ws("\n", "lang", "phrase")), "phrases")
    cand = known.where("phrase != ''").withColumn("size", _words(F.col("phrase"))).where(F.col("size") >= min_words)
    phrase, size, k = F.col("phrase"), F.col("size"), F.col("k")
    cuts = cand.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        F.concat_ws("\n", "lang", _some(phrase, k)).alias("left_key"), F.concat_ws("\n", "lang", _some(phrase, k - size)).alias("right_key"),
        "key", "k", F.col("n").alias("a"),
    )
    part = lambda side: known.select(F.col("key").alias(f"{side}_key"), F.col("n").alias(side[0]))
    once = join_skewed(materialize(cuts, "cuts"), part("left"), "left_key").drop("left_key")
    both = join_skewed(materialize(once, "cuts-left"), part("right"), "right_key")
    scored = both.groupBy("key").agg(F.min(F.struct(_floor_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))
    # the phrases inside a candidate: the suffix links of each of its beginnings
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(min_words), size),
            lambda end: F.transform(F.sequence(F.lit(min_words), end), lambda m: _some(_some(phrase, end), -m)),
        )
    )
    longer = cand.where(size > min_words).select("lang", F.explode(F.array_distinct(F.array_remove(inside, phrase))).alias("sub"), "n")
    covered = longer.groupBy(F.concat_ws("\n", "lang", "sub").alias("key")).agg(F.max("n").alias("in_longer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    left = cand.join(covered, "key", "left").where(F.col("in_longer").isNull() | (100 * wide("in_longer") < cover * wide("n"))).join(scored, "key")
    row = left.select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = row.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    total = known.where("phrase = ''").select("lang", "n")
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
