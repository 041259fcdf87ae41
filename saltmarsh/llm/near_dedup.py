"""MinHash near-duplicates by a signature-coordinate inverted join.

A text's set of word shingles has a signature of COORDINATES minima. Texts with equal sets form a class. A pair
of classes is worth confirming when MATCHES coordinates agree. Such a pair shares one of the
COORDINATES - MATCHES + 1 rarest coordinate values of either, so classes are posted under those only (the
prefix), and values that one class alone has are skipped: most texts have so many of them that they are not
posted at all. Candidates are confirmed on the full sets.

No list is expanded into pairs. Each list names a hub, the member whose values are the most shared, and pairs its
members with it; confirmed links join components. Lists that name the same hub form a group. In a group that
still holds several components, each member outside the largest one is held against all others, in blocks
of bounded rows and bytes, three times over: by sketches (a byte of each coordinate); by parities of what passed; by
full sets of what passed that. In a block the members lie in a posting list for each coordinate and byte, and an asking
row counts collisions by merging its lists: the SHORT shortest are merged, members that they give too seldom to reach
MATCHES are skipped, and the long lists are only probed for the rest. So most members travel as 64 bytes, and
sets only where sketch and parity leave a doubt. A block gives one link for each member and component at most. So
every pair of a list is confirmed, or its ends are joined by other links.

A parity is a bitmap of at least four bits a shingle, each the parity of the number of shingles hashed to it. Bits in
which two parities differ are at most the shingles that only one of two sets has: pairs it rejects aren't linked.

With a similarity of 0.8 the chance that fewer than MATCHES of COORDINATES agree is below 1e-5 a pair.

Cases: null and empty texts, and texts without words, have an empty set and link to nothing; fewer words than a
shingle make one shingle; equal texts form one class whatever their number; rows that share an id
are documents of their own; rows with null id link to nothing and are kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import bucketed, join_skewed, materialize, ship

COORDINATES = 64
MATCHES = 36
#: Lists of a sketch that are merged; the longer ones are probed.
SHORT = 32
#: Rows of a block: members outside the largest component, and members they are held against.
OUTSIDERS, MEMBERS = 4096, 16_384
#: Shingles of those members of a block that ask or are asked, where sets or parities travel.
BLOCK_SETS, BLOCK_PARITIES = 4_000_000, 64_000_000
#: Up to this many class ids and keys (48 bytes each) are broadcast to find their texts; more are joined by shuffle.
BROADCAST_IDS = 200_000
#: Words whose hashes a worker remembers before it starts afresh.
REMEMBERED = 100_000


class _WordHashes(defaultdict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int, known: _WordHashes) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. A-Z are lower-cased, as bytes.lower() does."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # splits at the six ASCII white spaces
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(known) > REMEMBERED:
        known.clear()
    if len(h) < width:
        width = len(h)
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(out)


_random = np.random.Generator(np.random.PCG64(20240601))
_A = _random.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def signature(hashes: np.ndarray, at_once: int = 20_000) -> np.ndarray:
    """Minima of COORDINATES hash functions, 32 bits each."""
    out = np.full(COORDINATES, 2**64 - 1, np.uint64)
    for k in range(0, len(hashes), at_once):
        out = np.minimum(out, (hashes[None, k : k + at_once] * _A[:, None] + _B[:, None]).min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32)


def _key(hashes: np.ndarray) -> bytes:
    return hashlib.sha256(hashes.tobytes()).digest()


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            n, keys, sigs = [], [], []
            for text in batch.column(1):
                h = shingles(text.as_py(), width, known)
                n.append(len(h))
                keys.append(_key(h) if len(h) else None)
                sigs.append(signature(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["id", "n_shingles", "set_key", "sig"]
            )

    return run


def parity(hashes: np.ndarray) -> np.ndarray:
    """Words of a bitmap: of how many hashes with the same low bits the number is odd."""
    bits = max(64, 1 << (4 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(bitmap: np.ndarray) -> np.ndarray:
    """The bitmaps that half as many bits give."""
    half = bitmap.shape[-1] // 2
    return bitmap[..., :half] ^ bitmap[..., half:]


def may_link(differ: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether 100 * shared >= percent * union is possible, of sets of ``both`` hashes in sum that differ in so many at least."""
    return (100 + percent) * differ <= (100 - percent) * both


def _sets(width: int):
    """Set and parity of each class, from (class, set_key, text); texts that only share the id are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            classes, parities, sets = [], [], []
            for c, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                h = shingles(text.as_py(), width, known)
                if _key(h) == key:
                    classes.append(c)
                    parities.append(parity(h).tobytes())
                    sets.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), pa.array(parities, pa.binary()), pa.array(sets, pa.binary())], ["class", "parity", "hashes"])

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each coordinate of a signature: the coordinate and its value as one number."""
    base = np.arange(COORDINATES, dtype=np.int64) << 32
    for batch in batches:
        sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
        owners = np.repeat(np.asarray(batch.column(0)), COORDINATES)
        yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array((sigs.astype(np.int64) + base).ravel())], ["class", "token"])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, n_shingles, sketch) from (class, n_shingles, sig): the sketch is the low byte of each coordinate."""
    for batch in batches:
        sketches = [np.frombuffer(x, np.uint32).astype(np.uint8).tobytes() for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sketches, pa.binary())], ["class", "n_shingles", "sketch"])


def _sketches(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether 100 * shared >= percent * union, of two sets of distinct hashes."""
    both = len(p) + len(q)
    if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
        return False
    merged = np.sort(np.concatenate([p, q]), kind="stable")
    shared = int(np.count_nonzero(merged[1:] == merged[:-1]))
    return 100 * shared >= percent * (both - shared)


PAIRS, SIZED = "a long, b long", "a long, b long, both long"
ROWS = "group long, class long, component long, n_shingles long"


def _select(batch: pa.RecordBatch, keep) -> pa.RecordBatch:
    return batch.select(["a", "b", "both"]).filter(pa.array(keep, pa.bool_()))


def _collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, both, sketch_a, sketch_b), the pairs above the match threshold."""
    for batch in batches:
        yield _select(batch, (_sketches(batch.column(3)) == _sketches(batch.column(4))).sum(axis=1) >= MATCHES)


def _confirm(test):
    """Of (a, b, both, x_a, x_b), the pairs whose x, read as 64-bit words, pass the test with the sum of their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = lambda k: (np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(k))  # noqa: B023, E731
            yield _select(batch, [bool(test(p, q, both)) for p, q, both in zip(words(3), words(4), batch.column(2).to_pylist(), strict=True)])

    return run


def differing(p: np.ndarray, q: np.ndarray) -> int:
    """In how many bits two parities differ, the longer one folded."""
    while len(p) != len(q):
        p, q = (fold(p), q) if len(p) > len(q) else (p, fold(q))
    return int(np.bitwise_count(p ^ q).sum())


class _Parities:
    """The parities of a block's rows, by their length."""

    def __init__(self, column: pa.Array):
        self.words = np.array([len(x.as_buffer()) // 8 for x in column])
        self.at, self.table = np.zeros(len(self.words), np.int64), {}
        for w in np.unique(self.words):
            own = np.flatnonzero(self.words == w)
            self.at[own] = np.arange(len(own))
            self.table[w] = np.frombuffer(b"".join(column.take(pa.array(own)).to_pylist()), np.uint64).reshape(-1, w)

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """In how many bits row i and the others differ; lengths may differ by a factor of two, others count as no difference."""
        out, w = np.zeros(len(others), np.int64), self.words[i]
        mine = self.table[w][self.at[i]]
        for v in np.unique(self.words[others]):
            sel = np.flatnonzero(self.words[others] == v)
            theirs = self.table[v][self.at[others[sel]]]
            if v == w:
                out[sel] = np.bitwise_count(theirs ^ mine).sum(axis=1)
            elif v == 2 * w:
                out[sel] = np.bitwise_count(fold(theirs) ^ mine).sum(axis=1)
            elif w == 2 * v:
                out[sel] = np.bitwise_count(theirs ^ fold(mine)).sum(axis=1)
        return out


class _Lists:
    """Posting lists of sketches: for each coordinate and byte the rows that have it, in order."""

    def __init__(self, sketches: np.ndarray):
        self.sketches = sketches
        self.rows = np.argsort(sketches, axis=0, kind="stable").astype(np.int32)
        size = np.stack([np.bincount(sketches[:, c], minlength=256) for c in range(COORDINATES)])
        self.ends = np.cumsum(size, axis=1)
        self.starts = self.ends - size

    def collisions(self, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that agree with a sketch in MATCHES coordinates at least, and in how many."""
        every = np.arange(COORDINATES)
        starts, ends = self.starts[every, sketch], self.ends[every, sketch]
        order = np.argsort(ends - starts, kind="stable")
        short, long = order[:SHORT], order[SHORT:]
        merged = np.concatenate([self.rows[starts[c] : ends[c], c] for c in short])
        times = np.bincount(merged, minlength=len(self.rows))
        met = np.flatnonzero(times >= MATCHES - len(long))  # the long lists can't make up for less
        agree = times[met] + (self.sketches[met][:, long] == sketch[long]).sum(axis=1)
        enough = agree >= MATCHES
        return met[enough], agree[enough]


class _Block:
    """Members that ask, and members of other components that may be linked with them."""

    def __init__(self, rows: pa.Table, percent: int):
        self.rows, self.percent = rows.combine_chunks(), percent
        column = lambda c: np.asarray(self.rows.column(c))
        self.cls, self.part, self.outside, self.asking, self.n = map(column, ("class", "component", "outside", "asking", "n_shingles"))
        self.sketches = _sketches(self.rows.column("sketch"))
        self.parities = _Parities(self.rows.column("parity").chunk(0)) if "parity" in self.rows.column_names else None

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each asking row and the rows in doubt, those with the most agreeing coordinates first."""
        members = np.flatnonzero(~self.asking)
        lists, n, cls, part = _Lists(self.sketches[members]), self.n[members], self.cls[members], self.part[members]
        inside = ~self.outside[members]
        for i in np.flatnonzero(self.asking):
            met, agree = lists.collisions(self.sketches[i])
            size = n[met]
            like = (np.minimum(size, self.n[i]) * 100 >= self.percent * np.maximum(size, self.n[i])) & (part[met] != self.part[i]) & (inside[met] | (self.cls[i] < cls[met]))
            met, agree = met[like], agree[like]
            others = members[met[np.argsort(-agree, kind="stable")]]
            if self.parities is not None and len(others):
                others = others[may_link(self.parities.differ(i, others), self.n[others] + self.n[i], self.percent)]
            if len(others):
                yield i, others


def _in_doubt(percent: int):
    """The rows of a block's members that sketches, and parities where given, leave in doubt."""

    def run(rows: pa.Table) -> pa.Table:
        block, open_ = _Block(rows, percent), set()
        for i, others in block:
            open_.add(block.cls[i])
            open_.update(block.cls[others])
        seen = ~block.asking & np.isin(block.cls, np.fromiter(open_, np.int64, len(open_)))
        asked = block.asking & np.isin(block.cls, np.fromiter(open_, np.int64, len(open_)))
        return block.rows.select(["group", "class", "component", "n_shingles"]).filter(pa.array(seen | asked))

    return run


def _hold_against(percent: int):
    """Links of a block's asking members with other components; one a component at most."""

    def run(rows: pa.Table) -> pa.Table:
        block, links = _Block(rows, percent), []
        hashes = block.rows.column("hashes").chunk(0)
        held = lambda k: np.frombuffer(hashes[int(k)].as_buffer(), np.uint64)
        for i, others in block:
            met, mine = set(), held(i)
            for k in others:
                if block.part[k] not in met and linked(mine, held(k), percent):
                    met.add(block.part[k])
                    links.append((min(block.cls[i], block.cls[k]), max(block.cls[i], block.cls[k])))
        return pa.table({c: pa.array([x[n] for x in links], pa.int64()) for n, c in enumerate("ab")})

    return run


def in_blocks(members: DataFrame, load: DataFrame, most_shingles: int | None = None, least: int = 2) -> DataFrame:
    """Rows of (group, component, class, n_shingles) with what ``load`` has of each class, placed in blocks of groups.

    Members outside a group's largest component ask; all are asked. Groups of one component or
    of fewer than ``least`` members have no block.
    """
    parts = members.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    split = parts.groupBy("group").agg(
        F.max(F.struct("n", "component", "shingles")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles")
    )

    def number(rows, most, shingles):
        return F.ceil(F.greatest(rows / most, shingles / most_shingles) if most_shingles else rows / most)

    split = split.where((F.col("parts") > 1) & (F.col("n") >= least)).select(
        "group",
        F.col("main.component").alias("main"),
        number(F.col("n"), MEMBERS, F.col("shingles")).alias("n_chunks"),
        number(F.col("n") - F.col("main.n"), OUTSIDERS, F.col("shingles") - F.col("main.shingles")).alias("n_blocks"),
    )
    apart = members.join(split, "group").withColumn("outside", F.col("component") != F.col("main"))
    at = F.xxhash64("class")
    place = lambda asking, chunk, block: F.struct(F.lit(asking).alias("asking"), chunk.cast("long").alias("chunk"), block.cast("long").alias("block"))
    heard = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda k: place(False, F.pmod(at, F.col("n_chunks")), k))
    asked = F.transform(F.sequence(F.lit(0), F.col("n_chunks") - 1), lambda k: place(True, k, F.pmod(at, F.col("n_blocks"))))
    apart = apart.withColumn("places", F.when(F.col("outside"), F.concat(heard, asked)).otherwise(heard)).drop("main", "n_chunks", "n_blocks")
    placed = apart.hint("shuffle_merge").join(load, "class").withColumn("place", F.explode("places")).drop("places")
    return placed.select("*", "place.*").drop("place").groupBy("group", "chunk", "block")


def components(links: DataFrame) -> DataFrame:
    """node and its component's smallest node, from (a, b) links: neighbours' minimum, then label of label."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = join_skewed(both, labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(near, "a").select("a", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        new = materialize(new, "labels")
        jump = new.select(F.col("a").alias("label"), F.col("label").alias("far"))
        new = materialize(join_skewed(new, jump, "label").select("a", F.least("label", "far").alias("label"), "old"), "labels")
        labels = new.select("a", "label")
        if new.where("label <> old").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))


def postings(classes: DataFrame) -> DataFrame:
    """Prefix postings (token, class, shared): shared adds up how many classes have each of the class's values."""
    tokens = classes.select("class", "sig").mapInArrow(_tokens, "class long, token long")
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = tokens.join(common, "token").groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("held"), F.sum("n").alias("shared")
    )
    prefix = COORDINATES - MATCHES + 1
    alone = COORDINATES - F.size("held")  # values of this class only are its rarest
    few = F.slice("held", 1, F.greatest(F.lit(0), prefix - alone))
    return held.select("class", "shared", F.explode(few).alias("t")).select(F.col("t.token").alias("token"), "class", "shared")


def pair_links(classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between classes that give all components; texts holds (id, text)."""
    spark = classes.sparkSession
    posted = materialize(postings(classes), "postings")
    sizes = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lists = materialize(posted.join(sizes, "token"), "lists")
    if lists.isEmpty():
        return spark.createDataFrame([], PAIRS)
    hubs = lists.groupBy("token").agg(F.max(F.struct("shared", "class")).getField("class").alias("hub"))
    groups = materialize(lists.select("token", "class").join(hubs, "token").select("class", F.col("hub").alias("group")).distinct(), "groups")
    listed = classes.join(groups.select("class").distinct(), "class").select("class", "n_shingles", "sig")
    sketches = bucketed(listed.mapInArrow(_sketch, "class long, n_shingles long, sketch binary"), "class", "near_dedup_sketches")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(class, parity, hashes) of the wanted classes, bucketed by class: one text of each is read."""
        wanted = materialize(classes.join(wanted.distinct(), "class").select("class", "id", "set_key"), "wanted")
        few = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
        found = texts.join(few, "id").select("class", "set_key", "text").mapInArrow(_sets(width), "class long, parity binary, hashes binary")
        return bucketed(found.groupBy("class").agg(F.first("parity").alias("parity"), F.first("hashes").alias("hashes")), "class", "near_dedup_sets")

    def sides_of(pairs: DataFrame, load: DataFrame, *columns: str) -> DataFrame:
        """Pairs with what the bucketed table has of both: only they travel, with what b has to a."""
        for c in "ba":
            pairs = pairs.hint("shuffle_merge").join(load.select(F.col("class").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in columns)), c)
        return pairs

    met = groups.where("class <> group").select(F.least("class", "group").alias("a"), F.greatest("class", "group").alias("b")).distinct()
    like = sides_of(met, sketches, "n_shingles", "sketch").where(
        100 * F.least("n_shingles_a", "n_shingles_b") >= percent * F.greatest("n_shingles_a", "n_shingles_b")
    )
    like = like.withColumn("both", F.col("n_shingles_a") + F.col("n_shingles_b")).select("a", "b", "both", "sketch_a", "sketch_b")
    close = materialize(like.mapInArrow(_collide, SIZED), "close")
    sets = sets_of(close.select(F.explode(F.array("a", "b")).alias("class")))
    tests = {"parity": lambda p, q, both: may_link(differing(p, q), both, percent), "hashes": lambda p, q, both: linked(p, q, percent)}
    for column, test in tests.items():
        sides = sides_of(close, sets, column).select("a", "b", "both", f"{column}_a", f"{column}_b")
        close = materialize(sides.mapInArrow(_confirm(test), SIZED), "links")
    links = close.select("a", "b")

    labels = components(links).withColumnRenamed("node", "class") if not links.isEmpty() else spark.createDataFrame([], "class long, component long")
    live = groups.join(sketches.select("class", "n_shingles"), "class").join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    # a group of two is a hub and a member that was held against it
    doubts = in_blocks(live, sketches.drop("n_shingles"), least=3).applyInArrow(_in_doubt(percent), ROWS)
    doubts = materialize(doubts.distinct(), "doubts")
    sets = sets_of(doubts.select("class"))
    load = sketches.select("class", "sketch").join(sets, "class")
    left = in_blocks(doubts, load.drop("hashes"), BLOCK_PARITIES).applyInArrow(_in_doubt(percent), ROWS)
    left = materialize(left.distinct(), "doubts")
    rest = in_blocks(left, load, BLOCK_SETS).applyInArrow(_hold_against(percent), PAIRS)
    return links.union(materialize(rest, "links"))


def group(docs: DataFrame, width: int, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return id, n_shingles, class_id, component_id and kept for every document.

    class_id is the smallest id with the same set, component_id the smallest id that links reach.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = materialize(rows.mapInArrow(_sign(width), "id long, n_shingles long, set_key binary, sig binary"), "signatures")
    usable = signed.where("id IS NOT NULL AND set_key IS NOT NULL")
    by_set = usable.groupBy("set_key").agg(F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    classes = materialize(by_set.withColumn("class", F.monotonically_increasing_id()), "classes")
    links = pair_links(classes, rows, width, percent)
    known = classes.select("set_key", "class", F.col("id").alias("class_id"))
    slim = signed.select("id", "n_shingles", "set_key")
    if links.isEmpty():
        known = known.withColumn("component_id", F.col("class_id"))
    else:
        labels = components(links).select(F.col("node").alias("class"), "component")
        known = known.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
        smallest = known.groupBy("component").agg(F.min("class_id").alias("component_id"))
        known = known.join(smallest, "component")
    named = join_skewed(slim.where("set_key IS NOT NULL"), known.select("set_key", "class_id", "component_id"), "set_key", "left")
    named = named.unionByName(slim.where("set_key IS NULL"), allowMissingColumns=True)
    linked = F.col("id").isNotNull()
    return named.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(linked, F.coalesce("class_id", "id")).alias("class_id"),
        F.when(linked, F.coalesce("component_id", "id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
