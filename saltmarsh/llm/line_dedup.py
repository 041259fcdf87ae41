"""Line dedup: by content-defined chunks of lines (``dedup``), and by whole repeated passages (``dedup_passages``).

``dedup`` gives what the SQL of op5_line_dedup states; the pipeline takes ``dedup_passages``.

Chunks. Each line is hashed, and a rolling hash covers each two neighbouring lines. A chunk starts where the rolling hash
is larger than the one before and the one after it, which depends on four lines alone: a passage is cut alike
wherever it stands, and a chunk has two lines at least. A line of LONG_WORDS words or more is a chunk of its own
and parts the lines before it from those after it. A chunk counts if it has two lines and CHUNK_WORDS words, or
LONG_WORDS words; if it occurs more than once in the corpus, and all occurrences are the same bytes, all but the
first (smallest id, then place) are removed.

Only hashes travel to find the repeats; texts of repeated chunks alone are grouped for the comparison, with
partial aggregation, so a passage that a third of the documents share costs a row a task. Chunks are written
once to the shared folder and read by each step.

Cases: null text stays null and empty text empty; rows that share an id count as one document, and only chunks
at the same place with the same hash are taken from them; rows with null id keep their text; a text that loses
all its chunks becomes empty; a word here is what single spaces separate; an empty table gives an empty result;
a text with its lines and chunks is one row of one task, some ten times its size; other columns are carried, but for columns
named like the result's, which give way.

Passages. Chunks leave the edges of a passage, and passages of few or short lines, in place, as a cut depends on
foreign lines beside it. So here each two neighbouring lines are a unit, and each line of LONG_WORDS words. A unit is
later if the same bytes stand at an earlier place of the corpus (smaller id, then row, then line). Neighbouring later
pairs make a run; a run goes if its lines have CHUNK_WORDS words together, and a later long line goes. So whatever
repeated chunk goes by ``dedup`` goes here, and a passage goes from its first line to its last. A line that goes
stands at an earlier place too, so no line is lost from the corpus.

Only hashes are counted over all units; texts of repeated units alone are compared. Cases: as above, but words
are what any white space of the shared rule separates; rows that share an id, or have none, are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import SPACE_RUN, materialize

CHUNK_WORDS = 20
LONG_WORDS = 50
#: Up to this many hashes of repeated chunks (16 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_HASHES = 1_000_000
#: Beyond that, hashes that occur so often are broadcast all the same: one of them would fill a task.
HOT = 1000
#: A word of a passage, by the word rule that the operators share.
WORD = SPACE_RUN.replace("[", "[^")
RESULT = ("n_lines", "n_removed_lines")


def _word_count(line: Column) -> Column:
    return F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def with_chunks(docs: DataFrame) -> DataFrame:
    """Of ``text``: texts (the chunks, which joined by newlines are the text), sizes (lines) and hashes (null: does not count)."""
    line, rolled, starts = F.col("lines"), F.col("rolled"), F.col("starts")
    long = lambda i: F.get(line, i)["words"] >= LONG_WORDS
    roll = lambda x, i: F.when(
        (i > 0) & (x["words"] < LONG_WORDS) & ~long(i - 1), F.md5(F.concat(F.get(line, i - 1)["h"], x["h"]))
    )
    peak = lambda i: F.coalesce((F.get(rolled, i) > F.get(rolled, i - 1)) & (F.get(rolled, i) > F.get(rolled, i + 1)), F.lit(False))
    cut = lambda i: (i == 0) | long(i) | long(i - 1) | peak(i)
    end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(line))
    part = lambda s, k: F.slice(line, s + 1, end(k) - s)
    counts = lambda c: ((c["lines"] >= 2) & (c["words"] >= CHUNK_WORDS)) | (c["words"] >= LONG_WORDS)
    return (
        docs.withColumn(
            "lines", F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), F.md5(x).alias("h"), _word_count(x).alias("words")))
        )
        .withColumn("rolled", F.transform(line, roll))
        .withColumn("starts", F.filter(F.sequence(F.lit(0), F.size(line) - 1), cut))
        .withColumn(
            "chunks",
            F.transform(
                starts,
                lambda s, k: F.struct(
                    F.array_join(F.transform(part(s, k), lambda x: x["text"]), "\n").alias("text"),
                    (end(k) - s).alias("lines"),
                    F.aggregate(part(s, k), F.lit(0), lambda a, x: a + x["words"]).alias("words"),
                ),
            ),
        )
        .withColumn("texts", F.transform("chunks", lambda c: c["text"]))
        .withColumn("sizes", F.transform("chunks", lambda c: c["lines"]))
        .withColumn("hashes", F.transform("chunks", lambda c: F.when(counts(c), F.unhex(F.md5(c["text"])))))
        .drop("text", "lines", "rolled", "starts", "chunks")
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``docs`` with repeated chunks taken out of the text, n_lines before and n_removed_lines."""
    columns = [c for c in docs.columns if c.lower() not in RESULT]
    others = [c for c in columns if c not in (id_col, text_col)]
    slim = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("rest"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chunked = materialize(with_chunks(slim), "chunks")
    with_id = chunked.where(F.col("id").isNotNull())
    placed = with_id.select("id", F.posexplode("hashes").alias("at", "hash")).where(F.col("hash").isNotNull()).distinct()
    firsts = placed.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "at")).alias("first"))
    repeated = materialize(firsts.where("n > 1").select("hash", "first"), "repeated")
    hashes = repeated.select("hash")
    if repeated.count() <= BROADCAST_HASHES:
        hashes = F.broadcast(hashes)
    # the byte comparison: the least and the greatest text of a hash are the same
    pairs = F.explode(F.arrays_zip(F.col("hashes").alias("hash"), F.col("texts").alias("text")))
    texts = with_id.select(pairs.alias("c")).select("c.hash", "c.text").join(hashes, "hash")
    same = texts.groupBy("hash").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low = high").select("hash")
    sure = materialize(repeated.join(same, "hash"), "sure")
    gone = (
        placed.join(sure, "hash")
        .where(F.struct("id", "at") != F.col("first"))
        .groupBy("id")
        .agg(F.collect_list(F.struct("at", "hash")).alias("gone"))
    )
    met = chunked.join(gone, "id", "left")
    here = F.filter("gone", lambda g: F.get("hashes", g["at"]).eqNullSafe(g["hash"]))
    places = F.array_distinct(F.transform(here, lambda g: g["at"]))
    all_places = F.sequence(F.lit(0), F.size("texts") - 1)
    left = F.transform(F.array_except(all_places, F.col("places")), lambda i: F.get("texts", i))
    lines = lambda a: F.aggregate(a, F.lit(0), lambda t, n: t + n)
    out = (
        met.withColumn("places", F.coalesce(places, F.array().cast("array<int>")))
        .withColumn("text", F.when(F.col("texts").isNotNull(), F.array_join(left, "\n")))
        .withColumn("n_lines", F.coalesce(lines(F.col("sizes")), F.lit(0)).cast("long"))
        .withColumn("n_removed_lines", F.coalesce(lines(F.transform("places", lambda i: F.get("sizes", i))), F.lit(0)).cast("long"))
    )
    own = {id_col: F.col("id"), text_col: F.col("text")}
    return out.select(*(own.get(c, F.col("rest").getField(c)).alias(c) for c in columns), *RESULT)


def _units() -> Column:
    """Of ``lines`` and ``words``: pairs of lines, and long lines alone, with the words of both lines."""
    line, word = F.col("lines"), F.col("words")

    def unit(i: Column, alone: bool) -> Column:
        text = F.get(line, i) if alone else F.concat_ws("\n", F.get(line, i), F.get(line, i + 1))
        after = F.lit(0) if alone else F.get(word, i + 1)
        key = F.xxhash64(F.lit(alone), text)
        return F.struct(i.alias("at"), F.lit(alone).alias("alone"), key.alias("hash"), F.get(word, i).alias("own"), after.alias("after"), text.alias("text"))

    every = F.sequence(F.lit(0), F.size(line) - 1)
    pairs = F.transform(F.filter(every, lambda i: i + 1 < F.size(line)), lambda i: unit(i, False))
    return F.concat(pairs, F.transform(F.filter(every, lambda i: F.get(word, i) >= LONG_WORDS), lambda i: unit(i, True)))


def _meet(units: DataFrame, hashes: DataFrame, few: bool) -> DataFrame:
    """Inner join by ``hash``; ``hashes`` has ``n``, how often each occurs."""
    if few:
        return units.join(F.broadcast(hashes), "hash")
    hot = F.broadcast(hashes.where(F.col("n") >= HOT))
    cold = units.join(hot.select("hash"), "hash", "left_anti").join(hashes.where(F.col("n") < HOT), "hash")
    return units.join(hot, "hash").unionByName(cold)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``docs`` with repeated passages taken out of the text, n_lines before and n_removed_lines."""
    columns = [c for c in docs.columns if c.lower() not in RESULT]
    others = [c for c in columns if c not in (id_col, text_col)]
    slim = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("rest"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = materialize(slim.withColumn("row", F.monotonically_increasing_id()), "rows")
    split = rows.where(F.col("text").isNotNull()).withColumn("lines", F.split("text", "\n")).withColumn("words", F.transform("lines", lambda x: F.regexp_count(x, F.lit(WORD))))
    units = split.select("id", "row", F.explode(_units()).alias("u")).select("id", "row", "u.*")
    # places lie in the shared folder: they are read three times
    placed = materialize(units.drop("text"), "places")
    repeated = materialize(placed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    few = repeated.count() <= BROADCAST_HASHES
    # the byte comparison: the least and the greatest text of a hash are the same
    sure = (
        _meet(units.select("hash", "text", F.struct("id", "row", "at").alias("place")), repeated, few)
        .groupBy("hash", "n")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"), F.min("place").alias("first"))
        .where("low = high")
        .select("hash", "n", F.col("first.row").alias("first_row"), F.col("first.at").alias("first_at"))
    )
    later = _meet(placed, materialize(sure, "sure"), few).where("row != first_row OR at != first_at")
    nth = F.row_number().over(Window.partitionBy("row", "alone").orderBy("at"))
    runs = (
        later.withColumn("run", F.when(F.col("alone"), F.col("at")).otherwise(F.col("at") - nth))
        .groupBy("row", "alone", "run")
        .agg(F.min("at").alias("start"), F.max("at").alias("end"), F.sum("own").alias("words"), F.max_by("after", "at").alias("after"))
        .where(F.col("words") + F.col("after") >= CHUNK_WORDS)
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", F.when(F.col("alone"), F.col("end")).otherwise(F.col("end") + 1).alias("end"))).alias("runs"))
    )
    gone = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["start"], r["end"]))))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    left = F.transform(F.array_except(every, F.col("gone")), lambda i: F.get("lines", i))
    out = (
        rows.join(runs, "row", "left")
        .withColumn("lines", F.split("text", "\n"))
        .withColumn("gone", gone)
        .withColumn("text", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
        .withColumn("n_lines", F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("long"))
        .withColumn("n_removed_lines", F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long"))
    )
    own = {id_col: F.col("id"), text_col: F.col("text")}
    return out.select(*(own.get(c, F.col("rest").getField(c)).alias(c) for c in columns), *RESULT)
