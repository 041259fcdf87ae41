"""Mixing sources to target weights by systematic sampling.

Each source has one rate, target words over own words. With the documents of a source in a fixed order the
expected copies add up to ``rate * rank``; one random offset, drawn from the seed, is added and a document is
emitted once for each integer that its step crosses. The order is by size class and then by a hash of the id, so every
size class is sampled evenly: the words taken miss their target by about the largest document, whatever the offset. So
that this is little, the few documents with more than 1 / GIANTS of their source's words are sampled by themselves,
and the rate of the others is set by what is left of the target. Over seeds each document's copies are its source's rate
on average, but for what a rate of the others beyond CAP would take.

Ranks come from counts in three levels (size class, hash slice, row), so no task holds a whole source:
windows run over the size classes of a source, over at most SLICES counts, or over the rows of one slice of
one size class.

Cases: null text has size 0, and a document of size 0 takes nothing; a source with no words has target 0;
null source is a source, last in order; null ids and repeated rows are documents of their own, and rows that
agree in every column are interchangeable; an empty table gives an empty result; other columns are
ignored unless asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import materialize

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
SLICES = 256
WORD = r"[^\x20\x09-\x0D]+"
SEED = 0
#: A size class whose documents each have more than this part of their source's words is sampled apart.
GIANTS = 200


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source_size and target, from (source_key, source, size) rows.

    Shares follow the weights; a source stops at CAP times its size and what it can't use goes to the others
    by weight. With sources ordered by CAP * size / weight, those below the final level are the full ones, so
    one pass over running sums finds the level. This window runs over sources, not over documents.
    """
    by_source = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS)) + 1)
    fill = Window.orderBy("level", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    upto = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = (
        by_source.withColumn("weight", weight)
        .withColumn("cap", CAP * F.col("source_size"))
        .withColumn("level", F.col("cap") / F.col("weight"))
        .withColumn("budget", BUDGET * F.sum("source_size").over(everything))
        .withColumn("full_before", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(after))
        .withColumn("water", (F.col("budget") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("place", F.row_number().over(fill))
        # the first source that isn't filled to its cap fixes the level of all after it
        .withColumn("first", F.min(F.when(F.col("level") > F.col("water"), F.struct("place", "water"))).over(everything))
        .withColumn("water", F.col("first.water"))
    )
    target = F.when(F.col("water").isNull() | (F.col("level") <= F.col("water")), F.col("cap").cast("double")).otherwise(
        F.col("water") * F.col("weight")
    )
    return t.select("source_key", "source_size", target.alias("target"))


def size_class(size: Column) -> Column:
    """Eight classes an octave: the bit length of the size and its three bits below the highest."""
    bits = F.length(F.bin(size))
    return bits * 16 + F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = (), seed: int = SEED) -> DataFrame:
    """Return id, source, size, source_size, target, copies and taken (copies * size) for every document.

    With ``carry``, those columns come too, as the struct ``carried``; they travel with the one shuffle that
    ranks the documents, while the counts are taken from a table without them.
    """
    cell = ["source_key", "size_class", "slice"]
    sized = (
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("")).alias("source_key"),
            F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            *([F.struct(*carry).alias("carried")] if carry else []),
        )
        .withColumn("size_class", size_class(F.col("size")))
        .withColumn("key", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
        .withColumn("slice", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % SLICES)
    )
    slim = materialize(sized.drop("carried"), "mix-sizes")
    counts = slim.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    by_class = slim.groupBy("source_key", "size_class").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.sum("size").alias("words"))
    targets = source_targets(slim)
    giant = (GIANTS * F.col("least") > F.col("source_size")).alias("giant")
    class_before = F.sum("n").over(Window.partitionBy("source_key", "giant").orderBy("size_class")) - F.col("n")
    classes = by_class.join(targets, "source_key").select("*", giant).withColumn("class_before", class_before)
    classes = materialize(classes.select("source_key", "size_class", "giant", "words", "class_before", "source_size", "target"), "mix-classes")
    slice_before = F.sum("n").over(Window.partitionBy("source_key", "size_class").orderBy("slice")) - F.col("n")
    cells = (
        counts.select(*cell, slice_before.alias("slice_before"))
        .join(classes, ["source_key", "size_class"])
        .withColumn("before", F.col("class_before") + F.col("slice_before"))
        .select(*cell, "giant", "before", "source_size", "target")
    )
    row = F.row_number().over(Window.partitionBy(*cell).orderBy("key", "id"))
    mark = F.concat(F.lit(f"{seed}:"), F.when(F.col("giant"), "giant:").otherwise(""), F.col("source_key"))
    offset = F.conv(F.substring(F.md5(mark), 1, 8), 16, 10).cast("double") / 2.0**32
    copies = F.floor(F.col("rate") * F.col("rank") + offset) - F.floor(F.col("rate") * (F.col("rank") - 1) + offset)

    def sample(rows: DataFrame, rated: DataFrame) -> DataFrame:
        ranked = rows.withColumn("row", row).join(rated, cell).withColumn("rank", F.col("before") + F.col("row"))
        return ranked.withColumn("copies", copies)

    whole = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    first = cells.where("giant").withColumn("rate", whole)
    few = slim.join(classes.where("giant").select("source_key", "size_class"), ["source_key", "size_class"], "left_semi")
    taken = sample(few, first).groupBy("source_key").agg(F.sum(F.col("copies") * F.col("size")).alias("giants_take"))
    rest = classes.where("NOT giant").groupBy("source_key").agg(F.sum("words").alias("rest_words"), F.max("target").alias("target")).join(taken, "source_key", "left")
    left = (F.col("target") - F.coalesce("giants_take", F.lit(0))) / F.nullif(F.col("rest_words"), F.lit(0))
    rest = rest.select("source_key", F.least(F.lit(float(CAP)), F.greatest(F.lit(0.0), F.coalesce(left, F.lit(0.0)))).alias("rate"))
    ranked = sample(sized if carry else slim, first.unionByName(cells.where("NOT giant").join(rest, "source_key")))
    return ranked.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        *(["carried"] if carry else []),
    )
