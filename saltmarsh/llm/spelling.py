"""Spelling variants: words one edit apart, found by their three rarest positional bigrams, and the form each stands for.

Bigrams are ordered globally by frequency, rarest first; those of one word that are the same go by position. One edit
destroys two bigrams of a word at most, and all others stand in the other word too, in the same order. So the rarest that survives
is among the three rarest of both words: it is enough to join words on those. The frequency is the bigram's, whatever
its place, as an order that depended on places would not be the same in both words.

Places limit the join: the edit lies on one side of a bigram that survives, so on the other side both words are the same up to their
beginning or end, and the bigram's place from there is the same too. That whole side, bigram included, is part of the
join key. On the side of the edit the half without it is the same as well, so each bigram has up to four keys: edit
behind or before it, in the first or the second half there. Lengths are part of the key: a word meets words as long as itself, and
words longer by one as if a letter were away. A key thus fixes half of a word's letters at least, candidates are few, and
``levenshtein`` confirms each pair once.

Bigrams are at most ALPHABET ** 2 whatever the input, so their frequencies are a constant of the plan. Everything is built-in column
expressions. Words, links and forms are stored in the shared folder; roots are found by pointer doubling, in as many
rounds as the greatest count allows, since each form is ``ratio`` times as frequent as what it stands for.

Cases: null and empty texts have no words; a null doc_id is spelled as an empty text in the hash; repeated rows count each; a
very long text is one row of words; words without near words have n_near 0, null form and form_n, and themselves as root; ties
between forms go to the smallest in code-point order; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.timeops import let
from saltmarsh.llm.common import materialize

#: Letters, one run in how many gets a code point deleted, the least length and count of a word, and what makes a form.
LETTERS = r"[A-Za-zÀ-ÿ]"
DELETED_ONE_IN, LEAST_LENGTH, LEAST_COUNT, RATIO = 31, 7, 2, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters after lower-casing: a to z, and U+00C0 to U+00FF.
ALPHABET = 26 + 64
#: One edit destroys two bigrams, so of three one survives.
PREFIX = 3


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the runs of letters after planted deletions, with their occurrences."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))
    run, length = F.col("run"), F.char_length("run")
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), run))
    cut = (h % length).cast("int")
    short = F.concat(F.substring(run, F.lit(1), cut), F.substring(run, cut + 2, length))
    word = F.when(h % DELETED_ONE_IN == 0, short).otherwise(run)
    # the same run of a document has the same fate, so a document's runs are counted first
    each = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run")).select(word.alias("word"))
    counted = each.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _number(letter: Column) -> Column:
    """0 to ALPHABET - 1."""
    point = F.ascii(letter)
    return F.when(point < 128, point - 97).otherwise(point - 0xC0 + 26)


def _bigrams(word: Column) -> Column:
    """The numbers of a word's bigrams, by place."""
    pairs = lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda x, y: x * ALPHABET + y)
    return let(F.transform(F.split(word, ""), _number), pairs)


def prefixes(known: DataFrame) -> DataFrame:
    """word, n, ats: the places of the three rarest bigrams of each word."""
    grams = known.withColumn("grams", _bigrams(F.col("word")))
    seen = grams.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("freq"))
    found = {r["gram"]: r["freq"] for r in seen.collect()}  # at most ALPHABET ** 2 rows
    # as one text, which the optimizer makes an array of once, and not an expression for each entry
    freqs = F.split(F.lit(",".join(str(found.get(g, 0)) for g in range(ALPHABET**2))), ",").cast("array<long>")
    ranked = F.transform("grams", lambda g, i: F.struct(F.get(freqs, g).alias("freq"), g.alias("gram"), i.alias("at")))
    rare = F.transform(F.slice(F.sort_array(ranked), 1, PREFIX), lambda g: g["at"])
    return grams.select("word", "n", rare.alias("ats"))


def _keys(word: Column, at: Column, longer: int) -> list[Column]:
    """The keys of a bigram at place ``at``; with ``longer`` 1 as a word that has a letter more than the one it meets."""
    length = F.char_length(word)
    out = []
    for side, fixed, part in (
        ("behind", F.substring(word, F.lit(1), at + 2), F.substring(word, at + 3, length)),
        ("before", F.substring(word, at + 1, length), F.substring(word, F.lit(1), at)),
    ):
        size = F.char_length(part) - longer  # of that part in the shorter word
        half = F.floor(size / 2).cast("int")
        first, last = F.substring(part, F.lit(1), half), F.substring(part, F.char_length(part) - (size - half) + 1, size - half)
        for which, text in (("second", first), ("first", last)):
            out.append(F.when(size >= 0, F.xxhash64(F.lit(side), F.lit(which), length - longer, fixed, F.lit("|"), text)))
    return out


def near_pairs(known: DataFrame) -> DataFrame:
    """word, other, n, other_n: each pair of words exactly one edit apart, both ways."""
    rare = materialize(prefixes(known), "rare-bigrams")

    def keyed(longer: int) -> DataFrame:
        keys = F.transform("ats", lambda at: F.array(*_keys(F.col("word"), at, longer)))
        return rare.select("word", "n", F.explode(F.array_distinct(F.flatten(keys))).alias("key")).where("key IS NOT NULL")

    as_long, longer = (keyed(k).select(F.col("word").alias("other"), F.col("n").alias("other_n"), "key", F.lit(k).alias("longer")) for k in (0, 1))
    met = keyed(0).join(as_long.unionByName(longer), "key").where((F.col("longer") == 1) | (F.col("word") < F.col("other")))
    near = met.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n").distinct()
    links = materialize(near, "near-words")
    return links.unionByName(links.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    known = materialize(words(docs, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("by"), F.col("other").alias("word")))
    near = near_pairs(known).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.by") >= RATIO * F.col("n")
    near = near.select("word", "n_near", F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.by")).alias("form_n"))
    near = materialize(near, "forms")
    most = known.agg(F.max("n")).first()[0] or LEAST_COUNT
    steps = math.log(most / LEAST_COUNT, RATIO) if most > LEAST_COUNT else 0  # forms in a chain, at most
    roots = near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) + 1 if steps > 1 else 0):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    out = known.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
