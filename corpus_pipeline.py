"""A training-data pipeline over ``documents``: each stage's result is written as Parquet and read by the next.

All stages but the last return the columns of documents; the last returns token ids.

Cases, in every stage: an empty table gives an empty result; other columns go; a null text stays null until quality rules
reject it, as they do empty texts. Repeated rows are judged each by quality rules, and the later one loses its passages
in line dedup, a null id coming first. Near-dedup decides by id: rows that share one stay or go together, rows without
id stay. Mixing takes each row by itself, ties in its order being rows that agree in id and size, and a null source is
one. The last stage gives every row its ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm import bpe, line_dedup, mixing, near_dedup, quality_rules
from saltmarsh.llm.common import materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near-duplicates share 80 % of their shingles of so many words.
SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.judge(docs).where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that other documents hold go; every document stays."""
    return line_dedup.dedup_passages(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    kept = near_dedup.group(docs, SHINGLE_WORDS).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    return docs.join(kept.where("NOT kept").select("doc_id"), "doc_id", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: a copy is a row."""
    taken = mixing.mix(docs, carry=COLUMNS).where("copies > 0")
    each = taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(*(F.col("carried").getField(c).alias(c) for c in COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and the digest of the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, then=bpe.decoding(ranks))
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("mixing", mix),
    ("tokens", tokens),
]

#: Signatures, passages and fitted rules in turn have no SQL form; tests hold run() against a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
