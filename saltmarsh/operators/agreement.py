"""Agreement of two ordered classifications. Every figure comes from one count by pair of labels (16 rows at most)."""

from __future__ import annotations

from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saltmarsh.functions.classify import LABELS

LEFT, RIGHT = "tide_level_class", "tide_level_class_threshold"


def rank_of(label: Column) -> Column:
    """0 to 3; null for any other label."""
    return F.nullif(F.array_position(F.array(*(F.lit(x) for x in LABELS)), label), F.lit(0)) - 1


def known(df: DataFrame, left: str = LEFT, right: str = RIGHT) -> DataFrame:
    return df.where(F.col(left).isin(*LABELS) & F.col(right).isin(*LABELS))


def confusion(df: DataFrame, left: str = LEFT, right: str = RIGHT) -> DataFrame:
    """left_rank, right_rank, n of the pairs that occur."""
    return known(df, left, right).groupBy(rank_of(F.col(left)).alias("left_rank"), rank_of(F.col(right)).alias("right_rank")).agg(F.count(F.lit(1)).alias("n"))


def dense(counts: DataFrame) -> DataFrame:
    """All 16 pairs, 0 where none occurred."""
    spark: SparkSession = counts.sparkSession
    ranks = spark.range(len(LABELS) ** 2).select((F.col("id").cast("long") % 4).alias("right_rank"), F.floor(F.col("id") / 4).alias("left_rank"))
    return ranks.join(F.broadcast(counts), ["left_rank", "right_rank"], "left").select("left_rank", "right_rank", F.coalesce("n", F.lit(0)).alias("n"))


def rate(counts: DataFrame) -> DataFrame:
    """rows, agreement and rate (null without rows)."""
    same = F.sum(F.when(F.col("left_rank") == F.col("right_rank"), F.col("n")).otherwise(0))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(same, F.lit(0)).alias("agreement")).withColumn(
        "rate", F.col("agreement") / F.nullif(F.col("rows"), F.lit(0))
    )


WEIGHTS = ("linear", "quadratic")


def kappas(counts: DataFrame) -> DataFrame:
    """One row, linear and quadratic weighted kappa: null without rows or where no disagreement is expected."""
    d = F.abs(F.col("left_rank") - F.col("right_rank")) / F.lit(len(LABELS) - 1.0)
    total = F.nullif(F.sum("n").over(Window.partitionBy()), F.lit(0))
    expected = F.sum("n").over(Window.partitionBy("left_rank")) * F.sum("n").over(Window.partitionBy("right_rank")) / total
    parts = dense(counts).select("n", d.alias("d"), expected.alias("expected"))
    seen = lambda w, c: F.sum(w * F.col(c))
    weight = {"linear": F.col("d"), "quadratic": F.col("d") * F.col("d")}
    return parts.agg(*((1 - seen(w, "n") / F.nullif(seen(w, "expected"), F.lit(0.0))).alias(k) for k, w in weight.items()))


def kappa(counts: DataFrame, weights: str = "linear") -> DataFrame:
    """One row, kappa with one of WEIGHTS."""
    if weights not in WEIGHTS:
        raise ValueError(f"weights must be linear or quadratic, not {weights}")
    return kappas(counts).select(F.col(weights).alias("kappa"))


def differences(counts: DataFrame) -> DataFrame:
    return counts.groupBy(F.abs(F.col("left_rank") - F.col("right_rank")).alias("difference")).agg(F.sum("n").alias("n")).orderBy("difference")


def label_of(rank: Column) -> Column:
    return F.get(F.array(*(F.lit(x) for x in LABELS)), rank.cast("int"))


def mismatch_pairs(counts: DataFrame) -> DataFrame:
    """Pairs of different labels, the most frequent first, ties by rank."""
    apart = counts.where("left_rank <> right_rank").orderBy(F.desc("n"), "left_rank", "right_rank")
    return apart.select(label_of(F.col("left_rank")).alias("left"), label_of(F.col("right_rank")).alias("right"), "n")


def mismatches(df: DataFrame, left: str = LEFT, right: str = RIGHT) -> DataFrame:
    """Rows with two known, different labels, with how far the left rank is above the right, and the absolute difference."""
    d = rank_of(F.col(left)) - rank_of(F.col(right))
    return known(df, left, right).where(F.col(left) != F.col(right)).withColumn("class_rank_difference", d).withColumn("class_difference_abs", F.abs(d))


def report(df: DataFrame, left: str = LEFT, right: str = RIGHT) -> str:
    """The text report; only the counts, 16 rows at most, reach the driver."""
    met = {(r.left_rank, r.right_rank): r.n for r in confusion(df, left, right).collect()}
    counts = df.sparkSession.createDataFrame([(*k, n) for k, n in met.items()], "left_rank long, right_rank long, n long")
    number = lambda x: "nan" if x is None else f"{x:.4f}"
    head, by_weight = rate(counts).first(), kappas(counts).first()
    matrix = pd.DataFrame([[met.get((i, j), 0) for j in range(4)] for i in range(4)], pd.Index(LABELS, name=left), pd.Index(LABELS, name=right))
    apart = differences(counts).toPandas()
    distances = pd.Series(apart["n"].to_numpy(), pd.Index(apart["difference"], name="class_difference_abs"))
    pairs = mismatch_pairs(counts).toPandas()
    sizes = pd.Series(pairs["n"].to_numpy(), pd.MultiIndex.from_frame(pairs[["left", "right"]], names=[left, right]))
    parts = [
        f"rows = {head['rows']}",
        f"exact_agreement = {head['agreement']}",
        f"exact_agreement_rate = {number(head['rate'])}",
        *(f"{w}_weighted_kappa = {number(by_weight[w])}" for w in WEIGHTS),
        f"\nconfusion_matrix_rows={left} columns={right}",
        matrix.to_string(),
        "\nabsolute_class_difference_counts",
        distances.to_string(),
        "\nmismatch_pairs",
        sizes.to_string() if len(sizes) else "none",
    ]
    return "\n".join(parts)


def write_report(df: DataFrame, path: str, left: str = LEFT, right: str = RIGHT) -> str:
    """Write the report as UTF-8, without a newline at the end, to a file of the driver's, and return it."""
    text = report(df, left, right)
    Path(path).write_text(text, encoding="utf-8")
    return text
