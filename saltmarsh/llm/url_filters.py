"""URL filters by hashed expressions.

A URL is expanded into (host suffix, path prefix) expressions, but only of the shapes the rules have: so many
host labels, so many path characters. Expressions meet rules in an equi-join on the first four bytes of their
SHA-256; the full digest confirms, and the longest rule wins. An expansion has at most (distinct label counts)
times (distinct path lengths) rows, and they fold back to one row a page before they are shuffled.

Cases: a null URL, or one without ``://``, has empty host and path and fits no rule; an empty path is a prefix
of itself only, so it does not fit a rule whose path is ``/``; repeated pages are judged each; equally long
rules yield to the longer host, then to block; an empty table or no rules give the default verdict; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to this many rows are broadcast; more are joined by shuffle.
BROADCAST_RULES = 100_000
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """(action, rule) rows as host, path, labels, path_chars, digest and prefix; ``rule`` reads ``host/path``."""
    host = F.substring_index("rule", "/", 1)
    r = rules.where(F.col("rule").isNotNull()).select(
        "action", "rule", host.alias("r_host"), F.expr("substring(rule, char_length(substring_index(rule, '/', 1)) + 1)").alias("r_path")
    )
    return (
        r.withColumn("labels", F.size(F.split("r_host", r"\.")))
        .withColumn("path_chars", F.char_length("r_path"))
        .withColumn("digest", F.sha2(F.concat("r_host", "r_path"), 256))
        .withColumn("prefix", F.substring("digest", 1, 8))
    )


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Return id, host, path, rule (null where none fits) and verdict for every row of ``pages``."""
    known = rule_table(rules)
    shapes = known.agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("labels").alias("labels"), F.collect_set("path_chars").alias("path_chars")
    ).first()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        F.monotonically_increasing_id().alias("row"), "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    if not shapes["n"]:
        return _named(rows.withColumn("best", F.lit(None).cast("struct<rule: string, verdict: string>")), id_col)
    ints = lambda xs: F.array(*(F.lit(int(x)) for x in sorted(xs)))
    parts = F.size(F.split("host", r"\."))
    suffixes = F.transform(
        F.filter(ints(shapes["labels"]), lambda k: (k <= parts) & (F.col("host") != "")),
        lambda k: F.array_join(F.slice(F.split("host", r"\."), parts - k + 1, k), "."),
    )
    prefixes = F.transform(
        F.filter(ints(shapes["path_chars"]), lambda k: k <= F.char_length("path")),
        lambda k: F.substring(F.col("path"), F.lit(1), k),
    )
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    hashed = F.transform(expressions, lambda e: F.sha2(e, 256))
    each = rows.select("*", F.explode_outer(hashed).alias("e_digest")).withColumn("prefix", F.substring("e_digest", 1, 8))
    side = known.select("prefix", "digest", "rule", "action", F.char_length("r_host").alias("host_chars"))
    if shapes["n"] <= BROADCAST_RULES:
        side = F.broadcast(side)
    # longest rule, then longer host, then block
    rank = F.struct(
        F.char_length("rule").alias("chars"), "host_chars", (F.col("action") == "block").alias("block"), "rule", F.col("action").alias("verdict")
    )
    met = each.join(side, "prefix", "left").withColumn("fit", F.when(F.col("e_digest") == F.col("digest"), rank))
    return _named(met.groupBy("row", "id", "host", "path").agg(F.max("fit").alias("best")), id_col)


def _named(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(DEFAULT)).alias("verdict"),
    )
