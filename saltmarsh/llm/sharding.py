"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``POINTS`` points. A document lies at the point its id hashes to, each shard owns ``VNODES``
points, and a document belongs to the first shard clockwise. Every shard has a fixed capacity; documents that
find it full continue clockwise to the next shard that has room, round by round. Capacities are the row count
split evenly, so counts differ by one at most.

The counts by point are a table of at most ``POINTS`` rows whatever the input; the rounds run over it and
give each point the ranges of its rows that go to each shard. Rows are numbered within their point, so no
window holds a whole shard, and a row's slot is its number in its range plus the range's place in the shard.

Cases: a null id hashes like any other value; null text has size 1 and CRC 0; empty and very long texts are
sized in bytes; rows with equal ids are numbered by text CRC and size, and rows that agree in all of these are
interchangeable; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import materialize

POINTS = 8192
VNODES = 64


def ring(n_shards: int) -> list[list[int]]:
    """For each point, the shards in the order in which they are met clockwise."""
    owner: dict[int, int] = {}
    for shard in range(n_shards):
        for v in range(VNODES):
            owner.setdefault(zlib.crc32(f"shard {shard} node {v}".encode()) % POINTS, shard)
    walks, ahead = [[] for _ in range(POINTS)], list(range(n_shards))
    for turn in range(2 * POINTS - 1, -1, -1):  # twice round, so that every shard is ahead of every point
        shard = owner.get(turn % POINTS)
        if shard is not None:
            ahead.remove(shard)
            ahead.insert(0, shard)
        walks[turn % POINTS] = list(ahead)
    return walks


def allot(counts: dict[int, int], n_shards: int) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """For each point with rows: (first row, rows, shard, first slot) of each range of its rows."""
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    used = [0] * n_shards
    walks, left, out = ring(n_shards), dict(sorted(counts.items())), {p: [] for p in sorted(counts)}
    for step in range(n_shards):
        for point, n in list(left.items()):
            shard = walks[point][step]
            if take := min(n, room[shard] - used[shard]):
                out[point].append((counts[point] - n, take, shard, used[shard]))
                used[shard] += take
                left[point] = n - take
        left = {p: n for p, n in left.items() if n}
    return list(out.items())


def point_of(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(POINTS)).cast("int")


def shard(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return id, size (UTF-8 bytes plus 1), text_crc32, shard and slot (from 0 in each shard)."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            point_of(id_col).alias("point"),
        ),
        "shard-rows",
    )
    counts = {r["point"]: r["count"] for r in rows.groupBy("point").count().collect()}  # at most POINTS rows
    ranges = spark.createDataFrame(
        allot(counts, n_shards),
        "point int, ranges array<struct<first: long, n: long, shard: int, slot: long>>",
    )
    order = Window.partitionBy("point").orderBy(F.xxhash64("id", F.lit("row")), "id", "text_crc32", "size")
    mine = F.get(F.filter("ranges", lambda r: (F.col("row") >= r["first"]) & (F.col("row") < r["first"] + r["n"])), F.lit(0))
    return (
        rows.withColumn("row", (F.row_number().over(order) - 1).cast("long"))
        .join(F.broadcast(ranges), "point")  # at most POINTS rows
        .withColumn("r", mine)
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.col("r.shard").alias("shard"),
            (F.col("r.slot") + F.col("row") - F.col("r.first")).alias("slot"),
        )
    )
