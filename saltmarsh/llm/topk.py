"""Exact top-k by inner product with a three-phase uniform threshold.

Equal vectors form a class, with the few smallest ids that can matter, so a vector that a third of the rows
share is scored once. The coordinates are dealt to NODES fragments, each a list holder that knows only its part
of a score. For a block of query classes:

1. each holder reports its best partial scores; the classes it names are scored in full, and the k-th best of
   these is a safe cutoff: the true k-th best is no lower;
2. the cutoff is broadcast, and each holder reports every partial score of at least cutoff / NODES. A class that
   no holder reports has a total below the cutoff. Totals that all holders reported are sums, and with those of the first
   phase they give a second cutoff, again the k-th best of what is known;
3. of the others only those are resolved from the whole vectors whose reported part, with the most that the silent
   holders can add, reaches the second cutoff.

Queries are taken in blocks of bounded size, so what is broadcast has a fixed bound however many there are.

Cases: null vectors, vectors with null or non-finite components and rows without id take no part; equal rows
count once; rows that share an id but not the vector are candidates of their own, and none of them answers a
query with that id; shorter vectors are padded with zeros; ties go to the smaller id; an empty table gives an
empty result; scores beyond 64 bits raise; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.llm.common import materialize, ship

K = 10
SCALE = 1024
NODES = 2
#: Query classes that are scored at a time.
QUERY_BLOCK = 4096
#: Rows of a score matrix are taken so that it has this many cells.
CELLS = 4_000_000


def quantise(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def valid(vector: Column) -> Column:
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    return vector.isNotNull() & F.forall(vector, finite)


def classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per vector: class, vec, and members, the k + 1 smallest ids, from (id, vec).

    The rank limit keeps a shared vector to a few rows per task before the shuffle.
    """
    rank = F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("r", rank).where(F.col("r") <= k + 1)
    grouped = few.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("members"))
    return materialize(grouped.withColumn("class", F.monotonically_increasing_id()), "vector-classes")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), width)


def _product(x: np.ndarray, q: np.ndarray, exact: str) -> np.ndarray:
    """x @ q.T as 64-bit integers, by whichever arithmetic holds every sum exactly."""
    if exact == "float":
        return (x.astype(np.float64) @ q.T.astype(np.float64)).astype(np.int64)
    if exact == "int":
        return x @ q.T
    out = x.astype(object) @ q.T.astype(object)
    if len(out) and out.size and max(abs(out.max()), abs(out.min())) >= 2**63:
        raise OverflowError("an inner product is beyond 64 bits")
    return out.astype(np.int64)


def _partials(data, exact: str, width: int, ends: list[int], keep) -> object:
    """Partial scores of fragments; keep(node, matrix) gives the cells to report."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = data.value[0]
        for batch in batches:
            node = np.asarray(batch.column(1))
            for g in range(len(ends)):
                low, mine = ends[g - 1] if g else 0, np.flatnonzero(node == g)
                step = max(1, CELLS // max(1, len(q)))
                for at in range(0, len(mine), step):
                    some = batch.take(pa.array(mine[at : at + step]))
                    p = _product(_matrix(some.column(2), ends[g] - low), q[:, low : ends[g]], exact)
                    r, c = keep(data.value, p)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c.astype(np.int32)), pa.array(np.full(len(r), g, np.int32)), some.column(0).take(pa.array(r)), pa.array(p[r, c])],
                        ["q", "node", "class", "partial"],
                    )

    return run


def _best(k: int):
    def keep(_, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(p) > k:
            r = np.argpartition(-p, k - 1, axis=0)[:k]
        else:
            r = np.repeat(np.arange(len(p))[:, None], p.shape[1], axis=1)
        return r.ravel(), np.tile(np.arange(p.shape[1]), len(r))

    return keep


def _above(nodes: int):
    def keep(data, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(p >= data[1][None, :])  # data[1]: the least partial score to report, by query

    return keep


def _scores(data, exact: str, width: int):
    """Full scores of (q, class, vec) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = data.value[0][np.asarray(batch.column(0))]
            x = _matrix(batch.column(2), width)
            kind = {"float": np.float64, "int": np.int64, "object": object}[exact]
            s = (q.astype(kind) * x.astype(kind)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([int(v) for v in s], pa.int64())], ["q", "class", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Return query_id, rank, the id and score of each query's k best candidates; ``is_query`` is over ``id``."""
    ship(vectors.sparkSession)
    spark = vectors.sparkSession
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
        .where(F.col("id").isNotNull() & valid(F.col("v")))
        .select("id", quantise(F.col("v")).alias("vec"))
    )
    shape = rows.agg(
        F.max(F.size("vec")).alias("width"),
        F.max(F.array_max(F.transform("vec", lambda x: F.abs(x)))).alias("most"),
    ).first()
    width, most = shape["width"] or 0, shape["most"] or 0
    exact = "float" if most * most * width < 2**53 else "int" if most * most * width < 2**63 else "object"
    rows = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec"))))
    every = classes(rows, k)
    asked = materialize(rows.where(is_query).distinct().join(every.select("class", "vec"), "vec").select(F.col("id").alias("query_id"), "class"), "queries")
    n_classes = asked.select("class").distinct().count()
    n_blocks = -(-n_classes // QUERY_BLOCK)
    block = F.pmod(F.xxhash64("class"), F.lit(max(1, n_blocks)))
    ends = [width * (g + 1) // NODES for g in range(NODES)]
    parts = [
        F.struct(F.lit(g).alias("node"), F.slice("vec", (ends[g - 1] if g else 0) + 1, ends[g] - (ends[g - 1] if g else 0)).alias("part"))
        for g in range(NODES)
    ]
    fragments = every.select("class", F.explode(F.array(*parts)).alias("f")).select("class", "f.node", "f.part")
    out = None
    for b in range(n_blocks):
        here = asked.where(block == b)
        got = every.join(here.select("class").distinct(), "class").select("class", "vec").collect()  # about QUERY_BLOCK rows
        got.sort(key=lambda r: r["class"])
        found = _block(spark, fragments, every, np.array([r["vec"] for r in got], np.int64).reshape(len(got), width), k, exact, width, ends)
        numbers = spark.createDataFrame([(i, r["class"]) for i, r in enumerate(got)], "q int, q_class long")
        answers = (
            here.withColumnRenamed("class", "q_class")
            .join(numbers, "q_class")
            .join(found, "q")
            .select("query_id", F.explode("members").alias(id_col), "score")
            .where(F.col("query_id") != F.col(id_col))
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(id_col))
        ranked = answers.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.select("query_id", "rank", id_col, "score")
        ranked = materialize(ranked, "top-k") if n_blocks > 1 else ranked
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    return out


def _block(spark, fragments, every, q, k, exact, width, ends) -> DataFrame:
    """For one block of query vectors: q, members and score of the k + 1 best classes of each."""
    k1, found = k + 1, "q int, node int, class long, partial long"  # one more: a query's own class may be its best
    queries = spark.sparkContext.broadcast((q,))
    local = fragments.mapInArrow(_partials(queries, exact, width, ends, _best(k1)), found)
    by_node = Window.partitionBy("q", "node").orderBy(F.desc("partial"), "class")
    named = local.withColumn("r", F.row_number().over(by_node)).where(F.col("r") <= k1).select("q", "class").distinct()
    whole = every.select("class", "vec")
    scored = "q int, class long, score long"
    first = named.join(whole, "class").select("q", "class", "vec").mapInArrow(_scores(queries, exact, width), scored)
    by_q = Window.partitionBy("q").orderBy(F.desc("score"), "class")
    first = materialize(first, "named")

    def kth(known: DataFrame) -> np.ndarray:
        """The k1-th best known score of each query; the least number where fewer are known. A row a query reaches the driver."""
        best = known.withColumn("r", F.row_number().over(by_q)).where(F.col("r") == k1).select("q", "score").collect()
        out = np.full(len(q), np.iinfo(np.int64).min)
        for r in best:
            out[r["q"]] = r["score"]
        return out

    least = np.array([-(-int(c) // len(ends)) for c in kth(first)], np.int64)
    cut = spark.sparkContext.broadcast((q, least))
    reported = fragments.mapInArrow(_partials(cut, exact, width, ends, _above(len(ends))), found)
    summed = reported.groupBy("q", "class").agg(F.sum("partial").alias("score"), F.count(F.lit(1)).alias("n"))
    summed = materialize(summed, "reported")
    sums = summed.where(F.col("n") == len(ends)).select("q", "class", "score")
    known = first.unionByName(sums).distinct()
    second = kth(known)
    # a silent holder has less than the least score to report, so the second cutoff bounds what is worth resolving
    most_silent = [int(x) - 1 if x > np.iinfo(np.int64).min // len(ends) else 0 for x in least]
    cutoffs = F.broadcast(spark.createDataFrame([(i, int(c), most_silent[i]) for i, c in enumerate(second)], "q int, cutoff long, silent long"))
    open_ = summed.where(F.col("n") < len(ends)).join(cutoffs, "q").where(F.col("score") >= F.col("cutoff") - F.col("silent") * (len(ends) - F.col("n")))
    resolved = open_.select("q", "class").join(whole, "class").select("q", "class", "vec").mapInArrow(_scores(queries, exact, width), scored)
    smallest = every.select("class", "members", F.get("members", F.lit(0)).alias("least_id"))
    enough = known.unionByName(resolved).join(cutoffs, "q").where(F.col("score") >= F.col("cutoff")).select("q", "class", "score").distinct()
    order = Window.partitionBy("q").orderBy(F.desc("score"), "least_id")
    top = enough.join(smallest, "class").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k1)
    return top.select("q", "members", "score")
