"""What several corpus operators share: tables in the shared folder, and the word rule."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.sources.tables import job_dir, materialize  # noqa: F401

#: Characters that separate words: space and U+0009 to U+000D.
WORD_SPACES = " \t\n\x0b\x0c\r"
#: The same as a regular expression.
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Bytes of an Arrow batch.
ARROW_BYTES = 8 * 1024 * 1024


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once a context, so that they can import its functions.

    Their Arrow batches are held to ARROW_BYTES: texts are long, and each core has a worker of its own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    context = spark.sparkContext
    if getattr(context, "_saltmarsh_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="saltmarsh-")) / "saltmarsh.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._saltmarsh_shipped = True


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``materialize``, as a table bucketed by ``key``: joins and groupings by it leave these rows where they are."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(n, key).option("path", f"{job_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


#: A key is hot with more than one in HOT_SHARE of all rows and more than HOT_ROWS rows; so there are fewer than HOT_SHARE of them.
HOT_SHARE, HOT_ROWS = 200, 10_000


def join_skewed(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right``, whose ``key`` is unique, inner or left: rows of hot keys stay where they are.

    ``left`` should be a stored table, as it is read once to count the keys.
    """
    rows = left.count()
    counts = left.groupBy(key).count().where((F.col("count") > max(HOT_ROWS, rows // HOT_SHARE)) & F.col(key).isNotNull())
    hot = [r[0] for r in counts.select(key).collect()] if rows > HOT_ROWS else []  # fewer than HOT_SHARE
    if not hot:
        return left.join(right, key, how)
    keys = F.broadcast(left.sparkSession.createDataFrame([(k,) for k in hot], left.select(key).schema))
    few = F.broadcast(right.join(keys, key, "left_semi"))
    cold = left.join(keys, key, "left_anti").join(right, key, how)
    return cold.unionByName(left.join(keys, key, "left_semi").join(few, key, how))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The runs of characters other than WORD_SPACES; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")
