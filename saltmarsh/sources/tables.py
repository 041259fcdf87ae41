"""CSV tables with a byte-order mark, checks on columns, and tables that a computation stores on its way."""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Texts that count as missing on reading.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)
BYTE_ORDER_MARK = "\ufeff"

_own: dict[str, str] = {}


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df``, or an error that lists the missing columns in order."""
    if absent := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False) -> DataFrame:
    """All columns as text, or cast to ``schema``, or with the types that all texts of a column fit; MISSING becomes null."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    clean = [F.when(raw[c].isin(*MISSING), None).otherwise(raw[c]).alias(c.removeprefix(BYTE_ORDER_MARK)) for c in raw.columns]
    df = raw.select(*clean)
    if schema is not None:
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        require(df, wanted.names)
        return df.select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in wanted))
    if infer and df.columns:
        fits = {(c, t): F.count_if(F.col(f"`{c}`").isNotNull() & F.trim(f"`{c}`").try_cast(t).isNull()) == 0 for c in df.columns for t in ("long", "double")}
        said = df.agg(*(v.alias(f"{k}") for k, v in enumerate(fits.values()))).first()
        kind = {c: t for k, (c, t) in reversed(list(enumerate(fits))) if said[k]}
        return df.select(*(F.trim(f"`{c}`").cast(kind[c]).alias(c) if c in kind else F.col(f"`{c}`") for c in df.columns))
    return df


def write_csv(df: DataFrame, path: str, order_by: Column | str | None = None) -> None:
    """Nulls as blanks; each file starts with a byte-order mark and a header; files are in order of ``order_by``."""
    names = [f"{BYTE_ORDER_MARK * (k == 0)}{c}" for k, c in enumerate(df.columns)]
    rows = df.orderBy(order_by) if order_by is not None else df
    rows.select(*(F.col(f"`{c}`").cast(StringType()).alias(n) for c, n in zip(df.columns, names, strict=True))).write.csv(
        path, header=True, mode="overwrite", escape='"', nullValue="", emptyValue=""
    )


@F.pandas_udf(StringType())
def double_text(x: pd.Series) -> pd.Series:
    """A double as Python writes it, in the fewest digits that read back as it, which the JVM's own text isn't always; missing ones are blank."""
    return x.map(lambda v: "" if v != v else repr(float(v)))


def _csv_field(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    text = double_text(c) if kind == "double" else F.when(c, "True").otherwise("False") if kind == "boolean" else c.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(c.isNull(), "").when(text.rlike('[",\r\n]'), quoted).otherwise(text)


def write_csv_file(df: DataFrame, path: str, order_by: Column | str | None = None) -> None:
    """``df`` as one CSV file with a byte-order mark and a header, in order: the bytes that pandas' ``to_csv`` without index would write.

    Tasks write the lines of ranges of ``order_by`` to parts in the shared folder, so the sort is spread; the parts, whose
    names are in order, are then copied behind each other through a buffer, in the file system that ``path`` belongs to.
    So neither the driver nor a task holds more than a buffer, but one stream writes the file: it is for
    results that someone wants to open, ``write_csv`` for all others. The file appears under its name when it is whole.
    """
    spark = df.sparkSession
    # a table of a single column has its blanks quoted, or they would be empty lines
    fields = [_csv_field(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if len(fields) == 1:
        fields = [F.when(fields[0] == "", '""').otherwise(fields[0])]
    rows = df.orderBy(order_by) if order_by is not None else df
    parts = f"{job_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows.select(F.concat_ws(",", *fields).alias("value")).write.text(parts)
    header = ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in '",\r\n') else c for c in df.columns)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop
    target, folder = hadoop.fs.Path(path), hadoop.fs.Path(parts)
    store, source = target.getFileSystem(conf), folder.getFileSystem(conf)
    partial = hadoop.fs.Path(f"{path}._partial")
    out = store.create(partial, True)
    try:
        out.write(bytearray(f"{BYTE_ORDER_MARK}{header}\n".encode()))
        names = sorted((s.getPath().getName() for s in source.listStatus(folder)), key=lambda n: (len(n), n))
        for name in names:
            if name.startswith("part-"):
                part = source.open(hadoop.fs.Path(folder, name))
                try:
                    hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
                finally:
                    part.close()
    finally:
        out.close()
    store.delete(target, False)
    if not store.rename(partial, target):
        raise OSError(f"could not name {path}")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return require(df, columns).na.drop(subset=columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, a temporary folder is made in local mode; on a cluster that is an error, as executors
    would write to folders of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if "dir" not in _own:
        _own["dir"] = "file://" + tempfile.mkdtemp(prefix="saltmarsh-")
    return _own["dir"]


def job_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one: what it wrote can go once its results are stored."""
    return f"{shared_dir(spark)}/saltmarsh-{spark.sparkContext.applicationId}"


def spread(df: DataFrame, *keys: str, by_split: int = 0) -> DataFrame:
    """``df`` dealt, by ``keys`` if given, to as many tasks as the session shuffles to, or has cores: for few bytes that cost much work.

    A file of few row groups is read by few tasks, and small shuffles are joined to few, whatever their rows cost. With ``by_split``, for
    a table just read, there are at least so many tasks a split of its files, so that what a task sorts doesn't grow with the table.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(max(tasks, by_split * df.rdd.getNumPartitions()) if by_split else tasks, *keys)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    Cuts lineage: what follows survives lost executors without repeating what came before.
    """
    spark = df.sparkSession
    path = f"{job_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
