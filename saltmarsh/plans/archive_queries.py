"""Registered queries of archives, stored grids and files, with their DuckDB SQL.

Archives, grids and files are made from the test tables by Spark, in the shared folder, and then read by the operators.
"""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.operators import scene, tide
from saltmarsh.sources import grid as grids
from saltmarsh.sources.tables import job_dir, read_csv, spread, write_csv_file

#: Bytes of the image that stands before and after the members.
IMAGE = 20_000


def _shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that every worker can open as files; archives and grids as files need one."""
    folder = f"{job_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not folder.startswith(("file:", "/")):
        raise ValueError("archives need a shared folder that workers can open")
    return folder


def _xml(k: int, j: int) -> bytes:
    if (k + j) % 7 == 0:
        return b"<metadata><bad>"
    tags = [("Satellite", "x")]
    if (3 * k + j) % 4:
        tags += [("ReceiveTime", "none"), ("StartTime", f"2024-01-{1 + j:02d} 00:00:00"), ("EndTime", f"2024-01-{1 + j:02d} 00:00:{k % 50:02d}")]
    if (k + 2 * j) % 3 == 0:
        tags += [("CenterLongitude", f" {100 + j + k % 8 / 8} \n"), ("CenterLatitude", str(20 + k % 4 / 4))]
    return ("<m xmlns='u:m'>" + "".join(f"<{t}>{v}</{t}>" for t, v in tags) + "</m>").encode()


def _pack(folder: str):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, nation in zip(batch["k"], batch["nation"], strict=True):
                path = Path(folder) / f"n{nation}" / f"GF2_PMS_E{100 + k % 30}.5_N{10 + k % 20}.25_202401{1 + k % 40:02d}_{k}.tar.gz"
                path.parent.mkdir(parents=True, exist_ok=True)
                held = io.BytesIO()
                with tarfile.open(fileobj=held, mode="w:gz") as tar:
                    for name, content in [("a.tif", bytes(IMAGE)), *((f"{j}.XML", _xml(k, j)) for j in range(k % 6 + 1)), ("z.tif", bytes(IMAGE))]:
                        info = tarfile.TarInfo(name)
                        info.size = len(content)
                        tar.addfile(info, io.BytesIO(content))
                # a task that runs again writes the same bytes
                path.write_bytes(held.getvalue() if k % 17 else b"no archive")
            yield pd.DataFrame({"n": [len(batch)]})

    return pack


def archive_scan(spark: SparkSession, d: str) -> DataFrame:
    """Each supplier as an archive of one to six XML members, written by tasks, then scanned as far as needed."""
    folder = _shared_path(spark, "archives")
    rows = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").cast("long").alias("k"), F.col("s_nationkey").alias("nation"))
    spread(rows).mapInPandas(_pack(folder.removeprefix("file://").removeprefix("file:")), "n long").agg(F.sum("n")).collect()
    read = scene.scan(spark, folder)
    info = scene.scene_info(read.select("file", "open_error", "members"))
    n = read.select("file", F.size("members").alias("n_read"), F.transform("members", lambda m: m["name"]).alias("names"))
    name = F.substring_index("file", "/", -1)
    return info.join(n, "file").select(
        name.alias("file"), "filename_center_lon", "filename_date", "n_read", F.concat_ws(",", "names").alias("names"), "xml", "selected_time_tag", "selected_time",
        "mid_time_from_start_end", "xml_center_lon", "xml_center_lat", "coordinate_source", "status", F.substring_index(F.substring_index("message", "\n", 1), ": ", 2).alias("message"),
    )


def path_order(spark: SparkSession, d: str) -> DataFrame:
    """Parts as files in folders with names that characters and components order differently; the place of each by path."""
    k = F.col("p_partkey")
    folder = F.get(F.array(*(F.lit(x) for x in ("a", "a-b", "a b", "a.b", "é"))), (k % 5).cast("int"))
    file = F.concat(F.lit("/d/"), folder, F.when(k % 3 == 0, "/x").otherwise(""), F.lit("/f"), k.cast("string"))
    parts = spark.read.parquet(f"{d}/part.parquet").select(file.alias("file"))
    folders = parts.groupBy(F.regexp_extract("file", "^(.*)/", 1).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    first = folders.agg(F.array_sort(F.collect_list(scene.path_key(F.col("file")))).alias("order"))  # ten folders at most
    return folders.crossJoin(F.broadcast(first)).select("file", "n", F.array_position("order", scene.path_key(F.col("file"))).alias("place"))


def csv_file(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as one ordered file and read again."""
    path = f"{job_dir(spark)}/customers-{uuid.uuid4().hex}.csv"
    c = spark.read.parquet(f"{d}/customer.parquet")
    k = F.col("c_custkey")
    text = F.when(k % 4 == 0, 'say "a, b"').when(k % 4 == 1, "two\nlines").when(k % 4 == 2, F.concat(F.lit(" "), F.col("c_name"))).otherwise(None)
    out = c.select(k, text.alias("text"), (F.col("c_acctbal").cast("double") / 7).alias("balance"), (k % 3 == 0).alias("third"))
    write_csv_file(out, path, F.desc("c_custkey"))
    back = read_csv(spark, path)
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), "text", F.round(F.col("balance").cast("double"), 9).alias("balance"), "third")


def tiled_cascade(spark: SparkSession, d: str) -> DataFrame:
    """The cascade over a grid that is stored by tiles and opened where scenes are."""
    from saltmarsh.plans import queries as q

    path = f"{job_dir(spark)}/grid-{uuid.uuid4().hex}"
    grids.write_grid(q._grid(spark), path)
    scenes = q._scenes(spark, d).withColumn("days", 11_688.0 + F.col("id") / 24.0)
    out = tide.cascade(scenes, grids.read_grid(spark, path), q._constituents(spark), q.GRID["step"], q.GRID["lon0"], q.GRID["lat0"])
    return out.select("id", F.round("tide_ocean_m", 6).alias("tide_ocean_m"), "tide_interpolation", F.round("tide_point_distance_km", 6).alias("km"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (archive_scan, path_order, csv_file, tiled_cascade)}
_TIME = "'2024-01-' || lpad((1 + j)::VARCHAR, 2, '0') || ' 00:00:00'"
ORACLE_SQL: dict[str, str] = {
    "archive_scan": f"""WITH m AS (SELECT s_suppkey AS k, unnest(range(s_suppkey % 6 + 1)) AS j FROM supplier),
t AS (SELECT *, (k + j) % 7 = 0 AS bad, (3 * k + j) % 4 <> 0 AS timed, (k + 2 * j) % 3 = 0 AS placed FROM m),
e AS (SELECT k, min(j) FILTER (WHERE NOT bad AND timed AND placed) AS stop FROM t GROUP BY k),
r AS (SELECT t.* FROM t JOIN e ON t.k = e.k WHERE stop IS NULL OR j <= stop),
a AS (SELECT k, count(*) AS n, string_agg(j || '.XML', ',' ORDER BY j) AS names, min(j) FILTER (WHERE NOT bad) AS good FROM r GROUP BY k),
x AS (SELECT k, max(j) FILTER (WHERE bad AND (good IS NULL OR j < good)) AS stuck FROM r JOIN a USING (k) GROUP BY k),
b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY 8 * timed::INT + 2 * placed::INT DESC, j) AS nth FROM r WHERE NOT bad),
f AS (SELECT a.*, stuck, j, timed, placed, a.k % 17 = 0 AS broken FROM a JOIN x USING (k) LEFT JOIN b ON b.k = a.k AND nth = 1),
g AS (SELECT *, broken OR j IS NULL AS none FROM f)
SELECT 'GF2_PMS_E' || (100 + k % 30) || '.5_N' || (10 + k % 20) || '.25_202401' || lpad((1 + k % 40)::VARCHAR, 2, '0') || '_' || k || '.tar.gz' AS file,
  100.5::DOUBLE + k % 30 AS filename_center_lon, '2024-01-' || lpad((1 + k % 40)::VARCHAR, 2, '0') AS filename_date, CASE WHEN broken THEN 0 ELSE n END AS n_read,
  CASE WHEN broken THEN '' ELSE names END AS names, CASE WHEN NOT none THEN j || '.XML' END AS xml, CASE WHEN NOT none AND timed THEN 'starttime' END AS selected_time_tag,
  CASE WHEN NOT none AND timed THEN {_TIME} END AS selected_time,
  CASE WHEN NOT none AND timed THEN strftime(({_TIME})::TIMESTAMP + to_microseconds(k % 50 * 500000), '%Y-%m-%d %H:%M:%S') || CASE WHEN k % 50 % 2 = 1 THEN '.500000' ELSE '' END END AS mid_time_from_start_end,
  CASE WHEN none THEN NULL WHEN placed THEN 100 + j + k % 8 / 8::DOUBLE ELSE 100.5::DOUBLE + k % 30 END AS xml_center_lon,
  CASE WHEN none THEN NULL WHEN placed THEN 20 + k % 4 / 4::DOUBLE ELSE 10.25::DOUBLE + k % 20 END AS xml_center_lat,
  CASE WHEN none THEN NULL WHEN placed THEN 'xml_center' ELSE 'filename' END AS coordinate_source,
  CASE WHEN broken THEN 'error' WHEN j IS NULL OR NOT timed OR stuck IS NOT NULL THEN 'warning' ELSE 'ok' END AS status,
  CASE WHEN broken THEN 'open_archive_failed: file could not be opened successfully:' WHEN j IS NOT NULL AND NOT timed THEN 'no_time_candidate' WHEN stuck IS NOT NULL THEN 'xml_parse_failed: ' || stuck || '.XML' ELSE '' END AS message
FROM g""",
    "path_order": """WITH p AS (SELECT '/d/' || ['a', 'a-b', 'a b', 'a.b', 'é'][p_partkey % 5 + 1] || CASE WHEN p_partkey % 3 = 0 THEN '/x' ELSE '' END AS file FROM part),
f AS (SELECT file, count(*) AS n FROM p GROUP BY file)
SELECT file, n, row_number() OVER (ORDER BY string_split(file, '/')) AS place FROM f""",
    "csv_file": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'say "a, b"' WHEN 1 THEN 'two' || chr(10) || 'lines' WHEN 2 THEN ' ' || c_name END AS text,
  round(c_acctbal::DOUBLE / 7, 9) AS balance, CASE WHEN c_custkey % 3 = 0 THEN 'True' ELSE 'False' END AS third FROM customer""",
}
