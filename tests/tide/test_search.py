"""Exact ranks by rounds, the pyramid of valid cells, and grids stored by tiles."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import classify
from saltmarsh.operators import tide
from saltmarsh.plans import queries
from saltmarsh.sources import grid as grids

CELLS = "constituent string, lat_idx long, lon_idx long, lat double, lon double, amplitude double, phase double"


def cuts(spark, values, column="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {column}").repartition(6)
    return tuple(classify.quantile_cuts(df, "v").first())


@pytest.mark.parametrize("few", [0, 1, 50])
def test_cuts_by_rounds_equal_a_sort(spark, monkeypatch, few):
    """With FEW_VALUES so small that brackets go through several rounds, down to single values."""
    monkeypatch.setattr(classify, "FEW_VALUES", few)
    rng = random.Random(few)
    cases = {
        "distinct": [rng.gauss(0, 1) for _ in range(3000)],
        "ties": [float(rng.randrange(4)) for _ in range(3000)],
        "one tie beside a continuum": [0.5] * 1500 + [0.5 + rng.random() for _ in range(1500)],
        "integers": [float(k) for k in range(1, 1002)],
        "few": [3.0, 1.0, 2.0],
    }
    for name, values in cases.items():
        assert cuts(spark, values) == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.75])), abs=1e-12), name


def test_cuts_with_what_is_no_number(spark):
    inf, nan = math.inf, math.nan
    assert cuts(spark, []) == (None, None, None) == cuts(spark, [nan, None])
    assert cuts(spark, [7.0, nan, None]) == (7.0, 7.0, 7.0)
    assert cuts(spark, [-inf, 1.0, 2.0, 3.0, inf]) == (1.0, 2.0, 3.0)
    assert cuts(spark, [-inf, -inf, 1.0, inf, inf]) == (-inf, 1.0, inf)
    assert cuts(spark, [1.0, 2.0, inf, inf]) == (1.75, inf, inf)
    assert cuts(spark, [3, 1, 2, 5], "int") == (1.75, 2.5, 3.5)


def test_a_round_leaves_few_values(spark):
    """No sort of all values: after a round the brackets hold a share of some 6 / 10,000 for each rank."""
    n = 400_000
    df = spark.range(n).select(F.hash("id").cast("double").alias("v"))
    sought = [classify._Sought(n // 2, n, 0)]
    ends = [0.5 - 3 * classify.RANK_ERROR, 0.5 + 3 * classify.RANK_ERROR]
    a, b = df.agg(F.percentile_approx("v", F.array(*map(F.lit, ends)), F.lit(10_000))).first()[0]
    v = F.col("v")
    counts = df.agg(*(F.count_if(t) for t in (v < a, v == a, (v > a) & (v < b), v == b))).first()
    sought[0].narrow(a, b, tuple(counts))
    assert sought[0].value is not None or sought[0].inside <= n * 12 * classify.RANK_ERROR
    want = sorted(r[0] for r in df.collect())
    assert classify.values_at(df, [0, n // 4, n - 1], n, 0, 0) == {0: want[0], n // 4: want[n // 4], n - 1: want[-1]}


def plain_nearest(scene, cells, max_degrees):
    lon, lat = scene
    for size in [*tide.BOXES, *([max_degrees] if max_degrees > 1 else [])]:
        near = []
        for i, j, clat, clon in cells:
            if abs(clat - lat) <= size and abs(clon - lon) <= size:
                a = math.sin(math.radians(clat - lat) / 2) ** 2 + math.cos(math.radians(lat)) * math.cos(math.radians(clat)) * math.sin(math.radians(clon - lon) / 2) ** 2
                near.append((2 * 6371.0088 * math.asin(math.sqrt(a)), i, j))
        if near:
            return min((round(km, 9), i, j) for km, i, j in near)[1:]
    return None


@pytest.mark.parametrize("max_degrees", [2.0, 0.75, 3.3])
@pytest.mark.parametrize("most", [0, 10**6])  # tiles joined by shuffle, and broadcast
def test_pyramid_equals_a_search_box_by_box(spark, monkeypatch, max_degrees, most):
    monkeypatch.setattr(tide, "BROADCAST_TILES", most)
    rng = random.Random(7)
    cells = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(40)})
    cells = [(i, j, 30 + i / 4, 118 + j / 4) for i, j in cells]
    scenes = [(k, 118 + rng.random() * 16, 29 + rng.random() * 17) for k in range(250)]
    scenes += [(300 + k, c[3], c[2]) for k, c in enumerate(cells[:20])]  # on a cell
    scenes += [(400 + k, c[3] + 0.25, c[2] - 0.25) for k, c in enumerate(cells[:20])]  # on the edge of a box
    got = tide.nearest_valid(
        spark.createDataFrame([*scenes, (999, math.nan, 1.0)], "id long, lon double, lat double"), spark.createDataFrame(cells, "lat_idx long, lon_idx long, lat double, lon double"), max_degrees
    )
    found = {r.id: (r.cell_lat_idx, r.cell_lon_idx) for r in got.collect()}
    want = {k: plain_nearest((lon, lat), cells, max_degrees) for k, lon, lat in scenes}
    assert found == {k: v for k, v in want.items() if v is not None}


def test_cells_are_joined_once(spark):
    cells = spark.range(50).select(F.col("id").alias("lat_idx"), F.col("id").alias("lon_idx"), (F.col("id") * 1.0).alias("lat"), (F.col("id") * 1.0).alias("lon"))
    scenes = spark.createDataFrame([(1, 3.2, 3.1)], "id long, lon double, lat double")
    plan = tide.nearest_valid(scenes, cells)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and plan.count("Range (0, 50") == 1  # tiles of the pyramid, and cells


def test_scenes_open_the_tiles_they_touch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(grids, "TILE_CELLS", 8)
    rows = [(c, i, j, 20 + i / 4, 100 + j / 4, 1.0 + (i + j) / 50 if (i * 7 + j) % 5 else math.nan, 10.0 * j) for c in ("M2", "S2") for i in range(40) for j in range(40)]
    plain = spark.createDataFrame(rows, CELLS)
    path = str(tmp_path / "grid")
    grids.write_grid(plain, path)
    tiled = grids.read_grid(spark, path)
    assert sorted(map(str, tiled.drop(grids.TILE_COLUMN).collect())) == sorted(map(str, plain.collect()))
    assert len(list((tmp_path / "grid").glob("grid_tile=*"))) == 25
    scenes = spark.createDataFrame([(1, 101.3, 21.2, 10.0), (2, 105.0, 25.1, 11.5), (3, 101.99, 21.3, 12.0), (4, math.nan, 1.0, 1.0), (5, 160.0, 70.0, 2.0)], "id long, lon double, lat double, days double")
    near = tide.touched(tiled, scenes, 0.25, 0.25, 100.0, 20.0)
    read = {r[0].rpartition("=")[2].partition("/")[0] for r in near.select(F.input_file_name()).distinct().collect()}
    assert read == {"0_0", "0_1", "2_2"}
    scan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "grid_tile" in scan.partition("PartitionFilters: [")[2].partition("]")[0]
    named = spark.createDataFrame([("M2", 28.9841042), ("S2", 30.0)], "name string, speed_deg_per_hour double")
    key = lambda df: sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in df.collect())
    for grid in (tiled,):
        assert key(tide.cascade(scenes, grid, named, 0.25, 100.0, 20.0)) == key(tide.cascade(scenes, plain, named, 0.25, 100.0, 20.0))
        assert key(tide.sample(scenes, grid, 0.25, 100.0, 20.0)) == key(tide.sample(scenes, plain, 0.25, 100.0, 20.0))
    none = scenes.where("id = 4")
    assert tide.touched(tiled, none, 0.25, 0.25, 100.0, 20.0).count() == 0
    monkeypatch.setattr(grids, "MOST_TILES", 1)
    assert key(tide.cascade(scenes, tiled, named, 0.25, 100.0, 20.0)) == key(tide.cascade(scenes, plain, named, 0.25, 100.0, 20.0))


@pytest.mark.parametrize("name", ["choose_coordinate", "best_member", "scene_status", "choose_time", "status_summary"])
def test_lines_are_shuffled_before_they_become_members(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    shuffled = re.split(r"\n[^\n]*(?:Aggregate \[l_orderkey|Window \[)", plan)[-1]
    assert "l_shipdate" in shuffled
    assert "concat_ws" in plan and "concat_ws" not in shuffled


@pytest.mark.parametrize("name", ["choose_coordinate", "best_member", "scene_status", "choose_time", "status_summary"])
def test_tasks_that_sort_lines_grow_with_the_table(spark, name):
    d, most = "/root/testdata/sf0.001", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(most)
    spark.conf.set(most, "8k")
    try:
        splits = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey").rdd.getNumPartitions()
        plan = queries.QUERIES[name](spark, d)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(most, before)
    tasks = int(re.search(r"RepartitionByExpression \[l_orderkey[^\]]*\], (\d+)", plan)[1])
    assert splits > 8 and tasks >= 8 * splits


def _shuffled(df):
    """Bytes that the exchanges of ``df`` write."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan()], 0
    for node in nodes:
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
        if node.metrics().contains("shuffleBytesWritten"):
            total += node.metrics().apply("shuffleBytesWritten").value()
    return total


@pytest.mark.parametrize("name", ["choose_time", "status_summary"])
def test_bytes_shuffled_grow_with_the_lines(spark, tmp_path, name):
    line = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n in (4, 24):
            again = line.crossJoin(spark.range(n)).withColumn("l_orderkey", F.col("l_orderkey") + F.col("id") * 1_000_000).drop("id")
            again.write.parquet(f"{tmp_path}/{n}/lineitem.parquet")
        few, many = (_shuffled(queries.QUERIES[name](spark, f"{tmp_path}/{n}")) for n in (4, 24))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert 0 < many <= 6 * few
    assert many <= 60 * 24 * line.count()
