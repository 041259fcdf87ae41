"""The tide, agreement and scene operators on hand-made cases."""

from __future__ import annotations

import io
import math
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import classify, geo, timeops
from saltmarsh.operators import agreement, scene, scene_tide, tide
from saltmarsh.sources import archive, tables

LOW, MIDLOW, MIDHIGH, HIGH = classify.LABELS
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def published(spark):
    """488 rows with the published confusion matrix, and rows that must not count."""
    matrix = [[74, 48, 0, 0], [0, 112, 10, 0], [0, 0, 122, 0], [0, 0, 37, 85]]
    rows = [(classify.LABELS[i], classify.LABELS[j]) for i in range(4) for j in range(4) for _ in range(matrix[i][j])]
    return spark.createDataFrame([*rows, ("", LOW), (None, LOW), (LOW, "other")], f"{agreement.LEFT} string, {agreement.RIGHT} string")


def test_published_agreement(published):
    counts = agreement.confusion(published)
    r = agreement.rate(counts).first()
    assert (r["rows"], r["agreement"], round(r["rate"], 4)) == (488, 393, 0.8053)
    assert [round(agreement.kappa(counts, w).first()[0], 4) for w in ("linear", "quadratic")] == [0.8326, 0.9095]
    assert [tuple(x) for x in agreement.differences(counts).collect()] == [(0, 393), (1, 95)]
    assert [tuple(x) for x in agreement.mismatch_pairs(counts).collect()] == [(LOW, MIDLOW, 48), (HIGH, MIDHIGH, 37), (MIDLOW, MIDHIGH, 10)]
    assert agreement.mismatches(published).count() == 95


#: The published report.
REPORT = """rows = 488
exact_agreement = 393
exact_agreement_rate = 0.8053
linear_weighted_kappa = 0.8326
quadratic_weighted_kappa = 0.9095

confusion_matrix_rows=tide_level_class columns=tide_level_class_threshold
tide_level_class_threshold  低潮  中低潮  中高潮  高潮
tide_level_class                            
低潮                          74   48    0   0
中低潮                          0  112   10   0
中高潮                          0    0  122   0
高潮                           0    0   37  85

absolute_class_difference_counts
class_difference_abs
0    393
1     95

mismatch_pairs
tide_level_class  tide_level_class_threshold
低潮                中低潮                           48
高潮                中高潮                           37
中低潮               中高潮                           10"""


def test_report_is_the_published_one(published, tmp_path):
    assert agreement.write_report(published, str(tmp_path / "report.txt")) == REPORT
    assert (tmp_path / "report.txt").read_bytes() == REPORT.encode()


def test_sign_of_a_mismatch(spark):
    rows = [(LOW, HIGH), (HIGH, MIDLOW), (MIDLOW, MIDHIGH), (LOW, LOW), ("", HIGH)]
    df = spark.createDataFrame(rows, f"{agreement.LEFT} string, {agreement.RIGHT} string")
    got = {(r[0], r[1]): (r.class_rank_difference, r.class_difference_abs) for r in agreement.mismatches(df).collect()}
    assert got == {(LOW, HIGH): (-3, 3), (HIGH, MIDLOW): (2, 2), (MIDLOW, MIDHIGH): (-1, 1)}


def test_agreement_without_rows(published):
    none = published.limit(0)
    assert agreement.kappa(agreement.confusion(none)).first()[0] is None
    assert "exact_agreement_rate = nan" in agreement.report(none) and agreement.report(none).endswith("none")
    one = published.where(F.col(agreement.LEFT) == MIDHIGH)
    assert agreement.kappa(agreement.confusion(one)).first()[0] is None
    with pytest.raises(ValueError):
        agreement.kappa(agreement.confusion(one), "cubic")


def test_classes(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 10.0, NAN, INF)], "h double")
    assert tuple(classify.quantile_cuts(df, "h").first()) == (2.25, 3.5, 8.5)
    got = {str(r.h): r.tide_level_class for r in classify.with_classes(df, "h").collect()}
    assert got["nan"] == got["inf"] == "" and got["1.0"] == LOW and got["10.0"] == HIGH
    edge = spark.createDataFrame([(v,) for v in (-1.0, -0.999, 0.0, 0.001, 0.599, 0.6, None)], "h double")
    assert [r[0] for r in edge.select(classify.threshold_class(F.col("h"))).collect()] == [LOW, MIDLOW, MIDLOW, MIDHIGH, MIDHIGH, HIGH, ""]


def test_cuts_of_many_values_with_ties_equal_a_full_sort(spark):
    import random

    import numpy as np

    r = random.Random(1)
    values = [r.choice([0.0, 1.5, r.gauss(0, 1), 1e300, -INF]) for _ in range(30_001)]
    got = classify.quantile_cuts(spark.createDataFrame([(v,) for v in [*values, NAN, None]], "h double"), "h").first()
    assert np.allclose(got, np.quantile(values, [0.25, 0.5, 0.75]), rtol=0, atol=1e-12)
    plain = [r.gauss(0, 1) for _ in range(20_002)]
    got = classify.quantile_cuts(spark.createDataFrame([(v,) for v in plain], "h double"), "h").first()
    assert np.allclose(got, np.quantile(plain, [0.25, 0.5, 0.75]), rtol=0, atol=1e-12)
    none = classify.quantile_cuts(spark.createDataFrame([(NAN,)], "h double"), "h")
    assert [tuple(r) for r in none.collect()] == [(None, None, None)]


DAY = datetime(2024, 1, 1)
#: Texts, the local time that they say, and their offset.
TIMES = [
    ("2024-01-01 00:00:00", DAY, None),
    (" 2024/1/2 3:4:5\n", datetime(2024, 1, 2, 3, 4, 5), None),
    ("2024-1-2t3:4:5", datetime(2024, 1, 2, 3, 4, 5), None),
    ("2024/01/02 \t 03:04:05", datetime(2024, 1, 2, 3, 4, 5), None),
    ("20240102030405", datetime(2024, 1, 2, 3, 4, 5), None),
    ("2020115123456", datetime(2020, 11, 5, 12, 34, 56), None),
    ("202011111", datetime(2020, 1, 1, 1, 1, 1), None),
    ("2020-01-05", datetime(2020, 1, 5), None),
    ("20200105", datetime(2020, 1, 5), None),
    ("2024-W01-1", DAY, None),
    ("2020W537", datetime(2021, 1, 3), None),
    ("2024-W01-1T10", datetime(2024, 1, 1, 10), None),
    ("2024-W53-1", None, None),
    ("2024-01-01T00:00:00.5", DAY.replace(microsecond=500_000), None),
    ("2024-01-01T10:11:12,1234567", datetime(2024, 1, 1, 10, 11, 12, 123_456), None),
    ("2024-01-01T00:00:00Z", DAY, "+00:00"),
    ("2024-01-01T00:00:00-00:00", DAY, "+00:00"),
    ("2024-01-01T101112+0830", datetime(2024, 1, 1, 10, 11, 12), "+08:30"),
    ("2024-01-01T10:11:12-08:00:30", datetime(2024, 1, 1, 10, 11, 12), "-08:00:30"),
    ("2024-01-01Z", DAY, None),  # spelled out, the offset reads as a time
    ("2024-01-01T24:00", None, None),
    ("2024-01-01T10:11:12+24:00", None, None),
    ("2024-1-1", None, None),
    ("2024-02-30 00:00:00", None, None),
    ("2024-01-01 00:00:60", None, None),
    ("2024-01-01T", None, None),
    ("no time", None, None),
    ("", None, None),
    (None, None, None),
]


def test_times(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(TIMES)], "k int, t string")
    got = df.select("k", timeops.parse_time(F.col("t")).alias("p"), timeops.offset_of(F.col("t")).alias("o")).orderBy("k").collect()
    assert [(TIMES[r.k][0], r.p, r.o) for r in got] == TIMES
    utc = timeops.to_utc(timeops.parse_time(F.col("t")), 8)
    row = df.where("k = 0").select(utc.alias("u"), timeops.iso_text(utc).alias("i"), timeops.day_number(utc).alias("d")).first()
    assert row.u == datetime(2023, 12, 31, 16) and row.i == "2023-12-31 16:00:00" and row.d == (row.u - datetime(1992, 1, 1)).total_seconds() / 86400


def test_numbers_and_names(spark):
    texts = [" 1.5\n", "1_000", "1__0", "_1", "-.5e-3", "+inf", "-Infinity", "NaN", "1.0d", "0x1", "", "5."]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(scene.number(F.col("t"))).collect()]
    assert str(got) == str([1.5, 1000.0, None, None, -0.0005, INF, -INF, NAN, None, None, None, 5.0])
    names = ["/a/GF2_E120.5_N30_20240133_x", "GF2_E1.2.3_N4_20240101_", "GF2_E120._N30_20240101_"]
    rows = spark.createDataFrame([(n,) for n in names], "f string").select(*(c.alias(n) for n, c in scene.filename_fields(F.col("f")).items())).collect()
    assert [tuple(r) for r in rows] == [(120.5, 30.0, "2024-01-33"), (None, None, None), (None, None, None)]


def test_distance_and_box_order(spark):
    km = spark.range(1).select(geo.haversine_km(F.lit(0.0), F.lit(36.0), F.lit(1.0), F.lit(37.0)), geo.haversine_km(F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(5.0))).first()
    p = [math.radians(x) for x in (36, 37, 1)]
    want = 2 * 6371.0088 * math.asin(math.sqrt(math.sin(p[2] / 2) ** 2 * (1 + math.cos(p[0]) * math.cos(p[1]))))
    assert abs(km[0] - want) < 1e-6 and km[1] == 0
    cells = spark.createDataFrame([(0, 1, 36.25, 120.25), (1, 2, 36.0, 120.26), (5, 5, 36.9, 130.0)], "lat_idx int, lon_idx int, lat double, lon double")
    scenes = spark.createDataFrame([(1, 120.0, 36.0), (2, 130.0, 36.0), (3, 0.0, 0.0), (4, NAN, 36.0)], "id long, lon double, lat double")
    got = {r.id: (r.cell_lat_idx, r.cell_lon_idx) for r in tide.nearest_valid(scenes, cells, 0.3).collect()}
    assert got == {1: (0, 1), 2: (5, 5)}  # the nearer cell lies outside the first box; 0.9 degrees is found though the limit is 0.3


GRID = "constituent string, lat_idx int, lon_idx int, lat double, lon double, amplitude double, phase double"


def grid_rows(missing=()):
    """M2 alone, 1 m everywhere on 4 by 4 cells of one degree from (100, 20), phase 0, with cells missing."""
    return [("M2", j, i, 20.0 + j, 100.0 + i, NAN if (i, j) in missing else 1.0 + i, 0.0) for i in range(4) for j in range(4)]


def test_cascade_by_hand(spark):
    grid = spark.createDataFrame(grid_rows({(2, 2), (3, 3), (3, 2), (2, 3)}), GRID)
    m2 = spark.createDataFrame([("M2", 28.9841042)], "name string, speed_deg_per_hour double")
    rows = [(1, 100.5, 20.5, 0.0), (2, 101.4, 21.4, 0.0), (3, 103.0, 23.0, 0.0), (4, 150.0, 50.0, 0.0), (5, NAN, 20.0, 0.0), (6, None, 20.0, 0.0), (7, 1e300, 20.0, 0.0)]
    twice = [*rows, rows[0], rows[2], (1, 101.0, 20.0, 0.0), (None, 100.0, 20.0, 0.0), (None, 102.0, 20.0, 0.0)]
    scenes = spark.createDataFrame([(*r, "mine") for r in twice], "id long, lon double, lat double, days double, km string")
    got = sorted((tuple(r[c] for c in ("id", "lon", *tide.CASCADE)) for r in tide.cascade(scenes, grid, m2, 1.0, 100.0, 20.0).collect()), key=str)
    km = 2 * 6371.0088 * math.asin(math.sqrt(math.sin(math.radians(1)) ** 2 * math.cos(math.radians(23)) ** 2))
    want = [
        (1, 100.5, 1.5, "linear", 100.5, 20.5, "scene_center", 0.0),
        (1, 100.5, 1.5, "linear", 100.5, 20.5, "scene_center", 0.0),
        (1, 101.0, 2.0, "linear", 101.0, 20.0, "scene_center", 0.0),
        (2, 101.4, 2.0, "nearest", 101.4, 21.4, "scene_center", 0.0),
        (3, 103.0, 2.0, "nearest_valid_grid", 101.0, 23.0, "nearest_valid_fes_grid", km),
        (3, 103.0, 2.0, "nearest_valid_grid", 101.0, 23.0, "nearest_valid_fes_grid", km),
        (4, 150.0, None, "nearest", 150.0, 50.0, "scene_center", 0.0),
        (5, NAN, None, "nearest", NAN, 20.0, "scene_center", 0.0),
        (6, None, None, "nearest", None, 20.0, "scene_center", 0.0),
        (7, 1e300, None, "nearest", 1e300, 20.0, "scene_center", 0.0),
        (None, 100.0, 1.0, "linear", 100.0, 20.0, "scene_center", 0.0),
        (None, 102.0, 3.0, "linear", 102.0, 20.0, "scene_center", 0.0),
    ]
    rounded = lambda rows: [tuple(str(round(x, 6)) if isinstance(x, float) else x for x in r) for r in rows]
    assert rounded(got) == rounded(want)
    assert tide.cascade(scenes.limit(0), grid, m2, 1.0, 100.0, 20.0).collect() == []
    assert {r.km for r in tide.cascade(scenes, grid, m2, 1.0, 100.0, 20.0).collect()} == {"mine"}


def test_nodal_corrections(spark):
    """At the epoch N is 279.802 degrees: M2 is weaker than without by 0.037 cos N and turned by -2.1 sin N degrees."""
    n = math.radians(279.802)
    want = (1 - 0.037 * math.cos(n)) * math.cos(math.radians(-2.1 * math.sin(n)))
    args = [F.lit(x) for x in (1.0, 0.0, 28.9841042, 0.0)]
    got = spark.range(1).select(tide.wave(*args, 0.0, F.lit("m2")), tide.wave(*args, 0.0, F.lit("S2")), tide.wave(*args)).first()
    assert abs(got[0] - want) < 1e-9 and got[1] == got[2] == 1.0


def xml(**tags) -> bytes:
    return ("<r xmlns='u:x'>" + "".join(f"<{k}>{v}</{k}>" for k, v in tags.items()) + "</r>").encode()


GOOD = {"centerTime": "2024-01-02 03:04:05", "CenterLongitude": "120.5", "CenterLatitude": "30.5"}
CASES = {
    "GF2_a_E1.5_N2.5_20240199_x": [("a.xml", xml(**GOOD)), ("b.xml", b"<bad")],
    "GF2_b": [("a.xml", b"<bad"), ("b.XML", xml(**GOOD))],
    "GF2_c": [("a.txt", b"")],
    "GF2_d": [("a.xml", xml(startTime="2024-01-01 00:00:00", endTime="2024-01-01 00:00:01", TopLeftLongitude="1"))],
    "GF2_e_E7.5_N8.5_20240101_": [("a.xml", xml(StartTime="2024-01-01 00:00:00", TopLeftLatitude=1, TopRightLatitude=1, BottomRightLatitude=2, BottomLeftLatitude=2)), ("b.xml", b"<bad")],
    "GF2_f": [("a.xml", xml(CenterLongitude="0.0"))],
    "GF2_g": [("a.xml", xml(endTime="2024-01-01T00:00:00Z", startTime="2024-01-01 00:00:00"))],
    "GF2_h": [("a.xml", b"<bad")],
    "GF2_i": [("g.xml", "<?xml version='1.0' encoding='gbk'?><r>潮</r>".encode("gbk")), ("u.xml", b"<?xml version='1.0' encoding='no-such'?><r/>"), ("a.xml", xml(**GOOD))],
    "GF2_j": [("a.xml", xml(startTime="2024-01-01T00:00:00+08:00", endTime="2024-01-01T01:00:00+08:00"))],
}


def broken(name: str, tmp_path) -> bytes:
    """An archive of two members, cut in the second or damaged near its start."""
    first = xml(**GOOD) if name == "after" else xml(startTime="2024-01-01 00:00:00")
    import os

    with tarfile.open(tmp_path / "whole.tar.gz", "w:gz") as tar:
        for member, content in (("a.xml", first), ("b.xml", b"<r>" + os.urandom(200_000).hex().encode() + b"</r>")):
            info = tarfile.TarInfo(member)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
    whole = (tmp_path / "whole.tar.gz").read_bytes()
    return whole[: len(whole) // 2] if name != "corrupt" else whole[:40] + b"\xff" * 40 + whole[80:]


def test_archives(spark, tmp_path):
    for name, members in CASES.items():
        folder = tmp_path / name[:5]
        folder.mkdir(exist_ok=True)
        with tarfile.open(folder / f"{name}.tar.gz", "w:gz") as tar:
            for member, content in members:
                info = tarfile.TarInfo(member)
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
    (tmp_path / "GF2_z.tar.gz").write_bytes(b"\x1f\x8b not an archive")
    for name in ("after", "before", "corrupt"):
        (tmp_path / f"GF2_{name[0].upper()}.tar.gz").write_bytes(broken(name, tmp_path))
    (tmp_path / "whole.tar.gz").unlink()
    (tmp_path / "other.tar.gz").write_bytes(b"")
    rows = scene.read(archive.archives(spark, str(tmp_path)))
    info = {r.file.rpartition("/")[2][4:5]: r for r in scene.scene_info(rows).collect()}
    assert len(info) == 14 and len(scene.scene_info(rows).columns) == 16
    status = {"a": "ok", "b": "warning", "c": "warning", "d": "ok", "e": "ok", "f": "warning", "g": "ok", "h": "warning", "i": "warning", "j": "ok"}
    assert {k: r.status for k, r in info.items()} == status | {"z": "error", "A": "ok", "B": "error", "C": "error"}
    a, d, e = info["a"], info["d"], info["e"]
    assert (a.filename_center_lon, a.filename_date, a.selected_time, a.xml_center_lon, a.coordinate_source) == (1.5, "2024-01-99", "2024-01-02 03:04:05", 120.5, "xml_center")
    assert a.file == str(tmp_path / "GF2_a" / "GF2_a_E1.5_N2.5_20240199_x.tar.gz")
    assert info["b"].message.startswith("xml_parse_failed: a.xml: ") and info["b"].xml_center_lat == 30.5
    assert info["i"].message.startswith("xml_parse_failed: u.xml: ") and info["i"].xml == "a.xml"
    assert info["c"].message == "no_xml_found" and info["f"].message == "no_time_candidate" and info["f"].xml_center_lon == 0.0
    assert (d.selected_time_tag, d.mid_time_from_start_end, d.xml_center_lon) == ("starttime", "2024-01-01 00:00:00.500000", None)
    assert (e.xml_center_lon, e.xml_center_lat, e.coordinate_source) == (7.5, 1.5, "filename/xml_corner_average")
    assert info["g"].mid_time_from_start_end is None and info["h"].message.startswith("xml_parse_failed: a.xml: ")
    assert (info["j"].mid_time_from_start_end, info["j"].selected_time) == ("2024-01-01 00:30:00+08:00", "2024-01-01 00:00:00+08:00")
    assert info["B"].message.startswith("open_archive_failed: ") and info["B"].selected_time is None and info["A"].xml_center_lon == 120.5
    assert tuple(scene.status_counts(scene.scene_info(rows)).first()) == (6, 5, 3)
    shown = archive.inspect(rows)
    assert shown.where("name = 'a.xml' AND filename_center_lon = 1.5").first().lons[0].value == 120.5
    assert archive.archives(spark, str(tmp_path), recursive=False).count() == 4
    with pytest.raises(FileNotFoundError):
        archive.archives(spark, str(tmp_path), "GF9*")


def test_from_archives_to_the_report(spark, tmp_path):
    """Eight scenes at one place: heights are cos(28.9841042 degrees an hour), so every class is known by hand."""
    for k in range(8):
        content = xml(centerTime=f"2024-01-01 {k:02d}:00:00", CenterLongitude="100.0", CenterLatitude="20.0")
        with tarfile.open(tmp_path / f"GF2_{k}.tar.gz", "w:gz") as tar:
            info = tarfile.TarInfo("a.xml")
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
    tables.write_csv(scene.scene_info(scene.read(archive.archives(spark, str(tmp_path)))), str(tmp_path / "info"), "file")
    info = tables.read_csv(spark, str(tmp_path / "info"), infer=True).withColumn("tide_model", F.lit("gives way"))
    m2 = spark.createDataFrame([("M2", 28.9841042)], "name string, speed_deg_per_hour double")
    out = scene_tide.scene_tide(info, spark.createDataFrame(grid_rows(), GRID), m2, 1.0, 100.0, 20.0)
    assert out.columns == [*(c for c in info.columns if c != "tide_model"), *scene_tide.ADDED]
    tables.write_csv(out, str(tmp_path / "tide"), "file")
    back = tables.read_csv(spark, str(tmp_path / "tide"), infer=True)
    hours = (datetime(2023, 12, 31, 16) - datetime(1992, 1, 1)).total_seconds() / 3600
    want = [math.cos(math.radians(28.9841042 * (hours + k))) for k in range(8)]
    rows = back.orderBy("file").collect()
    assert all(abs(r.tide_ocean_m - w) < 1e-6 for r, w in zip(rows, want, strict=True))
    assert (rows[0].selected_time_local, rows[0].selected_time_utc, rows[0].time_offset_hours_applied) == ("2024-01-01 00:00:00", "2023-12-31 16:00:00", 8.0)
    rank = sorted(range(8), key=want.__getitem__)
    assert [rows[k].tide_level_class for k in rank] == [LOW, LOW, MIDLOW, MIDLOW, MIDHIGH, MIDHIGH, HIGH, HIGH]
    fixed = [LOW if w <= -1 else MIDLOW if w <= 0 else MIDHIGH if w < 0.6 else HIGH for w in want]
    assert [r.tide_level_class_threshold for r in rows] == fixed
    # without a file between
    direct = scene_tide.scene_tide(scene.scene_info(scene.scan(spark, str(tmp_path))), spark.createDataFrame(grid_rows(), GRID), m2, 1.0, 100.0, 20.0)
    shown = lambda df: [(r.file, round(r.tide_ocean_m, 9), r.tide_level_class) for r in df.orderBy("file").collect()]
    assert shown(direct) == shown(back)
    text = agreement.report(back)
    assert text.startswith(f"rows = 8\nexact_agreement = {sum(rows[k].tide_level_class == fixed[k] for k in range(8))}\n")
    assert tuple(tide.summary(back).first())[:2] == (8, 0)
    with pytest.raises(Exception, match="has an offset"):
        info.select(scene_tide.local_time(F.lit("2024-01-01 00:00:00+08:00"))).collect()
    with pytest.raises(Exception, match="is no time"):
        info.select(scene_tide.local_time(F.lit("yesterday"))).collect()


def test_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text('﻿file,selected_time,x\na,2024-01-01 00:00:00,1.5\n"b,c",NA,\n', encoding="utf-8")
    df = tables.read_csv(spark, str(tmp_path / "in.csv"), "file string, selected_time string, x double")
    assert [tuple(r) for r in df.collect()] == [("a", "2024-01-01 00:00:00", 1.5), ("b,c", None, None)]
    assert tables.not_null(df, ["selected_time", "x"]).count() == 1
    tables.write_csv(df, str(tmp_path / "out"), "file")
    assert all(f.read_bytes().startswith(b"\xef\xbb\xbffile,") for f in (tmp_path / "out").glob("*.csv"))
    assert tables.read_csv(spark, str(tmp_path / "out"), "file string, x double").count() == 2
    (tmp_path / "empty.csv").write_text("﻿\n", encoding="utf-8")
    with pytest.raises(ValueError, match="selected_time, x"):
        tables.read_csv(spark, str(tmp_path / "empty.csv"), "x double, selected_time string")


def test_local_times_are_read_once_and_by_all_tasks(spark, monkeypatch):
    written = ["2024-02-29 23:59:59", "2024-01-01 00:00:00.250000", "0001-01-01 00:00:00"]
    other = ["2024-01-01T00:00:00", "20240101 000000", "2024-01-01", "2024-W01-1 12:00", "2024-01-01 00:00:00.25"]
    text = spark.createDataFrame([(t,) for t in [*written, *other]], "t string")
    for r in text.select("t", scene_tide.local_time(F.col("t")).alias("local"), timeops.iso_time(F.col("t"))["parsed"].alias("iso")).collect():
        assert r["local"] == r["iso"] is not None, r
    for t in ("2024-02-30 00:00:00", "0000-01-01 00:00:00", "2024-01-01 24:00:00", "2024-01-01 00:00:60"):
        with pytest.raises(Exception, match="is no time"):
            text.limit(1).select(scene_tide.local_time(F.lit(t))).collect()
    # a table in one partition: its times are stored by as many tasks as there are cores, before heights are made twice from them
    stored = {}
    keep = scene_tide.materialize
    monkeypatch.setattr(scene_tide, "materialize", lambda df, name: stored.setdefault(name, (df, keep(df, name)))[1])
    info = spark.range(0, 800, 1, 1).selectExpr("concat('s', id) AS file", "'2024-01-01 00:00:00' AS selected_time", "100.5D AS xml_center_lon", "20.5D AS xml_center_lat")
    m2 = spark.createDataFrame([("M2", 28.9841042)], "name string, speed_deg_per_hour double")
    assert scene_tide.scene_tide(info, spark.createDataFrame(grid_rows(), GRID), m2, 1.0, 100.0, 20.0).count() == 800
    assert stored["scene-info"][0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "local" in stored["scene-times"][1].columns
