"""The archive scan that stops early, path order, and tables as one file."""

from __future__ import annotations

import io
import os
import random
import tarfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from saltmarsh.operators import scene
from saltmarsh.sources import archive, tables
from tests.tide.test_tide import CASES, GOOD, broken, xml


def pack(path, members, mode="w:gz"):
    path.parent.mkdir(exist_ok=True, parents=True)
    with tarfile.open(path, mode) as tar:
        for name, content in members:
            info = tarfile.TarInfo(name)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))


def rows(df):
    return {r["file"]: r.asDict(recursive=True) for r in df.select("file", "open_error", "members").collect()}


def test_scan_gives_what_whole_reading_gives(spark, tmp_path):
    for name, members in CASES.items():
        pack(tmp_path / name[:5] / f"{name}.tar.gz", members)
    (tmp_path / "GF2_z.tar.gz").write_bytes(b"\x1f\x8b not an archive")
    (tmp_path / "GF2_y.tar.gz").write_bytes(b"")
    for name in ("after", "before", "corrupt"):
        (tmp_path / f"GF2_{name[0].upper()}.tar.gz").write_bytes(broken(name, tmp_path))
    (tmp_path / "whole.tar.gz").unlink()
    # many members before the first whole one, or none, so that there are several rounds
    poor = [(f"{k}.xml", xml(startTime=f"2024-01-01 00:00:{k:02d}")) for k in range(30)]
    pack(tmp_path / "GF2_many.tar.gz", [*poor[:9], ("bad.xml", b"<r>"), ("image.tif", os.urandom(5000)), ("good.xml", xml(**GOOD)), *poor[9:]])
    pack(tmp_path / "GF2_none.tar.gz", poor)
    pack(tmp_path / "GF2_six.tar.gz", [*poor[:5], ("n" * 150 + ".xml", xml(**GOOD))])  # a name that takes a header of its own
    whole = scene.read(archive.archives(spark, str(tmp_path)))
    scanned = scene.scan(spark, str(tmp_path))
    assert rows(scanned) == rows(whole)
    info = lambda df: sorted(map(tuple, scene.scene_info(df).collect()), key=str)
    assert info(scanned) == info(whole)
    with pytest.raises(FileNotFoundError):
        scene.scan(spark, str(tmp_path), "GF9*")


@pytest.mark.parametrize("mode", ["w", "w:gz", "w:bz2", "w:xz"])
def test_scan_leaves_the_image_unread(spark, tmp_path, mode):
    image = random.Random(1).randbytes(6_000_000)
    first = [("a.xml", xml(**GOOD)), ("image.tif", image), ("late.xml", xml(**GOOD))]
    last = [("poor.xml", xml(startTime="2024-01-01 00:00:00")), ("image.tif", image), ("a.xml", xml(**GOOD))]
    pack(tmp_path / "GF2_first.tar.gz", first, mode)
    pack(tmp_path / "GF2_last.tar.gz", last, mode)
    got = {r["file"].rpartition("_")[2]: r for r in scene.scan(spark, str(tmp_path)).collect()}
    early, late = got["first.tar.gz"], got["last.tar.gz"]
    assert early["n_bytes"] < 2_000_000 and [m["name"] for m in early["members"]] == ["a.xml"]
    assert [m["name"] for m in late["members"]] == ["poor.xml", "a.xml"]
    size = (tmp_path / "GF2_last.tar.gz").stat().st_size
    assert late["n_bytes"] < size * 1.1 + 1_000_000 if mode != "w" else late["n_bytes"] >= size - 100_000


def test_readings_go_on_where_they_stopped(tmp_path):
    pack(tmp_path / "x.tar.gz", [(f"{k}.xml", xml(startTime=f"2024-01-01 00:00:{k:02d}")) for k in range(7)])
    at, seen = (0, 0), []
    for most in (1, 2, 3, 4):
        row = archive.read_some(str(tmp_path / "x.tar.gz"), *at, most)
        seen += [m["name"] for m in row["members"]]
        at = row["at"], row["ordinal"]
    assert seen == [f"{k}.xml" for k in range(7)] and row["ended"] and at[1] == 7
    assert archive.read_some(str(tmp_path / "gone"), 0, 0, 1)["open_error"].startswith("[Errno 2]")


def test_paths_go_by_component(spark):
    paths = ["/a-b/x", "/a/x", "/a/x/y", "/a", "/a b/x", "b", "/a/é", "/a/z"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "file string").orderBy(scene.path_key(F.col("file"))).collect()]
    from pathlib import PurePosixPath

    assert got == sorted(paths, key=PurePosixPath)
    assert got.index("/a/x") < got.index("/a-b/x")


def test_one_file_is_what_pandas_writes(spark, tmp_path):
    rng = random.Random(3)
    numbers = [0.0, -0.0, 1.0, 0.1, 1e-4, 1.5e-5, 123456.789, 1e15, 1e16, 1.25e22, -3.5e-300, 2.5, 1e7, 12345678.0, 0.001, 9.999e15, float("nan"), None, float("inf"), float("-inf")]
    numbers += [rng.uniform(-1e3, 1e3) for _ in range(100)]
    texts = ["a", "b,c", 'say "x"', "two\nlines", "cr\r", " blanks ", "", None, "中高潮", "#x", "\\"]
    data = [(f"/d{k % 7}/f{k:03d}", x, texts[k % len(texts)], k * 10**9 if k % 5 else None) for k, x in enumerate(numbers)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "file string, x double, `a,b` string, n long").repartition(5)
    path = str(tmp_path / "out.csv")
    tables.write_csv_file(df, path, scene.path_key(F.col("file")))
    frame = pd.DataFrame(sorted(data, key=lambda r: r[0].split("/")), columns=["file", "x", "a,b", "n"]).astype({"n": "Int64"})
    frame.to_csv(tmp_path / "want.csv", index=False, encoding="utf-8-sig")
    assert (tmp_path / "out.csv").read_bytes() == (tmp_path / "want.csv").read_bytes()
    tables.write_csv_file(df.select("a,b").limit(0), path)
    assert (tmp_path / "out.csv").read_bytes() == b'\xef\xbb\xbf"a,b"\n'
    tables.write_csv_file(spark.createDataFrame([("x",), (None,)], "a string").coalesce(1), path)
    assert (tmp_path / "out.csv").read_bytes() == b'\xef\xbb\xbfa\nx\n""\n'
    back = tables.read_csv(spark, str(tmp_path / "want.csv"))
    assert back.count() == len(data)


def test_archives_are_read_by_all_tasks_and_handed_over_in_frames(spark, tmp_path):
    row = {"members": [{"elements": [{"tag": "t", "text": "x" * 9}]}]}
    long = {"members": [{"elements": [{"tag": "t", "text": "x" * archive.FRAME_CHARACTERS}]}]}
    n = archive.FRAME_ROWS
    assert [len(f) for f in archive._frames(iter([row] * (2 * n + 1)))] == [n, n, 1]
    assert [len(f) for f in archive._frames(iter([row, long, row]))] == [2, 1]
    assert list(archive._frames(iter([]))) == []
    for k in range(40):
        pack(tmp_path / f"GF2_{k}.tar.gz", [("a.xml", xml(**GOOD))])
    todo = archive.paths(spark, str(tmp_path)).coalesce(1).select("path", F.lit(0).cast("long").alias("at"), F.lit(0).alias("ordinal"))
    got = archive.read_on(todo, 1)
    assert got.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted((r["file"].split("_")[-1], len(r["members"])) for r in got.collect()) == sorted((f"{k}.tar.gz", 1) for k in range(40))
