"""Scene archives as rows: paths are listed by Spark, archives opened in tasks, one row each.

The reader gives what archives hold as it stands, tags and texts of XML members; ``operators.scene`` makes times
and coordinates of them. Paths must be readable on the workers.

``archives`` reads every archive to its end. ``read_on`` reads some XML members from where an earlier reading stopped and says
where it stops, so that a caller which has seen enough leaves the rest of the archive, mostly image, unread.
"""

from __future__ import annotations

import tarfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from itertools import islice
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.sources.tables import spread

#: Readings: where to go on, and whether the archive is at its end.
POSITION = "path string, at long, ordinal int"
READ_ON = "path string, file string, at long, ordinal int, ended boolean, open_error string, n_bytes long, members array<struct<name: string, parse_error: string, elements: array<struct<tag: string, text: string>>>>"
SCHEMA = "file string, open_error string, members array<struct<name: string, parse_error: string, elements: array<struct<tag: string, text: string>>>>"


#: A frame of rows goes to Spark when it has this many rows, or characters of tags and texts.
FRAME_ROWS, FRAME_CHARACTERS = 256, 4_000_000


def elements(content: bytes) -> list[dict]:
    """Tag and direct text of every element that has text, in document order."""
    return [{"tag": x.tag, "text": x.text} for x in ET.fromstring(content).iter() if x.text]


def _members(tar: tarfile.TarFile) -> Iterator[dict]:
    """A row for each regular file named ``.xml`` in any case; one that can't be read bears its error."""
    for info in tar:
        if not (info.isfile() and info.name.lower().endswith(".xml")):
            continue
        content = tar.extractfile(info).read()  # an error here is the archive's
        try:
            yield {"name": info.name, "parse_error": None, "elements": elements(content)}
        except Exception as error:  # parsers raise many kinds, e.g. for unknown encodings; none may end the job
            yield {"name": info.name, "parse_error": str(error), "elements": []}


def xml_members(path: str) -> Iterator[dict]:
    with tarfile.open(path) as tar:
        yield from _members(tar)


def _file(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def _frames(rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
    """Rows of archives by frames: a frame a row costs more than the reading, and all at once would be held in memory."""
    held: list[dict] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(e["tag"]) + len(e["text"]) for m in row["members"] for e in m["elements"])
        if len(held) >= FRAME_ROWS or size >= FRAME_CHARACTERS:
            yield pd.DataFrame(held)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def row(path: str) -> dict:
        row: dict = {"file": _file(path), "open_error": None, "members": []}
        try:
            row["members"].extend(xml_members(row["file"]))
        except Exception as error:  # damaged archives fail in tarfile, zlib, lzma or the file system
            row["open_error"] = str(error)
        return row

    yield from _frames(row(path) for batch in batches for path in batch["path"])


def read_some(path: str, at: int, ordinal: int, most: int) -> dict:
    """A row of READ_ON: up to ``most`` XML members from the header at ``at`` of the unpacked archive.

    Plain archives are sought; packed ones are unpacked again up to there, as their formats have no way in. ``n_bytes``
    is how far the file was read, with what the unpacker read ahead.
    """
    row: dict = {"path": path, "file": _file(path), "at": at, "ordinal": ordinal, "ended": True, "open_error": None, "n_bytes": 0, "members": []}
    try:
        with open(row["file"], "rb") as raw:
            try:
                with tarfile.open(fileobj=raw) as first:
                    first.fileobj.seek(at)
                    tar = tarfile.TarFile(fileobj=first.fileobj) if at else first
                    for member in islice(_members(tar), most):
                        row["members"].append(member)
                    row["ended"] = len(row["members"]) < most
                    row["at"], row["ordinal"] = tar.offset, ordinal + len(row["members"])
            finally:
                row["n_bytes"] = raw.tell()
    except Exception as error:  # as above
        row["open_error"] = str(error)
    return row


def read_on(todo: DataFrame, most: int) -> DataFrame:
    """READ_ON rows of POSITION rows, each with up to ``most`` members more, by as many tasks as the session has."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = (p for batch in batches for p in zip(batch["path"], batch["at"], batch["ordinal"], strict=True))
        yield from _frames(read_some(path, int(at), int(ordinal), most) for path, at, ordinal in places)

    return spread(todo.select("path", "at", "ordinal")).mapInPandas(read, READ_ON)


def paths(spark: SparkSession, folder: str, pattern: str = "GF2*.tar.gz", recursive: bool = True) -> DataFrame:
    """path of every archive, in no order; an error if there is none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    out = found.load(folder).select("path")
    if not out.take(1):  # one task, where isEmpty would run one for every 32 files
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return out


def archives(spark: SparkSession, folder: str, pattern: str = "GF2*.tar.gz", recursive: bool = True) -> DataFrame:
    """file, open_error and members of every archive, in no order; an error if there is none.

    members holds what was read before an error of the archive.
    """
    return paths(spark, folder, pattern, recursive).mapInPandas(_read, SCHEMA)


def inspect(read: DataFrame, most: int = 12) -> DataFrame:
    """Per member of ``scene.read`` rows: what the file name says, times, and the first longitudes and latitudes."""
    from saltmarsh.operators.scene import filename_fields

    names = [c.alias(k) for k, c in filename_fields(F.col("file")).items()]
    m = read.select("file", *names, F.posexplode_outer("members").alias("ordinal", "m"))
    firsts = [F.slice(f"m.{c}", 1, most).alias(c) for c in ("lons", "lats")]
    return m.select("file", *(n for n in m.columns if n.startswith("filename_")), "ordinal", "m.name", "m.parse_error", "m.times", *firsts)
