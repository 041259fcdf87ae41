"""Acquisition time and centre coordinates of a scene, by preference among what its XML members say.

``read`` makes candidates of what archives hold: file, open_error and members, each with name, parse_error, times
(tag, parsed, tz, raw), lons, lats (tag, value, raw) and fields (tag, value), in archive order. The rest chooses
among them. ``scan`` reads archives no further than that choice needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.timeops import iso_text, let, midpoint, read_time, trimmed
from saltmarsh.sources import archive
from saltmarsh.sources.tables import materialize

#: Parts of tag names, in order of preference.
TIME_PRIORITY = (
    "centertime", "center_time", "scenecentertime", "imagingtime", "imaging_time",
    "acquisitiontime", "acquisition_time", "starttime", "start_time",
)
#: Tags that hint at a time, a longitude, a latitude.
TIME_HINTS = (
    "centertime", "center_time", "imagingtime", "imaging_time", "scenecentertime", "starttime",
    "start_time", "endtime", "end_time", "acquisitiontime", "acquisition_time",
)
LON_HINTS = ("centerlongitude", "center_lon", "centerlong", "longitude")
LAT_HINTS = ("centerlatitude", "center_lat", "centerlat", "latitude")
CORNERS = ("topleft", "topright", "bottomright", "bottomleft")
NAME = r"_E([0-9]+(?:\.[0-9]+)?)_N([0-9]+(?:\.[0-9]+)?)_([0-9]{8})_"
#: A decimal number, digits parted by single underscores at most, or a word for infinity or no number.
NUMBER = r"^[+-]?(D\.?D?|\.D)([eE][+-]?D)?$".replace("D?", "(D)?").replace("D", "[0-9](_?[0-9])*")


def normal_tag(tag: Column) -> Column:
    return F.lower(F.substring_index(tag, "}", -1))


def hinted(tag: Column, hints: tuple[str, ...]) -> Column:
    return F.exists(F.array(*(F.lit(h) for h in hints)), lambda h: F.contains(tag, h))


def number(text: Column) -> Column:
    """The number that a text spells; null for any other text."""

    def spelled(t: Column) -> Column:
        plain = F.when(t.rlike(NUMBER), F.replace(t, F.lit("_"), F.lit(""))).when(t.rlike(r"^[+-]?inf(inity)?$"), t)
        return F.when(t.rlike(r"^[+-]?nan$"), float("nan")).otherwise(plain.try_cast("double"))

    return let(F.lower(trimmed(text)), spelled)


def read_elements(elements: Column) -> Column:
    """struct(times, lons, lats, fields) of an XML member's elements (tag, text); blank texts are left out."""
    def timed(f: Column) -> Column:
        row = lambda t: F.struct(f["tag"].alias("tag"), t["parsed"].alias("parsed"), t["tz"].alias("tz"), f["value"].alias("raw"))
        return let(read_time(f["value"]), row)

    def numbered(f: Column) -> Column:
        return F.struct(f["tag"].alias("tag"), number(f["value"]).alias("value"), f["value"].alias("raw"))

    def candidates(fields: Column) -> Column:
        of = lambda hints: F.filter(fields, lambda f: hinted(f["tag"], hints))
        lons, lats = (F.filter(F.transform(of(h), numbered), lambda c: c["value"].isNotNull()) for h in (LON_HINTS, LAT_HINTS))
        times = F.filter(F.transform(of(TIME_HINTS), timed), lambda c: c["parsed"].isNotNull())
        return F.struct(times.alias("times"), lons.alias("lons"), lats.alias("lats"), fields.alias("fields"))

    tidy = F.transform(elements, lambda e: F.struct(normal_tag(e["tag"]).alias("tag"), trimmed(e["text"]).alias("value")))
    return let(F.filter(tidy, lambda f: f["value"] != ""), candidates)


def _member(m: Column) -> Column:
    row = lambda r: F.struct(m["name"].alias("name"), m["parse_error"].alias("parse_error"), *(r[c].alias(c) for c in ("times", "lons", "lats", "fields")))
    return let(read_elements(m["elements"]), row)


def _upto(members: Column) -> Column:
    """struct(found, members): members up to the first that has times, longitudes and latitudes, and whether there is one."""
    whole = F.transform(members, lambda m: (F.size(m["times"]) > 0) & (F.size(m["lons"]) > 0) & (F.size(m["lats"]) > 0))
    cut = lambda end: F.struct(
        (end > 0).alias("found"), F.slice(members, F.lit(1), F.when(end > 0, end.cast("int")).otherwise(F.size(members))).alias("members")
    )
    return let(F.array_position(whole, True), cut)


def read(archives: DataFrame) -> DataFrame:
    """Candidates of every member up to the first that has times, longitudes and latitudes.

    What follows such a member counts as not read: neither later members nor an error of the archive after it.
    """
    error = F.when(~F.col("r.found"), F.col("open_error")).alias("open_error")
    return archives.select("file", "open_error", let(F.transform("members", _member), _upto).alias("r")).select("file", error, "r.members")


#: XML members that a reading takes in the first round, and how that number grows by round.
FIRST_MEMBERS, GROWTH = 1, 4


def scan(spark: SparkSession, folder: str, pattern: str = "GF2*.tar.gz", recursive: bool = True) -> DataFrame:
    """What ``read(archives(...))`` gives, and n_bytes read, without reading on behind the first whole member.

    Archives are read by rounds: in each, those that haven't shown times, longitudes and latitudes in one member, nor ended,
    are opened again where the round before stopped, for GROWTH times as many XML members. Columns decide which those
    are, so the workers read and the rules of candidates stay where all others are. Rounds are stored: a lost executor
    costs one round's reading at most. There are as many rounds as the logarithm of the most members before a whole one.
    """
    todo = archive.paths(spark, folder, pattern, recursive).select("path", F.lit(0).cast("long").alias("at"), F.lit(0).alias("ordinal"))
    rounds, most = [], FIRST_MEMBERS
    while True:
        got = archive.read_on(todo, most).withColumn("r", let(F.transform("members", _member), _upto))
        kept = got.select(F.lit(len(rounds)).alias("round"), "path", "file", "at", "ordinal", "ended", "open_error", "n_bytes", "r.found", "r.members")
        rounds.append(materialize(kept, "archive-round"))
        going_on = rounds[-1].where("NOT found AND NOT ended")
        if not going_on.select("path").take(1):
            break
        todo, most = going_on, most * GROWTH
    error = F.when(~F.col("found"), F.col("open_error")).alias("open_error")
    out = rounds[0].where("found OR ended").select("file", error, "members", "n_bytes")
    if len(rounds) == 1:
        return out
    rest = rounds[0].where("NOT found AND NOT ended")
    for r in rounds[1:]:
        rest = rest.unionByName(r)
    # an archive has a row a round, and its last one says how it ended
    whole = rest.groupBy("path").agg(
        F.max_by("file", "round").alias("file"), F.max_by(F.struct(error), "round")["open_error"].alias("open_error"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("round", "members"))), lambda r: r["members"])).alias("members"), F.sum("n_bytes").alias("n_bytes"),
    )
    return out.unionByName(whole.drop("path"))


def path_key(file: Column) -> Column:
    """What scenes are ordered by: the components of the path, so that ``/a/x`` comes before ``/a-b/x``."""
    return F.split(file, "/")


def filename_fields(file: Column) -> dict[str, Column]:
    """Centre and date from a file name; null where the name doesn't match."""
    name = F.substring_index(file, "/", -1)
    part = lambda k: F.nullif(F.regexp_extract(name, NAME, k), F.lit(""))
    date = part(3)
    return {
        "filename_center_lon": number(part(1)),
        "filename_center_lat": number(part(2)),
        "filename_date": F.when(date.isNotNull(), F.concat_ws("-", F.substring(date, 1, 4), F.substring(date, 5, 2), F.substring(date, 7, 2))),
    }


def choose_time(times: Column) -> Column:
    """The struct of the first candidate by TIME_PRIORITY, else the first; null without any."""
    first = lambda key: F.get(F.filter(times, lambda t: F.contains(t["tag"], F.lit(key))), F.lit(0))
    return F.coalesce(*(first(k) for k in TIME_PRIORITY), F.get(times, F.lit(0)))


def average_time(times: Column) -> Column:
    """Text of the middle of the first start and the first end, with their offset; null if either is missing or the offsets differ."""
    first = lambda key: F.get(F.filter(times, lambda t: F.contains(t["tag"], F.lit(key))), F.lit(0))
    start, end = first("start"), first("end")
    middle = F.concat(iso_text(midpoint(start["parsed"], end["parsed"])), F.coalesce(start["tz"], F.lit("")))
    return F.when(start["tz"].eqNullSafe(end["tz"]) & end.isNotNull(), middle)


def choose_coordinate(fields: Column, axis: str, fallback: Column) -> Column:
    """struct(tag, value, source): the exact centre tag, the mean of four corners, the file name, or nulls. Last duplicates win."""
    last = lambda tag: F.try_element_at(
        F.filter(F.transform(F.filter(fields, lambda f: F.lower(f["tag"]) == tag), lambda f: number(f["value"])), lambda v: v.isNotNull()), F.lit(-1)
    )
    pick = lambda tag, value, source: F.when(value.isNotNull(), F.struct(F.lit(tag).alias("tag"), value.alias("value"), F.lit(source).alias("source")))
    corners = [last(f"{c}{axis}") for c in CORNERS]
    mean = (corners[0] + corners[1] + corners[2] + corners[3]) / 4.0
    none = F.struct(F.lit(None).cast("string").alias("tag"), F.lit(None).cast("double").alias("value"), F.lit("").alias("source"))
    return F.coalesce(
        pick(f"center{axis}", last(f"center{axis}"), "xml_center"),
        pick(f"corner_average_{axis}", mean, "xml_corner_average"),
        pick(f"filename_{axis}", fallback, "filename"),
        none,
    )


def best_member(members: Column) -> Column:
    """The readable member with the highest 4 * times + lons + lats; the first of equals."""
    scored = F.transform(
        F.filter(members, lambda m: m["parse_error"].isNull()),
        lambda m, i: F.struct((4 * F.size(m["times"]) + F.size(m["lons"]) + F.size(m["lats"])).alias("score"), (-i).alias("at"), m.alias("m")),
    )
    top = F.array_max(F.transform(scored, lambda s: F.struct(s["score"].alias("score"), s["at"].alias("at"))))
    return F.get(F.filter(scored, lambda s: F.struct(s["score"].alias("score"), s["at"].alias("at")) == top), F.lit(0))["m"]


def status(open_error: Column, members: Column, best: Column) -> tuple[Column, Column]:
    """Status and message. An error while no member has yet been read sticks, the last such error winning."""
    first_good = F.coalesce(F.nullif(F.array_position(F.transform(members, lambda m: m["parse_error"].isNull()), True), F.lit(0)) - 1, F.size(members))
    early = F.filter(F.slice(members, 1, first_good.cast("int")), lambda m: m["parse_error"].isNotNull())
    last = F.try_element_at(early, F.lit(-1))
    stuck = F.concat(F.lit("xml_parse_failed: "), last["name"], F.lit(": "), last["parse_error"])
    kind = F.when(open_error.isNotNull(), "error").when(best.isNull() | (F.size(best["times"]) == 0) | stuck.isNotNull(), "warning").otherwise("ok")
    message = (
        F.when(open_error.isNotNull(), F.concat(F.lit("open_archive_failed: "), open_error))
        .when(best.isNull() & stuck.isNull(), "no_xml_found")
        .when(best.isNull(), F.coalesce(stuck, F.lit("no_readable_xml")))
        .when(F.size(best["times"]) == 0, "no_time_candidate")
        .otherwise(F.coalesce(stuck, F.lit("")))
    )
    return kind, message


INFO = (
    "xml", "selected_time_tag", "selected_time", "selected_time_raw", "mid_time_from_start_end", "xml_lon_tag", "xml_center_lon", "xml_lat_tag",
    "xml_center_lat", "coordinate_source", "status", "message",
)


def scene_info(read_rows: DataFrame) -> DataFrame:
    """The 16 columns of a scene, from ``read`` rows; missing values are null."""
    names = filename_fields(F.col("file"))

    def described(best: Column, time: Column, lon: Column, lat: Column) -> Column:
        kind, message = status(F.col("open_error"), F.col("members"), best)
        both = F.when(lon["source"] == lat["source"], lon["source"]).otherwise(F.concat(lon["source"], F.lit("/"), lat["source"]))
        values = (
            best["name"], time["tag"], F.concat(iso_text(time["parsed"]), F.coalesce(time["tz"], F.lit(""))), time["raw"], average_time(best["times"]),
            lon["tag"], lon["value"], lat["tag"], lat["value"], both, kind, message,
        )
        return F.struct(*(v.alias(n) for n, v in zip(INFO, values, strict=True)))

    def placed(best: Column) -> Column:
        coordinate = lambda axis, key: F.when(best.isNotNull(), choose_coordinate(best["fields"], axis, names[f"filename_center_{key}"]))
        at = lambda time, lon: let(coordinate("latitude", "lat"), lambda lat: described(best, time, lon, lat))
        return let(choose_time(best["times"]), lambda time: let(coordinate("longitude", "lon"), lambda lon: at(time, lon)))

    best = F.when(F.col("open_error").isNull(), best_member(F.col("members")))
    return read_rows.select("file", *(c.alias(k) for k, c in names.items()), let(best, placed).alias("info")).select("file", *names, "info.*")


def status_counts(info: DataFrame) -> DataFrame:
    return info.agg(*(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("ok", "warning", "error")))
