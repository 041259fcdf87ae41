"""The table of scenes with tide heights and level classes, from scene information and a tide model's grid.

Scene information is stored first: it is read more than once here, and in one plan with the expressions that choose among XML
candidates the optimizer would take minutes. Times are read from their texts once, by as many tasks as the session has, and stored
too: one that isn't as this library writes it takes some 0.2 ms, so that a million in the few tasks of a small table take minutes. So ``scene_tide(scene_info(scan(...)))`` is one call, without a file between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.classify import with_classes
from saltmarsh.functions.timeops import day_number, iso_text, iso_time, let, to_utc, trimmed
from saltmarsh.operators.tide import CASCADE, cascade
from saltmarsh.sources.tables import materialize, not_null, require, spread

REQUIRED = ["selected_time", "xml_center_lon", "xml_center_lat"]
#: The columns that are added, in order.
ADDED = (
    "selected_time_local", "selected_time_utc", "time_offset_hours_applied", "tide_model", "tide_interpolation", "tide_query_lon", "tide_query_lat",
    "tide_point_source", "tide_point_distance_km", "tide_ocean_m", "tide_level_class", "tide_level_class_threshold", "tide_q25_m", "tide_q50_m", "tide_q75_m",
)


#: Texts as ``iso_text`` writes them, which is what scene information holds; year 0 is no year.
WRITTEN = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{6})?\z"


def local_time(text: Column) -> Column:
    """The time of an ISO text without offset; anything else is an error when the row is read.

    WRITTEN texts that are times are cast; all others go through ``iso_time``, which takes them apart and costs some 0.2 ms each.
    """
    written = F.when(text.rlike(WRITTEN), text.try_cast("timestamp_ntz"))
    fault = lambda said: F.raise_error(F.concat(F.lit(f"selected_time {said}: "), text)).cast("timestamp_ntz")
    local = lambda t: F.when(t["tz"].isNotNull(), fault("has an offset")).when(t["parsed"].isNull(), fault("is no time")).otherwise(t["parsed"])
    return F.coalesce(written, let(iso_time(F.replace(text, F.lit("Z"), F.lit("+00:00"))), local))


def scene_tide(
    info: DataFrame,
    grid: DataFrame,
    constituents: DataFrame,
    step: float,
    lon0: float,
    lat0: float,
    hours: float = 8.0,
    model: str = "FES2022_extrapolated",
    max_degrees: float = 2.0,
    nodal: bool = False,
    arguments: bool = False,
    minor: bool = False,
) -> DataFrame:
    """All columns of ``info``, then ADDED; columns of those names give way.

    Rows without time or centre are left out, a blank time being none. Local times lie ``hours`` ahead of UTC. Rows that
    share a file are rows of their own. ``nodal``, ``arguments`` and ``minor`` are those of ``tide.cascade``. The quartiles are those of all rows of this table, whose heights are stored first.
    """
    info = materialize(spread(require(info, REQUIRED)), "scene-info")
    timed = not_null(info, REQUIRED).where(trimmed(F.col("selected_time")) != "")
    kept = [c for c in info.columns if c not in ADDED]
    local = local_time(trimmed(F.col("selected_time")))
    at = timed.select(F.struct(*kept).alias("info"), local.alias("local"), *(F.col(f"xml_center_{c}").cast("double").alias(c) for c in ("lon", "lat")))
    at = at.withColumn("utc", to_utc(F.col("local"), hours))
    at = materialize(at, "scene-times").withColumn("days", day_number(F.col("utc")))
    heights = materialize(cascade(at, grid, constituents, step, lon0, lat0, max_degrees, nodal, arguments, minor), "scene-heights")
    classed = with_classes(heights, "tide_ocean_m")
    added = {
        "selected_time_local": iso_text(F.col("local")),
        "selected_time_utc": iso_text(F.col("utc")),
        "time_offset_hours_applied": F.lit(float(hours)),
        "tide_model": F.lit(model),
        **{c: F.col(c) for c in CASCADE},
        **{c: F.col(c) for c in ("tide_level_class", "tide_level_class_threshold")},
        **{f"tide_{q}_m": F.col(q) for q in ("q25", "q50", "q75")},
    }
    return classed.select("info.*", *(added[c].alias(c) for c in ADDED))
