"""The registered queries of the tide and scene operators, with their DuckDB SQL.

The test tables hold no scenes, so each operator runs over whole stand-in tables: events as acquisition times,
customers as places or scenes, orders as heights.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saltmarsh.functions import astro, classify, geo, timeops
from saltmarsh.operators import agreement, scene, tide
from saltmarsh.operators.scene_tide import scene_tide as assemble
from saltmarsh.plans import archive_queries
from saltmarsh.sources.tables import materialize, not_null, spread

#: name, speed in degrees an hour, amplitude, phase of the inline constituents.
CONSTITUENTS = [("M2", 28.9841042, 1.2, 30.0), ("S2", 30.0, 0.5, 60.0), ("K1", 15.0410686, 0.3, 100.0), ("O1", 13.9430356, 0.25, 80.0)]
OFFSET_HOURS = 8
GRID = {"lon0": 117.0, "lat0": 33.0, "step": 0.25, "n_lon": 41, "n_lat": 37}


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _days(spark: SparkSession, d: str) -> DataFrame:
    utc = timeops.to_utc(F.col("ts"), OFFSET_HOURS)
    return _read(spark, d, "events").select("event_id", "ts", utc.alias("utc"), timeops.day_number(utc).alias("days"))


def _heights(spark: SparkSession, d: str) -> DataFrame:
    """Height by event; one event in 97 has none."""
    part = lambda c, turn: F.lit(c[2]) * turn(F.radians(F.lit(c[3])))
    waves = [tide.wave(part(c, F.cos), part(c, F.sin), F.lit(c[1]), F.col("days")) for c in CONSTITUENTS]
    h = waves[0]
    for w in waves[1:]:
        h = h + w
    return _days(spark, d).select("event_id", F.when(F.col("event_id") % 97 == 0, float("nan")).otherwise(F.round(h, 6)).alias("height"))


def _classes(spark: SparkSession, d: str) -> DataFrame:
    return classify.with_classes(materialize(_heights(spark, d), "heights"), "height")


def utc_days(spark: SparkSession, d: str) -> DataFrame:
    return _days(spark, d).select("event_id", "utc", F.round("days", 9).alias("days"))


def tide_height(spark: SparkSession, d: str) -> DataFrame:
    return _heights(spark, d).select("event_id", F.nanvl("height", F.lit(None).cast("double")).alias("height"))


def quantile_cuts(spark: SparkSession, d: str) -> DataFrame:
    cuts = classify.quantile_cuts(_read(spark, d, "orders"), "o_totalprice")
    return cuts.select(*(F.round(c, 6).alias(c) for c in cuts.columns))


def quantile_class(spark: SparkSession, d: str) -> DataFrame:
    return classify.with_classes(_read(spark, d, "orders"), "o_totalprice").select("o_orderkey", "o_totalprice", "tide_level_class")


def threshold_class(spark: SparkSession, d: str) -> DataFrame:
    h = F.round(F.col("c_acctbal") / 5000.0, 6)
    return _read(spark, d, "customer").select("c_custkey", classify.threshold_class(h).alias("tide_level_class_threshold"))


def tide_classes(spark: SparkSession, d: str) -> DataFrame:
    return _classes(spark, d).select("event_id", "tide_level_class", "tide_level_class_threshold")


def height_range(spark: SparkSession, d: str) -> DataFrame:
    return tide.summary(_heights(spark, d), "height")


def confusion_counts(spark: SparkSession, d: str) -> DataFrame:
    return agreement.confusion(_classes(spark, d))


def confusion_dense(spark: SparkSession, d: str) -> DataFrame:
    return agreement.dense(agreement.confusion(_classes(spark, d)))


def agreement_rate(spark: SparkSession, d: str) -> DataFrame:
    return agreement.rate(agreement.confusion(_classes(spark, d))).withColumn("rate", F.round("rate", 9))


def kappa_linear_quadratic(spark: SparkSession, d: str) -> DataFrame:
    return agreement.kappas(agreement.confusion(_classes(spark, d))).select(*(F.round(w, 9).alias(w) for w in agreement.WEIGHTS))


def abs_diff_hist(spark: SparkSession, d: str) -> DataFrame:
    return agreement.differences(agreement.confusion(_classes(spark, d)))


def mismatch_pairs(spark: SparkSession, d: str) -> DataFrame:
    return agreement.mismatch_pairs(agreement.confusion(_classes(spark, d)))


def mismatch_rows(spark: SparkSession, d: str) -> DataFrame:
    return agreement.mismatches(_classes(spark, d)).select("event_id", "class_rank_difference", "class_difference_abs")


def haversine(spark: SparkSession, d: str) -> DataFrame:
    lon, lat = F.col("c_custkey") % 360 - 180.0, F.col("c_custkey") % 171 - 85.0
    return _read(spark, d, "customer").select("c_custkey", F.round(geo.haversine_km(lon, lat, F.lit(120.25), F.lit(36.5)), 6).alias("km"))


def _scenes(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), (116.53 + (F.col("c_custkey") * 37 % 1103) / 100.0).alias("lon"), (32.51 + (F.col("c_custkey") * 53 % 997) / 100.0).alias("lat")
    )


def _grid(spark: SparkSession) -> DataFrame:
    """Cells with a row of every constituent, amplitudes and phases that vary smoothly, and gaps."""
    cells = spark.range(GRID["n_lon"] * GRID["n_lat"]).select((F.col("id") % GRID["n_lon"]).alias("lon_idx"), F.floor(F.col("id") / GRID["n_lon"]).alias("lat_idx"))
    cells = cells.withColumn("lon", GRID["lon0"] + GRID["step"] * F.col("lon_idx")).withColumn("lat", GRID["lat0"] + GRID["step"] * F.col("lat_idx"))
    names = F.explode(F.array(*(F.struct(F.lit(n).alias("constituent"), F.lit(a).alias("a"), F.lit(p).alias("p")) for n, _, a, p in CONSTITUENTS)))
    rows = cells.withColumn("c", names).select("*", "c.*")
    gap = (F.col("lat_idx") * 7 + F.col("lon_idx") * 5) % 6 == 0
    inland = (F.col("lon_idx") > 24) & (F.col("lat_idx") > 20)
    amplitude = F.when(gap | inland, float("nan")).otherwise(F.col("a") * (1 + F.col("lat_idx") / 100.0))
    return rows.select("constituent", "lat_idx", "lon_idx", "lat", "lon", amplitude.alias("amplitude"), (F.col("p") + F.col("lon_idx") * 9.0).alias("phase"))


def nearest_valid_cell(spark: SparkSession, d: str) -> DataFrame:
    out = tide.nearest_valid(_scenes(spark, d), tide.valid_cells(_grid(spark)))
    return out.select("id", "cell_lat_idx", "cell_lon_idx", F.round("km", 6).alias("km"))


def bilinear_sample(spark: SparkSession, d: str) -> DataFrame:
    out = tide.sample(_scenes(spark, d), _grid(spark), GRID["step"], GRID["lon0"], GRID["lat0"])
    return out.select("id", "constituent", F.round("re", 6).alias("re"), F.round("im", 6).alias("im"))


def fallback_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Every tenth scene stands there twice, and once more elsewhere under the same id."""
    once = _scenes(spark, d)
    again = once.where("id % 10 = 0")
    scenes = once.union(again).union(again.withColumn("lon", F.col("lon") - 0.5)).withColumn("days", 11_688.0 + F.col("id") / 24.0)
    out = tide.cascade(scenes, _grid(spark), _constituents(spark), GRID["step"], GRID["lon0"], GRID["lat0"])
    return out.select(
        "id", F.round("tide_ocean_m", 6).alias("tide_ocean_m"), "tide_interpolation", "tide_point_source", F.round("tide_point_distance_km", 6).alias("km"),
        F.round("tide_query_lon", 6).alias("tide_query_lon"), F.round("tide_query_lat", 6).alias("tide_query_lat"),
    )


def _constituents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, s) for n, s, *_ in CONSTITUENTS], "name string, speed_deg_per_hour double")


def scene_tide(spark: SparkSession, d: str) -> DataFrame:
    """Customers as scenes, each with a time of its own; some have no time, a blank one, or no centre."""
    k = F.col("id")
    text = F.date_format(F.timestamp_add("SECOND", k * 3601, F.lit("2024-01-01").cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss")
    info = _scenes(spark, d).select(
        F.concat(F.lit("s"), k.cast("string")).alias("file"),
        F.when(k % 11 == 0, None).when(k % 13 == 0, "  ").otherwise(text).alias("selected_time"),
        F.when(k % 17 != 0, F.col("lon")).alias("xml_center_lon"),
        F.col("lat").alias("xml_center_lat"),
    )
    out = assemble(info, _grid(spark), _constituents(spark), GRID["step"], GRID["lon0"], GRID["lat0"])
    double = [f.name for f in out.schema if f.dataType.simpleString() == "double"]
    return out.withColumns({c: F.round(c, 5) for c in double})


def equilibrium_arguments(spark: SparkSession, d: str) -> DataFrame:
    """Each event's time with the argument and nodal corrections of one constituent, simple or compound, in turn."""
    names = sorted([*astro.DOODSON, *astro.COMPOUND])
    known = F.broadcast(astro.table(spark, names).withColumn("k", F.array_position(F.array(*map(F.lit, names)), F.col("name")) - 1))
    met = _days(spark, d).withColumn("k", F.col("event_id") % len(names)).join(known, "k").withColumn("at", astro.doodson_longitudes(F.col("days")))
    v = F.radians(astro.argument(F.col("doodson"), F.col("phase"), F.col("at")))
    f, u = (part(F.col("nodal"), -F.col("at")[4]) for part in (astro.nodal_factor, astro.nodal_angle))
    return met.select("event_id", "name", *(F.round(c, 6).alias(n) for n, c in (("cos_v", F.cos(v)), ("sin_v", F.sin(v)), ("f", f), ("u", u))))


#: name, amplitude, phase of the grid from which minor constituents are inferred; M4 has none of its own.
SPECIES = [("Q1", 0.05, 80.0), ("O1", 0.25, 90.0), ("K1", 0.3, 110.0), ("N2", 0.2, 20.0), ("M2", 1.2, 30.0), ("K2", 0.14, 55.0), ("S2", 0.5, 60.0), ("M4", 0.1, 200.0)]


def minor_constituents(spark: SparkSession, d: str) -> DataFrame:
    """Customers as scenes: heights with equilibrium arguments, and with the minor constituents that admittance gives."""
    given = F.array(*(F.struct(F.lit(n).alias("constituent"), F.lit(a).alias("a"), F.lit(p).alias("p")) for n, a, p in SPECIES))
    cells = _grid(spark).where("constituent = 'M2'").select("lat_idx", "lon_idx", "lat", "lon", F.explode(given).alias("c"))
    amplitude, phase = F.col("c.a") * (1 + F.col("lat_idx") / 100.0), F.col("c.p") + F.col("lon_idx") * 9.0
    grid = cells.select("c.constituent", "lat_idx", "lon_idx", "lat", "lon", amplitude.alias("amplitude"), phase.alias("phase"))
    scenes = _scenes(spark, d).withColumn("days", 3000.0 + F.col("id") * 1.37)
    named = spark.createDataFrame([(n, astro.constituent(n).speed) for n, *_ in SPECIES], "name string, speed_deg_per_hour double")
    constants = tide.sample(scenes, grid, GRID["step"], GRID["lon0"], GRID["lat0"])
    without, with_ = (tide.predict(scenes, constants, named, arguments=True, minor=m).withColumnRenamed("height", n) for m, n in ((False, "major"), (True, "height")))
    return without.join(with_, "id").select("id", F.round("major", 5).alias("major"), F.round("height", 5).alias("height"))


def multi_format_time(spark: SparkSession, d: str) -> DataFrame:
    """Event times written in six layouts and read again."""
    t = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    shapes = ["yyyy-MM-dd HH:mm:ss", "yyyy/M/d H:m:s", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd'T'HH:mm:ss", "yyyyMMddHHmmss", "yyyy-MM-dd'T'HH:mm:ss'.000'"]
    text = F.get(F.array(*(F.date_format(t, s) for s in shapes)), (F.col("event_id") % len(shapes)).cast("int"))
    written = F.when(F.col("event_id") % 101 == 0, "no time").otherwise(F.concat(F.lit("  "), text, F.lit("\n")))
    return _read(spark, d, "events").select("event_id", timeops.parse_time(written).alias("parsed"))


def time_midpoint(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("s"), F.max("ts").alias("e"))
    return e.select("user_id", timeops.iso_text(timeops.midpoint(F.col("s"), F.col("e"))).alias("middle"))


def filename_fields(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.when(k % 9 == 0, F.concat(F.lit("GF2_"), k.cast("string"))).otherwise(
        F.concat(F.lit("dir/GF2_PMS1_E"), (100 + k % 40).cast("string"), F.lit(".5_N"), (20 + k % 30).cast("string"), F.lit(".25_202401"), F.lpad((k % 40).cast("string"), 2, "0"), F.lit("_L1A.tar.gz"))
    )
    return _read(spark, d, "part").select("p_partkey", *(c.alias(n) for n, c in scene.filename_fields(name).items()))


def _member(x: Column) -> Column:
    """A lineitem as a member with candidates made of its columns."""
    tag = F.get(F.array(*(F.lit(t) for t in ("starttime", "endtime", "centertime", "receivetime_end"))), (x["l_partkey"] % 4).cast("int"))
    time = F.struct(tag.alias("tag"), x["l_shipdate"].cast("timestamp_ntz").alias("parsed"), F.lit(None).cast("string").alias("tz"), F.lit("").alias("raw"))
    no_time, value = x["l_suppkey"] % 3 == 0, x["l_quantity"].cast("double")
    lon = F.struct(F.lit("centerlongitude").alias("tag"), value.alias("value"), F.lit("").alias("raw"))
    field = lambda axis, n: F.struct(F.lit(f"{n}{axis}").alias("tag"), value.cast("string").alias("value"))
    fields = F.when(x["l_partkey"] % 2 == 0, F.array(field("longitude", "center"))).otherwise(F.array(*(field("longitude", c) for c in scene.CORNERS)))
    return F.struct(
        F.concat_ws("/", *(x[c] for c in LINE[:4])).alias("name"),
        F.when(x["l_partkey"] % 5 == 0, F.concat(F.lit("bad "), x["l_linenumber"].cast("string"))).alias("parse_error"),
        F.when(no_time, F.array().cast("array<struct<tag:string,parsed:timestamp_ntz,tz:string,raw:string>>")).otherwise(F.array(time)).alias("times"),
        F.array(lon).alias("lons"), F.array().cast("array<struct<tag:string,value:double,raw:string>>").alias("lats"), fields.alias("fields"),
    )


#: What makes a member of a lineitem, and its place among the members of its order.
LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
#: Tasks that the lines of a split are dealt to: 128 MB of file hold some 10 million lines, which take 1 GB to sort.
LINE_TASKS = 8


def _members(spark: SparkSession, d: str) -> DataFrame:
    """Each order as an archive, each lineitem as a member.

    Only LINE is shuffled, as it stands, and sorted once; members, which are ten times as wide, are made of an order's lines where these have met.
    """
    by_order = Window.partitionBy("l_orderkey").orderBy(*LINE)
    whole = by_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = spread(_read(spark, d, "lineitem").select("l_orderkey", *LINE), "l_orderkey", by_split=LINE_TASKS)
    line = dealt.select("l_orderkey", F.collect_list(F.struct(*LINE)).over(whole).alias("xs"), F.row_number().over(by_order).alias("nth"))
    return line.where("nth = 1").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("file"),
        F.when(F.col("l_orderkey") % 13 == 0, "cut short").alias("open_error"),
        F.transform("xs", _member).alias("members"),
    )


def _elements(spark: SparkSession, d: str) -> DataFrame:
    """Each lineitem as an XML member with tags in a namespace, texts with blanks around them, and texts that say nothing."""
    k = F.col("l_partkey") % 7
    tag = F.get(F.array(*(F.lit(x) for x in ("{u:x}CenterTime", "StartTime", "{u}TopLeftLongitude", "CenterLatitude", "Receiver", "center_lon", "Center_Lat"))), k.cast("int"))
    time = F.date_format("l_shipdate", "yyyy/M/d H:m:s")
    text = F.when(F.col("l_suppkey") % 5 == 0, "none").when(k < 2, time).otherwise(F.col("l_quantity").cast("string"))
    element = F.struct(tag.alias("tag"), F.concat(F.lit(" \n"), text, F.lit("\t")).alias("text"))
    blank = F.struct(F.lit("starttime").alias("tag"), F.lit(" \n").alias("text"))
    return _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array(blank, element).alias("elements"))


def hint_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = _elements(spark, d).select("l_orderkey", "l_linenumber", scene.read_elements(F.col("elements")).alias("r"))
    first = lambda c: F.get(f"r.{c}", F.lit(0))
    return rows.select(
        "l_orderkey", "l_linenumber", F.size("r.fields").alias("n_fields"), F.get("r.fields", F.lit(0))["tag"].alias("tag"),
        first("times")["parsed"].alias("time"), first("lons")["value"].alias("lon"), first("lats")["value"].alias("lat"),
    )


def best_member(spark: SparkSession, d: str) -> DataFrame:
    best = scene.best_member(F.col("members"))
    return _members(spark, d).select("file", best.alias("b")).select("file", F.col("b.name").alias("name"), F.get("b.times", F.lit(0))["tag"].alias("tag"))


def choose_time(spark: SparkSession, d: str) -> DataFrame:
    """All candidates of an order, in order."""
    times = F.flatten(F.transform("members", lambda m: m["times"]))
    return _members(spark, d).select("file", scene.choose_time(times).alias("t")).select("file", "t.tag", timeops.iso_text(F.col("t.parsed")).alias("time"))


def choose_coordinate(spark: SparkSession, d: str) -> DataFrame:
    fields = F.flatten(F.transform("members", lambda m: m["fields"]))
    return _members(spark, d).select("file", scene.choose_coordinate(fields, "longitude", F.lit(None).cast("double")).alias("c")).select("file", "c.tag", "c.value", "c.source")


def scene_status(spark: SparkSession, d: str) -> DataFrame:
    return scene.scene_info(_members(spark, d)).select("file", "status", "message")


def status_summary(spark: SparkSession, d: str) -> DataFrame:
    return scene.status_counts(scene.scene_info(_members(spark, d)))


def not_null_filter(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("event_id") % 7 != 0, F.col("ts"))
    return not_null(_read(spark, d, "events").select("event_id", t.alias("selected_time"), F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value")), ["selected_time", "value"]).select("event_id")


_ALL = (
    utc_days, tide_height, quantile_cuts, quantile_class, threshold_class, tide_classes, height_range, confusion_counts, confusion_dense, agreement_rate,
    kappa_linear_quadratic, abs_diff_hist, mismatch_pairs, mismatch_rows, haversine, nearest_valid_cell, bilinear_sample, fallback_cascade, scene_tide,
    equilibrium_arguments, minor_constituents,
    multi_format_time, time_midpoint, filename_fields, hint_candidates, best_member, choose_time, choose_coordinate, scene_status, status_summary, not_null_filter,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL} | archive_queries.QUERIES

_WAVE = " + ".join(f"{a!r}::DOUBLE * cos(radians({s!r}::DOUBLE * 24 * days - {p!r}::DOUBLE))" for _, s, a, p in CONSTITUENTS)
_DAYS = f"days AS (SELECT event_id, ts - INTERVAL {OFFSET_HOURS} HOUR AS utc, date_diff('microsecond', TIMESTAMP '1992-01-01', ts - INTERVAL {OFFSET_HOURS} HOUR) / 86400e6 AS days FROM events)"
_HEIGHTS = f"{_DAYS}, heights AS (SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN round({_WAVE}, 6) END AS h FROM days)"
_QUANTILE = "CASE WHEN h IS NULL THEN '' WHEN h <= q[1] THEN '低潮' WHEN h <= q[2] THEN '中低潮' WHEN h <= q[3] THEN '中高潮' ELSE '高潮' END"
_FIXED = "CASE WHEN h IS NULL THEN '' WHEN h <= -1.0 THEN '低潮' WHEN h <= 0 THEN '中低潮' WHEN h < 0.6 THEN '中高潮' ELSE '高潮' END"
_CLASSES = f"""{_HEIGHTS}, cuts AS (SELECT quantile_cont(h, [0.25, 0.5, 0.75]) AS q FROM heights),
classes AS (SELECT event_id, {_QUANTILE} AS a, {_FIXED} AS b FROM heights, cuts),
ranked AS (SELECT *, list_position(['低潮', '中低潮', '中高潮', '高潮'], a) - 1 AS i, list_position(['低潮', '中低潮', '中高潮', '高潮'], b) - 1 AS j FROM classes WHERE a <> '' AND b <> ''),
counts AS (SELECT i, j, count(*) AS n FROM ranked GROUP BY i, j)"""
_SCENES = "scenes AS (SELECT c_custkey AS id, 116.53::DOUBLE + (c_custkey * 37 % 1103) / 100.0::DOUBLE AS s_lon, 32.51::DOUBLE + (c_custkey * 53 % 997) / 100.0::DOUBLE AS s_lat FROM customer)"
_KM = "2 * 6371.0088::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
_GRID = f"""grid AS (SELECT c.name AS constituent, y AS lat_idx, x AS lon_idx, 33 + 0.25::DOUBLE * y AS lat, 117 + 0.25::DOUBLE * x AS lon,
  c.a * (1 + y / 100.0::DOUBLE) AS amplitude, c.p + x * 9.0::DOUBLE AS phase, c.s AS speed
  FROM range({GRID["n_lon"]}) tx(x), range({GRID["n_lat"]}) ty(y), (VALUES {", ".join(f"('{n}', {s!r}::DOUBLE, {a!r}::DOUBLE, {p!r}::DOUBLE)" for n, s, a, p in CONSTITUENTS)}) c(name, s, a, p)
  WHERE NOT ((y * 7 + x * 5) % 6 = 0 OR x > 24 AND y > 20))"""
_NEAR = f"""met AS (SELECT id, lat_idx, lon_idx, lat, lon, {_KM.format(lon1="s_lon", lat1="s_lat", lon2="lon", lat2="lat")} AS km, greatest(abs(lat - s_lat), abs(lon - s_lon)) AS far
  FROM scenes JOIN grid ON constituent = 'M2' AND abs(lat - s_lat) <= 2 AND abs(lon - s_lon) <= 2),
near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE WHEN far <= 0.25 THEN 0 WHEN far <= 0.5 THEN 1 WHEN far <= 1 THEN 2 ELSE 3 END, km, lat_idx, lon_idx) AS r FROM met)"""
_LINEAR = """corners AS (SELECT id, (floor(x) + di)::BIGINT AS lon_idx, (floor(y) + dj)::BIGINT AS lat_idx,
  (CASE di WHEN 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) * (CASE dj WHEN 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) AS w
  FROM (SELECT id, (s_lon - 117) / 0.25::DOUBLE AS x, (s_lat - 33) / 0.25::DOUBLE AS y FROM scenes), range(2) a(di), range(2) b(dj)),
wanted AS (SELECT id, count(*) AS wanted FROM corners WHERE w > 0 GROUP BY id),
sampled AS (SELECT c.id, constituent, speed, sum(w * amplitude * cos(radians(phase))) AS re, sum(w * amplitude * sin(radians(phase))) AS im, count(*) AS n
  FROM corners c JOIN grid g ON c.lat_idx = g.lat_idx AND c.lon_idx = g.lon_idx WHERE w > 0 GROUP BY c.id, constituent, speed),
linear AS (SELECT s.* FROM sampled s JOIN wanted w ON s.id = w.id AND n = wanted)"""
_CASCADE = """h1 AS (SELECT l.id, sum(re * cos(radians(speed * 24 * days)) + im * sin(radians(speed * 24 * days))) AS h FROM linear l JOIN scenes s ON l.id = s.id GROUP BY l.id HAVING count(*) = 4),
h2 AS (SELECT id, sum(amplitude * cos(radians(speed * 24 * days - phase))) AS h FROM scenes JOIN grid ON lon_idx = floor((s_lon - 117) / 0.25::DOUBLE + 0.5::DOUBLE) AND lat_idx = floor((s_lat - 33) / 0.25::DOUBLE + 0.5::DOUBLE) GROUP BY id HAVING count(*) = 4),
h3 AS (SELECT near.id, max(km) AS km, max(near.lon) AS lon, max(near.lat) AS lat, sum(amplitude * cos(radians(speed * 24 * days - phase))) AS h
  FROM near JOIN scenes s ON near.id = s.id JOIN grid ON near.r = 1 AND near.lat_idx = grid.lat_idx AND near.lon_idx = grid.lon_idx GROUP BY near.id),
cascade AS (SELECT s.*, coalesce(h1.h, h2.h, h3.h) AS h, h1.h IS NOT NULL AS by_linear, h1.h IS NULL AND h2.h IS NULL AND h3.km IS NOT NULL AS moved, h3.km, h3.lon AS near_lon, h3.lat AS near_lat
  FROM scenes s LEFT JOIN h1 ON s.id = h1.id LEFT JOIN h2 ON s.id = h2.id LEFT JOIN h3 ON s.id = h3.id)"""
_CASCADED = """CASE WHEN by_linear THEN 'linear' WHEN moved THEN 'nearest_valid_grid' ELSE 'nearest' END AS tide_interpolation, CASE WHEN moved THEN 'nearest_valid_fes_grid' ELSE 'scene_center' END AS tide_point_source"""
_PLACES = """places AS (SELECT *, 11688.0::DOUBLE + id / 24.0::DOUBLE AS days FROM (SELECT c_custkey AS id, 0.0::DOUBLE AS shift FROM customer UNION ALL SELECT c_custkey, unnest([0.0::DOUBLE, 0.5::DOUBLE]) FROM customer WHERE c_custkey % 10 = 0)),
named AS (SELECT row_number() OVER () AS row, id AS name, days, 116.53::DOUBLE + (id * 37 % 1103) / 100.0::DOUBLE - shift AS s_lon, 32.51::DOUBLE + (id * 53 % 997) / 100.0::DOUBLE AS s_lat FROM places),
scenes AS (SELECT row AS id, name, days, s_lon, s_lat FROM named)"""
_TIMED = """scenes AS (SELECT *, date_diff('microsecond', TIMESTAMP '1992-01-01', local - INTERVAL 8 HOUR) / 86400e6 AS days FROM (
  SELECT c_custkey AS id, 116.53::DOUBLE + (c_custkey * 37 % 1103) / 100.0::DOUBLE AS s_lon, 32.51::DOUBLE + (c_custkey * 53 % 997) / 100.0::DOUBLE AS s_lat,
    TIMESTAMP '2024-01-01' + to_seconds(c_custkey * 3601) AS local FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0))"""
_MEMBERS = """m AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS k,
  ['starttime', 'endtime', 'centertime', 'receivetime_end'][l_partkey % 4 + 1] AS tag, l_suppkey % 3 <> 0 AS timed, l_partkey % 5 = 0 AS bad FROM lineitem)"""
_STATUS = f"""{_MEMBERS}, f AS (SELECT l_orderkey, min(k) FILTER (WHERE NOT bad) AS first_good, bool_or(timed AND NOT bad) AS timed FROM m GROUP BY l_orderkey),
e AS (SELECT f.l_orderkey, first_good, f.timed, arg_max(l_linenumber || '/' || l_partkey || '/' || l_suppkey || '/' || l_quantity || ': bad ' || l_linenumber, k) FILTER (WHERE bad AND (first_good IS NULL OR k < first_good)) AS stuck FROM m JOIN f ON m.l_orderkey = f.l_orderkey GROUP BY ALL),
s AS (SELECT 'o' || l_orderkey AS file,
  CASE WHEN l_orderkey % 13 = 0 THEN 'error' WHEN first_good IS NULL OR NOT timed OR stuck IS NOT NULL THEN 'warning' ELSE 'ok' END AS status,
  CASE WHEN l_orderkey % 13 = 0 THEN 'open_archive_failed: cut short' WHEN first_good IS NULL THEN 'xml_parse_failed: ' || stuck WHEN NOT timed THEN 'no_time_candidate' ELSE coalesce('xml_parse_failed: ' || stuck, '') END AS message FROM e)"""

#: Arguments as handbooks print them: multiples of T (15 degrees an hour), s, h, p, ps, and a constant.
_ARGUMENTS = {
    "SA": (0, 0, 1, 0, -1, 0), "SSA": (0, 0, 2, 0, 0, 0), "MM": (0, 1, 0, -1, 0, 0), "MSF": (0, 2, -2, 0, 0, 0), "MF": (0, 2, 0, 0, 0, 0), "MTM": (0, 3, 0, -1, 0, 0),
    "MSQM": (0, 4, -2, 0, 0, 0), "2Q1": (1, -4, 1, 2, 0, 270), "SIGMA1": (1, -4, 3, 0, 0, 270), "Q1": (1, -3, 1, 1, 0, 270), "RHO1": (1, -3, 3, -1, 0, 270),
    "O1": (1, -2, 1, 0, 0, 270), "CHI1": (1, -1, 3, -1, 0, 90), "PI1": (1, 0, -2, 0, 1, 270), "P1": (1, 0, -1, 0, 0, 270), "S1": (1, 0, 0, 0, 0, 180),
    "K1": (1, 0, 1, 0, 0, 90), "PHI1": (1, 0, 3, 0, 0, 90), "THETA1": (1, 1, -1, 1, 0, 90), "J1": (1, 1, 1, -1, 0, 90), "OO1": (1, 2, 1, 0, 0, 90),
    "EPS2": (2, -5, 4, 1, 0, 0), "2N2": (2, -4, 2, 2, 0, 0), "MU2": (2, -4, 4, 0, 0, 0), "N2": (2, -3, 2, 1, 0, 0), "NU2": (2, -3, 4, -1, 0, 0), "M2": (2, -2, 2, 0, 0, 0),
    "LAMBDA2": (2, -1, 0, 1, 0, 180), "L2": (2, -1, 2, -1, 0, 180), "T2": (2, 0, -1, 0, 1, 0), "S2": (2, 0, 0, 0, 0, 0), "R2": (2, 0, 1, 0, -1, 180), "K2": (2, 0, 2, 0, 0, 0),
    "ETA2": (2, 1, 2, -1, 0, 0), "M3": (3, -3, 3, 0, 0, 0), "MKS2": (2, -2, 4, 0, 0, 0), "2SM2": (2, 2, -2, 0, 0, 0), "MK3": (3, -2, 3, 0, 0, 90), "2MK3": (3, -4, 3, 0, 0, 270),
    "N4": (4, -6, 4, 2, 0, 0), "MN4": (4, -5, 4, 1, 0, 0), "M4": (4, -4, 4, 0, 0, 0), "MS4": (4, -2, 2, 0, 0, 0), "S4": (4, 0, 0, 0, 0, 0), "M6": (6, -6, 6, 0, 0, 0),
    "S6": (6, 0, 0, 0, 0, 0), "M8": (8, -8, 8, 0, 0, 0),
}
#: Of which constituents f is a product, for those that have any.
_FACTORS = {
    **{n: [n] for n in astro.NODAL}, **{n: ["O1"] for n in ("2Q1", "SIGMA1", "RHO1")}, "CHI1": ["J1"], "THETA1": ["J1"], **{n: ["M2"] for n in ("EPS2", "LAMBDA2", "L2", "MSF", "MS4")},
    "ETA2": ["K2"], "MTM": ["MF"], "MSQM": ["MF"], "MKS2": ["M2", "K2"], "MK3": ["M2", "K1"], "N4": ["N2", "N2"], "MN4": ["M2", "N2"], "M4": ["M2"] * 2, "M6": ["M2"] * 3, "M8": ["M2"] * 4,
}
_POLY = {n: " + ".join(f"({c!r})::DOUBLE * pow(t, {k})" for k, c in enumerate(terms)) for n, terms in astro.LONGITUDES.items()}
_LONGITUDES = f"""lon AS (SELECT *, 360 * (days - floor(days)) AS hour, {", ".join(f"{v} AS {k}" for k, v in _POLY.items())} FROM (SELECT *, (days - 2922.5::DOUBLE) / 36525.0::DOUBLE AS t FROM timed))"""
_f = lambda n: f"({astro.NODAL[n][0]!r} + {astro.NODAL[n][1]!r} * cos(radians(n)))::DOUBLE"
_u = lambda n: f"({astro.NODAL[n][2]!r})::DOUBLE * sin(radians(n))"
#: 2SM2 is S2 twice less M2, and 2MK3 is M2 twice less K1: factors multiply, angles subtract.
_F_OF = {n: " * ".join(map(_f, parts)) for n, parts in _FACTORS.items()} | {"2SM2": _f("M2"), "2MK3": f"{_f('M2')} * {_f('M2')} * {_f('K1')}"}
_U_OF = {n: " + ".join(map(_u, parts)) for n, parts in _FACTORS.items()} | {"2SM2": f"-{_u('M2')}", "2MK3": f"2 * {_u('M2')} - {_u('K1')}"}
_CASE = lambda values, other: "CASE name " + " ".join(f"WHEN '{n}' THEN {v}" for n, v in values.items()) + f" ELSE {other} END"
_V = _CASE({n: " + ".join(f"{m} * {x}" for m, x in zip(a, ("hour", "s", "h", "p", "ps", "1"), strict=True) if m) for n, a in _ARGUMENTS.items()}, "0")
_RATE = {k: v[1] / (astro.CENTURY * 24) for k, v in astro.LONGITUDES.items()}
_SPEED = {n: 15 * a[0] + sum(m * _RATE[k] for m, k in zip(a[1:5], ("s", "h", "p", "ps"), strict=True)) for n, a in _ARGUMENTS.items()}


def _minor_sql() -> str:
    """name, known and weight of what the constituents of SPECIES give, by interpolation in speed."""
    rows = [(n, n, 1.0) for n, *_ in SPECIES]
    for knots, lines in ((("Q1", "O1", "K1"), astro.POTENTIAL[1]), (("N2", "M2", "K2"), astro.POTENTIAL[2])):
        for name in sorted(set(lines) - {n for n, *_ in SPECIES}):
            x = [_SPEED[k] for k in knots]
            at = min(max(_SPEED[name], x[0]), x[2])
            i = 0 if at <= x[1] else 1
            part = (at - x[i]) / (x[i + 1] - x[i])
            rows += [(name, knots[i], (1 - part) * lines[name] / lines[knots[i]]), (name, knots[i + 1], part * lines[name] / lines[knots[i + 1]])]
    return ", ".join(f"('{n}', '{k}', {w!r}::DOUBLE)" for n, k, w in rows)


ORACLE_SQL: dict[str, str] = {
    "utc_days": f"WITH {_DAYS} SELECT event_id, utc, round(days, 9) AS days FROM days",
    "tide_height": f"WITH {_HEIGHTS} SELECT event_id, h AS height FROM heights",
    "quantile_cuts": "SELECT round(q[1], 6) AS q25, round(q[2], 6) AS q50, round(q[3], 6) AS q75 FROM (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders)",
    "quantile_class": f"WITH cuts AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders) SELECT o_orderkey, o_totalprice, {_QUANTILE.replace('h ', 'o_totalprice ')} AS tide_level_class FROM orders, cuts",
    "threshold_class": f"SELECT c_custkey, {_FIXED} AS tide_level_class_threshold FROM (SELECT c_custkey, round(c_acctbal / 5000, 6) AS h FROM customer)",
    "tide_classes": f"WITH {_CLASSES} SELECT event_id, a AS tide_level_class, b AS tide_level_class_threshold FROM classes",
    "height_range": f"WITH {_HEIGHTS} SELECT count(h) AS n_valid, count(*) - count(h) AS n_missing, min(h) AS least, max(h) AS most FROM heights",
    "confusion_counts": f"WITH {_CLASSES} SELECT i::BIGINT AS left_rank, j::BIGINT AS right_rank, n FROM counts",
    "confusion_dense": f"WITH {_CLASSES} SELECT a.r AS left_rank, b.r AS right_rank, coalesce(n, 0) AS n FROM range(4) a(r) CROSS JOIN range(4) b(r) LEFT JOIN counts ON a.r = i AND b.r = j",
    "agreement_rate": f"WITH {_CLASSES} SELECT count(*) AS rows, count(*) FILTER (WHERE a = b) AS agreement, round(avg((a = b)::INT), 9) AS rate FROM ranked",
    "kappa_linear_quadratic": f"""WITH {_CLASSES}, t AS (SELECT sum(n)::DOUBLE AS t FROM counts), l AS (SELECT i, sum(n)::DOUBLE AS l FROM counts GROUP BY i), r AS (SELECT j, sum(n)::DOUBLE AS r FROM counts GROUP BY j),
c AS (SELECT abs(l.i - r.j) / 3.0::DOUBLE AS w, coalesce(n, 0) AS n, l * r / t AS e FROM l CROSS JOIN r CROSS JOIN t LEFT JOIN counts ON counts.i = l.i AND counts.j = r.j)
SELECT round(1 - sum(w * n) / nullif(sum(w * e), 0), 9) AS linear, round(1 - sum(w * w * n) / nullif(sum(w * w * e), 0), 9) AS quadratic FROM c""",
    "abs_diff_hist": f"WITH {_CLASSES} SELECT abs(i - j)::BIGINT AS difference, sum(n)::BIGINT AS n FROM counts GROUP BY 1",
    "mismatch_pairs": f"WITH {_CLASSES} SELECT a AS left, b AS right, count(*) AS n FROM ranked WHERE a <> b GROUP BY a, b",
    "mismatch_rows": f"WITH {_CLASSES} SELECT event_id, (i - j)::BIGINT AS class_rank_difference, abs(i - j)::BIGINT AS class_difference_abs FROM ranked WHERE a <> b",
    "haversine": f"SELECT c_custkey, round({_KM.format(lon1='(c_custkey % 360 - 180.0::DOUBLE)', lat1='(c_custkey % 171 - 85.0::DOUBLE)', lon2='120.25::DOUBLE', lat2='36.5::DOUBLE')}, 6) AS km FROM customer",
    "nearest_valid_cell": f"WITH {_SCENES}, {_GRID}, {_NEAR} SELECT id, lat_idx AS cell_lat_idx, lon_idx AS cell_lon_idx, round(km, 6) AS km FROM near WHERE r = 1",
    "bilinear_sample": f"WITH {_SCENES}, {_GRID}, {_LINEAR} SELECT id, constituent, round(re, 6) AS re, round(im, 6) AS im FROM linear",
    "fallback_cascade": f"""WITH {_PLACES}, {_GRID}, {_LINEAR}, {_NEAR}, {_CASCADE}
SELECT name AS id, round(h, 6) AS tide_ocean_m, {_CASCADED}, round(CASE WHEN moved THEN km ELSE 0 END, 6) AS km,
  round(CASE WHEN moved THEN near_lon ELSE s_lon END, 6) AS tide_query_lon, round(CASE WHEN moved THEN near_lat ELSE s_lat END, 6) AS tide_query_lat FROM cascade""",
    "scene_tide": f"""WITH {_TIMED}, {_GRID}, {_LINEAR}, {_NEAR}, {_CASCADE}, cuts AS (SELECT quantile_cont(h, [0.25, 0.5, 0.75]) AS q FROM cascade)
SELECT 's' || id AS file, strftime(local, '%Y-%m-%d %H:%M:%S') AS selected_time, round(s_lon, 5) AS xml_center_lon, round(s_lat, 5) AS xml_center_lat,
  strftime(local, '%Y-%m-%d %H:%M:%S') AS selected_time_local, strftime(local - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS selected_time_utc,
  8.0::DOUBLE AS time_offset_hours_applied, 'FES2022_extrapolated' AS tide_model, {_CASCADED},
  round(CASE WHEN moved THEN near_lon ELSE s_lon END, 5) AS tide_query_lon, round(CASE WHEN moved THEN near_lat ELSE s_lat END, 5) AS tide_query_lat,
  round(CASE WHEN moved THEN km ELSE 0 END, 5) AS tide_point_distance_km, round(h, 5) AS tide_ocean_m,
  {_QUANTILE} AS tide_level_class, {_FIXED} AS tide_level_class_threshold, round(q[1], 5) AS tide_q25_m, round(q[2], 5) AS tide_q50_m, round(q[3], 5) AS tide_q75_m
FROM cascade, cuts""",
    "equilibrium_arguments": f"""WITH {_DAYS}, timed AS (SELECT event_id, days, [{", ".join(f"'{n}'" for n in sorted(_ARGUMENTS))}][event_id % {len(_ARGUMENTS)} + 1] AS name FROM days), {_LONGITUDES},
v AS (SELECT event_id, name, radians({_V}) AS v, {_CASE(_F_OF, "1.0::DOUBLE")} AS f, {_CASE(_U_OF, "0.0::DOUBLE")} AS u FROM lon)
SELECT event_id, name, round(cos(v), 6) AS cos_v, round(sin(v), 6) AS sin_v, round(f, 6) AS f, round(u, 6) AS u FROM v""",
    "minor_constituents": f"""WITH {_SCENES}, {_GRID.split("FROM range")[0].replace("c.s AS speed", "0 AS speed")}
  FROM range({GRID["n_lon"]}) tx(x), range({GRID["n_lat"]}) ty(y), (VALUES {", ".join(f"('{n}', {a!r}::DOUBLE, {p!r}::DOUBLE)" for n, a, p in SPECIES)}) c(name, a, p)),
{_LINEAR}, timed AS (SELECT DISTINCT l.id, 3000.0::DOUBLE + l.id * 1.37::DOUBLE AS days FROM linear l), {_LONGITUDES},
gives(name, known, weight) AS (VALUES {_minor_sql()}),
v AS (SELECT g.*, l.id, re, im, {_CASE(_F_OF, "1.0::DOUBLE")} AS f, radians({_V} + {_CASE(_U_OF, "0.0::DOUBLE")}) AS a FROM (SELECT id, constituent, re, im FROM linear) l JOIN lon ON lon.id = l.id JOIN gives g ON g.known = l.constituent)
SELECT id, round(sum(weight * f * (re * cos(a) + im * sin(a))) FILTER (WHERE name = known), 5) AS major, round(sum(weight * f * (re * cos(a) + im * sin(a))), 5) AS height
FROM v GROUP BY id HAVING count(*) FILTER (WHERE name = known) = {len(SPECIES)}""",
    "hint_candidates": """WITH t AS (SELECT *, l_partkey % 7 AS k, l_suppkey % 5 = 0 AS none FROM lineitem)
SELECT l_orderkey, l_linenumber, 1 AS n_fields, ['centertime', 'starttime', 'topleftlongitude', 'centerlatitude', 'receiver', 'center_lon', 'center_lat'][k + 1] AS tag,
  CASE WHEN k < 2 AND NOT none THEN l_shipdate END AS time, CASE WHEN k IN (2, 5) AND NOT none THEN l_quantity END AS lon, CASE WHEN k IN (3, 6) AND NOT none THEN l_quantity END AS lat FROM t""",
    "multi_format_time": "SELECT event_id, CASE WHEN event_id % 101 <> 0 THEN date_trunc('second', ts) END AS parsed FROM events",
    "time_midpoint": """SELECT user_id, strftime(m, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us(m) % 1000000 = 0 THEN '' ELSE strftime(m, '.%f') END AS middle
FROM (SELECT user_id, make_timestamp(epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2 + ((epoch_us(max(ts)) - epoch_us(min(ts))) % 4 = 3)::INT) AS m FROM events GROUP BY user_id)""",
    "filename_fields": """SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN 100.5::DOUBLE + p_partkey % 40 END AS filename_center_lon, CASE WHEN p_partkey % 9 <> 0 THEN 20.25::DOUBLE + p_partkey % 30 END AS filename_center_lat,
  CASE WHEN p_partkey % 9 <> 0 THEN '2024-01-' || lpad((p_partkey % 40)::VARCHAR, 2, '0') END AS filename_date FROM part""",
    "best_member": f"""WITH {_MEMBERS}, g AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY timed DESC, k) AS r FROM m WHERE NOT bad)
SELECT 'o' || o.l_orderkey AS file, l_linenumber || '/' || l_partkey || '/' || l_suppkey || '/' || l_quantity AS name, CASE WHEN timed THEN tag END AS tag FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN g ON o.l_orderkey = g.l_orderkey AND r = 1""",
    "choose_time": f"""WITH {_MEMBERS}, g AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE tag WHEN 'centertime' THEN 0 WHEN 'starttime' THEN 1 ELSE 2 END, k) AS r FROM m WHERE timed)
SELECT 'o' || o.l_orderkey AS file, tag, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN g ON o.l_orderkey = g.l_orderkey AND r = 1""",
    "choose_coordinate": f"""WITH {_MEMBERS}, g AS (SELECT l_orderkey, arg_max(l_quantity, k) FILTER (WHERE l_partkey % 2 = 0) AS centre, arg_max(l_quantity, k) FILTER (WHERE l_partkey % 2 = 1) AS corner FROM m GROUP BY l_orderkey)
SELECT 'o' || l_orderkey AS file, CASE WHEN centre IS NOT NULL THEN 'centerlongitude' ELSE 'corner_average_longitude' END AS tag, coalesce(centre, corner)::DOUBLE AS value, CASE WHEN centre IS NOT NULL THEN 'xml_center' ELSE 'xml_corner_average' END AS source FROM g""",
    "scene_status": f"WITH {_STATUS} SELECT file, status, message FROM s",
    "status_summary": f"WITH {_STATUS} SELECT count(*) FILTER (WHERE status = 'ok') AS n_ok, count(*) FILTER (WHERE status = 'warning') AS n_warning, count(*) FILTER (WHERE status = 'error') AS n_error FROM s",
    "not_null_filter": "SELECT event_id FROM events WHERE event_id % 7 <> 0 AND event_id % 5 <> 0 AND value IS NOT NULL",
}

ORACLE_SQL |= archive_queries.ORACLE_SQL
ORACLE_SQL["tiled_cascade"] = f"""WITH {_SCENES.replace("SELECT c_custkey AS id,", "SELECT c_custkey AS id, 11688.0::DOUBLE + c_custkey / 24.0::DOUBLE AS days,")}, {_GRID}, {_LINEAR}, {_NEAR}, {_CASCADE}
SELECT id, round(h, 6) AS tide_ocean_m, CASE WHEN by_linear THEN 'linear' WHEN moved THEN 'nearest_valid_grid' ELSE 'nearest' END AS tide_interpolation, round(CASE WHEN moved THEN km ELSE 0 END, 6) AS km FROM cascade"""
