"""Astronomical tide heights from a grid of harmonic constants.

``grid``: constituent, lat_idx, lon_idx, lat, lon, amplitude, phase (degrees), one row a constituent and cell.
``constituents``: name, speed_deg_per_hour, and optionally argument_deg, the phase at the epoch; they are few and broadcast.
Heights are ``sum(f * amplitude * cos(speed * t + argument + u - phase))``; f and u are 1 and 0 unless nodal corrections
are asked for. With ``arguments`` the angle is the equilibrium argument of ``functions.astro`` instead, which holds over
centuries and knows compound constituents, and f and u are theirs; ``minor`` adds the constituents that the grid hasn't, inferred
from those it has. Interpolation is on ``amplitude * cos(phase)`` and ``amplitude * sin(phase)``, as phases wrap at 360 degrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saltmarsh.functions import astro
from saltmarsh.functions.astro import NODAL
from saltmarsh.functions.classify import finite
from saltmarsh.functions.geo import haversine_km
from saltmarsh.functions.timeops import let
from saltmarsh.sources.grid import TILE_COLUMN, only_tiles, tile_name, tile_of
from saltmarsh.sources.tables import materialize

BOXES = (0.25, 0.5, 1.0)
LEAST_AMPLITUDE = 0.001
#: Coordinates beyond this aren't on any grid.
FAR = 1e6
#: N at the start of 1992 and its motion a day, in degrees.
NODE_AT_EPOCH, NODE_A_DAY = 279.802, -0.0529538


def valid_cells(grid: DataFrame, constituent: str = "M2") -> DataFrame:
    fit = finite(F.col("amplitude")) & finite(F.col("phase")) & (F.col("amplitude") > LEAST_AMPLITUDE)
    return grid.where((F.col("constituent") == constituent) & fit).select("lat_idx", "lon_idx", "lat", "lon")


def on_earth(lon: Column, lat: Column) -> Column:
    return finite(lon) & finite(lat) & (F.abs(lon) < FAR) & (F.abs(lat) < FAR)


#: Up to this many tiles of the pyramid (five numbers each) are broadcast; more are joined by shuffle.
BROADCAST_TILES = 200_000


def _tile(level: Column, size: Column, lat: Column, lon: Column) -> Column:
    return F.struct(level.alias("level"), F.floor(lat / size).alias("y"), F.floor(lon / size).alias("x"))


def _levels(sizes: list[float]) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("level"), F.lit(float(s)).alias("size")) for k, s in enumerate(sizes)))


def _around(level: Column, lat: Column, lon: Column) -> Column:
    """The tiles of a level that the box of its size around a place meets: three by three."""
    size = level["size"]
    span = lambda c: F.sequence(F.floor((c - size) / size), F.floor((c + size) / size))
    return F.flatten(F.transform(span(lat), lambda y: F.transform(span(lon), lambda x: F.struct(level["level"].alias("level"), y.alias("y"), x.alias("x")))))


def pyramid(cells: DataFrame, sizes: list[float]) -> DataFrame:
    """tile (level, y, x) of every level whose tiles are as wide as ``sizes`` that holds a cell, and the bounds of its cells."""
    level = F.explode(F.transform(_levels(sizes), lambda s: _tile(s["level"], s["size"], F.col("lat"), F.col("lon")))).alias("tile")
    bounds = [f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for n, f in (("least", F.min), ("most", F.max))]
    return cells.select("lat", "lon", level).groupBy("tile").agg(*bounds)


def nearest_valid(scenes: DataFrame, cells: DataFrame, max_degrees: float = 2.0, id_col: str = "id") -> DataFrame:
    """id, cell_lat_idx, cell_lon_idx, cell_lon, cell_lat, km: the nearest cell of the smallest box that holds one.

    Boxes of BOXES and max_degrees are tried in turn, so radii under 1 degree don't limit the search. Ties go to the first
    row, then column. Scenes look their boxes up in a pyramid of occupied tiles, nine to a level: a tile whose cells all lie in the
    box shows that the box holds one, so the search need go no further, and a box that meets no occupied tile holds
    none. Then cells are joined once, by tiles of the level found, with that box as residual condition; where smaller boxes
    only may hold a cell, the cells say which one does, as the box comes before the distance in their order. ``min_by``
    combines before the shuffle. Scenes without any cell are left out, and scenes that share an id are one scene only if they share the place. Longitudes
    don't wrap.
    """
    sizes = [*BOXES, *([max_degrees] if max_degrees > BOXES[-1] else [])]
    lon, lat = F.col("s_lon"), F.col("s_lat")
    s = scenes.select(F.col(id_col).alias("id"), F.col("lon").alias("s_lon"), F.col("lat").alias("s_lat")).where(on_earth(lon, lat)).distinct()
    s = s.withColumn("row", F.struct("id", "s_lon", "s_lat"))
    tiles = materialize(pyramid(cells, sizes), "pyramid")
    known = F.broadcast(tiles) if tiles.count() <= BROADCAST_TILES else tiles
    met = s.withColumn("level", F.explode(_levels(sizes))).withColumn("tile", F.explode(_around(F.col("level"), lat, lon))).join(known, "tile")
    size = F.col("level.size")
    sure = F.lit(True)
    for c, at in (("lat", lat), ("lon", lon)):
        sure = sure & (F.abs(F.col(f"least_{c}") - at) <= size) & (F.abs(F.col(f"most_{c}") - at) <= size)
    # the level at which the search ends: the first sure one, else the last that may hold a cell
    ends = met.groupBy("row").agg(F.coalesce(F.min(F.when(sure, F.col("level"))), F.max("level")).alias("level"))
    opened = ends.select("row", size.alias("size"), F.explode(_around(F.col("level"), F.col("row.s_lat"), F.col("row.s_lon"))).alias("tile"))
    tiled = cells.select("*", F.explode(F.transform(_levels(sizes), lambda v: _tile(v["level"], v["size"], F.col("lat"), F.col("lon")))).alias("tile"))
    lon, lat = F.col("row.s_lon"), F.col("row.s_lat")
    far = F.greatest(F.abs(F.col("lat") - lat), F.abs(F.col("lon") - lon))
    box = F.array_min(F.filter(_levels(sizes), lambda v: far <= v["size"]))["level"]
    km = haversine_km(lon, lat, F.col("lon"), F.col("lat"))
    index = [F.col(c).cast("long").alias(c) for c in ("lat_idx", "lon_idx")]
    found = opened.join(tiled, "tile").where(far <= F.col("size")).select("row", F.struct(box.alias("box"), km.alias("km"), *index).alias("by"), "lon", "lat")
    best = found.groupBy("row").agg(F.min_by(F.struct("by", "lon", "lat"), "by").alias("best"))
    names = {"by.lat_idx": "cell_lat_idx", "by.lon_idx": "cell_lon_idx", "lon": "cell_lon", "lat": "cell_lat", "by.km": "km"}
    return best.select(F.col("row.id").alias(id_col), *(F.col(f"best.{k}").alias(v) for k, v in names.items()))


def wave(re: Column, im: Column, speed: Column, days: Column, argument: Column | float = 0.0, constituent: Column | None = None) -> Column:
    """Height of one constituent, from ``amplitude * cos(phase)`` and ``amplitude * sin(phase)``.

    With the constituent's name, nodal corrections apply; those not in NODAL have none.
    """
    angle = speed * 24 * days + argument
    if constituent is None:
        return re * F.cos(F.radians(angle)) + im * F.sin(F.radians(angle))
    node = F.radians(NODE_AT_EPOCH + NODE_A_DAY * days)
    table = F.create_map(*(x for k, v in NODAL.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    known = F.coalesce(F.try_element_at(table, F.upper(constituent)), F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)))
    f = F.get(known, F.lit(0)) + F.get(known, F.lit(1)) * F.cos(node)
    moved = F.radians(angle + F.get(known, F.lit(2)) * F.sin(node))
    return f * (re * F.cos(moved) + im * F.sin(moved))


def astronomical_wave(re: Column, im: Column, days: Column, targets: Column) -> Column:
    """Height of a constituent and of what is inferred from it, from its constants and ``_targets``."""

    def at(longitude: Column) -> Column:
        n = -longitude[4]

        def add(total: Column, c: Column) -> Column:
            angle = F.radians(astro.argument(c["doodson"], c["phase"], longitude) + astro.nodal_angle(c["nodal"], n))
            turned = let(angle, lambda a: re * F.cos(a) + im * F.sin(a))
            return total + c["coefficient"] * astro.nodal_factor(c["nodal"], n) * turned

        return F.aggregate(targets, F.lit(0.0), add)

    return let(astro.doodson_longitudes(days), at)


def _targets(constituents: DataFrame, minor: bool) -> DataFrame:
    """constituent, targets (itself, and with ``minor`` what is inferred from it) and n_all, the number of constituents; some dozens of rows."""
    names = [r[0] for r in constituents.select("name").distinct().collect()]
    given = astro.inferred(names) if minor else [(n, n, 1.0) for n in names]
    known = astro.rows([name for _, name, _ in given])
    rows = [(k, [(coefficient, *known[n][1:]) for c, n, coefficient in given if c == k], len(names)) for k in names]
    target = f"struct<coefficient: double, doodson: array<int>, phase: double, nodal: {astro.NODAL_TYPE}>"
    return F.broadcast(constituents.sparkSession.createDataFrame(rows, f"constituent string, targets array<{target}>, n_all long"))


def _constants(grid: DataFrame) -> DataFrame:
    return grid.where(finite(F.col("amplitude")) & finite(F.col("phase"))).select(
        "constituent",
        F.col("lat_idx").cast("long").alias("lat_idx"),
        F.col("lon_idx").cast("long").alias("lon_idx"),
        (F.col("amplitude") * F.cos(F.radians("phase"))).alias("re"),
        (F.col("amplitude") * F.sin(F.radians("phase"))).alias("im"),
    )


def _corners(x: Column, y: Column) -> Column:
    """The cells around a place in grid steps: w, the linear weight, and near, whether it is the nearest."""
    i, j = F.floor(x), F.floor(y)
    u, v = x - i, y - j
    corner = lambda di, dj: F.struct(
        (i + di).cast("long").alias("lon_idx"),
        (j + dj).cast("long").alias("lat_idx"),
        ((u if di else 1 - u) * (v if dj else 1 - v)).alias("w"),
        ((i + di == F.floor(x + 0.5)) & (j + dj == F.floor(y + 0.5))).alias("near"),
    )
    return F.array(*(corner(di, dj) for di in (0, 1) for dj in (0, 1)))


def touched(grid: DataFrame, places: DataFrame, reach: float, step: float, lon0: float, lat0: float) -> DataFrame:
    """The part of a tiled grid (``sources.grid``) that lies within ``reach`` degrees of a place; any other grid as it is.

    Places say which tiles they touch; there are no more of these than the grid has, and the grid's reader opens their partitions alone.
    """
    if TILE_COLUMN not in grid.columns:
        return grid
    span = lambda c, first: F.sequence(*(tile_of(F.floor((c + side * reach - first) / step)) for side in (-1, 1)))
    near = places.where(on_earth(F.col("lon"), F.col("lat"))).select(F.explode(span(F.col("lat"), lat0)).alias("y"), F.col("lon")).distinct()
    tiles = near.select(F.explode(span(F.col("lon"), lon0)).alias("x"), "y").distinct().select(tile_name(F.col("y"), F.col("x")).alias(TILE_COLUMN))
    return only_tiles(grid, tiles)


def sample(scenes: DataFrame, grid: DataFrame, step: float, lon0: float, lat0: float, linear: bool = True, id_col: str = "id") -> DataFrame:
    """id, constituent, re, im: harmonic constants at each scene of a regular grid, without extrapolation.

    Linear sampling needs every corner of positive weight, or gives no row. Scenes carry their corners to an
    equi-join on cell indexes. Rows that share an id are one scene: ids are keys here.
    """
    x, y = (F.col("lon") - lon0) / step, (F.col("lat") - lat0) / step
    corners = F.filter(_corners(x, y), (lambda c: c["w"] > 0) if linear else (lambda c: c["near"]))
    weight = F.col("c.w") if linear else F.lit(1.0)
    s = scenes.where(on_earth(F.col("lon"), F.col("lat"))).select(F.col(id_col).alias("id"), "lon", "lat").distinct()
    s = s.select("id", F.size(corners).alias("wanted"), F.explode(corners).alias("c")).select("id", "wanted", "c.lat_idx", "c.lon_idx", weight.alias("w"))
    near = touched(grid, scenes, step, step, lon0, lat0)
    met = s.join(_constants(near), ["lat_idx", "lon_idx"]).groupBy("id", "constituent").agg(
        F.sum(F.col("w") * F.col("re")).alias("re"), F.sum(F.col("w") * F.col("im")).alias("im"), F.count(F.lit(1)).alias("n"), F.max("wanted").alias("wanted")
    )
    return met.where("n = wanted").select(F.col("id").alias(id_col), "constituent", "re", "im")


def _speeds(constituents: DataFrame) -> DataFrame:
    """The constituents with their number; a window over one partition, as they are some dozens."""
    argument = F.col("argument_deg") if "argument_deg" in constituents.columns else F.lit(0.0)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return F.broadcast(constituents.select(F.col("name").alias("constituent"), F.col("speed_deg_per_hour").alias("speed"), argument.alias("argument"), n.alias("n_all")))


def _waves(constituents: DataFrame, days: Column, nodal: bool, arguments: bool, minor: bool) -> tuple[DataFrame, Column]:
    """What constants are joined to by constituent, and the height that each such row gives."""
    re, im = F.col("re"), F.col("im")
    if arguments or minor:
        return _targets(constituents, minor), astronomical_wave(re, im, days, F.col("targets"))
    return _speeds(constituents), wave(re, im, F.col("speed"), days, F.col("argument"), F.col("constituent") if nodal else None)


def predict(
    scenes: DataFrame, constants: DataFrame, constituents: DataFrame, id_col: str = "id", nodal: bool = False, arguments: bool = False, minor: bool = False
) -> DataFrame:
    """id, height, from scenes (id, days since the epoch) and sampled constants; null unless all constituents are there."""
    waves, h = _waves(constituents, F.col("days"), nodal, arguments, minor)
    met = constants.join(waves, "constituent").join(scenes.select(id_col, "days").distinct(), id_col)
    return met.groupBy(id_col).agg(F.when(F.count(F.lit(1)) == F.max("n_all"), F.sum(h)).alias("height"))


#: What ``cascade`` adds.
CASCADE = ("tide_ocean_m", "tide_interpolation", "tide_query_lon", "tide_query_lat", "tide_point_source", "tide_point_distance_km")


def cascade(
    scenes: DataFrame,
    grid: DataFrame,
    constituents: DataFrame,
    step: float,
    lon0: float,
    lat0: float,
    max_degrees: float = 2.0,
    nodal: bool = False,
    arguments: bool = False,
    minor: bool = False,
) -> DataFrame:
    """Scenes (lon, lat, days and any other columns) with CASCADE; columns of those names give way.

    Linear first, then the nearest cell, then the nearest valid cell, each for the scenes left without a height. Heights
    are made once for each distinct (lon, lat, days), whatever ids the scenes have or share, so repeated rows have one
    height. One pass over the grid serves linear and nearest; its result is stored, as the scenes it leaves are sought in
    it. A scene that no step resolves, such as one with a null or non-finite coordinate, is marked nearest, at its own
    centre, with null height.
    """
    kept = [c for c in scenes.columns if c not in CASCADE]
    place = F.struct("lon", "lat", "days").alias("place")
    every = scenes.select(F.struct(*kept).alias("scene"), place)
    at = lambda c: F.col("place").getField(c)
    places = every.select("place").distinct().where(on_earth(at("lon"), at("lat")))
    corners = F.filter(_corners((at("lon") - lon0) / step, (at("lat") - lat0) / step), lambda c: (c["w"] > 0) | c["near"])
    open_ = places.select("place", F.size(F.filter(corners, lambda c: c["w"] > 0)).alias("wanted"), F.explode(corners).alias("c")).select("place", "wanted", "c.*")
    known = _constants(touched(grid, scenes, step, step, lon0, lat0))
    waves, h = _waves(constituents, at("days"), nodal, arguments, minor)
    weighs = F.col("w") > 0
    both = open_.join(known, ["lat_idx", "lon_idx"]).join(waves, "constituent").groupBy("place").agg(
        F.when(F.count_if(weighs) == F.max(F.col("wanted") * F.col("n_all")), F.sum(F.when(weighs, F.col("w") * h))).alias("h1"),
        F.when(F.count_if(F.col("near")) == F.max("n_all"), F.sum(F.when(F.col("near"), h))).alias("h2"),
    )
    tried = materialize(places.join(both, "place", "left"), "heights")
    rest = tried.where("h1 IS NULL AND h2 IS NULL").select("place", "place.lon", "place.lat")
    wide = touched(grid, rest, max(BOXES[-1], max_degrees) + step, step, lon0, lat0)
    near = nearest_valid(rest, valid_cells(wide), max_degrees, "place")
    moved = near.select("place", "km", F.col("cell_lon").alias("near_lon"), F.col("cell_lat").alias("near_lat"), F.col("cell_lat_idx").alias("lat_idx"), F.col("cell_lon_idx").alias("lon_idx"))
    met = moved.join(_constants(wide), ["lat_idx", "lon_idx"], "left").join(waves, "constituent", "left")
    third = met.groupBy("place", "km", "near_lon", "near_lat").agg(F.when(F.count("n_all") == F.max("n_all"), F.sum(h)).alias("h3"))
    found = F.col("near_lon").isNotNull()
    return (
        every.join(tried, "place", "left")
        .join(third, "place", "left")
        .select(
            "scene.*",
            F.coalesce("h1", "h2", "h3").alias("tide_ocean_m"),
            F.when(F.col("h1").isNotNull(), "linear").when(found, "nearest_valid_grid").otherwise("nearest").alias("tide_interpolation"),
            F.coalesce("near_lon", at("lon")).alias("tide_query_lon"),
            F.coalesce("near_lat", at("lat")).alias("tide_query_lat"),
            F.when(found, "nearest_valid_fes_grid").otherwise("scene_center").alias("tide_point_source"),
            F.coalesce("km", F.lit(0.0)).alias("tide_point_distance_km"),
        )
    )


def summary(heights: DataFrame, height: str = "tide_ocean_m") -> DataFrame:
    """One row: n_valid, n_missing, least and most; infinite heights are missing but are the least or the most."""
    h = F.nanvl(F.col(height), F.lit(None).cast("double"))
    fit = F.count_if(finite(F.col(height)))
    return heights.agg(fit.alias("n_valid"), (F.count(F.lit(1)) - fit).alias("n_missing"), F.min(h).alias("least"), F.max(h).alias("most"))
