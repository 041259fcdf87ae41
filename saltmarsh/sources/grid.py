"""Grids of harmonic constants stored by tiles, so that scenes read the part of the world that they lie in.

A tile is TILE_CELLS cells wide both ways and a partition of the table, with all its constituents; cells are sorted within it. The grid of a
global model is some hundred tiles, so which of them scenes touch is a small question, asked before the grid is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TILE_COLUMN, TILE_CELLS = "grid_tile", 512
#: Up to this many tiles stand in the reader's partition filter; more are a semi-join, which prunes no partitions by itself.
MOST_TILES = 10_000


def tile_of(index: Column) -> Column:
    return F.floor(index / TILE_CELLS)


def tile_name(y: Column, x: Column) -> Column:
    return F.concat_ws("_", y.cast("string"), x.cast("string"))


def write_grid(grid: DataFrame, path: str) -> None:
    """Store a grid by tiles; a file a tile, as rows are dealt by tile first."""
    tile = tile_name(tile_of(F.col("lat_idx")), tile_of(F.col("lon_idx")))
    tiled = grid.withColumn(TILE_COLUMN, tile).repartition(TILE_COLUMN).sortWithinPartitions(TILE_COLUMN, "constituent", "lat_idx", "lon_idx")
    tiled.write.partitionBy(TILE_COLUMN).parquet(path)


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """A stored grid, with the tile of each row in TILE_COLUMN."""
    schema = spark.read.parquet(path).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString() if f.name != TILE_COLUMN else 'string'}" for f in schema.fields)
    return spark.read.schema(fields).parquet(path)


def only_tiles(grid: DataFrame, tiles: DataFrame) -> DataFrame:
    """The grid's rows in these tiles (TILE_COLUMN, distinct); the reader opens no other partition."""
    wanted = [r[0] for r in tiles.limit(MOST_TILES + 1).collect()]
    if len(wanted) > MOST_TILES:
        return grid.join(tiles, TILE_COLUMN, "left_semi")
    return grid.where(F.col(TILE_COLUMN).isin(wanted)) if wanted else grid.limit(0)
