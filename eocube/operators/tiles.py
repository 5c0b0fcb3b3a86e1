"""Tile selection by geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.functions.projection import EQUI7_GRIDS
from eocube.functions.text import tile_bounds
from eocube.model import Extent

TILE_KEY = ("grid_name", "tile_name")


def tiles_meeting(tiles: DataFrame, extent: Extent) -> DataFrame:
    """Tiles whose box overlaps the extent.

    An extent with a reference system is moved into the grid of each tile, since
    the coordinates of two grids are unrelated: a table of one row per continental
    grid.  One without is in the tiles' own.
    """
    if extent.crs is None:
        return tiles.where(
            (F.col("min_x") < extent.max_x) & (F.col("max_x") > extent.min_x)
            & (F.col("min_y") < extent.max_y) & (F.col("max_y") > extent.min_y)
        )
    boxes = [(name, *extent.to(crs).corners()) for name, crs in EQUI7_GRIDS.items()]
    asked = tiles.sparkSession.createDataFrame(boxes, "grid_name string, _x0 double, _y0 double, _x1 double, _y1 double")
    meets = (F.col("min_x") < F.col("_x1")) & (F.col("max_x") > F.col("_x0")) & (F.col("min_y") < F.col("_y1")) & (F.col("max_y") > F.col("_y0"))
    return tiles.join(F.broadcast(asked), "grid_name").where(meets).select(*tiles.columns)


def tile_table(files: DataFrame) -> DataFrame:
    """Boxes of the tiles a file catalogue lists."""
    named = distinct_tiles(files).withColumn("b", tile_bounds(F.col("tile_name")))
    return named.select(*TILE_KEY, "b.*")


def tile_semi_join(files: DataFrame, tiles: DataFrame, extent: Extent) -> DataFrame:
    """Files whose tile meets the extent.

    The tile table is the grid's own list of tiles; its real size decides
    whether Spark broadcasts it.
    """
    return files.join(tiles_meeting(tiles, extent).select(*TILE_KEY), list(TILE_KEY), "left_semi")


def distinct_tiles(files: DataFrame) -> DataFrame:
    return files.select(*TILE_KEY).distinct()


def sorted_tiles(files: DataFrame) -> DataFrame:
    """Sorted distinct tile names of each grid, as one array per grid."""
    return (
        distinct_tiles(files)
        .groupBy("grid_name")
        .agg(F.sort_array(F.collect_list("tile_name")).alias("tiles"))
    )
