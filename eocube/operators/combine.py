"""Stacking, uniting and mosaicking of cell tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.functions.text import tile_bounds
from eocube.model import GridSpec
from eocube.operators.select import CELL
from eocube.operators.sizing import small_side


def concat(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack cubes over different coordinates; in long form they align by themselves."""
    if not parts:
        raise ValueError("nothing to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def outer_align(parts: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Several variables over the union of their coordinates, missing-filled.

    Each table holds the column it is named after.  One grouping of the stacked
    rows takes the place of a chain of outer joins.
    """
    stacked = concat([df.select(*keys, name) for name, df in parts.items()])
    return stacked.groupBy(*keys).agg(*(F.max(name).alias(name) for name in parts))


def union_domains(parts: Sequence[DataFrame], value: str, day: str = "day") -> DataFrame:
    """Unite spatial domains; where they overlap the daily mean decides."""
    return concat(parts).groupBy(day, *CELL).agg(F.avg(value).alias(value))


def mosaic(tiles: DataFrame, value: str, *, strict: bool = True) -> DataFrame:
    """One raster from tiles ``(tile_y, tile_x, y_idx, x_idx, value)``.

    ``tile_y`` and ``tile_x`` are the tile's first row and column on the mosaic
    grid.  Tiles must not overlap; ``strict`` fails if two give the same cell.
    """
    placed = tiles.select(
        (F.col("tile_y") + F.col("y_idx")).alias("y_idx"), (F.col("tile_x") + F.col("x_idx")).alias("x_idx"), value
    )
    merged = placed.groupBy(*CELL).agg(F.max(value).alias(value), F.count(F.lit(1)).alias("n"))
    if strict:
        merged = merged.where(F.assert_true(F.col("n") == 1, F.lit("tiles of a mosaic overlap")).isNull())
    return merged.drop("n")


def place_tiles(open_files: Callable[[Sequence[str], bool], DataFrame], files: DataFrame, spec: GridSpec) -> DataFrame:
    """The cells of a catalogue's files as input of :func:`mosaic`; only these files are opened.

    A tile's first row and column on the mosaic grid follow from the box that its
    name stands for: one row per file, which is known here and stays beside the cells.
    """
    box = tile_bounds(F.col("tile_name"), abs(spec.dx))
    offsets = files.select(
        "file",
        F.round((box["y0"] - spec.y0) / spec.dy).cast("bigint").alias("tile_y"),
        F.round((box["x0"] - spec.x0) / spec.dx).cast("bigint").alias("tile_x"),
    ).collect()
    listed = files.sparkSession.createDataFrame(offsets, "file string, tile_y bigint, tile_x bigint")
    cells = open_files([r.file for r in offsets], True)
    return cells.join(small_side(listed, len(offsets)), "file").drop("file")


def meshgrid(spark: SparkSession, ny: int, nx: int) -> DataFrame:
    """All index pairs of two axes, generated from one range."""
    return spark.range(ny * nx).select(F.floor(F.col("id") / nx).alias("y_idx"), (F.col("id") % nx).alias("x_idx"))


def compose(*steps):
    """Chain transformers of a DataFrame into one."""

    def run(df: DataFrame) -> DataFrame:
        for step in steps:
            df = df.transform(step)
        return df

    return run


def scale(factor: float, *columns: str):
    """Transformer that multiplies columns by a constant."""
    return lambda df: df.withColumns({c: F.col(c) * F.lit(factor) for c in columns})
