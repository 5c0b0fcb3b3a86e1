"""Shaded relief."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.model import GridSpec

# Light from the north-west, 45 degrees high, flattened heights.
AZIMUTH, ALTITUDE, VERT_EXAG = 315.0, 45.0, 0.001


#: Cells per side of a block.
BLOCK = 512


def _with_halo(df: DataFrame, block: int) -> DataFrame:
    """Cells dealt to blocks, those on a block's edge to its neighbour too; ``_own`` marks the block's own."""
    y, x = F.col("y_idx"), F.col("x_idx")
    home = F.struct(F.floor(y / block).alias("y"), F.floor(x / block).alias("x"), F.lit(True).alias("own"))
    beside = lambda dy, dx: F.struct((home["y"] + dy).alias("y"), (home["x"] + dx).alias("x"), F.lit(False).alias("own"))
    edges = ((y % block == 0, -1, 0), (y % block == block - 1, 1, 0), (x % block == 0, 0, -1), (x % block == block - 1, 0, 1))
    homes = F.array_compact(F.array(home, *(F.when(at, beside(dy, dx)) for at, dy, dx in edges)))
    dealt = df.withColumn("_at", F.explode(homes)).select("*", "_at.*").drop("_at")
    dealt = dealt.withColumnsRenamed({"y": "_by", "x": "_bx", "own": "_own"})
    return dealt.repartition("_by", "_bx")


def _slope(z: Column, along: str, across: str, n: int) -> Column:
    """Central difference along an index inside a block, one-sided on the raster's border.

    A neighbour that is absent, or missing, makes the slope missing.
    """
    w = Window.partitionBy("_by", "_bx", across).orderBy(along)
    i = F.col(along)
    before = F.when(F.lag(i).over(w) == i - 1, F.lag(z).over(w))
    after = F.when(F.lead(i).over(w) == i + 1, F.lead(z).over(w))
    return F.when(i == 0, after - z).when(i == n - 1, z - before).otherwise((after - before) / 2)


def hillshade(
    df: DataFrame,
    spec: GridSpec,
    height: str = "dem",
    *,
    azimuth: float = AZIMUTH,
    altitude: float = ALTITUDE,
    vert_exag: float = VERT_EXAG,
    block: int = BLOCK,
) -> DataFrame:
    """Illumination 0..1 of a surface, stretched over the raster's own range.

    Cells are exchanged once, by blocks with a halo of their neighbours' edge cells; windows run
    along the rows and columns inside a block.  Row indices grow southwards, so the slope northwards is the negated row difference.
    """
    z = F.col(height) * vert_exag
    a, h = math.radians(90 - azimuth), math.radians(altitude)
    blocks = _with_halo(df.select("y_idx", "x_idx", height), block)
    sloped = blocks.withColumn("_gx", _slope(z, "x_idx", "y_idx", spec.nx)).withColumn(
        "_gy", -_slope(z, "y_idx", "x_idx", spec.ny)
    ).where("_own")
    gx, gy = F.col("_gx"), F.col("_gy")
    lit = (
        -gx * (math.cos(a) * math.cos(h)) - gy * (math.sin(a) * math.cos(h)) + math.sin(h)
    ) / F.sqrt(gx * gx + gy * gy + 1.0)
    shaded = sloped.select("y_idx", "x_idx", lit.alias("shade"))
    ends = shaded.agg(F.struct(F.min("shade").alias("lo"), F.max("shade").alias("hi"))).scalar()
    placed = shaded.withColumn("_ends", ends)
    lo, hi = F.col("_ends.lo"), F.col("_ends.hi")
    stretched = F.when(hi - lo > 1e-6, (F.col("shade") - lo) / (hi - lo)).otherwise(F.col("shade"))
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), stretched))
    return placed.select("y_idx", "x_idx", F.when(F.col("shade").isNotNull(), clipped).alias("shade"))
