"""Regridding between reference systems: nearest and bilinear sampling.

Every target cell looks up its own centre in the source grid, so the source is
never searched.  Between systems whose axes transform independently the lookup
splits into two one-dimensional tables of ``nx`` and ``ny`` rows, small enough
to broadcast, and source cells fan out to their target cells without a shuffle.
Otherwise the lookup is a two-dimensional table joined on the source index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.functions.projection import project, separable
from eocube.model import GridSpec
from eocube.operators.select import CELL
from eocube.operators.sizing import small_side


def _axis_lookup(spark: SparkSession, src: GridSpec, dst: GridSpec, axis: str) -> DataFrame:
    """(target index, fractional source position) along one axis."""
    i, mid = F.col("id"), F.lit(0.0)
    if axis == "x":
        n, size, x, y = dst.nx, src.nx, dst.center_x(i), mid
    else:
        n, size, x, y = dst.ny, src.ny, mid, dst.center_y(i)
    placed = project(spark.range(n), x, y, dst.crs, src.crs, ("x", "y"))
    at = src.pixel_x(F.col("x")) if axis == "x" else src.pixel_y(F.col("y"))
    return placed.select(i.alias(f"to_{axis}"), at.alias(f"at_{axis}")).where(
        (F.col(f"at_{axis}") >= 0) & (F.col(f"at_{axis}") < size)
    )


def _cell_lookup(spark: SparkSession, src: GridSpec, dst: GridSpec) -> DataFrame:
    """(target cell, fractional source position) for every target cell."""
    x, y = dst.center_x(F.col("x_idx")), dst.center_y(F.col("y_idx"))
    at = project(dst.spine(spark), x, y, dst.crs, src.crs, ("x", "y")).select(
        F.col("x_idx").alias("to_x"), F.col("y_idx").alias("to_y"),
        src.pixel_x(F.col("x")).alias("at_x"), src.pixel_y(F.col("y")).alias("at_y"),
    )
    return at.where(
        (F.col("at_x") >= 0) & (F.col("at_x") < src.nx) & (F.col("at_y") >= 0) & (F.col("at_y") < src.ny)
    )


def _attach(df: DataFrame, src: GridSpec, dst: GridSpec, key) -> DataFrame:
    """Join rows keyed by a source index (jx, jy) with the target cells there."""
    spark = df.sparkSession
    if separable(src.crs, dst.crs):
        for axis, n in (("x", dst.nx), ("y", dst.ny)):
            side = _axis_lookup(spark, src, dst, axis).withColumn(f"j{axis}", key(F.col(f"at_{axis}")))
            df = df.join(small_side(side, n), f"j{axis}")
        return df
    cells = _cell_lookup(spark, src, dst).withColumns(
        {"jx": key(F.col("at_x")), "jy": key(F.col("at_y"))}
    )
    return df.join(small_side(cells, dst.cells), ["jy", "jx"])


def _densify(out: DataFrame, df: DataFrame, dst: GridSpec, keys: Sequence[str]) -> DataFrame:
    """Every target cell for every label of the input, also of those without a cell in the target."""
    spine = dst.spine(out.sparkSession)
    for k in keys:
        labels = df.agg(F.collect_set(k)).scalar()
        spine = spine.withColumn(k, F.explode(labels))
    return spine.join(out, [*keys, *CELL], "left").select(*out.columns)


def regrid(
    df: DataFrame,
    src: GridSpec,
    dst: GridSpec,
    values: Sequence[str],
    method: str = "nearest",
    *,
    keys: Sequence[str] = (),
    dense: bool = False,
    nodata: float | None = None,
) -> DataFrame:
    """Sample ``values`` at the cell centres of ``dst``.

    ``keys`` are carried along (time, band).  Target cells whose centre lies
    outside the source are absent, and so are those that meet no source row;
    ``dense`` returns every target cell, per key, with missing values there.
    ``nodata`` counts as missing on the way in and stands for it on the way out.
    """
    if nodata is not None:
        df = df.withColumns({v: F.nullif(F.col(v), F.lit(nodata)) for v in values})
    if method == "nearest":
        out = _nearest(df, src, dst, values, keys)
    elif method == "bilinear":
        out = _bilinear(df, src, dst, values, keys)
    else:
        raise ValueError(f"unknown resampling method {method!r}")
    if dense:
        out = _densify(out, df, dst, keys)
    return out if nodata is None else out.fillna(nodata, list(values))


def _nearest(df, src, dst, values, keys) -> DataFrame:
    cells = df.select(*keys, *values, F.col("x_idx").alias("jx"), F.col("y_idx").alias("jy"))
    return _attach(cells, src, dst, F.floor).select(
        *keys, F.col("to_y").alias("y_idx"), F.col("to_x").alias("x_idx"), *values
    )


def _corner(at: Column) -> Column:
    """Index of the left (upper) of the two cells whose centres enclose a position."""
    return F.floor(at - 0.5)


def _bilinear(df, src, dst, values, keys) -> DataFrame:
    """Gather the 2 x 2 neighbourhood at source resolution, then fan out.

    The one shuffle of a separable case moves four rows per *source* cell, and
    only for neighbourhoods some target cell uses, so enlarging a grid hundreds
    of times shuffles nothing of the enlarged result.
    """
    spark = df.sparkSession
    steps = F.array(F.lit(0), F.lit(1))
    parts = df.select(*keys, *values, "y_idx", "x_idx", F.explode(steps).alias("right")).withColumn(
        "low", F.explode(steps)
    ).withColumns({"jx": F.col("x_idx") - F.col("right"), "jy": F.col("y_idx") - F.col("low")})
    if separable(src.crs, dst.crs):
        for axis, n in (("x", dst.nx), ("y", dst.ny)):
            used = _axis_lookup(spark, src, dst, axis).select(_corner(F.col(f"at_{axis}")).alias(f"j{axis}"))
            parts = parts.join(small_side(used, n), f"j{axis}", "left_semi")
    corners = [(v, r, b) for v in values for b in (0, 1) for r in (0, 1)]
    quads = parts.groupBy(*keys, "jy", "jx").agg(
        *(
            F.max(F.when((F.col("right") == r) & (F.col("low") == b), F.col(v))).alias(f"{v}_{b}{r}")
            for v, r, b in corners
        )
    )
    placed = _attach(quads, src, dst, _corner)
    wx = F.col("at_x") - 0.5 - F.col("jx")
    wy = F.col("at_y") - 0.5 - F.col("jy")
    weight = {0: lambda w: 1.0 - w, 1: lambda w: w}

    def blend(v):
        top, bottom = F.lit(0.0), F.lit(0.0)
        for b in (0, 1):
            for r in (0, 1):
                c = F.col(f"{v}_{b}{r}")
                w = weight[r](wx) * weight[b](wy)
                top = top + F.coalesce(w * c, F.lit(0.0))
                bottom = bottom + F.when(c.isNotNull(), w).otherwise(0.0)
        return F.when(bottom > 0, top / bottom).alias(v)

    return placed.select(
        *keys, F.col("to_y").alias("y_idx"), F.col("to_x").alias("x_idx"), *(blend(v) for v in values)
    )


def reproject(df, src, crs, values, method="nearest", *, resolution=None, keys=(), dense=False, nodata=None):
    """Regrid to another system on its default grid; returns (cells, grid)."""
    dst = src.project(crs, resolution)
    return regrid(df, src, dst, values, method, keys=keys, dense=dense, nodata=nodata), dst
