"""Scattered points onto a grid: the nearest point within a radius."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eocube.functions.geodesy import EARTH_RADIUS_M, haversine
from eocube.functions.projection import DEG, LONLAT, WEB_MERCATOR, WGS84_RADIUS, project
from eocube.model import GridSpec
from eocube.operators.sizing import small_side

def _reach(one: Column, two: Column, n: int) -> Column:
    """Indices of target cells whose centre may lie between two positions."""
    lo = F.greatest(F.lit(0), F.ceil(F.least(one, two) - 0.5 - 1e-6))
    hi = F.least(F.lit(n - 1), F.floor(F.greatest(one, two) - 0.5 + 1e-6))
    return F.when(hi >= lo, F.sequence(lo, hi))


def _offers(places: DataFrame, dst: GridSpec, radius: float) -> DataFrame:
    """Places with the target box ``(x_lo, x_hi, y_lo, y_hi)`` of the ground circle around them.

    In longitude and latitude the box of a circle is known exactly, and web
    mercator keeps it a box; where it crosses the date line it is listed again
    a world's width to either side, and around a pole it spans all longitudes.
    """
    angle = radius / EARTH_RADIUS_M
    south, north = F.col("lat") - angle / DEG, F.col("lat") + angle / DEG
    pole = (south <= -90) | (north >= 90)
    wide = F.asin(F.least(F.lit(1.0), F.sin(F.lit(angle)) / F.greatest(F.cos(F.col("lat") * DEG), F.lit(1e-12)))) / DEG
    boxes = places.withColumns(
        {
            "x_lo": F.when(pole, -180.0).otherwise(F.col("lon") - wide), "x_hi": F.when(pole, 180.0).otherwise(F.col("lon") + wide),
            "y_lo": F.greatest(south, F.lit(-90.0)), "y_hi": F.least(north, F.lit(90.0)),
        }
    )
    turns = F.explode(F.array(F.lit(0.0), F.lit(-360.0), F.lit(360.0)))
    boxes = boxes.withColumn("turn", turns).withColumns({c: F.col(c) + F.col("turn") for c in ("x_lo", "x_hi")})
    if dst.crs == LONLAT:
        return boxes
    scale = DEG * WGS84_RADIUS
    edge = lambda c: F.ln(F.tan(F.least(F.greatest(F.col(c), F.lit(-89.9999)), F.lit(89.9999)) * (DEG / 2) + F.lit(math.pi / 4))) * WGS84_RADIUS
    return boxes.withColumns({"x_lo": F.col("x_lo") * scale, "x_hi": F.col("x_hi") * scale, "y_lo": edge("y_lo"), "y_hi": edge("y_hi")})


def _offered_in_boxes(places: DataFrame, dst: GridSpec, radius: float) -> DataFrame:
    """Places beside the target cells of their boxes, for maps on which the reach is a box."""
    offered = (
        _offers(places, dst, radius)
        .withColumn("x_idx", F.explode(_reach(dst.pixel_x(F.col("x_lo")), dst.pixel_x(F.col("x_hi")), dst.nx)))
        .withColumn("y_idx", F.explode(_reach(dst.pixel_y(F.col("y_lo")), dst.pixel_y(F.col("y_hi")), dst.ny)))
    )
    centre = dst.center_x(F.col("x_idx")), dst.center_y(F.col("y_idx"))
    return project(offered, *centre, dst.crs, LONLAT, ("cell_lon", "cell_lat"))


def _space(lon: str, lat: str) -> dict[str, Column]:
    """A position as a unit vector."""
    level = F.cos(F.col(lat) * DEG)
    return {"u": level * F.cos(F.col(lon) * DEG), "v": level * F.sin(F.col(lon) * DEG), "w": F.sin(F.col(lat) * DEG)}


def _offered_in_space(places: DataFrame, dst: GridSpec, radius: float) -> DataFrame:
    """Places beside the target cells near them in space, for any map.

    Cells and places are unit vectors, so that the reach is a chord whatever the map does to
    distances, poles and the date line.  Space is cut into cubes of two chords; a cell lies in one
    of them, a place reaches into one or two along each axis, and cube by cube they meet.
    """
    chord = 2 * math.sin(min(radius / EARTH_RADIUS_M, math.pi) / 2) * (1 + 1e-9) + 1e-12
    size = 2 * chord
    spine = dst.spine(places.sparkSession)
    cells = project(spine, dst.center_x(F.col("x_idx")), dst.center_y(F.col("y_idx")), dst.crs, LONLAT, ("cell_lon", "cell_lat"))
    cells = cells.where(F.col("cell_lon").isNotNull() & F.col("cell_lat").isNotNull()).withColumns(_space("cell_lon", "cell_lat"))
    cells = cells.withColumns({f"cube_{c}": F.floor(F.col(c) / size) for c in "uvw"}).drop(*"uvw")
    reaching = places.withColumns(_space("lon", "lat"))
    for c in "uvw":
        cubes = F.sequence(F.floor((F.col(c) - chord) / size), F.floor((F.col(c) + chord) / size))
        reaching = reaching.withColumn(f"cube_{c}", F.explode(cubes))
    return reaching.drop(*"uvw").join(small_side(cells, dst.cells), [f"cube_{c}" for c in "uvw"])


def nearest_points(
    points: DataFrame,
    dst: GridSpec,
    radius: float,
    *,
    point_id: str = "location_id",
    lon: str = "lon",
    lat: str = "lat",
) -> DataFrame:
    """(y_idx, x_idx, point, distance): the nearest point of each target cell.

    Each point offers itself to the few cells near it and a minimum per cell decides, ties to the
    smaller id.  On maps where a ground circle has a known box the cells follow from the box, on
    all others points and cells meet in space.  Minima are taken before the shuffle, and points at
    one place count as one.
    """
    places = (
        points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
        .groupBy(F.col(lon).alias("lon"), F.col(lat).alias("lat"))
        .agg(F.min(point_id).alias("point"))
    )
    offered = (_offered_in_boxes if dst.crs in (LONLAT, WEB_MERCATOR) else _offered_in_space)(places, dst, radius)
    measured = offered.withColumn("distance", haversine(F.col("lat"), F.col("lon"), F.col("cell_lat"), F.col("cell_lon")))
    best = (
        measured.where(F.col("distance") <= radius)
        .groupBy("y_idx", "x_idx")
        .agg(F.min(F.struct("distance", "point")).alias("best"))
    )
    return best.select("y_idx", "x_idx", F.col("best.point").alias(point_id), F.col("best.distance").alias("distance"))


def resample_points(
    points: DataFrame,
    obs: DataFrame,
    dst: GridSpec,
    radius: float,
    values: Sequence[str],
    *,
    point_id: str = "location_id",
    keys: Sequence[str] = ("time",),
    fill: float | None = None,
    dense: bool = False,
) -> DataFrame:
    """Grid the observations of scattered locations.

    The cell-to-location table does not depend on time; it is found once from
    the locations and joined with all steps; it has at most one row per target
    cell, so a moderate grid is broadcast and the observations stay.  A missing value of the nearest
    location stays missing.  ``dense`` lists cells out of reach, as ``fill``.
    """
    cells = nearest_points(points, dst, radius, point_id=point_id).drop("distance")
    out = obs.join(small_side(cells, dst.cells), point_id).select(*keys, "y_idx", "x_idx", *values)
    if not dense:
        return out
    spine = dst.spine(obs.sparkSession)
    for k in keys:
        spine = spine.withColumn(k, F.explode(obs.agg(F.collect_set(k)).scalar()))
    hit = spine.join(out.withColumn("_hit", F.lit(True)), [*keys, "y_idx", "x_idx"], "left")
    return hit.select(
        *keys, "y_idx", "x_idx", *(F.when(F.col("_hit"), F.col(v)).otherwise(F.lit(fill)).alias(v) for v in values)
    )
