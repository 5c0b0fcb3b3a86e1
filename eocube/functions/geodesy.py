"""Great-circle distance and the area of a longitude-latitude cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eocube.functions.projection import DEG

# The sphere and the spacing of the global 0.1 degree grid.
EARTH_RADIUS_M = 6371e3
GLOBAL_STEP_DEG = 0.1


def haversine(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Distance in metres between two points given in degrees."""
    half_lat = F.sin((lat_b - lat_a) * (DEG / 2))
    half_lon = F.sin((lon_b - lon_a) * (DEG / 2))
    a = half_lat * half_lat + F.cos(lat_a * DEG) * F.cos(lat_b * DEG) * half_lon * half_lon
    a = F.greatest(F.lit(0.0), F.least(F.lit(1.0), a))
    return F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)) * (2 * EARTH_RADIUS_M)


def cell_corners(lat: Column, lon: Column, step: float = GLOBAL_STEP_DEG) -> list[tuple[Column, Column]]:
    """(lat, lon) of the corners: lower left, upper left, upper right, lower right."""
    h = step / 2
    return [(lat - h, lon - h), (lat + h, lon - h), (lat + h, lon + h), (lat - h, lon + h)]


def cell_area(lat: Column, lon: Column, step: float = GLOBAL_STEP_DEG) -> Column:
    """Quadrilateral area from sides and diagonals as stored beside the rain cube.

    The formula takes ``(p q)^2 / 16`` from the product of the half-perimeter
    terms, so it underestimates, and is missing towards the poles where the
    radicand turns negative.  :func:`cell_area_exact` gives the true area.
    """
    corners = cell_corners(lat, lon, step)

    def gap(i, j):
        return haversine(*corners[i], *corners[j])

    sides = [gap(0, 1), gap(1, 2), gap(2, 3), gap(3, 0)]
    half = (sides[0] + sides[1] + sides[2] + sides[3]) / 2
    diagonals = gap(0, 2) * gap(1, 3)
    product = F.lit(1.0)
    for s in sides:
        product = product * (half - s)
    radicand = product - diagonals * diagonals / 16
    return F.when(radicand >= 0, F.sqrt(radicand))


def cell_area_exact(lat: Column, step: float = GLOBAL_STEP_DEG) -> Column:
    """Area of the cell on the sphere, between two meridians and two parallels."""
    h = step / 2
    band = F.sin((lat + h) * DEG) - F.sin((lat - h) * DEG)
    return band * (EARTH_RADIUS_M**2 * step * DEG)
