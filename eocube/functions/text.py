"""Parsers for extent strings, file names, colour tables and legends."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Naming rules of the input files.
TILE_PATTERN = r"E(\d{3})N(\d{3})T(\d)"
FLOOD_LEVELS = [r"V0M2R3", r"EQUI7_(AS|AF|EU|NA|SA|OZ)020M", r"E\d\d\dN\d\d\dT3"]
DEM_LEVELS = [r"V01R01", r"EQUI7_(AS|AF|EU|NA|SA|OZ)020M", r"E\d\d\dN\d\d\dT3"]
LANDCOVER_LEVELS = [r"E\d\d\dN\d\d\dT6"]
CCI_LEVELS = [r"CCI_Land_Cover", r"V1M0R1", r"EQUI7_EU500M", r"E\d\d\dN\d\d\dT6"]
CCI_FIELDS = ["product", "var_name", "level", "type", "resolution", "epoch", "time", "version", "grid_name", "tile_name"]


def parse_extent(text: Column) -> Column:
    """``"min_x, min_y, max_x, max_y[, crs]"`` as a struct; bad numbers are missing."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    number = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("double")
    x0, y0, x1, y1 = (number(i) for i in (1, 2, 3, 4))
    return F.struct(
        F.least(x0, x1).alias("min_x"),
        F.least(y0, y1).alias("min_y"),
        F.greatest(x0, x1).alias("max_x"),
        F.greatest(y0, y1).alias("max_y"),
        F.try_element_at(parts, F.lit(5)).alias("crs"),
    )


def extent_ring(extent: Column) -> Column:
    """Closed outline of an extent struct as five vertices."""
    corner = lambda x, y: F.struct(extent[x].alias("x"), extent[y].alias("y"))
    return F.array(
        corner("min_x", "min_y"),
        corner("max_x", "min_y"),
        corner("max_x", "max_y"),
        corner("min_x", "max_y"),
        corner("min_x", "min_y"),
    )


def extent_epsg(extent: Column) -> Column:
    """Number of an extent's reference system, missing without one."""
    return F.try_element_at(F.split(extent["crs"], ":"), F.lit(2)).try_cast("int")


def rgb_hex(line: Column) -> Column:
    """``"r g b"`` as ``#rrggbb``."""
    channels = F.split(F.trim(line), r"\s+")
    return F.format_string("#%02x%02x%02x", *(F.get(channels, F.lit(i)).cast("int") for i in range(3)))


def parse_legend(line: Column) -> Column:
    """``id "label" rest`` as a struct (code, rest, label)."""
    parts = F.filter(F.transform(F.split(line, '"'), lambda p: F.trim(p)), lambda p: p != "")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).try_cast("int").alias("code"),
        F.try_element_at(parts, F.lit(3)).alias("rest"),
        F.try_element_at(parts, F.lit(2)).alias("label"),
    )


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def scene_name(path: Column) -> Column:
    """Grid, tile and sensing day of a flood scene path; absent parts are missing."""
    found = lambda pattern, group: F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))
    return F.struct(
        found(r"EQUI7_([A-Z]{2})\d{3}M", 1).alias("grid_name"),
        found(r"(E\d{3}N\d{3}T\d)", 1).alias("tile_name"),
        F.try_to_date(found(r"_(\d{8})_", 1), "yyyyMMdd").alias("day"),
    )


def landcover_name(path: Column) -> Column:
    """Three fields of a land-cover file name: variable, grid and tile."""
    parts = F.split(F.element_at(F.split(path, "/"), -1), "_")
    clean = lambda i: F.regexp_replace(F.try_element_at(parts, F.lit(i)), r"\..*$", "")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("var_name"),
        F.try_element_at(parts, F.lit(3)).alias("grid_name"),
        clean(4).alias("tile_name"),
    )


def cci_name(path: Column) -> Column:
    """Ten fields of a CCI file name; the fourth joins two tokens with a dash."""
    parts = F.split(file_stem(path), "_")
    token = lambda i: F.try_element_at(parts, F.lit(i))
    tokens = [token(1), token(2), token(3), F.concat(token(4), F.lit("-"), token(5))] + [token(i) for i in range(6, 12)]
    return F.struct(*(t.alias(n) for t, n in zip(tokens, CCI_FIELDS)))


def tile_bounds(tile: Column, metres_per_pixel: Column | float = 20.0) -> Column:
    """Box, pixel shape and affine of a tile named ``E###N###T#``.

    The digits count 100 km steps of the lower left corner; T3 tiles are 300 km
    wide and T6 tiles 600 km.
    """
    part = lambda g: F.nullif(F.regexp_extract(tile, TILE_PATTERN, g), F.lit("")).cast("double")
    x, y, size = part(1) * 100_000.0, part(2) * 100_000.0, part(3) * 100_000.0
    res = F.lit(metres_per_pixel) if isinstance(metres_per_pixel, (int, float)) else metres_per_pixel
    return F.struct(
        x.alias("min_x"),
        y.alias("min_y"),
        (x + size).alias("max_x"),
        (y + size).alias("max_y"),
        F.floor(size / res).alias("pixels"),
        x.alias("x0"),
        res.cast("double").alias("dx"),
        (y + size).alias("y0"),
        (-res).cast("double").alias("dy"),
    )
