"""Flood scenes, the flood risk map and the rain forecast."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.functions.missing import encode_int16
from eocube.functions.projection import WEB_MERCATOR
from eocube.model import Extent, GridSpec
from eocube.operators.clip import clip_polygon
from eocube.operators.combine import mosaic, place_tiles
from eocube.operators.nearest import nth_step
from eocube.operators.overlay import OVERLAY_CLASSES, class_label, overlay_flood_built
from eocube.operators.reduce import coarsen, composite_max
from eocube.operators.regrid import regrid, reproject
from eocube.operators.running import accumulate
from eocube.operators.select import bbox_slice, block_steps, clip_box, crop, day_select, native_resolution, time_slice
from eocube.operators.tiles import tile_semi_join
from eocube.sources.archive import Opener, meeting
from eocube.sources.catalog import with_attrs


def flood_scene(
    files: DataFrame,
    tiles: DataFrame,
    open_files: Opener,
    spec: GridSpec,
    extent: Extent,
    start: dt.date,
    end: dt.date | None = None,
) -> tuple[DataFrame, GridSpec]:
    """Scene of one day, or of several: pick files by day and tile, open them, crop, take the maximum.

    ``files`` is a catalogue of the archive or its manifest, whose bounds then leave out files
    beside the crop.  Tiles are picked by the extent moved into each grid; their sorted names are
    an attribute of the scene.  Choosing is a job over the catalogue while the plan is made, as
    the plan names the files it reads; the grid returned is that of the crop.
    """
    cut = crop(spec, extent)
    chosen = tile_semi_join(day_select(files, start, end, "day"), tiles, extent)
    picked = chosen.select("grid_name", "tile_name", "file").collect()
    names = {g: sorted({r.tile_name for r in picked if r.grid_name == g}) for g in sorted({r.grid_name for r in picked})}
    near = picked if "y_from" not in files.columns else meeting(chosen, spec, cut).select("file").collect()
    cells, cut = clip_box(open_files([r.file for r in near], False), spec, extent)
    return with_attrs(composite_max(cells, "flood"), "flood", {"tiles": names}), cut


def restructure_flood(scene: DataFrame, spec: GridSpec, land: DataFrame, crs: str) -> tuple[DataFrame, GridSpec]:
    """Reproject a scene and blank the sea; ``land`` is in the target system."""
    cells, dst = reproject(scene, spec, crs, ["flood"])
    return clip_polygon(cells, dst, land, ["flood"]), dst


def restructure_built(built: DataFrame, spec: GridSpec, extent: Extent, crs: str) -> tuple[DataFrame, GridSpec]:
    cells, cut = clip_box(built, spec, extent)
    return reproject(cells, cut, crs, ["built"])


def restructure_dem(
    open_files: Opener, files: DataFrame, spec: GridSpec, crs: str, k: int | None = None
) -> tuple[DataFrame, GridSpec]:
    """Open and place the catalogue's tiles, mosaic, exact block mean, reproject, pack to 16 bits."""
    k = k or block_steps(native_resolution("dem"))
    means, coarse = coarsen(mosaic(place_tiles(open_files, files, spec), "dem"), spec, k, "mean", "dem", boundary="exact")
    cells, dst = reproject(means, coarse, crs, ["dem"])
    return cells.withColumn("dem", encode_int16(F.col("dem"))), dst


def flood_risk_map(
    flood: DataFrame,
    flood_spec: GridSpec,
    built: DataFrame,
    built_spec: GridSpec,
    *,
    crs: str = WEB_MERCATOR,
    flood_k: int | None = None,
    built_k: int | None = None,
    labels: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Class per target cell: 0 other, 1 flooded, 2 built.

    Both rasters shrink to 500 m blocks first, so only blocks are regridded and
    joined.  ``labels`` maps key columns of the flood cells (days) to their
    labels; there is one map per label then, from one pass over the cells.
    """
    keys = tuple(labels or ())
    flags, fs = coarsen(
        flood, flood_spec, flood_k or block_steps(native_resolution("flood")), "flag", "flood", keys=keys, labels=labels
    )
    means, bs = coarsen(built, built_spec, built_k or block_steps(native_resolution("built")), "mean", "built")
    flood_cells, dst = reproject(flags, fs, crs, ["flood"], keys=keys)
    built_cells = regrid(means, bs, dst, ["built"])
    classes = overlay_flood_built(flood_cells, built_cells, keys=keys)
    return classes.withColumn("label", class_label(F.col("class"), OVERLAY_CLASSES))


def flood_change(
    flood: DataFrame, flood_spec: GridSpec, built: DataFrame, built_spec: GridSpec, days: list[dt.date], **kw
) -> DataFrame:
    """Cells per class on each of several days, from one pass over either raster."""
    asked = flood.where(F.col("day").isin(days))
    maps = flood_risk_map(asked, flood_spec, built, built_spec, labels={"day": days}, **kw)
    counts = maps.groupBy("day", "class", "label").agg(F.count(F.lit(1)).alias("cells"))
    return counts.select("day", "class", "label", "cells")


def accumulate_rain(
    rain: DataFrame, spec: GridSpec, start, end, extent: Extent, time: str = "time"
) -> tuple[DataFrame, GridSpec]:
    """Slice in time and space, then the running total in millimetres, on the cropped grid."""
    cells, cut = bbox_slice(time_slice(rain, start, end, time), spec, extent)
    return accumulate(cells, "tp", time=time), cut


def rain_forecast(
    rain: DataFrame,
    spec: GridSpec,
    start,
    end,
    extent: Extent,
    *,
    step: int | None = None,
    resolution: float = 500.0,
    time: str = "time",
) -> tuple[DataFrame, GridSpec]:
    """Accumulated rain on a fine metric grid, bilinear.

    No rain, 0, is the no-data value, so dry cells do not dilute their wet
    neighbours.  ``step`` keeps one time step, chosen before the grid is refined.
    """
    total, cut = accumulate_rain(rain, spec, start, end, extent, time)
    if step is not None:
        total = nth_step(total, step, time)
    return reproject(total, cut, WEB_MERCATOR, ["tp"], "bilinear", resolution=resolution, keys=[time], nodata=0.0)
