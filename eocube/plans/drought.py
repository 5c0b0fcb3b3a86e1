"""Soil-moisture monitors and the preparation of their inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.functions.calendar import midnight
from eocube.functions.projection import EQUIDISTANT_EU, LONLAT, WEB_MERCATOR
from eocube.model import Extent, GridSpec
from eocube.operators.clip import clip_polygon
from eocube.operators.combine import mosaic, place_tiles, union_domains
from eocube.operators.nearest import select_nearest
from eocube.operators.overlay import LANDCOVER_CLASSES, class_label, major_class
from eocube.operators.ragged import align_to_axis, decode_ragged, ragged_offsets
from eocube.operators.reduce import coarsen, normalize
from eocube.operators.regrid import reproject
from eocube.operators.resample import resample_time
from eocube.operators.select import bbox_slice, block_steps, clip_box, native_resolution, time_slice, valid_location
from eocube.operators.swath import resample_points
from eocube.sources.archive import Opener
from eocube.sources.store import materialize

# The swath's target area, search radius and final crop.
SWATH_GRID = GridSpec(EQUIDISTANT_EU, 4_200_000.0, 6_500.0, 1_500_000.0, -6_500.0, 200, 200)
SWATH_RADIUS_M = 5_000.0
CLIP_BOX = Extent(7, 37, 18, 46.5, LONLAT)


def swath_drought(
    points: DataFrame,
    obs: DataFrame,
    *,
    grid: GridSpec = SWATH_GRID,
    radius: float = SWATH_RADIUS_M,
    box: Extent = CLIP_BOX,
    catchment: DataFrame | None = None,
    every_days: int = 10,
) -> tuple[DataFrame, GridSpec]:
    """10-day means of scattered soil moisture, gridded, stretched to 0..1."""
    means = resample_time(obs, every_days, "sm", keys=["location_id"])
    area = normalize(resample_points(points, means, grid, radius, ["sm"]), "sm")
    cells, dst = reproject(area, grid, WEB_MERCATOR, ["sm"], "bilinear", keys=["time"])
    if catchment is not None:
        cells = clip_polygon(cells, dst, catchment, ["sm"])
    return clip_box(cells, dst, box)


def model_drought(
    cube: DataFrame,
    spec: GridSpec,
    bounds: Extent,
    *,
    value: str = "swvl1",
    method: str = "nearest",
    every_days: int = 15,
) -> tuple[DataFrame, GridSpec]:
    """15-day means of modelled soil moisture inside a catchment's bounds."""
    inside, cut = bbox_slice(cube, spec, bounds)
    level = normalize(resample_time(inside, every_days, value), value)
    return reproject(level, cut, WEB_MERCATOR, [value], method, keys=["time"])


def gridded_drought(
    cube: DataFrame, spec: GridSpec, *, value: str = "SM", time: str = "date", every_days: int = 15
) -> tuple[DataFrame, GridSpec]:
    level = normalize(resample_time(cube, every_days, value, time=time), value)
    return reproject(level, spec, WEB_MERCATOR, [value], "bilinear", keys=[time])


def landcover_major(
    landcover: DataFrame, spec: GridSpec, *, method: str = "median", k: int | None = None
) -> tuple[DataFrame, GridSpec]:
    """Block median of the codes, reprojected, as labelled major classes."""
    k = k or block_steps(native_resolution("landcover"))
    blocks, coarse = coarsen(landcover, spec, k, method, "corine_lc")
    cells, dst = reproject(blocks, coarse, WEB_MERCATOR, ["corine_lc"])
    major = major_class(F.col("corine_lc"))
    return cells.withColumns({"major": major, "label": class_label(major, LANDCOVER_CLASSES)}), dst


def restructure_gridded(domains: list[DataFrame], value: str = "SM") -> DataFrame:
    """Unite domains, daily mean, canonical names and order."""
    daily = [d.withColumn("day", F.to_date("time")).drop("time") for d in domains]
    merged = union_domains(daily, value)
    return merged.select(midnight(F.col("day")).alias("date"), "y_idx", "x_idx", value)


def restructure_ragged(
    locations: DataFrame, obs: DataFrame, start, end, *, dense: bool = True
) -> DataFrame:
    """Ragged series as one table of locations on the longest series' time axis.

    ``locations`` is ``(file_id, pos, location_id, row_size, lat, lon)``.  Every
    valid location is in the result with its coordinates, without observations as
    missing values; ``dense=False`` lists the filled slots only.  Offsets are taken
    over all locations before the invalid ones go.  The
    decoded series are written once, since finding the longest one, its axis
    and the snapped values each read them.
    """
    offsets = ragged_offsets(locations)
    owned = valid_location(decode_ragged(offsets, obs))
    valid = valid_location(locations)
    series = materialize(time_slice(owned, start, end), "series")
    aligned = align_to_axis(series, locations=valid, order=("file_id", "pos"), dense=dense)
    places = valid.select("location_id", "lat", "lon").dropDuplicates(["location_id"])
    return aligned.join(places, "location_id").select("location_id", "lat", "lon", "time", "sm")


def restructure_landcover(
    open_files: Opener, files: DataFrame, spec: GridSpec, catchment: DataFrame, value: str = "corine_lc"
) -> tuple[DataFrame, GridSpec]:
    """Open and place the catalogue's tiles, mosaic, mask to the catchment, keep, reproject to longitude and latitude.

    ``files`` is the catalogue of either product; ``catchment`` is in the system of the tiles.
    """
    masked = clip_polygon(mosaic(place_tiles(open_files, files, spec), value), spec, catchment, [value])
    return reproject(materialize(masked, "landcover"), spec, LONLAT, [value])


def retro_compare(observed: DataFrame, model: DataFrame, time: str = "time") -> DataFrame:
    """The observed cube at the step nearest to each of the model's steps.

    Resampled cubes are small beside what they come from; the observed one is
    written once, since its time axis and its values both read it.
    """
    steps = model.select(F.col(time).alias("request")).distinct()
    return select_nearest(materialize(observed, "observed"), steps, time=time)
