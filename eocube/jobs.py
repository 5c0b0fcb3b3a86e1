"""Batch jobs: ``spark-submit`` this file with a job name and its folders.

Inputs are Parquet cell tables, those of an archive one file or folder per scene under its
name; rasters, swaths and polygons in other formats
are converted to those (and to GeoJSON) before they get here.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from eocube.functions.projection import LONLAT
from eocube.model import Extent, GridSpec
from eocube.functions.text import CCI_LEVELS, DEM_LEVELS, FLOOD_LEVELS, LANDCOVER_LEVELS, cci_name, landcover_name, scene_name
from eocube.operators.tiles import tile_table
from eocube.plans import drought, flood as flood_plans, ingest
from eocube.sources.archive import catalogue, opener
from eocube.sources.store import calendar, write_cube
from eocube.sources.vector import read_geojson

CELLS = "y_idx bigint, x_idx bigint"


def _extent(text: str) -> Extent:
    return Extent.parse(text)


def flood(spark, source, target, spec: GridSpec, extent: str, day: dt.date, land: str, crs: str = LONLAT) -> None:
    """One day's files of the archive that meet the extent: crop, take the maximum, reproject, blank the sea.

    ``source`` is the folder of the archive: it is listed, and the chosen files are opened.
    """
    files = catalogue(spark, source, scene_name, FLOOD_LEVELS)
    cells = opener(spark, f"{CELLS}, flood double")
    scene, cut = flood_plans.flood_scene(files, tile_table(files), cells, spec, _extent(extent), day)
    write_cube(flood_plans.restructure_flood(scene, cut, read_geojson(spark, land), crs)[0], target)


def built(spark, source, target, spec: GridSpec, extent: str, crs: str = LONLAT) -> None:
    write_cube(flood_plans.restructure_built(spark.read.parquet(source), spec, _extent(extent), crs)[0], target)


def dem(spark, source, target, spec: GridSpec, crs: str = LONLAT) -> None:
    """The tiles of the height model below the folder, by their names."""
    files = catalogue(spark, source, scene_name, DEM_LEVELS)
    write_cube(flood_plans.restructure_dem(opener(spark, f"{CELLS}, dem double"), files, spec, crs)[0], target)


def gridded(spark, sources: list[str], target) -> None:
    write_cube(drought.restructure_gridded([spark.read.parquet(s) for s in sources]), target)


def ragged(spark, locations, obs, target, start: dt.datetime, end: dt.datetime) -> None:
    # locations: file_id, pos (place in the file), location_id, row_size, lat, lon
    out = drought.restructure_ragged(spark.read.parquet(locations), spark.read.parquet(obs), start, end)
    out.sortWithinPartitions("location_id", "time").write.parquet(target)


def landcover(
    spark, source, target, spec: GridSpec, catchment: str, value: str = "corine_lc", product: str = "corine"
) -> None:
    """Corine or CCI: the files of the product below the folder, by their names."""
    names = {"corine": (landcover_name, LANDCOVER_LEVELS), "cci": (cci_name, CCI_LEVELS)}[product]
    files = catalogue(spark, source, *names)
    tiles = opener(spark, f"{CELLS}, {value} double")
    cells, _ = drought.restructure_landcover(tiles, files, spec, read_geojson(spark, catchment), value)
    write_cube(cells, target)


def retrieve(spark, landing, target, value: str, start: dt.date, end: dt.date) -> None:
    """Store the uncovered days between two dates."""
    ingest.fill_days(spark, target, spark.read.parquet(landing), value, calendar(spark, start, end))


def _spec(text: str) -> GridSpec:
    """``crs;x0;dx;y0;dy;nx;ny``"""
    crs, x0, dx, y0, dy, nx, ny = text.split(";")
    return GridSpec(crs, float(x0), float(dx), float(y0), float(dy), int(nx), int(ny))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["flood", "built", "dem", "gridded", "ragged", "landcover", "retrieve"])
    parser.add_argument("source", help="input folder; several separated by commas for 'gridded' and 'ragged'")
    parser.add_argument("target", help="output folder")
    parser.add_argument("--grid", type=_spec, help="crs;x0;dx;y0;dy;nx;ny of the input")
    parser.add_argument("--extent", help="min_x, min_y, max_x, max_y[, crs]")
    parser.add_argument("--crs", default=LONLAT)
    parser.add_argument("--polygons", help="GeoJSON of land or catchment")
    parser.add_argument("--value", default="corine_lc")
    parser.add_argument("--product", choices=["corine", "cci"], default="corine")
    parser.add_argument("--start", type=dt.date.fromisoformat)
    parser.add_argument("--end", type=dt.date.fromisoformat)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"eocube-{a.job}").getOrCreate()
    end_of = lambda d: dt.datetime.combine(d, dt.time(23, 59, 59))
    runs = {
        "flood": lambda: flood(spark, a.source, a.target, a.grid, a.extent, a.start, a.polygons, a.crs),
        "built": lambda: built(spark, a.source, a.target, a.grid, a.extent, a.crs),
        "dem": lambda: dem(spark, a.source, a.target, a.grid, a.crs),
        "gridded": lambda: gridded(spark, a.source.split(","), a.target),
        "ragged": lambda: ragged(
            spark, *a.source.split(","), a.target, dt.datetime.combine(a.start, dt.time()), end_of(a.end)
        ),
        "landcover": lambda: landcover(spark, a.source, a.target, a.grid, a.polygons, a.value, a.product),
        "retrieve": lambda: retrieve(spark, a.source, a.target, a.value, a.start, a.end or a.start),
    }
    runs[a.job]()


if __name__ == "__main__":
    main()
