"""Datasets by name: where they are, what they hold, how to cut them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.functions.missing import drop_nan, mask_and_scale
from eocube.model import Extent, GridSpec
from eocube.operators.select import day_select, in_box


class Source(Protocol):
    """Anything that yields cells for an extent and a range of days."""

    def get(self, extent: Extent | None, start: dt.date | None, end: dt.date | None = None) -> DataFrame: ...


def with_attrs(df: DataFrame, column: str, attrs: dict) -> DataFrame:
    """Attach dataset attributes to a column; they live in the schema only."""
    return df.withMetadata(column, {**df.schema[column].metadata, **attrs})


def attrs_of(df: DataFrame, column: str) -> dict:
    return dict(df.schema[column].metadata)


@dataclass(frozen=True)
class CellSource:
    """A cell table with one variable, its grid and its time column.

    ``load`` returns the table; Spark pushes the variable selection, the time
    range and the index ranges of the extent into the scan. Cells keep the numbers
    of the dataset's grid.
    """

    load: Callable[[], DataFrame]
    variable: str
    spec: GridSpec | None = None
    time: str | None = None
    attrs: dict = field(default_factory=dict)
    packed: tuple[float, float, float] | None = None

    def get(self, extent: Extent | None = None, start=None, end=None) -> DataFrame:
        df = self.load()
        dims = [c for c in (self.time, "band", "location_id", "y_idx", "x_idx") if c in df.columns]
        df = df.select(*dims, self.variable)
        if self.time and start is not None:
            df = day_select(df, start, end, self.time)
        if extent is not None and self.spec is not None:
            df = in_box(df, self.spec, extent)
        if self.packed:
            df = df.withColumn(self.variable, mask_and_scale(F.col(self.variable), *self.packed))
        else:
            df = drop_nan(df, self.spec.nodata if self.spec else None)
        return with_attrs(df, self.variable, self.attrs) if self.attrs else df


class Catalog:
    """Sources by dataset name."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._sources: dict[str, Source] = {}

    def register(self, name: str, source: Source) -> Catalog:
        self._sources[name] = source
        return self

    def source(self, name: str) -> Source:
        if name not in self._sources:
            raise ValueError(f"unknown dataset {name!r}, known: {sorted(self._sources)}")
        return self._sources[name]

    def get(self, name: str, extent=None, start=None, end=None) -> DataFrame:
        return self.source(name).get(extent, start, end)

    def describe(self) -> DataFrame:
        """The catalogue as a table: one row per dataset with its attributes."""
        rows = []
        for name, s in sorted(self._sources.items()):
            attrs = {k: str(v) for k, v in getattr(s, "attrs", {}).items()}
            spec = getattr(s, "spec", None)
            rows.append((name, getattr(s, "variable", None), spec.crs if spec else None, attrs))
        return self.spark.createDataFrame(rows, "name string, variable string, crs string, attrs map<string,string>")


# The datasets by name, their variable and native attributes.
FLOOD = CellSource(None, "flood", time="day", attrs={"location": "central-site", "resolution": 20})
BUILT = CellSource(None, "built", attrs={"location": "central-site", "resolution": 10})
DEM = CellSource(None, "dem", attrs={"location": "central-site"}, packed=(-9999, 1.0, 0.0))
RAIN = CellSource(None, "tp", time="time", attrs={"location": "bridge"})
LANDCOVER = CellSource(None, "corine_lc", attrs={"location": "central-site"})
SWATH_SM = CellSource(None, "sm", time="time", attrs={"location": "central-site", "resolution": 20})
MODEL_SM = CellSource(None, "swvl1", time="time", attrs={"location": "bridge"})
GRIDDED_SM = CellSource(None, "SM", time="date", attrs={"location": "central-site"})


def open_at(dataset: CellSource, load: Callable[[], DataFrame], spec: GridSpec | None = None) -> CellSource:
    """A named dataset bound to the table it is stored in."""
    return replace(dataset, load=load, spec=spec)


def at_path(dataset: CellSource, spark: SparkSession, path: str, spec: GridSpec | None = None) -> CellSource:
    return open_at(dataset, lambda: spark.read.parquet(path), spec)


def find_flood(source: CellSource, day: dt.date, extent: Extent | None = None) -> DataFrame:
    return source.get(extent, day)


def find_built(source: CellSource, extent: Extent | None = None) -> DataFrame:
    return source.get(extent)


def find_dem(source: CellSource, extent: Extent | None = None) -> DataFrame:
    return source.get(extent)


def find_rain(source: CellSource, start, end, extent: Extent | None = None) -> DataFrame:
    return source.get(extent, start, end)


def find_landcover(source: CellSource, extent: Extent | None = None) -> DataFrame:
    return source.get(extent)


def find_swath_sm(source: CellSource, start, end) -> DataFrame:
    return source.get(None, start, end)


def find_model_sm(source: CellSource, start, end, extent: Extent | None = None) -> DataFrame:
    return source.get(extent, start, end)


def find_gridded_sm(source: CellSource, start=None, end=None, extent: Extent | None = None) -> DataFrame:
    return source.get(extent, start, end)
