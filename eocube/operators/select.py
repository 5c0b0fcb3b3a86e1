"""Projections, label slices, box crops and masks.

Boxes are rewritten to ranges of the integer index columns, so they prune
Parquet row groups instead of evaluating coordinates row by row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eocube.functions.missing import exceeds
from eocube.model import Extent, GridSpec

CELL = ("y_idx", "x_idx")

# Native cell size in metres by variable, and the common target.
NATIVE_RESOLUTION_M = {"flood": 20, "built": 10, "dem": 20, "landcover": 100}
TARGET_RESOLUTION_M = 500


def select_variable(df: DataFrame, name: str, dims: Sequence[str] = CELL) -> DataFrame:
    return df.select(*dims, name)


def squeeze(df: DataFrame, *dims: str) -> DataFrame:
    """Drop dimensions of length one; fails at run time if one is longer."""
    for dim in dims:
        ends = df.agg(F.min(dim).alias("lo"), F.max(dim).alias("hi"))
        same = ends.select(F.col("lo").eqNullSafe(F.col("hi"))).scalar()
        df = df.where(F.assert_true(same, F.lit(f"dimension {dim} is longer than one")).isNull()).drop(dim)
    return df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    absent = set(names) - set(df.columns)
    if absent:
        raise ValueError(f"no such columns: {sorted(absent)}")
    return df.withColumnsRenamed(dict(names))


def transpose(df: DataFrame, *dims: str) -> DataFrame:
    """Put the dimensions first, in this order; moves no data."""
    return df.select(*dims, *(c for c in df.columns if c not in dims))


def _bound(df: DataFrame, time: str, value) -> Column:
    """A literal of the time column's own type, so that the range is pushed down."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast(df.schema[time].dataType)


def time_slice(df: DataFrame, start, end, time: str = "time") -> DataFrame:
    """Rows from start to end, both included."""
    return df.where(F.col(time).between(_bound(df, time, start), _bound(df, time, end)))


def day_select(df: DataFrame, start: dt.date, end: dt.date | None = None, time: str = "time") -> DataFrame:
    """Rows of one day, or of the days from start to end, both included."""
    after = (start if end is None else end) + dt.timedelta(days=1)
    return df.where((F.col(time) >= _bound(df, time, start)) & (F.col(time) < _bound(df, time, after)))


def _on(spec: GridSpec, extent: Extent) -> Extent:
    return extent.to(spec.crs) if extent.crs and extent.crs != spec.crs else extent


def in_box(df: DataFrame, spec: GridSpec, extent: Extent) -> DataFrame:
    """Cells whose centre lies in a box of any reference system, still numbered on the whole grid."""
    y_lo, y_hi, x_lo, x_hi = spec.index_window(_on(spec, extent))
    return df.where(F.col("y_idx").between(y_lo, y_hi) & F.col("x_idx").between(x_lo, x_hi))


def bbox_slice(df: DataFrame, spec: GridSpec, extent: Extent) -> tuple[DataFrame, GridSpec]:
    """Cells whose centre label lies in the box, numbered on the cropped grid, and that grid."""
    y_lo, y_hi, x_lo, x_hi = window = spec.index_window(extent)
    inside = df.where(F.col("y_idx").between(y_lo, y_hi) & F.col("x_idx").between(x_lo, x_hi))
    moved = {c: F.col(c) - lo for c, lo in (("y_idx", y_lo), ("x_idx", x_lo)) if lo}
    return inside.withColumns(moved) if moved else inside, spec.window(*window)


def crop(spec: GridSpec, extent: Extent) -> GridSpec:
    """The grid that a crop by a box leaves."""
    return spec.window(*spec.index_window(_on(spec, extent)))


def clip_box(df: DataFrame, spec: GridSpec, extent: Extent) -> tuple[DataFrame, GridSpec]:
    """Crop by a box that may be given in another reference system; cells and the cropped grid."""
    return bbox_slice(df, spec, _on(spec, extent))


def mask_drop(df: DataFrame, x: Column, y: Column, extent: Extent) -> DataFrame:
    """Keep rows whose coordinates meet the four inclusive bounds."""
    return df.where(extent.contains(x, y))


def valid_location(df: DataFrame, column: str = "location_id") -> DataFrame:
    return df.where(F.col(column) > 0)


def index_select(df: DataFrame, **index) -> DataFrame:
    """Positional pick: an integer keeps that index, a pair a half-open range."""
    for name, at in index.items():
        c = F.col(name)
        df = df.where((c >= at[0]) & (c < at[1]) if isinstance(at, tuple) else c == at)
    return df


def threshold(df: DataFrame, column: str, limit: float, to: str) -> DataFrame:
    return df.withColumn(to, exceeds(F.col(column), limit))


def native_resolution(name: str) -> int:
    if name not in NATIVE_RESOLUTION_M:
        raise ValueError(f"no resolution known for variable {name!r}")
    return NATIVE_RESOLUTION_M[name]


def block_steps(resolution: int, target: int = TARGET_RESOLUTION_M) -> int:
    """Native cells per side of one target block."""
    return target // resolution


def resolution_of(name: Column) -> Column:
    """Column form of :func:`native_resolution`; an unknown name is an error."""
    known = F.create_map(*(F.lit(v) for kv in NATIVE_RESOLUTION_M.items() for v in kv))
    unknown = F.raise_error(F.concat(F.lit("no resolution known for variable "), name)).cast("int")
    return F.coalesce(F.try_element_at(known, name), unknown)
