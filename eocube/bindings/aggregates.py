"""Reductions over blocks, bands, days, bins and whole arrays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eocube.bindings import sqltext as q
from eocube.bindings.fixtures import BUILT, DEM, LANDCOVER, POLYGONS, SCENE
from eocube.bindings.joins import files_catalog
from eocube.bindings.registry import Tables, q6, query, r6, rounded
from eocube.operators import reduce as red
from eocube.operators.combine import mosaic, union_domains
from eocube.operators.ragged import longest_series, series_length
from eocube.operators.resample import resample_daily, resample_time
from eocube.operators.select import time_slice
from eocube.operators.tiles import distinct_tiles
from eocube.sources.vector import vertices_of


@query("coarsen_median_flag", q.coarse("fx_scene", "flood", 30, SCENE, q.flag("flood")))
def coarsen_median_flag(t: Tables):
    return red.coarsen(t.scene, SCENE, 30, "flag", "flood")[0]


@query("coarsen_mean", f"select y_idx, x_idx, {q6('built')} as built from ({q.coarse('fx_built', 'built', 50, BUILT, 'avg(s.built)')})")
def coarsen_mean(t: Tables):
    return rounded(red.coarsen(t.built, BUILT, 50, "mean", "built")[0], "built")


@query("coarsen_exact", f"select y_idx, x_idx, {q6('dem')} as dem from ({q.coarse('fx_dem', 'dem', 25, DEM, 'avg(s.dem)')})")
def coarsen_exact(t: Tables):
    return rounded(red.coarsen(t.dem, DEM, 25, "mean", "dem", boundary="exact")[0], "dem")


@query("coarsen_class_median", q.coarse("fx_landcover", "corine_lc", 5, LANDCOVER, "median(s.corine_lc)"))
def coarsen_class_median(t: Tables):
    return red.coarsen(t.landcover, LANDCOVER, 5, "median", "corine_lc")[0]


@query("global_reduce", f"""
    select case when median(flood) > 0 then 1e0 else 0e0 end as flag, {q6('avg(flood)')} as mean from fx_scene""")
def global_reduce(t: Tables):
    c = F.col("flood")
    return t.scene.agg(red.reducer("flag")(c).alias("flag"), r6(red.reducer("mean")(c), "mean"))


@query("global_median", f"select {q6('median(l_extendedprice)')} as median from lineitem")
def global_median(t: Tables):
    """Exact median of a whole column with many distinct values."""
    middle = red.exact_median(t.lineitem, "l_extendedprice", finish_rows=20_000)
    return t.spark.range(1).select(r6(F.lit(middle), "median"))


@query("composite_max", "select day, y_idx, x_idx, max(flood) as flood from fx_scene group by 1, 2, 3")
def composite_max(t: Tables):
    return red.composite_max(t.scene, "flood", ["day", "y_idx", "x_idx"])


@query("daily_sum", f"select day, y_idx, x_idx, {q6('coalesce(sum(tp), 0)')} as tp from fx_hourly group by 1, 2, 3")
def daily_sum(t: Tables):
    return rounded(red.daily_sum(t.hourly, "tp"), "tp")


@query("daily_mean_hours", f"select day, y_idx, x_idx, {q6('avg(tp)')} as tp from fx_hourly group by 1, 2, 3")
def daily_mean_hours(t: Tables):
    return rounded(red.daily_mean(t.hourly, "tp"), "tp")


def _bins(every: int) -> str:
    return f"select time, y_idx, x_idx, {q6('sm')} as sm from ({q.bins('fx_sm', 'y_idx,x_idx', 'sm', every)})"


@query("resample_1d_mean", _bins(1))
def resample_1d_mean(t: Tables):
    return rounded(resample_daily(t.sm, "sm"), "sm")


@query("resample_10d_mean", _bins(10))
def resample_10d_mean(t: Tables):
    return rounded(resample_time(t.sm, 10, "sm"), "sm")


@query("resample_15d_mean", _bins(15))
def resample_15d_mean(t: Tables):
    return rounded(resample_time(t.sm, 15, "sm"), "sm")


@query("global_minmax", f"select {q6('min(tp)')} as lo, {q6('max(tp)')} as hi from fx_tp")
def global_minmax(t: Tables):
    return rounded(red.min_max(t.tp, "tp"), "lo", "hi")


@query("normalize", f"""
    select day, y_idx, x_idx, {q6('tp')} as tp from ({q.stretched('select * from fx_tp', 'tp', 'day, y_idx, x_idx')})""")
def normalize(t: Tables):
    return rounded(red.normalize(t.tp, "tp"), "tp")


@query("total_bounds", f"""
    select {q6('min(lon)')} as min_x, {q6('min(lat)')} as min_y, {q6('max(lon)')} as max_x, {q6('max(lat)')} as max_y from fx_points""")
def total_bounds(t: Tables):
    corners = red.total_bounds(t.points.withColumnsRenamed({"lon": "x", "lat": "y"}))
    return rounded(corners, *corners.columns)


@query("distinct_tiles", r"""
    select distinct regexp_extract(path, 'EQUI7_([A-Z]{2})', 1) as grid_name, regexp_extract(path, '(E\d{3}N\d{3}T\d)', 1) as tile_name from fx_files""")
def distinct_tiles_(t: Tables):
    return distinct_tiles(files_catalog(t))


@query("series_length", """
    select p.location_id, count(o.location_id) as n from fx_points p left join
      (select * from fx_point_obs where time between timestamp '2024-01-05' and timestamp '2024-01-25') o on o.location_id = p.location_id
    group by 1""")
def series_length_(t: Tables):
    """Locations without observations count 0."""
    inside = time_slice(t.point_obs, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 25))
    return series_length(inside, locations=t.points)


@query("longest_series", """
    select location_id, n from (
      select s_suppkey as location_id, s_nationkey as file_id, (s_suppkey * 7) % 1000 as pos, count(l_suppkey) as n
      from supplier left join lineitem on l_suppkey = s_suppkey and l_quantity > 49 group by 1, 2, 3)
    order by n desc, file_id, pos, location_id limit 1""")
def longest_series_(t: Tables):
    """Of equally long series the first in the files' order, which is not that of the ids."""
    places = t.supplier.select(
        F.col("s_suppkey").alias("location_id"), F.col("s_nationkey").alias("file_id"), (F.col("s_suppkey") * 7 % 1000).alias("pos")
    )
    obs = t.lineitem.where("l_quantity > 49").select(F.col("l_suppkey").alias("location_id"))
    order = ("file_id", "pos", "location_id")
    lengths = series_length(obs, locations=places, order=order[:2])
    return longest_series(lengths, order=order).select("location_id", "n")


@query("mosaic", f"""
    select y_idx, x_idx, {q6('built')} as built from fx_built""")
def mosaic_(t: Tables):
    """The built-up raster cut into 250 x 100 tiles and put together again."""
    tiles = t.built.select(
        (F.floor(F.col("y_idx") / 250) * 250).alias("tile_y"), (F.floor(F.col("x_idx") / 100) * 100).alias("tile_x"),
        (F.col("y_idx") % 250).alias("y_idx"), (F.col("x_idx") % 100).alias("x_idx"), "built",
    )
    return rounded(mosaic(tiles, "built"), "built")


@query("union_domains", f"""
    select day, y_idx, x_idx, {q6('avg(v)')} as v from (
      select day, y_idx, x_idx, tp as v from fx_tp union all
      select cast(time as date), y_idx, x_idx, sm from fx_sm) group by 1, 2, 3""")
def union_domains_(t: Tables):
    rain = t.tp.withColumnRenamed("tp", "v")
    sm = t.sm.select(F.to_date("time").alias("day"), "y_idx", "x_idx", F.col("sm").alias("v"))
    return rounded(union_domains([rain, sm], "v"), "v")


@query("polygon_bounds", f"""
    select {min(x for r in POLYGONS for x, _ in r)}::double as min_x, {min(y for r in POLYGONS for _, y in r)}::double as min_y,
           {max(x for r in POLYGONS for x, _ in r)}::double as max_x, {max(y for r in POLYGONS for _, y in r)}::double as max_y,
           count(*) as cells from fx_scene
    where {q.center(SCENE, 'x', 'x_idx')} between {min(x for r in POLYGONS for x, _ in r)}::double and {max(x for r in POLYGONS for x, _ in r)}::double
      and {q.center(SCENE, 'y', 'y_idx')} between {min(y for r in POLYGONS for _, y in r)}::double and {max(y for r in POLYGONS for _, y in r)}::double""")
def polygon_bounds(t: Tables):
    """Cells inside the bounds of a polygon table, the bounds found by Spark."""
    ends = red.total_bounds(vertices_of(t.spark, POLYGONS))
    x, y = SCENE.center_x(F.col("x_idx")), SCENE.center_y(F.col("y_idx"))
    lo = {c: ends.select(c).scalar() for c in ("min_x", "min_y", "max_x", "max_y")}
    hit = t.scene.where(x.between(lo["min_x"], lo["max_x"]) & y.between(lo["min_y"], lo["max_y"]))
    return hit.agg(F.count(F.lit(1)).alias("cells")).select(*(lo[c].alias(c) for c in lo), "cells")
