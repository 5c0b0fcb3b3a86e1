"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eocube.bindings.fixtures import RAIN, SCENE
from eocube.bindings.registry import Tables, i64, q6, query, r6, rounded
from eocube.functions.missing import constant_like
from eocube.model import Extent
from eocube.operators import select as sel
from eocube.operators.ragged import ragged_offsets
from eocube.sources.store import uncovered


@query("select_variable", f"select y_idx, x_idx, {q6('tp')} as tp from fx_tp")
def select_variable(t: Tables):
    return rounded(sel.select_variable(t.tp, "tp"), "tp")


@query("squeeze", "select day, y_idx, x_idx, flood from fx_scene where band = 3")
def squeeze(t: Tables):
    return sel.squeeze(t.scene.where(F.col("band") == 3), "band")


@query("rename", f'select time, y_idx as latitude, x_idx as longitude, {q6("sm")} as "SM" from fx_sm')
def rename(t: Tables):
    return rounded(sel.rename(t.sm, {"y_idx": "latitude", "x_idx": "longitude", "sm": "SM"}), "SM")


@query("transpose", "select band, y_idx, x_idx, day, flood from fx_scene")
def transpose(t: Tables):
    return sel.transpose(t.scene, "band", "y_idx", "x_idx")


@query("time_slice", f"""
    select time, y_idx, x_idx, {q6('sm')} as sm from fx_sm
    where time between timestamp '2024-01-08 06:00:00' and timestamp '2024-01-20 18:30:00'""")
def time_slice(t: Tables):
    return rounded(sel.time_slice(t.sm, dt.datetime(2024, 1, 8, 6), dt.datetime(2024, 1, 20, 18, 30)), "sm")


@query("day_select", f"""
    select time, y_idx, x_idx, {q6('sm')} as sm from fx_sm where cast(time as date) = date '2024-01-17'""")
def day_select(t: Tables):
    return rounded(sel.day_select(t.sm, dt.date(2024, 1, 17)), "sm")


@query("bbox_slice", f"""
    select day, y_idx - 1 as y_idx, x_idx - 2 as x_idx, {q6('tp')} as tp from fx_tp
    where 65e0 + 0.1e0 * (x_idx + 0.5e0) between 65.22e0 and 66.08e0 and 31e0 - 0.1e0 * (y_idx + 0.5e0) between 30.12e0 and 30.93e0""")
def bbox_slice(t: Tables):
    return rounded(sel.bbox_slice(t.tp, RAIN, Extent(65.22, 30.93, 66.08, 30.12))[0], "tp")


@query("clip_box", """
    select day, band, y_idx - 129 as y_idx, x_idx - 29 as x_idx, flood from fx_scene
    where 65e0 + 0.02e0 * (x_idx + 0.5e0) between degrees(7301000e0 / 6378137e0) and degrees(7502000e0 / 6378137e0)
      and 31e0 - 0.02e0 * (y_idx + 0.5e0) between degrees(2 * atan(exp(2801000e0 / 6378137e0)) - pi() / 2)
                                              and degrees(2 * atan(exp(3302000e0 / 6378137e0)) - pi() / 2)""")
def clip_box(t: Tables):
    return sel.clip_box(t.scene, SCENE, Extent(7301000, 2801000, 7502000, 3302000, "EPSG:3857"))[0]


@query("mask_drop", f"""
    select location_id, {q6('lon')} as lon, {q6('lat')} as lat from fx_points
    where lon >= 8.125e0 and lon <= 14.375e0 and lat >= 38.505e0 and lat <= 43.995e0""")
def mask_drop(t: Tables):
    return rounded(sel.mask_drop(t.points, F.col("lon"), F.col("lat"), Extent(8.125, 38.505, 14.375, 43.995)), "lon", "lat")


@query("valid_location", """
    select file_id, location_id, row_size, cum_sum, cum_sum - row_size as "offset" from (
      select *, cast(sum(row_size) over (partition by file_id order by pos) as bigint) as cum_sum from fx_ragged_loc)
    where location_id > 0""")
def valid_location(t: Tables):
    return sel.valid_location(ragged_offsets(t.ragged_loc)).select("file_id", "location_id", "row_size", "cum_sum", "offset")


@query("uncovered_filter", "select day, cast(covered as bigint) as covered from fx_coverage where covered <> 1")
def uncovered_filter(t: Tables):
    return i64(uncovered(t.coverage), "covered")


@query("index_select", """
    select day, band, y_idx, x_idx, flood from fx_scene where band = 1 and y_idx >= 20 and y_idx < 140""")
def index_select(t: Tables):
    return sel.index_select(t.scene, band=1, y_idx=(20, 140))


@query("threshold", f"""
    select y_idx, x_idx, {q6('built')} as built, coalesce(built > 10, false) as is_built from fx_built""")
def threshold(t: Tables):
    return rounded(sel.threshold(t.built, "built", 10, "is_built"), "built")


@query("cast", f"""
    select location_id, time, {q6('cast(sm as float)')} as sm, cast(cast(floor(sm * 10) as tinyint) as bigint) as tenth from fx_point_obs""")
def cast(t: Tables):
    return t.point_obs.select(
        "location_id", "time", r6(F.col("sm").cast("float"), "sm"),
        F.floor(F.col("sm") * 10).cast("tinyint").cast("bigint").alias("tenth"),
    )


@query("constant_grid", "select y_idx, x_idx, 0e0 as built, cast(null as double) as empty from fx_built")
def constant_grid(t: Tables):
    zeros = constant_like(t.built, ["built"])
    return constant_like(zeros, ["empty"], None)


@query("resolution_lookup", """
    select name, cast(res as bigint) as resolution, cast(floor(500 / res) as bigint) as steps, count(*) as parts from (
      select case p_size % 3 when 0 then 'flood' when 1 then 'built' else 'landcover' end as name,
             case p_size % 3 when 0 then 20 when 1 then 10 else 100 end as res from part) group by all""")
def resolution_lookup(t: Tables):
    name = F.when(F.col("p_size") % 3 == 0, "flood").when(F.col("p_size") % 3 == 1, "built").otherwise("landcover")
    known = t.part.select(name.alias("name")).withColumn("resolution", sel.resolution_of(F.col("name")).cast("bigint"))
    steps = F.floor(F.lit(sel.TARGET_RESOLUTION_M) / F.col("resolution"))
    return known.groupBy("name", "resolution", steps.alias("steps")).agg(F.count(F.lit(1)).alias("parts"))


@query("index_by_time", """
    select l_orderkey as location_id, l_shipdate as time, l_quantity as sm from lineitem
    where l_shipdate between timestamp '1997-03-01' and timestamp '1997-08-31'""")
def index_by_time(t: Tables):
    """Time is a column already, so a series is sliced by it without an index."""
    series = t.lineitem.select(
        F.col("l_orderkey").alias("location_id"), F.col("l_shipdate").alias("time"), F.col("l_quantity").alias("sm")
    )
    return sel.time_slice(series, dt.datetime(1997, 3, 1), dt.datetime(1997, 8, 31))
