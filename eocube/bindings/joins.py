"""Joins: overlays, regridding, swaths, polygons, nearest time, ragged series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eocube.bindings import sqltext as q
from eocube.bindings.fixtures import BUILT, POLYGONS, RAIN, SCENE
from eocube.bindings.registry import Tables, q6, query, r6, rounded
from eocube.functions.projection import WEB_MERCATOR
from eocube.functions.text import scene_name
from eocube.model import Extent
from eocube.operators import combine, overlay, regrid, swath
from eocube.operators.clip import clip_polygon
from eocube.operators.nearest import select_nearest
from eocube.operators.ragged import align_to_axis, decode_ragged, ragged_offsets
from eocube.operators.reduce import coarsen, composite_max
from eocube.operators.resample import resample_time
from eocube.operators.tiles import tile_semi_join, tile_table
from eocube.plans.drought import SWATH_GRID
from eocube.sources.store import calendar, materialize, missing_days
from eocube.sources.vector import vertices_of

FLAGS = q.coarse("fx_scene", "flood", 25, SCENE, q.flag("flood"))
MEANS = q.coarse("fx_built", "built", 50, BUILT, "avg(s.built)")
RAIN_MERC = RAIN.project(WEB_MERCATOR)
COARSE_MERC = SCENE.coarsen(25).project(WEB_MERCATOR)


def _blocks(t: Tables):
    flags, fs = coarsen(t.scene, SCENE, 25, "flag", "flood")
    means, bs = coarsen(t.built, BUILT, 50, "mean", "built")
    return flags, fs, means, bs


@query("overlay_classes", f"""
    select f.y_idx, f.x_idx, greatest(f.flood, case when coalesce(b.built > 10, false) then 2e0 else 0e0 end) as class
    from ({FLAGS}) f left join ({MEANS}) b on f.y_idx = b.y_idx and f.x_idx = b.x_idx""")
def overlay_classes(t: Tables):
    flags, _, means, _ = _blocks(t)
    return overlay.overlay_flood_built(flags, means)


@query("reproject_match", f"""
    with means as ({MEANS})
    select y_idx, x_idx, {q6('built')} as built from ({q.nearest(q.mercator_lookup(BUILT.coarsen(50), COARSE_MERC), 'means', '', 'built')})""")
def reproject_match(t: Tables):
    _, fs, means, bs = _blocks(t)
    return rounded(regrid.regrid(means, bs, fs.project(WEB_MERCATOR), ["built"]), "built")


@query("regrid_nearest", f"""
    select day, y_idx, x_idx, {q6('tp')} as tp from ({q.nearest(q.mercator_lookup(RAIN, RAIN_MERC), 'fx_tp', 'day', 'tp')})""")
def regrid_nearest(t: Tables):
    cells, _ = regrid.reproject(t.tp, RAIN, WEB_MERCATOR, ["tp"], keys=["day"])
    return rounded(cells, "tp")


@query("regrid_bilinear", f"""
    select day, y_idx, x_idx, {q6('tp')} as tp from ({q.bilinear(q.mercator_lookup(RAIN, RAIN_MERC), 'fx_tp', 'day', 'tp')})""")
def regrid_bilinear(t: Tables):
    cells, _ = regrid.reproject(t.tp, RAIN, WEB_MERCATOR, ["tp"], "bilinear", keys=["day"])
    return rounded(cells, "tp")


def haversine_sql(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    a = (
        f"(pow(sin(radians({lat_b} - {lat_a}) / 2), 2) + cos(radians({lat_a})) * cos(radians({lat_b}))"
        f" * pow(sin(radians({lon_b} - {lon_a}) / 2), 2))"
    )
    return f"(2 * 6371e3 * atan2(sqrt({a}), sqrt(1 - {a})))"


_CENTRES = q.aeqd_inverse(
    f"select y_idx, x_idx, {q.center(SWATH_GRID, 'x', 'x_idx')} as east, {q.center(SWATH_GRID, 'y', 'y_idx')} as north from ({q.cells(SWATH_GRID)})"
)
NEAREST_POINTS = f"""
    select y_idx, x_idx, location_id, d as distance from (
      select c.y_idx, c.x_idx, p.location_id, {haversine_sql('p.lat', 'p.lon', 'c.lat', 'c.lon')} as d
      from ({_CENTRES}) c
      join fx_points p on p.lat between c.lat - 0.05e0 and c.lat + 0.05e0)
    where d <= 5000e0
    qualify row_number() over (partition by y_idx, x_idx order by d, location_id) = 1"""


@query("swath_nearest", f"select y_idx, x_idx, location_id, {q6('distance / 1000', 3)} as km from ({NEAREST_POINTS})")
def swath_nearest(t: Tables):
    near = swath.nearest_points(t.points, SWATH_GRID, 5_000.0)
    return near.select("y_idx", "x_idx", "location_id", r6(F.col("distance") / 1000, "km", 3))


_INSIDE = q.inside(POLYGONS, q.center(SCENE, "x", "x_idx"), q.center(SCENE, "y", "y_idx"))


@query("polygon_clip", f"""
    select y_idx, x_idx, case when {_INSIDE} then flood end as flood
    from (select y_idx, x_idx, max(flood) as flood from fx_scene group by 1, 2)""")
def polygon_clip(t: Tables):
    return clip_polygon(composite_max(t.scene, "flood"), SCENE, vertices_of(t.spark, POLYGONS), ["flood"])


#: A box in longitude and latitude that reaches into both grids.
TILE_BOX = Extent(15, 15, 75, 60, "EPSG:4326")


def files_catalog(t: Tables):
    return t.files.select("s_suppkey", "path", scene_name(F.col("path")).alias("f")).select("s_suppkey", "path", "f.*")


@query("tile_semi_join", r"""
    select path, grid_name, tile_name from (
      select path, regexp_extract(path, 'EQUI7_([A-Z]{2})', 1) as grid_name, regexp_extract(path, '(E\d{3}N\d{3}T\d)', 1) as tile_name,
             1e5 * cast(regexp_extract(path, 'E(\d{3})N\d{3}T', 1) as double) as x0, 1e5 * cast(regexp_extract(path, 'E\d{3}N(\d{3})T', 1) as double) as y0
      from fx_files)
    where (grid_name = 'AS' and x0 < 3284415 and x0 + 300000 > -3624423 and y0 < 8520154 and y0 + 300000 > 1480241)
       or (grid_name = 'EU' and x0 < 11450168 and x0 + 300000 > 4796197 and y0 < 3917224 and y0 + 300000 > -2094214)""")
def tile_semi_join_(t: Tables):
    files = files_catalog(t)
    return tile_semi_join(files, tile_table(files), TILE_BOX).select("path", "grid_name", "tile_name")


_TEN_DAYS = q.bins("fx_sm", "y_idx,x_idx", "sm", 10)


@query("nearest_time", f"""
    with cube as ({_TEN_DAYS}), axis as (select distinct time from cube),
    asked as (select distinct cast(cast(ts as date) as timestamp) + interval 15 hour as request from events),
    hit as (select request, time from asked, axis
            qualify row_number() over (partition by request order by abs(epoch_us(request) - epoch_us(time)), time desc) = 1)
    select h.request, c.time, c.y_idx, c.x_idx, {q6('c.sm')} as sm from hit h join cube c on c.time = h.time""")
def nearest_time(t: Tables):
    cube = materialize(resample_time(t.sm, 10, "sm"), "means")
    asked = t.events.select(
        (F.to_date("ts").cast("timestamp_ntz") + F.expr("interval 15 hours")).alias("request")
    ).distinct()
    return rounded(select_nearest(cube, asked).select("request", "time", "y_idx", "x_idx", "sm"), "sm")


@query("missing_days", """
    select cast(d as date) as day from range(date '2024-01-01', date '2024-02-06', interval 1 day) r(d)
    where cast(d as date) not in (select day from fx_coverage where covered = 1)""")
def missing_days_(t: Tables):
    return missing_days(calendar(t.spark, dt.date(2024, 1, 1), dt.date(2024, 2, 5)), t.coverage)




def aligned(series: str, longest: str = "") -> str:
    """Series on the longest one's axis, by comparing every time with every label."""
    longest = longest or f"select location_id from (select location_id, count(*) as n from {series} group by 1) order by n desc, location_id limit 1"
    return f"""
      select location_id, s.label as time, max_by(sm, obs_idx) as sm
      from {series} o join (
        select time, label from (select distinct time from {series}),
          (select distinct date_trunc('minute', time) as label from {series} where location_id = ({longest}))
        qualify row_number() over (partition by time order by abs(epoch_us(time) - epoch_us(label)), label desc) = 1) s on s.time = o.time
      group by 1, 2"""


@query("align_to_axis", f"""
    with series as (select user_id as location_id, ts as time, value as sm, event_id as obs_idx from events)
    {aligned('series')}""")
def align_to_axis_(t: Tables):
    return align_to_axis(
        t.events.select(
            F.col("user_id").alias("location_id"), F.col("ts").alias("time"),
            F.col("value").alias("sm"), F.col("event_id").alias("obs_idx"),
        )
    )


@query("ragged_decode", """
    select file_id, location_id, time, sm, cast(obs_idx as bigint) as obs_idx from fx_ragged_owner""")
def ragged_decode(t: Tables):
    """Owners found from offsets alone; the view with owners is the check."""
    return decode_ragged(ragged_offsets(t.ragged_loc), t.ragged_obs)


@query("outer_align", f"""
    with a as (select day, y_idx, x_idx, tp from fx_tp),
    b as (select cast(time as date) as day, y_idx, x_idx, avg(sm) as sm from fx_sm where sm is not null group by 1, 2, 3)
    select coalesce(a.day, b.day) as day, coalesce(a.y_idx, b.y_idx) as y_idx, coalesce(a.x_idx, b.x_idx) as x_idx,
           {q6('tp')} as tp, {q6('sm')} as sm
    from a full join b on a.day = b.day and a.y_idx = b.y_idx and a.x_idx = b.x_idx""")
def outer_align(t: Tables):
    valid = t.sm.where(F.col("sm").isNotNull()).withColumn("day", F.to_date("time"))
    sm = valid.groupBy("day", "y_idx", "x_idx").agg(F.avg("sm").alias("sm"))
    return rounded(combine.outer_align({"tp": t.tp, "sm": sm}, ["day", "y_idx", "x_idx"]), "tp", "sm")


@query("scalar_broadcast", f"""
    select day, y_idx, x_idx, {q6('tp - (select avg(tp) from fx_tp)')} as anomaly from fx_tp""")
def scalar_broadcast(t: Tables):
    rain = t.tp
    mean = rain.agg(F.avg("tp")).scalar()
    return rain.select("day", "y_idx", "x_idx", r6(F.col("tp") - mean, "anomaly"))


@query("class_labels", """
    select case flood when 0 then 'non-flooded' when 1 then 'flooded' end as label, count(*) as cells from fx_scene group by 1""")
def class_labels(t: Tables):
    label = overlay.class_label(F.col("flood"), overlay.FLOOD_CLASSES)
    return t.scene.select(label.alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("cells"))


@query("meshgrid", f"""
    select g.y_idx, g.x_idx, count(t.day) as days, {q6('coalesce(sum(t.tp), 0)')} as total
    from ({q.cells(RAIN)}) g left join fx_tp t on t.y_idx = g.y_idx and t.x_idx = g.x_idx group by 1, 2""")
def meshgrid(t: Tables):
    """Every pair of the two axes, with what the cube holds there."""
    pairs = combine.meshgrid(t.spark, RAIN.ny, RAIN.nx)
    stacked = combine.concat([pairs, t.tp])
    return stacked.groupBy("y_idx", "x_idx").agg(
        F.count("day").alias("days"), r6(F.coalesce(F.sum("tp"), F.lit(0.0)), "total")
    )
