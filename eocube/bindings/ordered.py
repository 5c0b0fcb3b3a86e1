"""Windows, orderings, top-k and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eocube.bindings import sqltext as q
from eocube.bindings.fixtures import DEM, RAIN
from eocube.bindings.joins import files_catalog
from eocube.bindings.registry import Tables, i64, q6, query, rounded
from eocube.model import Extent
from eocube.operators import combine, nearest
from eocube.operators.ragged import last_write_wins, ragged_offsets
from eocube.operators.resample import resample_time
from eocube.operators.running import accumulate
from eocube.operators.terrain import hillshade
from eocube.operators.tiles import sorted_tiles
from eocube.plans.flood import accumulate_rain
from eocube.sources.store import missing_days

#: Rows 1 to 29 and columns 1 to 39 of the rain grid.
RAIN_BOX = Extent(65.12, 28.02, 68.98, 30.88, "EPSG:4326")
IN_RAIN_BOX = "65e0 + 0.1e0 * (x_idx + 0.5e0) between 65.12e0 and 68.98e0 and 31e0 - 0.1e0 * (y_idx + 0.5e0) between 28.02e0 and 30.88e0"
RAIN_START, RAIN_END = dt.date(2024, 1, 8), dt.date(2024, 1, 20)
ACCUMULATED = f"""
    select day, y_idx - 1 as y_idx, x_idx - 1 as x_idx, sum(coalesce(tp, 0)) over (partition by y_idx, x_idx order by day) * 1000 as tp from fx_tp
    where day between date '2024-01-08' and date '2024-01-20'
      and {IN_RAIN_BOX}"""


@query("accumulate_rain", f"select day, y_idx, x_idx, {q6('tp')} as tp from ({ACCUMULATED})")
def accumulate_rain_(t: Tables):
    return rounded(accumulate_rain(t.tp, RAIN, RAIN_START, RAIN_END, RAIN_BOX, "day")[0], "tp")


@query("accumulate_strict", f"""
    select day, y_idx, x_idx, {q6('''case when not bool_or(tp is null) over (partition by y_idx, x_idx order by day)
           then sum(tp * 1000) over (partition by y_idx, x_idx order by day) end''')} as tp from fx_tp""")
def accumulate_strict(t: Tables):
    """Running sum that a missing step ends."""
    return rounded(accumulate(t.tp, "tp", time="day", skipna=False), "tp")


_OFFSETS = """
    select file_id, pos, location_id, row_size, cast(sum(row_size) over (partition by file_id order by pos) as bigint) as cum_sum from fx_ragged_loc"""


@query("ragged_cumsum", _OFFSETS)
def ragged_cumsum(t: Tables):
    return ragged_offsets(t.ragged_loc).select("file_id", "pos", "location_id", "row_size", "cum_sum")


@query("ragged_offset", f"""
    select file_id, pos, location_id, coalesce(lag(cum_sum) over (partition by file_id order by pos), 0) as "offset" from ({_OFFSETS})""")
def ragged_offset(t: Tables):
    return ragged_offsets(t.ragged_loc).select("file_id", "pos", "location_id", "offset")


@query("last_write_wins", """
    select user_id as location_id, cast(ts as date) as slot, max_by(value, event_id) as sm from events group by 1, 2""")
def last_write_wins_(t: Tables):
    writes = t.events.select(
        F.col("user_id").alias("location_id"), F.to_date("ts").alias("slot"),
        F.col("event_id").alias("obs_idx"), F.col("value").alias("sm"),
    )
    return last_write_wins(writes, "sm", "location_id", "slot")


@query("hillshade", f"""
    with z as (select y_idx, x_idx, dem * 0.001e0 as z from fx_dem),
    g as (select y_idx, x_idx,
            case when x_idx = 0 then lead(z) over r - z when x_idx = 99 then z - lag(z) over r else (lead(z) over r - lag(z) over r) / 2 end as gx,
            -(case when y_idx = 0 then lead(z) over c - z when y_idx = 99 then z - lag(z) over c else (lead(z) over c - lag(z) over c) / 2 end) as gy
          from z window r as (partition by y_idx order by x_idx), c as (partition by x_idx order by y_idx)),
    i as (select y_idx, x_idx, (-gx * cos(radians(-225e0)) * cos(radians(45e0)) - gy * sin(radians(-225e0)) * cos(radians(45e0)) + sin(radians(45e0)))
                 / sqrt(gx * gx + gy * gy + 1) as s from g)
    select y_idx, x_idx, {q6('(s - (select min(s) from i)) / ((select max(s) from i) - (select min(s) from i))')} as shade from i""")
def hillshade_(t: Tables):
    return rounded(hillshade(t.dem, DEM), "shade")


@query("first_index_of", """
    with axis as (select time, row_number() over (order by time) - 1 as index from (select distinct cast(cast(ts as date) as timestamp) as time from events)),
    asked as (select distinct o_orderdate + interval 9000 day as request from orders)
    select request, time, index from asked, axis
    qualify row_number() over (partition by request order by abs(epoch_us(request) - epoch_us(time)), time desc) = 1""")
def first_index_of(t: Tables):
    """Order dates moved to the events' year, looked up on the events' day axis."""
    axis = t.events.select(F.to_date("ts").cast("timestamp_ntz").alias("time")).distinct()
    asked = t.orders.select((F.col("o_orderdate") + F.expr("interval 9000 days")).alias("request")).distinct()
    return i64(nearest.first_index_of(axis, asked).select("request", "time", "index"), "index")


@query("sort_time", f"""
    select day, y_idx, x_idx, {q6('tp')} as tp from fx_tp order by day, y_idx, x_idx""")
def sort_time(t: Tables):
    return rounded(t.tp, "tp").orderBy("day", "y_idx", "x_idx")


@query("sorted_tiles", r"""
    select grid_name, string_agg(tile_name, ',' order by tile_name) as tiles from (
      select distinct regexp_extract(path, 'EQUI7_([A-Z]{2})', 1) as grid_name, regexp_extract(path, '(E\d{3}N\d{3}T\d)', 1) as tile_name from fx_files) group by 1""")
def sorted_tiles_(t: Tables):
    return sorted_tiles(files_catalog(t)).select("grid_name", F.array_join("tiles", ",").alias("tiles"))


_CUBE = q.bins("fx_sm", "y_idx,x_idx", "sm", 10)


@query("first_step", f"""
    with cube as ({_CUBE}) select time, y_idx, x_idx, {q6('sm')} as sm from cube where time = (select min(time) from cube)""")
def first_step(t: Tables):
    return rounded(nearest.first_step(resample_time(t.sm, 10, "sm")), "sm")


@query("nth_step", f"""
    with cube as ({ACCUMULATED}) select day, y_idx, x_idx, {q6('tp')} as tp from cube
    where day = (select day from (select distinct day from cube) order by day limit 1 offset 12)""")
def nth_step(t: Tables):
    total, _ = accumulate_rain(t.tp, RAIN, RAIN_START, RAIN_END, RAIN_BOX, "day")
    return rounded(nearest.nth_step(total, 12, "day"), "tp")


@query("time_axis", "select distinct cast(time as date) as day from fx_sm order by 1")
def time_axis(t: Tables):
    return nearest.step_dates(t.sm)


@query("concat_time", f"""
    select day, y_idx, x_idx, {q6('tp')} as tp from fx_tp""")
def concat_time(t: Tables):
    """Two halves of the calendar stacked again."""
    early, late = t.tp.where(F.col("day") <= "2024-01-15"), t.tp.where(F.col("day") > "2024-01-15")
    return rounded(combine.concat([early, late]), "tp")


@query("union_locations", f"""
    select location_id, {q6('lat')} as lat, {q6('lon')} as lon from fx_points""")
def union_locations(t: Tables):
    """Location lists of three longitude strips appended to one."""
    lon = F.col("lon")
    strips = [t.points.where(c) for c in (lon < 10, (lon >= 10) & (lon < 14), lon >= 14)]
    return rounded(combine.concat(strips).select("location_id", "lat", "lon"), "lat", "lon")


@query("day_difference", """
    select distinct cast(ts as date) as day from events except select day from fx_coverage where covered = 1""")
def day_difference(t: Tables):
    return missing_days(t.events.select(F.to_date("ts").alias("day")).distinct(), t.coverage)
