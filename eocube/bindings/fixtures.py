"""Raster, swath and ragged views over the given tables.

The texts run unchanged in Spark and in the checking engine; ``{name}`` stands
for a table or another view.  Odd divisors keep means of decimal values off the
exact halves that two engines may round apart.  Views in ``SPARK_VIEWS`` have a Spark form of
their own where plain SQL would put one long group into one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eocube.functions.projection import LONLAT
from eocube.model import GridSpec

SCENE = GridSpec(LONLAT, 65.0, 0.02, 31.0, -0.02, 200, 500)
BUILT = GridSpec(LONLAT, 65.0, 0.01, 31.0, -0.01, 400, 1000)
RAIN = GridSpec(LONLAT, 65.0, 0.1, 31.0, -0.1, 60, 100)
DEM = GridSpec(LONLAT, 65.0, 0.02, 31.0, -0.02, 100, 100)
LANDCOVER = GridSpec(LONLAT, 6.0, 0.02, 47.0, -0.02, 200, 500)

#: Users as cells of the rain grid: 12 columns first, then 100 rows, then the
#: next 12 columns.
_CELL = (
    "cast(floor(user_id / 12e0) as bigint) % 100 as y_idx, "
    "user_id % 12 + 12 * (cast(floor(user_id / 1200e0) as bigint) % 5) as x_idx"
)

VIEWS: dict[str, str] = {
    # Overlapping flood scenes of two days; two blocks of 25 x 25 have no valid value.
    "scene": """
        select case when l_linestatus = 'F' then date '2022-08-18' else date '2022-08-30' end as day,
               cast(l_linenumber as bigint) as band, l_orderkey % 500 as y_idx, l_partkey % 200 as x_idx,
               case when l_discount = 0 or (l_orderkey % 500 between 100 and 149 and l_partkey % 200 between 50 and 74) then null
                    when l_returnflag = 'R' then 1e0
                    when l_returnflag = 'A' and (floor((l_orderkey % 500) / 60e0) + floor((l_partkey % 200) / 40e0)) % 2 = 0 then 1e0
                    else 0e0 end as flood
        from {lineitem}""",
    "built": """
        select l_orderkey % 1000 as y_idx, (l_partkey * 7 + l_suppkey) % 400 as x_idx, avg(l_quantity) / 1.9873e0 as built
        from {lineitem} group by 1, 2""",
    "landcover": """
        select l_orderkey % 500 as y_idx, l_partkey % 200 as x_idx,
               max(((1 + l_partkey % 5) * 100 + (1 + l_suppkey % 4) * 10 + 1 + l_linenumber % 3) * 1e0) as corine_lc
        from {lineitem} group by 1, 2""",
    "heights": """
        select o_orderkey % 100 as y_idx, o_custkey % 100 as x_idx, avg(o_totalprice) / 997e0 as dem
        from {orders} group by 1, 2""",
    "dem_packed": """
        select o_orderkey % 100 as y_idx, o_custkey % 100 as x_idx,
               max(case when o_orderstatus = 'P' then -9999e0 else floor(o_totalprice / 1000e0) end) as dem
        from {orders} group by 1, 2""",
    "dem": """
        select g.y_idx, g.x_idx, coalesce(o.dem, 0e0) as dem
        from (select cast(a.i as bigint) as y_idx, cast(b.i as bigint) as x_idx from range(100) a(i), range(100) b(i)) g
        left join fx_heights o on g.y_idx = o.y_idx and g.x_idx = o.x_idx""",
    "hourly": f"""
        select cast(ts as date) as day, cast(hour(ts) as bigint) as step, {_CELL},
               sum(case when event_type = 'error' then null else value / 997e0 end) as tp
        from {{events}} group by 1, 2, 3, 4""",
    "tp": f"""
        select cast(ts as date) as day, {_CELL},
               sum(case when event_type = 'error' then null else value / 997e0 end) as tp
        from {{events}} group by 1, 2, 3""",
    "sm": f"""
        select ts as time, {_CELL}, case when event_type = 'signup' then value / 497e0 end as sm
        from {{events}}""",
    "points": """
        select c_custkey as location_id, 7e0 + ((c_custkey * 7919) % 1100) / 100e0 as lon,
               37e0 + ((c_custkey * 104729) % 950) / 100e0 as lat
        from {customer}""",
    "point_obs": """
        select user_id as location_id, ts as time, value / 497e0 as sm from {events}""",
    # Events are numbered in time order, so the hours of a day are contiguous
    # stretches of that day's file; the time counts from the start of the hour.
    # Ids do not follow the place in the file, two hours are padding with one
    # id, and place 12 is a location without observations.
    "ragged_owner": """
        select cast(cast(ts as date) - date '2023-12-31' as bigint) as file_id,
               cast(hour(ts) + case when hour(ts) >= 12 then 1 else 0 end as bigint) as pos,
               cast(case when hour(ts) in (3, 17) then -1 else 1000 + cast(cast(ts as date) - date '2024-01-01' as bigint) * 25 + (hour(ts) * 7) % 24 end as bigint) as location_id,
               timestamp '2022-03-01 00:00:00' + (ts - date_trunc('hour', ts)) as time, value as sm,
               event_id - min(event_id) over (partition by cast(ts as date)) as obs_idx
        from {events}""",
    "ragged_loc": """
        select file_id, pos, location_id, count(*) as row_size, 37e0 + pos / 8e0 as lat, 7e0 + file_id / 4e0 as lon
        from fx_ragged_owner group by 1, 2, 3
        union all
        select distinct file_id, cast(12 as bigint), 1000 + (file_id - 1) * 25 + 24, cast(0 as bigint), 37e0 + 12 / 8e0, 7e0 + file_id / 4e0
        from fx_ragged_owner""",
    "coverage": """
        select distinct cast(ts as date) as day, case when extract(day from ts) % 3 = 0 then 0 else 1 end as covered
        from {events}""",
    "files": """
        select s_suppkey,
               concat(case when s_nationkey % 5 = 4 then '/V0M1R0' else '/V0M2R3' end, '/EQUI7_',
                      case when s_nationkey % 2 = 0 then 'AS' else 'EU' end, '020M/E',
                      lpad(cast((s_suppkey * 3) % 60 as string), 3, '0'), 'N', lpad(cast(20 + (s_nationkey * 3) % 15 as string), 3, '0'),
                      'T3/FLOOD_202208', lpad(cast(1 + s_suppkey % 30 as string), 2, '0'), '_VV_', cast(s_suppkey as string), '.tif') as path
        from {supplier}""",
    "extent_text": """
        select c_custkey as id,
               concat(cast(c_custkey % 60 as string), '.5, 22.0, ', cast(c_custkey % 60 + 4 as string), '.25, 30.0',
                      case when c_custkey % 3 = 0 then '' else ', EPSG:4326' end) as txt
        from {customer}""",
}

#: Two overlapping polygons inside the scene grid, in longitude and latitude.
POLYGONS = [
    [(65.205, 30.703), (68.105, 30.103), (68.805, 23.303), (66.705, 26.103), (65.405, 22.303)],
    [(65.907, 27.511), (68.907, 26.911), (68.307, 24.011), (66.107, 24.511)],
]


def _dem(t):
    """The height cells completed to the full raster with 0."""
    full = t.heights.unionByName(DEM.spine(t.spark).withColumn("dem", F.lit(None).cast("double")))
    return full.groupBy("y_idx", "x_idx").agg(F.coalesce(F.max("dem"), F.lit(0.0)).alias("dem"))


def _ragged(t):
    """Hours as locations, days as files; positions count from the day's first event."""
    day, ts = F.to_date("ts"), F.col("ts")
    first = t.events.groupBy(day.alias("day")).agg(F.min("event_id").alias("first"))
    hours = t.events.withColumn("day", day).join(first, "day")
    number = F.datediff("day", F.lit("2024-01-01").cast("date")).cast("bigint")
    return hours.select(
        (number + 1).alias("file_id"),
        (F.hour(ts) + F.when(F.hour(ts) >= 12, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.when(F.hour(ts).isin(3, 17), -1).otherwise(1000 + number * 25 + (F.hour(ts) * 7) % 24).cast("bigint").alias("location_id"),
        F.make_timestamp_ntz(F.lit(2022), F.lit(3), F.lit(1), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts)).alias("time"),
        F.col("value").alias("sm"),
        (F.col("event_id") - F.col("first")).alias("obs_idx"),
    )


def _ragged_loc(t):
    found = _ragged(t).groupBy("file_id", "pos", "location_id").agg(F.count(F.lit(1)).alias("row_size"))
    empty = found.select(
        "file_id", F.lit(12).cast("bigint").alias("pos"), (1000 + (F.col("file_id") - 1) * 25 + 24).alias("location_id"),
        F.lit(0).cast("bigint").alias("row_size"),
    ).distinct()
    return found.unionByName(empty).withColumns({"lat": 37.0 + F.col("pos") / 8, "lon": 7.0 + F.col("file_id") / 4})


SPARK_VIEWS = {
    "dem": _dem,
    "ragged_owner": _ragged,
    "ragged_obs": lambda t: _ragged(t).drop("location_id", "pos"),
    "ragged_loc": _ragged_loc,
}
