"""Whole analyses, each composed of the operators above."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eocube.bindings import sqltext as q
from eocube.bindings.fixtures import BUILT, DEM, LANDCOVER, POLYGONS, RAIN, SCENE
from eocube.bindings.joins import NEAREST_POINTS, aligned
from eocube.bindings.ordered import ACCUMULATED, IN_RAIN_BOX, RAIN_BOX, RAIN_END, RAIN_START
from eocube.bindings.registry import Tables, i64, q6, query, r6, rounded
from eocube.bindings.scans import SCENE_BOX
from eocube.bindings.streams import running_accumulator
from eocube.functions.projection import EQUIDISTANT_EU, LONLAT, WEB_MERCATOR, project_point
from eocube.functions.text import CCI_LEVELS, DEM_LEVELS, LANDCOVER_LEVELS, cci_name, landcover_name, scene_name
from eocube.model import Extent, GridSpec
from eocube.operators.clip import to_crs
from eocube.operators.tiles import tile_table
from eocube.operators.resample import day_span, resample_time
from eocube.plans import drought, flood, ingest
from eocube.sources import store
from eocube.sources.archive import catalogue, land_archive, opener
from eocube.sources.vector import vertices_of


def _pixels(t: Tables):
    """Scene cells with the file they come from: one file per supplier."""
    cells = t.lineitem.select(
        "l_suppkey",
        (F.col("l_orderkey") % 500).alias("y_idx"),
        (F.col("l_partkey") % 200).alias("x_idx"),
        F.when(F.col("l_discount") == 0, None).when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("flood"),
    )
    paths = t.files.select(F.col("s_suppkey").alias("l_suppkey"), "path")
    return cells.join(paths, "l_suppkey").drop("l_suppkey")


FLOOD_SCENE = rf"""
    select l_orderkey % 500 - 50 as y_idx, l_partkey % 200 - 25 as x_idx,
           max(case when l_discount = 0 then null when l_returnflag = 'R' then 1e0 else 0e0 end) as flood
    from lineitem join (
      select s_suppkey, path, 1e5 * cast(regexp_extract(path, 'E(\d{{3}})N\d{{3}}T', 1) as double) as x0, 1e5 * cast(regexp_extract(path, 'E\d{{3}}N(\d{{3}})T', 1) as double) as y0, regexp_extract(path, 'EQUI7_([A-Z]{{2}})', 1) as grid from fx_files) f
      on s_suppkey = l_suppkey
    where regexp_extract(path, '_(\d{{8}})_', 1) between '20220805' and '20220820' 
      and ((grid = 'AS' and x0 < 1829727 and x0 + 300000 > 1406639 and y0 < 3387243 and y0 + 300000 > 2657546)
        or (grid = 'EU' and x0 < 10311377 and x0 + 300000 > 9781387 and y0 < 770101 and y0 + 300000 > 19430))
      and 65e0 + 0.02e0 * (l_partkey % 200 + 0.5e0) between 65.505e0 and 67.995e0 and 31e0 - 0.02e0 * (l_orderkey % 500 + 0.5e0) between 24.005e0 and 29.995e0
    group by 1, 2"""


_landed: dict[tuple, str] = {}


def _archive(t: Tables, name: str, cells, levels: int) -> str:
    """Land the cells of an archive, once a session and data folder; queries only list and open it."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _landed:
        root = store.workspace(t.spark, "archive")
        land_archive(cells(), root, levels)
        _landed[key] = root
    return _landed[key]


def _scene(t: Tables):
    root = _archive(t, "scenes", lambda: _pixels(t), 4)
    files = catalogue(t.spark, root, scene_name, ())
    cells = opener(t.spark, "y_idx bigint, x_idx bigint, flood double")
    return flood.flood_scene(files, tile_table(files), cells, SCENE, SCENE_BOX, dt.date(2022, 8, 5), dt.date(2022, 8, 20))


@query("flood_scene", FLOOD_SCENE)
def flood_scene(t: Tables):
    return _scene(t)[0]


#: Rows 50 to 349 and columns 25 to 149 of the scene grid, and its default web-mercator grid, as numbers.
SCENE_CROP = GridSpec(LONLAT, 65.5, 0.02, 30.0, -0.02, 125, 300)
SCENE_CROP_MERC = GridSpec(WEB_MERCATOR, 7291426.646959418, 2461.8515238192776, 3503549.843504374, -2461.8515238192776, 114, 305)


def _merc_polygons():
    return [[project_point(x, y, LONLAT, WEB_MERCATOR) for x, y in ring] for ring in POLYGONS]


_LAND = q.inside(_merc_polygons(), q.center(SCENE_CROP_MERC, "x", "x_idx"), q.center(SCENE_CROP_MERC, "y", "y_idx"))


@query("restructure_flood", f"""
    with scene as ({FLOOD_SCENE})
    select y_idx, x_idx, case when {_LAND} then flood end as flood
    from ({q.nearest(q.mercator_lookup(SCENE_CROP, SCENE_CROP_MERC), 'scene', '', 'flood')})""")
def restructure_flood(t: Tables):
    """From the files of the archive to a masked scene in the store."""
    scene, cut = _scene(t)
    land = to_crs(vertices_of(t.spark, POLYGONS), "EPSG:4326", WEB_MERCATOR)
    path = store.workspace(t.spark, "flood")
    store.write_cube(flood.restructure_flood(scene, cut, land, WEB_MERCATOR)[0], path)
    return t.spark.read.parquet(path)


#: The cropped grids and their default grids in web mercator, as numbers from the formulas alone.
BUILT_CROP = GridSpec(LONLAT, 65.5, 0.01, 30.0, -0.01, 200, 600)
BUILT_CROP_MERC = GridSpec(WEB_MERCATOR, 7291426.646959418, 1237.2153585972333, 3503549.843504374, -1237.2153585972333, 180, 607)
_RAIN_CROP = GridSpec(LONLAT, 65.1, 0.1, 30.9, -0.1, 39, 29)
_RAIN_CROP_FINE = GridSpec(WEB_MERCATOR, 7246898.850642109, 500.0, 3619769.038150872, -500.0, 869, 742)
_MODEL_CROP = GridSpec(LONLAT, 65.1, 0.1, 30.9, -0.1, 11, 9)
_MODEL_CROP_MERC = GridSpec(WEB_MERCATOR, 7246898.850642109, 11878.355457387514, 3619769.038150872, -11878.355457387514, 11, 10)
_BUILT_CUT = "65e0 + 0.01e0 * (x_idx + 0.5e0) between 65.5025e0 and 67.4975e0 and 31e0 - 0.01e0 * (y_idx + 0.5e0) between 24.0025e0 and 29.9975e0"


@query("restructure_built", f"""
    with cut as (select y_idx - 100 as y_idx, x_idx - 50 as x_idx, built from fx_built where {_BUILT_CUT})
    select y_idx, x_idx, {q6('built')} as built from ({q.nearest(q.mercator_lookup(BUILT_CROP, BUILT_CROP_MERC), 'cut', '', 'built')})""")
def restructure_built(t: Tables):
    box = Extent(65.5025, 24.0025, 67.4975, 29.9975, "EPSG:4326")
    return rounded(flood.restructure_built(t.built, BUILT, box, WEB_MERCATOR)[0], "built")


#: Tiles of 50 x 50 cells of 6 km on the European grid, and the target grid of their blocks as numbers.
DEM_GRID = GridSpec(EQUIDISTANT_EU, 4_500_000.0, 6_000.0, 1_500_000.0, -6_000.0, 100, 100)
DEM_MERC = GridSpec(WEB_MERCATOR, 737758.253710541, 47901.15794520513, 5938135.660178418, -47901.15794520513, 20, 21)


def _dem_lookup() -> str:
    """Web-mercator cells placed among the blocks of the European grid, by the forward formula."""
    lon, lat = q.mercator_lon(q.center(DEM_MERC, "x", "x_idx")), q.mercator_lat(q.center(DEM_MERC, "y", "y_idx"))
    placed = q.aeqd(f"select y_idx, x_idx, {lon} as lon, {lat} as lat from ({q.cells(DEM_MERC)})")
    return f"""
      select y_idx, x_idx, (east - 4500000e0) / 30000e0 as ax, (1500000e0 - north) / 30000e0 as ay from ({placed})
      where east >= 4500000e0 and east < 5100000e0 and north <= 1500000e0 and north > 900000e0"""


@query("restructure_dem", f"""
    with blocks as ({q.coarse('fx_dem', 'dem', 5, DEM, 'avg(s.dem)')})
    select y_idx, x_idx, cast(round_even(dem, 0) as bigint) as dem
    from ({q.nearest(_dem_lookup(), 'blocks', '', 'dem')})""")
def restructure_dem(t: Tables):
    """Cells by file, with an older version of every tile beside it, through the catalogue into the store."""
    tile = F.format_string(
        "E%03dN%03dT3", (45 + 3 * F.floor(F.col("x_idx") / 50)).cast("int"), (12 - 3 * F.floor(F.col("y_idx") / 50)).cast("int")
    )
    cells = t.dem.select(
        F.format_string("/V01R01/EQUI7_EU020M/%s/DEM.tif", tile).alias("path"),
        (F.col("y_idx") % 50).alias("y_idx"), (F.col("x_idx") % 50).alias("x_idx"), "dem",
    )
    old = cells.withColumns({"path": F.regexp_replace("path", "V01R01", "V00R01"), "dem": F.lit(-5.0)})
    root = _archive(t, "heights", lambda: cells.union(old), 4)
    files = catalogue(t.spark, root, scene_name, DEM_LEVELS)
    path = store.workspace(t.spark, "dem")
    opened = opener(t.spark, "y_idx bigint, x_idx bigint, dem double")
    store.write_cube(flood.restructure_dem(opened, files, DEM_GRID, WEB_MERCATOR, k=5)[0], path)
    return i64(t.spark.read.parquet(path), "dem")


def risk_sql(where: str) -> str:
    merc = SCENE.coarsen(25).project(WEB_MERCATOR)
    return f"""
      select f.y_idx, f.x_idx, greatest(f.flood, case when coalesce(b.built > 10, false) then 2e0 else 0e0 end) as class
      from ({q.nearest(q.mercator_lookup(SCENE.coarsen(25), merc), f"({q.coarse(f'(select * from fx_scene where {where})', 'flood', 25, SCENE, q.flag('flood'))})", '', 'flood')}) f
      left join ({q.nearest(q.mercator_lookup(BUILT.coarsen(50), merc), f"({q.coarse('fx_built', 'built', 50, BUILT, 'avg(s.built)')})", '', 'built')}) b
        on b.y_idx = f.y_idx and b.x_idx = f.x_idx"""


_LABEL = "case class when 0 then 'other' when 1 then 'flooded' when 2 then 'built' end"


@query("flood_risk_map", f"select y_idx, x_idx, class, {_LABEL} as label from ({risk_sql('true')})")
def flood_risk_map(t: Tables):
    return flood.flood_risk_map(t.scene, SCENE, t.built, BUILT)


@query("rain_forecast_500m", f"""
    with cube as ({ACCUMULATED}), last as (select day, y_idx, x_idx, nullif(tp, 0) as tp from cube where day = (select day from (select distinct day from cube) order by day limit 1 offset 12))
    select day, y_idx, x_idx, {q6('coalesce(tp, 0)', 3)} as tp from ({q.bilinear(q.mercator_lookup(_RAIN_CROP, _RAIN_CROP_FINE), 'last', 'day', 'tp')})""")
def rain_forecast_500m(t: Tables):
    cells, _ = flood.rain_forecast(t.tp, RAIN, RAIN_START, RAIN_END, RAIN_BOX, step=12, time="day")
    return rounded(cells, "tp", digits=3)


_FLOOD_DAYS = [dt.date(2022, 8, 18), dt.date(2022, 8, 30)]


@query("flood_change", " union all ".join(
    f"select date '{d}' as day, class, {_LABEL} as label, count(*) as cells from ({risk_sql(f'day = date {chr(39)}{d}{chr(39)}')}) group by 1, 2, 3"
    for d in _FLOOD_DAYS))
def flood_change(t: Tables):
    return flood.flood_change(t.scene, SCENE, t.built, BUILT, _FLOOD_DAYS)


_SWATH_MERC = drought.SWATH_GRID.project(WEB_MERCATOR)


def _swath_lookup() -> str:
    """Web-mercator cells placed in the azimuthal grid, by the forward formula."""
    lon = q.mercator_lon(q.center(_SWATH_MERC, "x", "x_idx"))
    lat = q.mercator_lat(q.center(_SWATH_MERC, "y", "y_idx"))
    g = drought.SWATH_GRID
    placed = q.aeqd(f"select y_idx, x_idx, {lon} as lon, {lat} as lat from ({q.cells(_SWATH_MERC)})")
    return f"""
      select y_idx, x_idx, (east - {q.num(g.x0)}) / {q.num(g.dx)} as ax, (north - {q.num(g.y0)}) / {q.num(g.dy)} as ay from ({placed})
      where east >= {q.num(g.x0)} and east < {q.num(g.x0 + g.nx * g.dx)} and north <= {q.num(g.y0)} and north > {q.num(g.y0 + g.ny * g.dy)}"""


_SWATH_MEANS = q.bins("fx_point_obs", "location_id", "sm", 10)


@query("ascat_drought", f"""
    with area as (select m.time, n.y_idx, n.x_idx, m.sm from ({_SWATH_MEANS}) m join ({NEAREST_POINTS}) n on n.location_id = m.location_id),
    level as ({q.stretched('select * from area', 'sm', 'time, y_idx, x_idx')})
    select time, y_idx - 14 as y_idx, x_idx - 47 as x_idx, {q6('sm')} as sm from ({q.bilinear(_swath_lookup(), 'level', 'time', 'sm')})
    where {q.mercator_lon(q.center(_SWATH_MERC, 'x', 'x_idx'))} between 7 and 18 and {q.mercator_lat(q.center(_SWATH_MERC, 'y', 'y_idx'))} between 37 and 46.5""")
def ascat_drought(t: Tables):
    return rounded(drought.swath_drought(t.points, t.point_obs)[0], "sm")


_MODEL_BOUNDS = Extent(65.12, 30.02, 66.18, 30.88)
_MODEL_CUT = "(select time, y_idx - 1 as y_idx, x_idx - 1 as x_idx, sm from fx_sm where 65e0 + 0.1e0 * (x_idx + 0.5e0) between 65.12e0 and 66.18e0 and 31e0 - 0.1e0 * (y_idx + 0.5e0) between 30.02e0 and 30.88e0)"
_RAIN_MERC = RAIN.project(WEB_MERCATOR)


@query("model_drought", f"""
    with level as ({q.stretched(q.bins(_MODEL_CUT, 'y_idx,x_idx', 'sm', 15), 'sm', 'time, y_idx, x_idx')})
    select time, y_idx, x_idx, {q6('sm')} as sm from ({q.nearest(q.mercator_lookup(_MODEL_CROP, _MODEL_CROP_MERC), 'level', 'time', 'sm')})""")
def model_drought(t: Tables):
    return rounded(drought.model_drought(t.sm, RAIN, _MODEL_BOUNDS, value="sm")[0], "sm")


@query("gridded_drought", f"""
    with level as ({q.stretched(q.bins('fx_sm', 'y_idx,x_idx', 'sm', 15), 'sm', 'time, y_idx, x_idx')})
    select time, y_idx, x_idx, {q6('sm')} as sm from ({q.bilinear(q.mercator_lookup(RAIN, _RAIN_MERC), 'level', 'time', 'sm')})""")
def gridded_drought(t: Tables):
    return rounded(drought.gridded_drought(t.sm, RAIN, value="sm", time="time")[0], "sm")


_LC = LANDCOVER.coarsen(5)


@query("landcover_major", f"""
    with blocks as ({q.coarse('fx_landcover', 'corine_lc', 5, LANDCOVER, 'median(s.corine_lc)')})
    select y_idx, x_idx, corine_lc, cast(floor(corine_lc / 100) as bigint) as major,
           case floor(corine_lc / 100) when 1 then 'Artificial surfaces' when 2 then 'Agricultural areas' when 3 then 'Forest and seminatural areas'
                when 4 then 'Wetlands' when 5 then 'Water bodies' end as label
    from ({q.nearest(q.mercator_lookup(_LC, _LC.project(WEB_MERCATOR)), 'blocks', '', 'corine_lc')})""")
def landcover_major(t: Tables):
    return drought.landcover_major(t.landcover, LANDCOVER)[0]


@query("restructure_4dmed", f"""
    select cast(day as timestamp) as date, y_idx, x_idx, {q6('avg(v)')} as "SM" from (
      select cast(time as date) as day, y_idx, x_idx, sm as v from fx_sm union all
      select day, y_idx, x_idx, tp from fx_tp) group by 1, 2, 3""")
def restructure_4dmed(t: Tables):
    """Two domains that overlap in some cells, united by day and stored."""
    one = t.sm.withColumnRenamed("sm", "SM")
    two = t.tp.select(F.col("day").cast("timestamp_ntz").alias("time"), "y_idx", "x_idx", F.col("tp").alias("SM"))
    path = store.workspace(t.spark, "gridded")
    store.write_cube(drought.restructure_gridded([one, two]), path)
    return rounded(t.spark.read.parquet(path), "SM")


@query("restructure_ascat", f"""
    with owned as (select * from fx_ragged_owner where location_id > 0 and time between timestamp '2022-03-01 00:05:00' and timestamp '2022-03-01 00:50:00'),
    valid as (select * from fx_ragged_loc where location_id > 0),
    first as (select v.location_id from valid v left join owned o on o.location_id = v.location_id
              group by v.location_id, v.file_id, v.pos order by count(o.location_id) desc, v.file_id, v.pos limit 1),
    slots as ({aligned('owned', 'select location_id from first')}),
    axis as (select distinct date_trunc('minute', time) as time from owned where location_id = (select location_id from first))
    select v.location_id, v.lat, v.lon, a.time, s.sm from valid v cross join axis a
    left join slots s on s.location_id = v.location_id and s.time = a.time""")
def restructure_ascat(t: Tables):
    start, end = dt.datetime(2022, 3, 1, 0, 5), dt.datetime(2022, 3, 1, 0, 50)
    return drought.restructure_ragged(t.ragged_loc, t.ragged_obs, start, end)


#: Tiles of 100 x 100 cells of 6 km on the European grid, a catchment on it, and the target grid as numbers.
LC_GRID = GridSpec(EQUIDISTANT_EU, 4_200_000.0, 6_000.0, 3_600_000.0, -6_000.0, 200, 500)
LC_RING = [(4_411_000.0, 3_307_000.0), (5_207_000.0, 3_101_000.0), (5_003_000.0, 1_203_000.0), (4_505_000.0, 909_000.0)]
LC_LONLAT = GridSpec(LONLAT, -9.097718049739271, 0.07425403547922634, 65.99488410257169, -0.07425403547922634, 379, 384)


def _landcover_lookup() -> str:
    """Cells of the target grid placed in the European grid, by the forward formula."""
    placed = q.aeqd(f"select y_idx, x_idx, {q.center(LC_LONLAT, 'x', 'x_idx')} as lon, {q.center(LC_LONLAT, 'y', 'y_idx')} as lat from ({q.cells(LC_LONLAT)})")
    return f"""
      select y_idx, x_idx, (east - 4200000e0) / 6000e0 as ax, (3600000e0 - north) / 6000e0 as ay from ({placed})
      where east >= 4200000e0 and east < 5400000e0 and north <= 3600000e0 and north > 600000e0"""


LANDCOVER_SQL = f"""
    with lc as (select y_idx, x_idx, case when {q.inside([LC_RING], q.center(LC_GRID, 'x', 'x_idx'), q.center(LC_GRID, 'y', 'y_idx'))} then corine_lc end as corine_lc from fx_landcover)
    select y_idx, x_idx, corine_lc from ({q.nearest(_landcover_lookup(), 'lc', '', 'corine_lc')})"""


def _landcover(t: Tables, name: str, convention, levels):
    """Cells by file, with an older version of every file beside it, through the catalogue into the store."""
    tile = F.format_string(
        "E%03dN%03dT6", (42 + 6 * F.floor(F.col("x_idx") / 100)).cast("int"), (30 - 6 * F.floor(F.col("y_idx") / 100)).cast("int")
    )
    path = F.format_string(name, tile, tile)
    cells = t.landcover.select(
        path.alias("path"), (F.col("y_idx") % 100).alias("y_idx"), (F.col("x_idx") % 100).alias("x_idx"), "corine_lc"
    )
    old = cells.withColumns({"path": F.concat(F.regexp_replace("path", "T6/", "T3/"), F.lit("_old")), "corine_lc": F.lit(999.0)})
    root = _archive(t, name, lambda: cells.union(old), name.count("/"))
    files = catalogue(t.spark, root, convention, levels)
    catchment = vertices_of(t.spark, [LC_RING])
    out = store.workspace(t.spark, "landcover")
    opened = opener(t.spark, "y_idx bigint, x_idx bigint, corine_lc double")
    store.write_cube(drought.restructure_landcover(opened, files, LC_GRID, catchment)[0], out)
    return t.spark.read.parquet(out)


@query("restructure_landcover", LANDCOVER_SQL)
def restructure_landcover(t: Tables):
    return _landcover(t, "/lc/%s/CLC2018_CLC_EU500M_%s.tif", landcover_name, LANDCOVER_LEVELS)


@query("restructure_cci", LANDCOVER_SQL)
def restructure_cci(t: Tables):
    """The other land-cover product: its own file names and folders."""
    name = "/CCI_Land_Cover/V1M0R1/EQUI7_EU500M/%s/ESA_LCMAP_L4_LC_L4_300m_2018_2018_v2_EU500M_%s.tif"
    return _landcover(t, name, cci_name, CCI_LEVELS)


@query("predicted_rain_get", f"""
    select day, y_idx, x_idx, {q6('coalesce(sum(tp), 0)')} as tp from fx_hourly
    where day between date '2024-01-08' and date '2024-01-20'
      and {IN_RAIN_BOX}
    group by 1, 2, 3""")
def predicted_rain_get(t: Tables):
    """Asked twice for overlapping days; a day that had landed in part is done again."""
    root = store.workspace(t.spark, "rain")
    early = t.hourly.where((F.col("day") < "2024-01-14") | (F.col("step") < 12))
    ingest.cached_get(t.spark, root, early, "tp", RAIN, RAIN_BOX, dt.date(2024, 1, 8), dt.date(2024, 1, 14))
    return rounded(ingest.cached_get(t.spark, root, t.hourly, "tp", RAIN, RAIN_BOX, RAIN_START, RAIN_END), "tp")


@query("retrieve_swvl1", f"""
    select day, y_idx, x_idx, {q6('avg(tp)')} as swvl1 from fx_hourly
    where day between date '2024-01-02' and date '2024-01-25' group by 1, 2, 3""")
def retrieve_swvl1(t: Tables):
    root = store.workspace(t.spark, "swvl1")
    hourly = t.hourly.withColumnRenamed("tp", "swvl1")
    days = store.calendar(t.spark, dt.date(2024, 1, 2), dt.date(2024, 1, 25))
    ingest.fill_days(t.spark, root, hourly, "swvl1", days)
    return rounded(t.spark.read.parquet(f"{root}/cube").select("day", "y_idx", "x_idx", "swvl1"), "swvl1")


@query("stream_accumulate", f"""
    select y_idx, x_idx, max(day) as last, {q6('max(tp)', 3)} as total from (
      select day, y_idx, x_idx, case when not bool_or(tp is null) over (partition by y_idx, x_idx order by day)
             then sum(tp * 1000) over (partition by y_idx, x_idx order by day) end as tp from fx_tp) group by 1, 2""")
def stream_accumulate(t: Tables):
    """The stream's running totals reduced to the last valid one per cell."""
    totals = running_accumulator(t)
    return totals.groupBy("y_idx", "x_idx").agg(F.max("day").alias("last"), r6(F.max("tp"), "total", 3))


_OBSERVED = q.bins("fx_sm", "y_idx,x_idx", "sm", 10)


@query("retro_compare", f"""
    with observed as ({_OBSERVED}), axis as (select distinct time from observed),
    asked as (select distinct time as request from ({q.bins('fx_sm', 'y_idx,x_idx', 'sm', 15)})),
    hit as (select request, time from asked, axis
            qualify row_number() over (partition by request order by abs(epoch_us(request) - epoch_us(time)), time desc) = 1)
    select h.request, o.time, o.y_idx, o.x_idx, {q6('o.sm')} as sm from hit h join observed o on o.time = h.time""")
def retro_compare(t: Tables):
    """10-day observations at the steps of the 15-day model, ties to the later."""
    span = day_span(t.sm)
    compared = drought.retro_compare(resample_time(t.sm, 10, "sm", span=span), resample_time(t.sm, 15, "sm", span=span))
    return rounded(compared.select("request", "time", "y_idx", "x_idx", "sm"), "sm")
