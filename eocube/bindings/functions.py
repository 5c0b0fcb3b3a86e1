"""Scalar functions on table columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eocube.bindings import sqltext as q
from eocube.bindings.fixtures import RAIN
from eocube.bindings.joins import files_catalog, haversine_sql
from eocube.bindings.registry import Tables, i64, q6, query, r6, rounded
from eocube.bindings.scans import COLOUR_LINES, colour_file
from eocube.functions import calendar as cal
from eocube.functions import geodesy
from eocube.functions.projection import EQUIDISTANT_EU, LONLAT, MOLLWEIDE, WEB_MERCATOR, project
from eocube.functions.text import cci_name, extent_epsg, extent_ring, landcover_name, parse_extent, parse_legend, rgb_hex, tile_bounds
from eocube.operators.clip import transform_extents
from eocube.operators.combine import compose, scale
from eocube.operators.overlay import major_class, ramp_bin
from eocube.operators.reduce import min_max
from eocube.operators.select import block_steps
from eocube.sources.store import calendar
from eocube.sources.tables import read_colours


@query("haversine", f"""
    select location_id, {q6(haversine_sql('lat', 'lon', '41.9e0', '12.5e0') + ' / 1000', 3)} as km from fx_points""")
def haversine(t: Tables):
    km = geodesy.haversine(F.col("lat"), F.col("lon"), F.lit(41.9), F.lit(12.5)) / 1000
    return t.points.select("location_id", r6(km, "km", 3))


def _area_sql(lat: str, lon: str) -> str:
    c = [(f"({lat} + {a}e0)", f"({lon} + {b}e0)") for a, b in ((-0.05, -0.05), (0.05, -0.05), (0.05, 0.05), (-0.05, 0.05))]
    s = [haversine_sql(*c[i], *c[j]) for i, j in ((0, 1), (1, 2), (2, 3), (3, 0), (0, 2), (1, 3))]
    return f"""
      select location_id, case when k >= 0 then sqrt(k) end as area, lat from (
        select location_id, lat, (h - a) * (h - b) * (h - c) * (h - d) - pow(p * q, 2) / 16 as k from (
          select *, (a + b + c + d) / 2 as h from (
            select location_id, lat, {s[0]} as a, {s[1]} as b, {s[2]} as c, {s[3]} as d, {s[4]} as p, {s[5]} as q from fx_points)))"""


@query("cell_area", f"""
    select location_id, {q6('area / 1e6', 3)} as area,
           {q6('6371e3 * 6371e3 * radians(0.1e0) * (sin(radians(lat + 0.05e0)) - sin(radians(lat - 0.05e0))) / 1e6', 3)} as area_exact
    from ({_area_sql('lat', 'lon')})""")
def cell_area(t: Tables):
    lat, lon = F.col("lat"), F.col("lon")
    return t.points.select(
        "location_id", r6(geodesy.cell_area(lat, lon) / 1e6, "area", 3), r6(geodesy.cell_area_exact(lat) / 1e6, "area_exact", 3)
    )


@query("cell_corners", f"""
    select location_id, {q6('lat - 0.05e0')} as lat1, {q6('lon - 0.05e0')} as lon1, {q6('lat + 0.05e0')} as lat3, {q6('lon + 0.05e0')} as lon3 from fx_points""")
def cell_corners(t: Tables):
    c = geodesy.cell_corners(F.col("lat"), F.col("lon"))
    return t.points.select("location_id", r6(c[0][0], "lat1"), r6(c[0][1], "lon1"), r6(c[2][0], "lat3"), r6(c[2][1], "lon3"))


def _there_and_back(t: Tables, crs: str):
    """The points in another system, and transformed back from it."""
    there = project(t.points, F.col("lon"), F.col("lat"), LONLAT, crs, ("x", "y"))
    return project(there, F.col("x"), F.col("y"), crs, LONLAT, ("lon", "lat"))


@query("web_mercator", f"""
    select location_id, {q6('6378137e0 * radians(lon) / 1000')} as x, {q6('6378137e0 * ln(tan(pi() / 4 + radians(lat) / 2)) / 1000')} as y,
           {q6('lon')} as lon, {q6('lat')} as lat from fx_points""")
def web_mercator(t: Tables):
    """Forward, and back again to where it started."""
    moved = _there_and_back(t, WEB_MERCATOR)
    return moved.select("location_id", r6(F.col("x") / 1000, "x"), r6(F.col("y") / 1000, "y"), r6("lon"), r6("lat"))


@query("aeqd_eu", f"""
    select location_id, {q6('east / 1000', 3)} as x, {q6('north / 1000', 3)} as y, round(lon, 3) as lon, round(lat, 3) as lat from ({q.aeqd('select * from fx_points')})""")
def aeqd_eu(t: Tables):
    """Forward, and back to within metres."""
    moved = _there_and_back(t, EQUIDISTANT_EU)
    return moved.select(
        "location_id", r6(F.col("x") / 1000, "x", 3), r6(F.col("y") / 1000, "y", 3),
        F.round("lon", 3).alias("lon"), F.round("lat", 3).alias("lat"),
    )


def _newton_sql(steps: int) -> str:
    inner = "select *, 2 * radians(lat) as u from fx_points"
    for _ in range(steps):
        inner = f"select * replace (u - (u + sin(u) - pi() * sin(radians(lat))) / (1 + cos(u)) as u) from ({inner})"
    return inner


@query("mollweide", f"""
    select location_id, {q6('6378137e0 * 2 * sqrt(2e0) / pi() * radians(lon) * cos(u / 2) / 1000')} as x,
           {q6('6378137e0 * sqrt(2e0) * sin(u / 2) / 1000')} as y, {q6('lon')} as lon, {q6('lat')} as lat
    from ({_newton_sql(12)})""")
def mollweide(t: Tables):
    moved = _there_and_back(t, MOLLWEIDE)
    return moved.select("location_id", r6(F.col("x") / 1000, "x"), r6(F.col("y") / 1000, "y"), r6("lon"), r6("lat"))


@query("affine", f"""
    select y_idx, x_idx, {q6(q.center(RAIN, 'x', 'x_idx'))} as x, {q6(q.center(RAIN, 'y', 'y_idx'))} as y, y_idx as row_back, x_idx as col_back
    from (select distinct y_idx, x_idx from fx_tp)""")
def affine(t: Tables):
    cells = t.tp.select("y_idx", "x_idx").distinct()
    x, y = RAIN.center_x(F.col("x_idx")), RAIN.center_y(F.col("y_idx"))
    return cells.select(
        "y_idx", "x_idx", r6(x, "x"), r6(y, "y"),
        F.floor(RAIN.pixel_y(y)).alias("row_back"), F.floor(RAIN.pixel_x(x)).alias("col_back"),
    )


_EXTENT_SQL = """
    select id, cast(trim(split_part(txt, ',', 1)) as double) as min_x, cast(trim(split_part(txt, ',', 2)) as double) as min_y,
           cast(trim(split_part(txt, ',', 3)) as double) as max_x, cast(trim(split_part(txt, ',', 4)) as double) as max_y,
           nullif(trim(split_part(txt, ',', 5)), '') as crs from fx_extent_text"""


@query("parse_extent", _EXTENT_SQL)
def parse_extent_(t: Tables):
    return t.extent_text.select("id", parse_extent(F.col("txt")).alias("e")).select("id", "e.*")


@query("extent_polygon", f"""
    select id, cast(seq as bigint) as seq, case when seq in (0, 3, 4) then min_x else max_x end as x,
           case when seq in (0, 1, 4) then min_y else max_y end as y, cast(nullif(split_part(crs, ':', 2), '') as bigint) as epsg
    from ({_EXTENT_SQL}), range(5) s(seq)""")
def extent_polygon(t: Tables):
    boxes = t.extent_text.select("id", parse_extent(F.col("txt")).alias("e"))
    vertices = boxes.select(
        "id", extent_epsg(F.col("e")).alias("epsg"), F.posexplode(extent_ring(F.col("e"))).alias("seq", "v")
    )
    return i64(vertices.select("id", "seq", "v.x", "v.y", "epsg"), "seq", "epsg")


@query("extent_transform", f"""
    select id, {q6('6378137e0 * radians(min_x) / 1000')} as min_x, {q6('6378137e0 * ln(tan(pi() / 4 + radians(min_y) / 2)) / 1000')} as min_y,
           {q6('6378137e0 * radians(max_x) / 1000')} as max_x, {q6('6378137e0 * ln(tan(pi() / 4 + radians(max_y) / 2)) / 1000')} as max_y
    from ({_EXTENT_SQL})""")
def extent_transform(t: Tables):
    """Boxes to web mercator: edges densified, vertices moved, envelope taken."""
    boxes = t.extent_text.select("id", parse_extent(F.col("txt")).alias("e"))
    moved = transform_extents(boxes, "e", ["id"], LONLAT, WEB_MERCATOR)
    return moved.select("id", *(r6(F.col(c) / 1000, c) for c in ("min_x", "min_y", "max_x", "max_y")))


@query("scale", f"select day, y_idx, x_idx, {q6('tp * 1000')} as tp from fx_tp")
def scale_(t: Tables):
    return rounded(t.tp.transform(scale(1000.0, "tp")), "tp")


@query("major_class", """
    select cast(floor(corine_lc / 100) as bigint) as major, count(*) as cells from fx_landcover group by 1""")
def major_class_(t: Tables):
    return t.landcover.groupBy(major_class(F.col("corine_lc")).alias("major")).agg(F.count(F.lit(1)).alias("cells"))


@query("date_functions", """
    select event_id, cast(ts as date) as day, date_trunc('day', ts) as midnight, date_trunc('minute', ts) as minute, epoch_us(ts) as micros,
           cast('2024-01-31' as date) - cast(ts as date) as days_left from events""")
def date_functions(t: Tables):
    ts = F.col("ts")
    day = cal.day_of(ts)
    left = F.datediff(F.to_date(F.lit("2024-01-31")), day).cast("bigint")
    return t.events.select(
        "event_id", day.alias("day"), cal.midnight(day).alias("midnight"), cal.to_minute(ts).alias("minute"),
        cal.epoch_micros(ts).alias("micros"), left.alias("days_left"),
    )


@query("parse_filename", r"""
    select path, regexp_extract(path, 'EQUI7_([A-Z]{2})', 1) as grid_name, regexp_extract(path, '(E\d{3}N\d{3}T\d)', 1) as tile_name,
           cast(strptime(regexp_extract(path, '_(\d{8})_', 1), '%Y%m%d') as date) as day,
           concat('CLC', cast(s_suppkey as string)) as lc_var, concat('T', cast(s_suppkey as string)) as lc_tile,
           'LC-L4' as cci_type, concat('E', cast(s_suppkey as string)) as cci_tile from fx_files""")
def parse_filename(t: Tables):
    n = F.col("s_suppkey").cast("string")
    landcover = landcover_name(F.concat(F.lit("/lc/CLC"), n, F.lit("_2018_EU_T"), n, F.lit(".tif")))
    cci = cci_name(F.concat(F.lit("/cci/ESA_LCMAP_L4_LC_L4_300m_2018_2018_v2_EU_E"), n, F.lit(".tif")))
    named = files_catalog(t).select("path", "grid_name", "tile_name", "day", landcover.alias("lc"), cci.alias("cci"))
    return named.select(
        "path", "grid_name", "tile_name", "day", F.col("lc.var_name").alias("lc_var"), F.col("lc.tile_name").alias("lc_tile"),
        F.col("cci.type").alias("cci_type"), F.col("cci.tile_name").alias("cci_tile"),
    )


@query("rgb_hex", """
    select p_partkey, printf('#%02x%02x%02x', p_size, (p_size * 5) % 256, cast(p_partkey % 256 as int)) as hex from part""")
def rgb_hex_(t: Tables):
    line = F.concat_ws(
        " ", F.col("p_size").cast("string"), ((F.col("p_size") * 5) % 256).cast("string"), (F.col("p_partkey") % 256).cast("string")
    )
    return t.part.select("p_partkey", rgb_hex(line).alias("hex"))


@query("parse_legend", "select c_custkey as code, c_mktsegment as label, concat(c_name, ' x') as rest from customer")
def parse_legend_(t: Tables):
    line = F.concat(F.col("c_custkey").cast("string"), F.lit('  "'), F.col("c_mktsegment"), F.lit('" '), F.col("c_name"), F.lit(" x "))
    parsed = t.customer.select(parse_legend(line).alias("l"))
    return parsed.select(F.col("l.code").cast("bigint").alias("code"), "l.label", "l.rest")


@query("ramp_bin", f"""
    with lines as ({COLOUR_LINES}),
    colours as (select row_number() over (order by line) as bin, line from lines),
    v as (select day, y_idx, x_idx, case when tp >= 0 then least(200, cast(floor(tp / (select max(tp) from fx_tp) * 200) as bigint) + 1) end as bin from fx_tp)
    select day, y_idx, x_idx, v.bin, printf('#%02x%02x%02x', cast(split_part(line, ' ', 1) as int), cast(split_part(line, ' ', 2) as int), cast(split_part(line, ' ', 3) as int)) as hex
    from v left join colours c on c.bin = v.bin""")
def ramp_bin_(t: Tables):
    """Rain coloured on a ramp from 0 to its maximum."""
    rain = t.tp
    top = min_max(rain, "tp").select("hi").scalar()
    binned = rain.select("day", "y_idx", "x_idx", ramp_bin(F.col("tp"), 0.0, top).alias("bin"))
    return i64(binned.join(read_colours(t.spark, colour_file(t)), "bin", "left"), "bin").select("day", "y_idx", "x_idx", "bin", "hex")


@query("tile_bounds", r"""
    select path, x0 as min_x, y0 as min_y, x0 + 3e5 as max_x, y0 + 3e5 as max_y, cast(15000 as bigint) as pixels from (
      select path, 1e5 * cast(regexp_extract(path, 'E(\d{3})N\d{3}T', 1) as double) as x0, 1e5 * cast(regexp_extract(path, 'E\d{3}N(\d{3})T', 1) as double) as y0 from fx_files)""")
def tile_bounds_(t: Tables):
    boxes = files_catalog(t).select("path", tile_bounds(F.col("tile_name")).alias("b"))
    return boxes.select("path", "b.min_x", "b.min_y", "b.max_x", "b.max_y", "b.pixels")


@query("block_steps", """
    select cast(res as bigint) as res, cast(floor(500 / res) as bigint) as steps, count(*) as n from (
      select case l_returnflag when 'A' then 20 when 'N' then 10 else 100 end as res from lineitem) group by 1, 2""")
def block_steps_(t: Tables):
    steps = F.when(F.col("res") == 20, block_steps(20)).when(F.col("res") == 10, block_steps(10)).otherwise(block_steps(100))
    res = F.when(F.col("l_returnflag") == "A", 20).when(F.col("l_returnflag") == "N", 10).otherwise(100)
    counted = t.lineitem.select(res.alias("res")).groupBy("res").agg(F.count(F.lit(1)).alias("n"))
    return i64(counted.withColumn("steps", steps), "res", "steps").select("res", "steps", "n")


@query("date_range", """
    select cast(d as date) as day, count(e.day) as events from range(date '2023-12-25', date '2024-02-06', interval 1 day) r(d)
    left join (select cast(ts as date) as day from events) e on e.day = cast(d as date) group by 1""")
def date_range(t: Tables):
    """Daily calendar with the events of each day, days without any included."""
    days = calendar(t.spark, dt.date(2023, 12, 25), dt.date(2024, 2, 5))
    counts = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).cast("bigint").alias("events"))


@query("compose", f"select y_idx, x_idx, {q6('max(tp) * 1000')} as rain from fx_tp group by 1, 2")
def compose_(t: Tables):
    steps = compose(
        scale(1000.0, "tp"),
        lambda df: df.withColumnRenamed("tp", "rain"),
        lambda df: df.groupBy("y_idx", "x_idx").agg(F.max("rain").alias("rain")),
    )
    return rounded(steps(t.tp), "rain")
