"""Sources, sinks and the catalogue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eocube.bindings.fixtures import BUILT, RAIN, SCENE
from eocube.bindings.registry import Tables, i64, q6, query, r6, rounded
from eocube.functions.missing import encode_int16
from eocube.functions.text import FLOOD_LEVELS, scene_name
from eocube.model import Extent
from eocube.operators.combine import concat
from eocube.operators.reduce import coarsen, min_max
from eocube.operators.select import block_steps
from eocube.sources import catalog as cat
from eocube.sources import store
from eocube.sources.files import file_catalog, raster_roi_read, read_landing_day, read_many
from eocube.sources.tables import read_colours, read_legend
from eocube.sources.vector import read_geojson

BOX = Extent(65.22, 30.22, 66.08, 30.88, "EPSG:4326")
SCENE_BOX = Extent(65.505, 24.005, 67.995, 29.995, "EPSG:4326")
IN_BOX = "65e0 + 0.1e0 * (x_idx + 0.5e0) between 65.22e0 and 66.08e0 and 31e0 - 0.1e0 * (y_idx + 0.5e0) between 30.22e0 and 30.88e0"
IN_SCENE_BOX = "65e0 + 0.02e0 * (x_idx + 0.5e0) between 65.505e0 and 67.995e0 and 31e0 - 0.02e0 * (y_idx + 0.5e0) between 24.005e0 and 29.995e0"


def rain_source(t: Tables) -> cat.CellSource:
    return cat.CellSource(lambda: t.tp, "tp", RAIN, time="day", attrs={"location": "bridge"})


@query("catalog_get", f"""
    select day, y_idx, x_idx, {q6('tp')} as tp from fx_tp
    where day between date '2024-01-05' and date '2024-01-12' and {IN_BOX}""")
def catalog_get(t: Tables):
    catalog = cat.Catalog(t.spark).register("rain", rain_source(t))
    return rounded(catalog.get("rain", BOX, dt.date(2024, 1, 5), dt.date(2024, 1, 12)), "tp")


@query("find_flood", """
    select day, band, y_idx, x_idx, flood from fx_scene where day = date '2022-08-18'""")
def find_flood(t: Tables):
    return cat.find_flood(cat.open_at(cat.FLOOD, lambda: t.scene, SCENE), dt.date(2022, 8, 18))


@query("find_built", f"select y_idx, x_idx, {q6('built')} as built from fx_built")
def find_built(t: Tables):
    return rounded(cat.find_built(cat.open_at(cat.BUILT, lambda: t.built, BUILT)), "built")


@query("find_dem", "select y_idx, x_idx, case when dem <> -9999e0 then dem end as dem from fx_dem_packed")
def find_dem(t: Tables):
    return cat.find_dem(cat.open_at(cat.DEM, lambda: t.dem_packed))


@query("find_rain", f"""
    select cast(day as timestamp) as time, y_idx, x_idx, {q6('tp')} as tp from fx_tp
    where day between date '2024-01-18' and date '2024-01-30' and {IN_BOX}""")
def find_rain(t: Tables):
    load = lambda: t.tp.withColumn("time", F.col("day").cast("timestamp_ntz")).drop("day")
    return rounded(cat.find_rain(cat.open_at(cat.RAIN, load, RAIN), dt.date(2024, 1, 18), dt.date(2024, 1, 30), BOX), "tp")


@query("find_landcover", "select y_idx, x_idx, corine_lc from fx_landcover")
def find_landcover(t: Tables):
    return cat.find_landcover(cat.open_at(cat.LANDCOVER, lambda: t.landcover))


@query("find_swath_sm", f"""
    select time, location_id, {q6('sm')} as sm from fx_point_obs
    where time >= timestamp '2024-01-10' and time < timestamp '2024-01-21'""")
def find_swath_sm(t: Tables):
    source = cat.open_at(cat.SWATH_SM, lambda: t.point_obs)
    return rounded(cat.find_swath_sm(source, dt.date(2024, 1, 10), dt.date(2024, 1, 20)), "sm")


@query("find_model_sm", f"""
    select time, y_idx, x_idx, {q6('sm')} as swvl1 from fx_sm
    where time >= timestamp '2024-01-03' and time < timestamp '2024-01-26' and {IN_BOX}""")
def find_model_sm(t: Tables):
    source = cat.open_at(cat.MODEL_SM, lambda: t.sm.withColumnRenamed("sm", "swvl1"), RAIN)
    return rounded(cat.find_model_sm(source, dt.date(2024, 1, 3), dt.date(2024, 1, 25), BOX), "swvl1")


@query("find_gridded_sm", f"""
    select time as date, y_idx, x_idx, {q6('sm')} as "SM" from fx_sm where time < timestamp '2024-01-16'""")
def find_gridded_sm(t: Tables):
    source = cat.open_at(cat.GRIDDED_SM, lambda: t.sm.withColumnsRenamed({"sm": "SM", "time": "date"}), RAIN)
    return rounded(cat.find_gridded_sm(source, dt.date(2024, 1, 1), dt.date(2024, 1, 15)), "SM")


@query("file_catalog", r"""
    select path, regexp_extract(path, 'EQUI7_([A-Z]{2})', 1) as grid_name,
           regexp_extract(path, '(E\d{3}N\d{3}T\d)', 1) as tile_name,
           cast(strptime(regexp_extract(path, '_(\d{8})_', 1), '%Y%m%d') as date) as day
    from fx_files where path like '%/V0M2R3/%'""")
def file_catalog_(t: Tables):
    return file_catalog(t.files.select("path"), scene_name, FLOOD_LEVELS)


@query("multi_file_concat", f"""
    select band, count(*) as cells, {q6('sum(v)', 2)} as total from
      (select 'lineitem.parquet' as band, l_quantity as v, l_orderkey as k from lineitem
       union all select 'orders.parquet', o_totalprice, o_orderkey from orders) group by band""")
def multi_file_concat(t: Tables):
    one = read_many(t.spark, [t.path("lineitem")]).select("band", F.col("l_quantity").alias("v"))
    two = read_many(t.spark, [t.path("orders")]).select("band", F.col("o_totalprice").alias("v"))
    stacked = concat([one, two]).withColumn("band", F.element_at(F.split("band", "/"), -1))
    return rounded(stacked.groupBy("band").agg(F.count(F.lit(1)).alias("cells"), F.sum("v").alias("total")), "total", digits=2)


@query("daily_landing_read", f"""
    select day, step, y_idx, x_idx, {q6('tp')} as tp from fx_hourly where day = date '2024-01-11'""")
def daily_landing_read(t: Tables):
    root = store.workspace(t.spark, "landing")
    store.write_cube(t.hourly, root, partition_by=["day"])
    return rounded(read_landing_day(t.spark, root, "2024-01-11", "tp"), "tp")


@query("vector_read", f"""
    with box as (
      select c_nationkey as n, row_number() over (order by c_nationkey) - 1 as f,
             min(p.lon) as x0, min(p.lat) as y0, max(p.lon) as x1, max(p.lat) as y1
      from customer join fx_points p on p.location_id = c_custkey group by c_nationkey),
    ring as (
      select f, 0 as seq, x0 as x, y0 as y from box where x0 <= 12 and x1 >= 7.5 union all
      select f, 1, x1, y0 from box where x0 <= 12 and x1 >= 7.5 union all
      select f, 2, x1, y1 from box where x0 <= 12 and x1 >= 7.5 union all
      select f, 3, x0, y1 from box where x0 <= 12 and x1 >= 7.5 union all
      select f, 4, x0, y0 from box where x0 <= 12 and x1 >= 7.5)
    select concat(cast(f as string), '/0') as poly_id, cast(0 as bigint) as ring_id, cast(seq as bigint) as seq,
           {q6('x')} as x, {q6('y')} as y from ring""")
def vector_read(t: Tables):
    """Customer boxes per nation written as one GeoJSON file of as many features."""
    spots = t.customer.join(t.points, F.col("c_custkey") == F.col("location_id"))
    box = spots.groupBy("c_nationkey").agg(
        F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1")
    )
    corner = lambda a, b: F.array(F.col(a), F.col(b))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    features = F.transform(F.sort_array(F.collect_list(F.struct("c_nationkey", feature.alias("f")))), lambda s: s["f"])
    path = store.workspace(t.spark, "geojson")
    document = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), features.alias("features")))
    box.agg(document.alias("value")).write.text(path)
    vertices = read_geojson(t.spark, path, Extent(7.5, 30, 12, 50))
    return rounded(i64(vertices, "ring_id", "seq"), "x", "y")


@query("raster_roi_read", f"select day, y_idx - 50 as y_idx, x_idx - 25 as x_idx, flood from fx_scene where band = 1 and {IN_SCENE_BOX}")
def raster_roi_read_(t: Tables):
    return raster_roi_read(t.scene, SCENE, SCENE_BOX, band=1)[0]


@query("cube_write", f"select day, y_idx, x_idx, {q6('tp')} as tp from fx_tp")
def cube_write(t: Tables):
    path = store.workspace(t.spark, "cube")
    store.write_cube(t.tp, path, partition_by=["day"])
    return rounded(t.spark.read.parquet(path).select("day", "y_idx", "x_idx", "tp"), "tp")


@query("dims_append", f"""
    select day, {q6('sum(tp * 6371e3 * 6371e3 * radians(0.1e0) * (sin(radians(31.05e0 - 0.1e0 * (y_idx + 0.5e0))) - sin(radians(30.95e0 - 0.1e0 * (y_idx + 0.5e0)))) / 1e6)')} as volume,
           count(*) as cells from fx_tp group by day""")
def dims_append(t: Tables):
    """Rain volume per day through the cell areas kept beside the cube."""
    root = store.workspace(t.spark, "dims")
    store.write_cube(t.tp, f"{root}/cube", partition_by=["day"])
    store.append_dims(t.spark, root, RAIN)
    cube, grid = (t.spark.read.parquet(f"{root}/{p}") for p in ("cube", "grid"))
    both = cube.join(grid, ["y_idx", "x_idx"])
    return both.groupBy("day").agg(
        r6(F.sum(F.col("tp") * F.col("area_exact") / 1e6), "volume"), F.count(F.lit(1)).alias("cells")
    )


@query("region_upsert", f"""
    select day, y_idx, x_idx, {q6("case when day = date '2024-01-05' then tp * 2 else tp end")} as tp from fx_tp""")
def region_upsert(t: Tables):
    path = store.workspace(t.spark, "upsert")
    store.upsert_days(t.tp, path)
    store.upsert_days(t.tp.where(F.col("day") == "2024-01-05").withColumn("tp", F.col("tp") * 2), path)
    return rounded(t.spark.read.parquet(path).select("day", "y_idx", "x_idx", "tp"), "tp")


@query("grid_spine", """
    select d.day, count(*) as cells, count(t.day) as landed, count(t.tp) as filled
    from (select distinct day from fx_tp) d
    cross join (select i as y_idx, j as x_idx from range(100) a(i), range(60) b(j)) g
    left join fx_tp t on t.day = d.day and t.y_idx = g.y_idx and t.x_idx = g.x_idx group by d.day""")
def grid_spine(t: Tables):
    """How much of the empty cube the landed days fill."""
    days = t.tp.select("day").distinct()
    cube = store.empty_cube(t.spark, RAIN, days, "nothing")
    landed = t.tp.withColumn("hit", F.lit(1))
    return cube.join(landed, ["day", "y_idx", "x_idx"], "left").groupBy("day").agg(
        F.count(F.lit(1)).alias("cells"), F.count("hit").alias("landed"), F.count("tp").alias("filled")
    )


@query("grid_gaps", """
    select d.day, count(*) - count(t.day) as missing
    from (select distinct day from fx_tp) d
    cross join (select i as y_idx, j as x_idx from range(100) a(i), range(60) b(j)) g
    left join (select distinct day, y_idx, x_idx from fx_tp) t on t.day = d.day and t.y_idx = g.y_idx and t.x_idx = g.x_idx group by d.day""")
def grid_gaps(t: Tables):
    """How much of the cube the landed days leave open, counted by runs of columns."""
    gaps = store.gap_runs(store.covered_runs(t.tp), RAIN, t.tp.select("day"))
    days = t.tp.select("day").distinct()
    counts = gaps.groupBy("day").agg(F.sum(F.col("x_to") - F.col("x_from")).alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).cast("bigint").alias("missing"))


@query("encode_int16", """
    select y_idx, x_idx, cast(case when round_even(dem * 100, 0) between -32768 and 32767 then round_even(dem * 100, 0) else -9999 end as bigint) as packed
    from fx_heights""")
def encode_int16_(t: Tables):
    packed = encode_int16(F.col("dem") * 100).cast("bigint")
    return t.heights.select("y_idx", "x_idx", packed.alias("packed"))


@query("text_dims_read", """
    select cast(n_nationkey as bigint) as code, cast(n_regionkey as string) as rest, n_name as label from nation""")
def text_dims_read(t: Tables):
    """A legend file of one line per nation, written and read back."""
    line = F.concat(F.col("n_nationkey").cast("string"), F.lit(' "'), F.col("n_name"), F.lit('" '), F.col("n_regionkey").cast("string"))
    path = store.workspace(t.spark, "legend")
    lines = t.nation.agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("value"))
    lines.write.text(path)
    return i64(read_legend(t.spark, path), "code")


#: Colour lines from the parts: brands and sizes bound their number.
COLOUR_LINES = """
    select distinct concat(cast(p_size * 5 as string), ' ', cast(cast(regexp_replace(p_brand, '[^0-9]', '', 'g') as int) * 10 as string), ' ',
           cast((p_size * cast(regexp_replace(p_brand, '[^0-9]', '', 'g') as int)) % 256 as string)) as line from part"""


def colour_file(t: Tables) -> str:
    number = F.regexp_replace("p_brand", "[^0-9]", "").cast("int")
    line = F.concat_ws(
        " ", (F.col("p_size") * 5).cast("string"), (number * 10).cast("string"), ((F.col("p_size") * number) % 256).cast("string")
    )
    path = store.workspace(t.spark, "colours")
    lines = t.part.agg(F.array_join(F.sort_array(F.collect_set(line)), "\n").alias("value"))
    lines.write.text(path)
    return path


@query("dataset_attrs", f"""
    select cast(floor(y_idx / 50) as bigint) as y_idx, cast(floor(x_idx / 50) as bigint) as x_idx,
           {q6('avg(built)')} as built, 'central-site' as location, cast(10 as bigint) as resolution
    from fx_built group by 1, 2""")
def dataset_attrs(t: Tables):
    """The block size follows from the resolution attribute, which stays readable."""
    built = cat.open_at(cat.BUILT, lambda: t.built, BUILT).get()
    attrs = cat.attrs_of(built, "built")
    blocks, _ = coarsen(built, BUILT, block_steps(attrs["resolution"]), "mean", "built")
    return rounded(blocks, "built").withColumns(
        {"location": F.lit(attrs["location"]), "resolution": F.lit(attrs["resolution"]).cast("bigint")}
    )


@query("grid_spec", f"""
    select y_idx, x_idx, {q6('65e0 + 0.02e0 * (x_idx + 0.5e0)')} as longitude, {q6('31e0 - 0.02e0 * (y_idx + 0.5e0)')} as latitude,
           case when dem <> -9999e0 then dem end as dem from fx_dem_packed""")
def grid_spec(t: Tables):
    cells = t.dem_packed.withColumn("dem", F.nullif("dem", F.lit(-9999.0)))
    return cells.select(
        "y_idx", "x_idx",
        r6(SCENE.center_x(F.col("x_idx")), "longitude"), r6(SCENE.center_y(F.col("y_idx")), "latitude"), "dem",
    )


@query("materialize", f"""
    select day, count(*) as cells, {q6('max(tp) - (select min(tp) from fx_tp)')} as above from fx_tp group by day""")
def materialize(t: Tables):
    kept = store.materialize(t.tp, "tp")
    lo = min_max(kept, "tp").select("lo").scalar()
    days = kept.groupBy("day").agg(F.count(F.lit(1)).alias("cells"), F.max("tp").alias("top"))
    return days.select("day", "cells", r6(F.col("top") - lo, "above"))


@query("rechunk", """
    select cast(floor(y_idx / 100) as bigint) as block_y, cast(floor(x_idx / 100) as bigint) as block_x,
           count(*) as cells, cast(1 as bigint) as parts from fx_scene group by 1, 2""")
def rechunk(t: Tables):
    """Cells per block, and the number of partitions each block ended in."""
    chunks = store.rechunk(t.scene, 100).select(
        F.floor(F.col("y_idx") / 100).alias("block_y"), F.floor(F.col("x_idx") / 100).alias("block_x"),
        F.spark_partition_id().alias("part"),
    )
    per_part = chunks.groupBy("block_y", "block_x", "part").agg(F.count(F.lit(1)).alias("cells"))
    return per_part.groupBy("block_y", "block_x").agg(
        F.sum("cells").alias("cells"), F.count(F.lit(1)).alias("parts")
    )


@query("head_n", f"""
    with lines as ({COLOUR_LINES}),
    numbered as (select row_number() over (order by line) as bin, line from lines)
    select bin, printf('#%02x%02x%02x', cast(split_part(line, ' ', 1) as int), cast(split_part(line, ' ', 2) as int), cast(split_part(line, ' ', 3) as int)) as hex
    from numbered where bin <= 200""")
def head_n(t: Tables):
    return i64(read_colours(t.spark, colour_file(t)), "bin")
