"""Archives: what a plan opens follows what it chooses."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from eocube import jobs
from eocube.functions.projection import EQUIDISTANT_EU, LONLAT
from eocube.functions.text import DEM_LEVELS, FLOOD_LEVELS, scene_name
from eocube.model import Extent, GridSpec
from eocube.operators.combine import mosaic, place_tiles
from eocube.operators.tiles import tile_table
from eocube.plans.flood import flood_scene
from eocube.sources import archive as archives
from eocube.sources.archive import catalogue, land_archive, listing, meeting, opener, update_manifest

GRID = GridSpec(LONLAT, 65.0, 1.0, 31.0, -1.0, 4, 4)
CELLS = "y_idx bigint, x_idx bigint, flood double"
DAY = dt.date(2022, 8, 18)


def scene(tile, day, version="V0M2R3", grid="AS"):
    return f"/{version}/EQUI7_{grid}020M/{tile}/FLOOD_{day:%Y%m%d}_VV.tif"


@pytest.fixture
def archive(spark, tmp_path):
    """Twelve scenes: three tiles on three days, and an old version of one day; a tile is a row of cells each."""
    rows = []
    for k, tile in enumerate(("E015N030T3", "E018N030T3", "E057N006T3")):
        for d in range(3):
            rows += [(scene(tile, DAY + dt.timedelta(d)), k, x, float(d)) for x in range(4)]
        rows += [(scene(tile, DAY, "V0M1R0"), k, x, 9.0) for x in range(4)]
    root = str(tmp_path / "archive")
    land_archive(spark.createDataFrame(rows, "path string, y_idx long, x_idx long, flood double"), root, 4)
    return root


def test_names_of_the_archive(spark, archive):
    assert {r.path.rsplit("archive")[-1] for r in listing(spark, archive).collect()} >= {scene("E015N030T3", DAY)}
    files = catalogue(spark, archive, scene_name, FLOOD_LEVELS)
    assert files.count() == 9 and files.where("day = '2022-08-18'").count() == 3


def test_a_scene_opens_the_chosen_files_only(spark, archive):
    files = catalogue(spark, archive, scene_name, FLOOD_LEVELS)
    box = Extent(65.0, 27.0, 69.0, 31.0, LONLAT)
    cells, cut = flood_scene(files, tile_table(files), opener(spark, CELLS), GRID, box, DAY, DAY + dt.timedelta(1))
    opened = cells.inputFiles()
    assert len(opened) == 4 and all("E057" not in p and "V0M1R0" not in p and "20220820" not in p for p in opened)
    assert {(r.y_idx, r.x_idx): r.flood for r in cells.collect()} == {(y, x): 1.0 for y in (0, 1) for x in range(4)}
    assert cells.schema["flood"].metadata["tiles"] == {"AS": ["E015N030T3", "E018N030T3"]}
    none, _ = flood_scene(files, tile_table(files), opener(spark, CELLS), GRID, box, dt.date(1999, 1, 1))
    assert none.count() == 0 and none.inputFiles() == []


def test_the_manifest_leaves_out_files_beside_the_crop(spark, archive, tmp_path):
    target = str(tmp_path / "manifest")
    manifest = update_manifest(spark, archive, target, scene_name, FLOOD_LEVELS, CELLS)
    assert {(r.tile_name, r.y_from, r.y_to, r.x_from, r.x_to) for r in manifest.collect()} == {
        ("E015N030T3", 0, 1, 0, 4), ("E018N030T3", 1, 2, 0, 4), ("E057N006T3", 2, 3, 0, 4)
    }
    first_row = Extent(65.1, 30.1, 68.9, 30.9, LONLAT)
    cells, cut = flood_scene(manifest, tile_table(manifest), opener(spark, CELLS), GRID, first_row, DAY)
    assert len(cells.inputFiles()) == 1 and cells.count() == 4 and cut.ny == 1
    assert meeting(manifest, GRID, GRID).count() == 9


def test_the_manifest_reads_new_files_only(spark, archive, tmp_path):
    target = str(tmp_path / "manifest")
    update_manifest(spark, archive, target, scene_name, FLOOD_LEVELS, CELLS)
    parts = len(spark.read.parquet(target).inputFiles())
    assert update_manifest(spark, archive, target, scene_name, FLOOD_LEVELS, CELLS).count() == 9
    assert len(spark.read.parquet(target).inputFiles()) == parts  # nothing new, nothing read or written
    late = spark.createDataFrame([(scene("E021N030T3", DAY), 3, 0, 1.0)], "path string, y_idx long, x_idx long, flood double")
    land_archive(late.union(late.withColumn("path", F.lit(scene("E021N030T3", DAY, "V0M1R0")))), f"{archive}/late", 4)
    again = update_manifest(spark, archive, target, scene_name, FLOOD_LEVELS, CELLS)
    assert again.count() == 10 and again.where("y_from = 3 and y_to = 4").count() == 1


def test_tiles_are_placed_by_their_names(spark, tmp_path):
    spec = GridSpec(EQUIDISTANT_EU, 4_500_000.0, 150_000.0, 1_500_000.0, -150_000.0, 4, 4)
    tiles = {"E045N012T3": (0, 0), "E048N009T3": (2, 2)}
    rows = [(f"/V01R01/EQUI7_EU020M/{t}/DEM.tif", y, x, 1.0) for t in tiles for y in (0, 1) for x in (0, 1)]
    rows += [(f"/V00R01/EQUI7_EU020M/{t}/DEM.tif", 0, 0, -5.0) for t in tiles]
    root = str(tmp_path / "dem")
    land_archive(spark.createDataFrame(rows, "path string, y_idx long, x_idx long, dem double"), root, 4)
    files = catalogue(spark, root, scene_name, DEM_LEVELS)
    placed = place_tiles(opener(spark, "y_idx bigint, x_idx bigint, dem double"), files, spec)
    assert len(placed.inputFiles()) == 2
    got = {(r.y_idx, r.x_idx) for r in mosaic(placed, "dem").collect()}
    assert got == {(y + a, x + b) for y, x in tiles.values() for a in (0, 1) for b in (0, 1)}


def test_the_flood_job_lists_its_folder(spark, archive, tmp_path):
    land = tmp_path / "land.geojson"
    ring = [[60, 20], [80, 20], [80, 40], [60, 40], [60, 20]]
    land.write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [%s]}}]}' % ring)
    out = str(tmp_path / "out")
    jobs.flood(spark, archive, out, GRID, "65.0, 27.0, 69.0, 31.0, EPSG:4326", DAY, str(land))
    assert spark.read.parquet(out).where("flood = 0").count() > 0


def test_many_scenes_are_landed_by_their_tasks(spark, tmp_path):
    names = spark.range(3000).select(
        F.when(F.col("id") % 1000 < 998, F.format_string("//V0M2R3/a=b/T%03d/S_%d.tif/more", F.col("id") % 7, F.col("id") % 1000)).alias("path"),
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("y_idx"), F.when(F.col("id") % 3 > 0, F.col("id") / 2).alias("flood"),
    )
    names = names.union(spark.createDataFrame([("/V0M2R3//T/x y.tif", 1, 0.5), (None, 2, None)], names.schema)).repartition(5)
    root = str(tmp_path / "many")
    land_archive(names, root, 4)
    # tasks report their files: 998 names in up to 7 tiles each, one with an empty part, one missing
    want = names.withColumn("path", F.substring_index(F.regexp_replace("path", "^/+", ""), "/", 4))
    scenes = want.select("path").distinct().count()
    assert tuple(spark.read.parquet(f"{root}/_landed").agg(F.sum("files"), F.sum("rows")).first()) == (scenes, 3002)
    got = opener(spark, "y_idx bigint, flood double")([r.file for r in listing(spark, root).collect()], True)
    assert got.select("file").distinct().count() == scenes and len(list((tmp_path / "many").rglob("part-*.parquet"))) == scenes + len(list((tmp_path / "many" / "_landed").glob("part-*.parquet")))
    assert not list((tmp_path / "many").glob("p0=*/**/_*"))
    assert sorted(map(str, got.select("y_idx", "flood").collect())) == sorted(map(str, names.select("y_idx", "flood").collect()))
    folders = {r.file.split("/many/")[1].rsplit("/", 1)[0] for r in listing(spark, root).collect()}
    assert {"p0=V0M2R3/p1=__HIVE_DEFAULT_PARTITION__/p2=T/p3=x y.tif", "/".join(f"p{i}=__HIVE_DEFAULT_PARTITION__" for i in range(4))} <= folders
    assert "p0=V0M2R3/p1=a%3Db/p2=T000/p3=S_0.tif" in folders
    with pytest.raises(ValueError, match="exists"):
        land_archive(names, root, 4)
    empty = str(tmp_path / "none")
    land_archive(names.limit(0), empty, 4)
    assert listing(spark, empty).count() == 0


def test_a_scene_file_has_large_groups_and_replaces_an_earlier_attempt(tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "GROUP_ROWS", 100)
    for attempt in (0, 1):
        out = archives._SceneFile(pafs.LocalFileSystem(), str(tmp_path / "p0=a"), "part-00000.parquet")
        for i in range(25):
            out.add(pa.record_batch([pa.array([i + attempt] * 10)], names=["y_idx"]))
        out.close()
    found = pq.ParquetFile(tmp_path / "p0=a" / "part-00000.parquet")
    assert found.num_row_groups == 3 and found.read()["y_idx"].to_pylist() == [i + 1 for i in range(25) for _ in range(10)]
    assert [p.name for p in (tmp_path / "p0=a").iterdir()] == ["part-00000.parquet"]


def test_the_catalogue_lists_an_archive_once(spark, archive):
    files = catalogue(spark, archive, scene_name, FLOOD_LEVELS)
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("binaryFile") == 1 and "Join" not in plan and "Aggregate" not in plan
    assert files.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert files.columns[0] == "path" and files.columns[-1] == "file"
