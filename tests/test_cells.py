"""Operators on small hand-computed grids."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from conftest import grid
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eocube.functions import missing
from eocube.functions.projection import LONLAT
from eocube.model import Extent, GridSpec
from eocube.operators import combine, overlay, reduce, select
from eocube.operators.clip import clip_polygon, inside_spans
from eocube.operators.running import accumulate, running_total
from eocube.operators.terrain import hillshade
from eocube.sources.vector import vertices_of


def spec(ny, nx):
    return GridSpec(LONLAT, 0.0, 1.0, float(ny), -1.0, nx, ny)


def test_flag_blocks(cells):
    rows = [
        [1, 1, 0, 0, None, None, 9],
        [1, 0, 1, 1, None, None, 9],
        [0, 0, None, 1, ..., ..., 9],
        [0, 1, None, 0, ..., ..., 9],
    ]
    df = cells(rows)
    out, blocks = reduce.coarsen(df, spec(4, 7), 2, "flag", "v")
    # majority; tie (median one half); all missing; minority; tie; all absent
    assert grid(out) == {(0, 0): 1.0, (0, 1): 1.0, (0, 2): 0.0, (1, 0): 0.0, (1, 1): 1.0, (1, 2): 0.0}
    assert (blocks.ny, blocks.nx) == (2, 3)
    kept, _ = reduce.coarsen(df, spec(4, 7), 2, "flag", "v", keep_missing=True)
    assert grid(kept)[(0, 2)] is None and grid(kept)[(1, 2)] is None
    median, _ = reduce.coarsen(df, spec(4, 7), 2, "median", "v")
    assert {k: 1.0 if (v or 0) > 0 else 0.0 for k, v in grid(median).items()} == grid(out)


def test_mean_blocks_trim_and_exact(cells):
    df = cells([[1, 3, 5], [None, 5, 5], [7, 7, 7]])
    out, _ = reduce.coarsen(df, spec(3, 3), 2, "mean", "v")
    assert grid(out) == {(0, 0): 3.0}
    with pytest.raises(ValueError):
        reduce.coarsen(df, spec(3, 3), 2, "mean", "v", boundary="exact")
    with pytest.raises(ValueError):
        reduce.coarsen(df, spec(3, 3), 2, "middle", "v")


def test_mode_keeps_existing_codes(cells):
    df = cells([[111, 111], [311, 512]])
    assert grid(reduce.coarsen(df, spec(2, 2), 2, "median", "v")[0]) == {(0, 0): 211.0}
    assert grid(reduce.coarsen(df, spec(2, 2), 2, "mode", "v")[0]) == {(0, 0): 111.0}


def test_coarsen_per_key_lists_present_blocks(cells):
    df = cells([[1, 1], [0, 1]]).withColumn("day", F.lit("a"))
    out, _ = reduce.coarsen(df, spec(4, 4), 2, "flag", "v", keys=["day"])
    assert [(r.day, r.y_idx, r.x_idx, r.v) for r in out.collect()] == [("a", 0, 0, 1.0)]
    with pytest.raises(ValueError):
        reduce.coarsen(df, spec(4, 4), 2, "flag", "v", keys=["day"], dense=True)
    every, _ = reduce.coarsen(df, spec(4, 4), 2, "flag", "v", keys=["day"], labels={"day": ["a", "b"]})
    assert {(r.day, r.y_idx, r.x_idx): r.v for r in every.collect()} == {
        (d, y, x): float((d, y, x) == ("a", 0, 0)) for d in "ab" for y in (0, 1) for x in (0, 1)
    }


@pytest.mark.parametrize("n", [1, 2, 9, 10])
def test_exact_median_small(spark, n):
    df = spark.range(n).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    values = sorted(float(i * i) for i in range(n))
    want = (values[(n - 1) // 2] + values[n // 2]) / 2
    assert reduce.exact_median(df, "v", finish_rows=3) == want
    assert reduce.exact_median(df.where("v < 0"), "v") is None


def test_exact_median_hot_value_and_spread(spark):
    # A third of the rows on one value, the rest spread unevenly.
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pow(F.col("id") / 1000.0, 2)).alias("v")
    )
    want = df.agg(F.median("v")).first()[0]
    assert reduce.exact_median(df, "v", finish_rows=200) == want
    hot = df.withColumn("v", F.when(F.col("v") < 400, 5.0).otherwise(F.col("v")))
    assert reduce.exact_median(hot, "v", finish_rows=200) == hot.agg(F.median("v")).first()[0]


def test_normalize(cells):
    assert grid(reduce.normalize(cells([[2, 4], [None, 6]]), "v")) == {(0, 0): 0.0, (0, 1): 0.5, (1, 0): None, (1, 1): 1.0}
    assert set(grid(reduce.normalize(cells([[3, 3]]), "v")).values()) == {None}


def test_daily_reductions(spark):
    df = spark.createDataFrame(
        [("d", 0, 0, 1.0), ("d", 0, 0, None), ("d", 0, 0, 4.0), ("d", 0, 1, None)], "day string, y_idx int, x_idx int, v double"
    )
    assert grid(reduce.daily_sum(df, "v")) == {(0, 0): 5.0, (0, 1): 0.0}
    assert grid(reduce.daily_mean(df, "v")) == {(0, 0): 2.5, (0, 1): None}


def test_overlay_is_never_missing(cells):
    flood = cells([[1, 0], [None, None]], "flood")
    built = cells([[11, 10], [None, 12]], "built")
    assert grid(overlay.overlay_flood_built(flood, built), "class") == {(0, 0): 2.0, (0, 1): 0.0, (1, 0): 0.0, (1, 1): 2.0}


def test_legend_join(spark, cells):
    legend = spark.createDataFrame([(1, "a"), (2, "b")], "code int, label string")
    joined = overlay.join_labels(cells([[1, 2, 3]]), legend, "v")
    assert grid(joined, "label") == {(0, 0): "a", (0, 1): "b", (0, 2): None}


def test_ramp_bins(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (0.5,), (1.0,), (1.5,), (None,)], "v double")
    got = [r[0] for r in df.select(overlay.ramp_bin(F.col("v"), 0.0, 1.0)).collect()]
    assert got == [None, 1, 101, 200, 200, None]


def test_accumulate_skips_or_propagates_missing(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, None), (2, 0, 0, 2.0), (3, 0, 0, None), (1, 0, 1, 1.0), (2, 0, 1, None), (3, 0, 1, 1.0)],
        "time int, y_idx int, x_idx int, tp double",
    )
    at = lambda d: {(r.time, r.x_idx): r.tp for r in d.collect()}
    assert at(accumulate(df, "tp", factor=10.0)) == {
        (1, 0): 0.0, (2, 0): 20.0, (3, 0): 20.0, (1, 1): 10.0, (2, 1): 10.0, (3, 1): 20.0
    }
    assert at(accumulate(df, "tp", factor=10.0, skipna=False)) == {
        (1, 0): None, (2, 0): None, (3, 0): None, (1, 1): 10.0, (2, 1): None, (3, 1): None
    }


@pytest.mark.parametrize("levels", [[], ["a"], ["a", "b"]])
def test_running_total_by_levels(spark, levels):
    # One group holds most of the rows; levels only cut the work.
    df = spark.range(500).select(
        F.when(F.col("id") < 400, "hot").otherwise("cold").alias("g"),
        F.col("id"), (F.col("id") * 7 % 11).alias("v"),
        F.floor(F.col("id") / 100).alias("a"), F.floor(F.col("id") / 10).alias("b"),
    )
    got = {r.id: (r.g, r.v, r.s) for r in running_total(df, ["g"], ["id"], F.col("v"), "s", levels=levels).collect()}
    run = {"hot": 0, "cold": 0}
    for i in range(500):
        g, v, s = got[i]
        run[g] += v
        assert s == run[g]


def test_hillshade_of_a_plane_is_flat(cells):
    df = cells([[x * 100 + y * 50 for x in range(5)] for y in range(4)], "dem")
    assert len({round(v, 9) for v in grid(hillshade(df, spec(4, 5)), "shade").values()}) == 1


@pytest.mark.parametrize("block", [1, 2, 3])
def test_hillshade_does_not_depend_on_blocks(cells, block):
    rng = np.random.default_rng(1)
    rows = [[None if rng.random() < 0.1 else ... if rng.random() < 0.1 else float(rng.integers(0, 900)) for _ in range(7)] for _ in range(6)]
    df = cells(rows, "dem")
    assert grid(hillshade(df, spec(6, 7), block=block), "shade") == grid(hillshade(df, spec(6, 7)), "shade")


def test_hillshade_matches_gradients(cells):
    import numpy as np

    z = np.array([[0, 400, 300, 100], [900, 200, 500, 0], [100, 800, 0, 700]], dtype=float)
    gy, gx = np.gradient(z * 0.001, -1, 1)
    a, h = math.radians(90 - 315), math.radians(45)
    shade = (-gx * math.cos(a) * math.cos(h) - gy * math.sin(a) * math.cos(h) + math.sin(h)) / np.sqrt(gx**2 + gy**2 + 1)
    want = (shade - shade.min()) / (shade.max() - shade.min())
    got = grid(hillshade(cells(z.tolist(), "dem"), spec(3, 4)), "shade")
    assert all(abs(got[(y, x)] - want[y, x]) < 1e-9 for y in range(3) for x in range(4))
    gap = grid(hillshade(cells([[0, 400, 300], [900, ..., 500], [100, 800, 0]], "dem"), spec(3, 3)), "shade")
    assert gap[(0, 1)] is None and gap[(1, 0)] is None and gap[(0, 0)] is not None


def test_rectangle_mask_is_a_box_filter(spark, cells):
    df = cells([[1] * 6 for _ in range(5)])
    s = spec(5, 6)
    box = vertices_of(spark, [[(1, 1), (4, 1), (4, 3), (1, 3)]])
    got = grid(clip_polygon(df, s, box, ["v"]))
    want = {(y, x): 1.0 if 1 <= x < 4 and 2 <= y < 4 else None for y in range(5) for x in range(6)}
    assert got == want
    dropped = grid(clip_polygon(df, s, box, ["v"], keep_shape=False))
    assert dropped == {k: v for k, v in want.items() if v}


def test_polygon_holes_overlaps_and_outside(spark, cells):
    df = cells([[1] * 10 for _ in range(10)])
    s = spec(10, 10)
    rows = [("a", 0, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)])]
    rows += [("a", 1, i, float(x), float(y)) for i, (x, y) in enumerate([(3, 3), (7, 3), (7, 7), (3, 7)])]
    rows += [("b", 0, i, float(x), float(y)) for i, (x, y) in enumerate([(5, 5), (30, 5), (30, 6), (5, 6)])]
    v = spark.createDataFrame(rows, "poly_id string, ring_id int, seq int, x double, y double")
    got = grid(clip_polygon(df, s, v, ["v"]))
    for (y, x), value in got.items():
        cx, cy = x + 0.5, 10 - y - 0.5
        hole = 3 < cx < 7 and 3 < cy < 7
        other = cx > 5 and 5 < cy < 6
        assert (value is not None) == (not hole or other)
    assert len(got) == 100
    per_row = inside_spans(v, s).where("y_idx = 4").orderBy("x_from").collect()
    assert [(r.x_from, r.x_to) for r in per_row] == [(0.0, 3.0), (5.0, 30.0)]


def test_wide_rows_use_blocks(spark):
    s = GridSpec(LONLAT, 0.0, 1.0, 2.0, -1.0, 2000, 2)
    df = s.spine(spark).withColumn("v", F.lit(1.0))
    v = vertices_of(spark, [[(100, 0), (1500.2, 0), (1500.2, 2), (100, 2)]])
    got = clip_polygon(df, s, v, ["v"]).groupBy("y_idx").agg(F.count("v"), F.count(F.lit(1))).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1400, 2000), (1, 1400, 2000)]


def test_mosaic_and_overlap(cells, spark):
    tiles = spark.createDataFrame(
        [(0, 0, 0, 0, 1.0), (0, 2, 0, 0, 2.0)], "tile_y long, tile_x long, y_idx long, x_idx long, v double"
    )
    assert grid(combine.mosaic(tiles, "v")) == {(0, 0): 1.0, (0, 2): 2.0}
    with pytest.raises(PySparkException):
        combine.mosaic(tiles.union(tiles), "v").collect()


def test_squeeze(cells):
    df = cells([[1, 2]]).withColumn("band", F.lit(1))
    assert select.squeeze(df, "band").columns == ["y_idx", "x_idx", "v"]
    with pytest.raises(PySparkException):
        select.squeeze(df.withColumn("band", F.col("x_idx")), "band").collect()


def test_boxes(cells):
    df = cells([[y * 10 + x for x in range(4)] for y in range(4)])
    s = spec(4, 4)
    assert set(grid(select.bbox_slice(df, s, Extent(0.5, 3.5, 1.5, 2.5))[0])) == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert select.bbox_slice(df, s, Extent(50, 50, 60, 60))[0].count() == 0
    merc = Extent(0.4, 2.4, 1.6, 3.6, LONLAT).to("EPSG:3857")
    assert set(grid(select.clip_box(df, s, merc)[0])) == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_crops_carry_their_grid(cells):
    df = cells([[y * 10 + x for x in range(4)] for y in range(4)])
    cut, s = select.bbox_slice(df, spec(4, 4), Extent(1.5, 0.5, 2.5, 1.5))
    whole = spec(4, 4)
    assert (s.nx, s.ny) == (2, 2) and s.x0 == whole.x0 + 1 and grid(cut)[0, 0] == grid(df)[2, 1]
    assert s.bounds().corners() == (1.0, 0.0, 3.0, 2.0)


def test_the_global_grid_projects(spark):
    from eocube.plans import drought, flood
    from eocube.sources.store import GLOBAL_GRID

    box = GLOBAL_GRID.project("EPSG:3857").bounds()
    assert abs(box.max_y - 20037508.34) < 20_000
    cells = [(dt.date(2024, 1, d), 498 + i, 1898 + j, 0.5 * d + i) for d in (1, 2) for i in range(5) for j in range(5)]
    df = spark.createDataFrame(cells, "day date, y_idx long, x_idx long, tp double")
    area = Extent(9.0, 39.0, 11.0, 41.0, LONLAT)
    cells, dst = flood.rain_forecast(df, GLOBAL_GRID, dt.date(2024, 1, 1), dt.date(2024, 1, 2), area, time="day", resolution=5_000.0)
    assert dst.bounds().max_x < 1_300_000 and cells.count() > 0
    sm = df.select(F.col("day").cast("timestamp_ntz").alias("time"), "y_idx", "x_idx", F.col("tp").alias("swvl1"))
    cells, dst = drought.model_drought(sm, GLOBAL_GRID, area)
    assert dst.bounds().max_x < 1_300_000 and cells.count() > 0


def test_missing_values(spark):
    df = spark.createDataFrame([(float("nan"),), (-9999.0,), (3.0,), (None,)], "v double")
    assert [r.v for r in missing.drop_nan(df, -9999.0).collect()] == [None, None, 3.0, None]
    flags = missing.drop_nan(df).select(missing.exceeds(F.col("v"), 0)).collect()
    assert [r[0] for r in flags] == [False, False, True, False]
    packed = spark.createDataFrame([(1.5,), (2.5,), (40000.0,), (None,)], "v double")
    assert [r[0] for r in packed.select(missing.encode_int16(F.col("v"))).collect()] == [2, 2, -9999, -9999]


def test_resolutions(spark):
    assert select.block_steps(select.native_resolution("flood")) == 25
    assert select.block_steps(select.native_resolution("built")) == 50
    with pytest.raises(ValueError):
        select.native_resolution("snow")
    df = spark.createDataFrame([("snow",)], "n string")
    with pytest.raises(PySparkException):
        df.select(select.resolution_of(F.col("n"))).collect()


def test_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, h),) for d in (1, 2, 3) for h in (0, 23)], "time timestamp_ntz")
    assert select.day_select(df, dt.date(2024, 1, 2)).count() == 2
    assert select.day_select(df, dt.date(2024, 1, 1), dt.date(2024, 1, 2)).count() == 4
    assert select.time_slice(df, dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 3)).count() == 4
