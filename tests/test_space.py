"""Projections, regridding and scattered points."""

from __future__ import annotations

import math
import random

import pytest
from conftest import grid
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eocube.functions.geodesy import cell_area, cell_area_exact, haversine
from eocube.functions.projection import EQUI7_GRIDS, EQUIDISTANT_EU, LONLAT, MOLLWEIDE, WEB_MERCATOR, project, project_point
from eocube.model import Extent, GridSpec
from eocube.operators.regrid import regrid, reproject
from eocube.operators.swath import nearest_points, resample_points


@settings(max_examples=60, deadline=None)
@given(st.floats(-170, 170), st.floats(-80, 80), st.sampled_from([WEB_MERCATOR, MOLLWEIDE]))
def test_round_trip(lon, lat, crs):
    back = project_point(*project_point(lon, lat, LONLAT, crs), crs, LONLAT)
    assert back == pytest.approx((lon, lat), abs=1e-6)


@settings(max_examples=60, deadline=None)
@given(st.floats(-10, 50), st.floats(30, 70))
def test_round_trip_equidistant(lon, lat):
    # Forward and inverse series are cut at the same order: metres, not millimetres.
    back = project_point(*project_point(lon, lat, LONLAT, EQUIDISTANT_EU), EQUIDISTANT_EU, LONLAT)
    assert back == pytest.approx((lon, lat), abs=1e-3)


def geodesic(lat_a, lon_a, lat_b, lon_b):
    """Distance and start azimuth on the ellipsoid by Vincenty's iteration."""
    f = 1 / 298.257223563
    b = 6378137.0 * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(v))) for v in (lat_a, lat_b))
    lam = start = math.radians(lon_b - lon_a)
    for _ in range(30):
        east = math.cos(u2) * math.sin(lam)
        north = math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam)
        ss, cs = math.hypot(east, north), math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        s = math.atan2(ss, cs)
        sa = math.cos(u1) * math.cos(u2) * math.sin(lam) / ss
        c2 = 1 - sa * sa
        cm = cs - 2 * math.sin(u1) * math.sin(u2) / c2
        k = f / 16 * c2 * (4 + f * (4 - 3 * c2))
        lam = start + (1 - k) * f * sa * (s + k * ss * (cm + k * cs * (2 * cm * cm - 1)))
    w = c2 * (6378137.0**2 - b * b) / (b * b)
    big = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
    low = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
    d = low * ss * (cm + low / 4 * (cs * (2 * cm * cm - 1) - low / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
    return b * big * (s - d), math.atan2(east, north)


@settings(max_examples=60, deadline=None)
@given(st.floats(6, 19), st.floats(36, 47.5))
def test_equidistant_is_close_to_geodesics(lon, lat):
    d, az = geodesic(53.0, 24.0, lat, lon)
    x, y = project_point(lon, lat, LONLAT, EQUIDISTANT_EU)
    assert math.hypot(x - 5837287.81977 - d * math.sin(az), y - 2121415.69617 - d * math.cos(az)) < 80


@pytest.mark.parametrize("crs", [WEB_MERCATOR, MOLLWEIDE, EQUIDISTANT_EU])
def test_columns_agree_with_floats(spark, crs):
    rng = random.Random(1)
    points = [(rng.uniform(5, 25), rng.uniform(35, 60)) for _ in range(20)] + [(24.0, 53.0)]
    df = spark.createDataFrame(points, "x double, y double")
    for (px, py), r in zip(points, project(df, F.col("x"), F.col("y"), LONLAT, crs, ("u", "v")).collect()):
        assert (r.u, r.v) == pytest.approx(project_point(px, py, LONLAT, crs), abs=1e-3)


def test_known_places():
    assert project_point(180, 0, LONLAT, WEB_MERCATOR)[0] == pytest.approx(20037508.342789244)
    assert project_point(24, 53, LONLAT, EQUIDISTANT_EU) == pytest.approx((5837287.81977, 2121415.69617), abs=1e-6)
    assert project_point(0, 90, LONLAT, MOLLWEIDE)[1] == pytest.approx(9020047.848, abs=1)


def test_unknown_system():
    with pytest.raises(ValueError):
        project_point(0, 0, LONLAT, "EPSG:1")


def test_distances_and_areas(spark):
    row = spark.range(1).select(
        haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        cell_area(F.lit(0.0), F.lit(0.0)).alias("a0"), cell_area_exact(F.lit(0.0)).alias("e0"),
        cell_area(F.lit(80.0), F.lit(0.0)).alias("a80"),
    ).first()
    assert row.half == pytest.approx(math.pi * 6371e3)
    assert row.a0 / row.e0 == pytest.approx(0.866, abs=1e-3)
    assert row.a80 is None


def test_extent():
    e = Extent.parse(" 6.15, 46.90,19.60,35.64 , EPSG:4326 ")
    assert e.corners() == (6.15, 35.64, 19.6, 46.9) and e.crs == LONLAT
    assert Extent.parse("1,2,3,4").crs is None
    assert e.to(WEB_MERCATOR).to(LONLAT).corners() == pytest.approx(e.corners(), abs=1e-6)
    with pytest.raises(ValueError):
        Extent.parse("1,2,3")


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 9))
def test_trim_keeps_whole_blocks(ny, nx, k):
    out = GridSpec(LONLAT, 0, 1, 0, -1, nx, ny).coarsen(k)
    assert (out.ny, out.nx) == (ny // k, nx // k)


SRC = GridSpec(LONLAT, 10.0, 0.5, 50.0, -0.5, 8, 6)


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_regrid_to_itself_is_identity(cells, method):
    df = cells([[y * 10 + x if (y + x) % 3 else None for x in range(8)] for y in range(6)])
    got = grid(regrid(df, SRC, SRC, ["v"], method))
    want = grid(df)
    assert set(got) == set(want)
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-6) for k in want)


def test_bilinear_of_a_plane_is_the_plane(cells):
    df = cells([[3 * x + 7 * y for x in range(8)] for y in range(6)])
    fine = GridSpec(LONLAT, 10.25, 0.1, 49.75, -0.1, 35, 25)
    for (y, x), v in grid(regrid(df, SRC, fine, ["v"], "bilinear")).items():
        lon, lat = 10.25 + 0.1 * (x + 0.5), 49.75 - 0.1 * (y + 0.5)
        assert v == pytest.approx(3 * ((lon - 10) / 0.5 - 0.5) + 7 * ((50 - lat) / 0.5 - 0.5))


def brute(values, src, dst, method):
    """Target-by-target sampling in plain Python."""
    out = {}
    for i in range(dst.ny):
        for j in range(dst.nx):
            x, y = project_point(dst.x0 + (j + 0.5) * dst.dx, dst.y0 + (i + 0.5) * dst.dy, dst.crs, src.crs)
            ax, ay = (x - src.x0) / src.dx, (y - src.y0) / src.dy
            if not (0 <= ax < src.nx and 0 <= ay < src.ny):
                continue
            if method == "nearest":
                if (math.floor(ay), math.floor(ax)) in values:
                    out[(i, j)] = values[(math.floor(ay), math.floor(ax))]
                continue
            jx, jy = math.floor(ax - 0.5), math.floor(ay - 0.5)
            wx, wy = ax - 0.5 - jx, ay - 0.5 - jy
            near = {(jy + b, jx + r): (wy if b else 1 - wy) * (wx if r else 1 - wx) for b in (0, 1) for r in (0, 1)}
            present = {k: w for k, w in near.items() if k in values}
            if present:
                valid = {k: w for k, w in present.items() if values[k] is not None}
                total = sum(valid.values())
                out[(i, j)] = sum(values[k] * w for k, w in valid.items()) / total if total else None
    return out


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
@pytest.mark.parametrize("crs", [WEB_MERCATOR, EQUIDISTANT_EU, MOLLWEIDE])
def test_reproject_against_brute_force(cells, method, crs):
    df = cells([[(y * 13 + x * 7) % 10 if (y * x) % 4 != 3 else (None if x % 2 else ...) for x in range(8)] for y in range(6)])
    out, dst = reproject(df, SRC, crs, ["v"], method)
    got, want = grid(out), brute(grid(df), SRC, dst, method)
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) if want[k] is not None else got[k] is None for k in want)


def test_nodata_does_not_dilute(cells):
    df = cells([[0, 6], [6, 6]])
    between = GridSpec(LONLAT, 10.25, 0.5, 49.75, -0.5, 1, 1)
    assert grid(regrid(df, SRC, between, ["v"], "bilinear")) == pytest.approx({(0, 0): 4.5})
    assert grid(regrid(df, SRC, between, ["v"], "bilinear", nodata=0.0)) == pytest.approx({(0, 0): 6.0})
    dry = regrid(cells([[0, 0], [0, 0]]), SRC, between, ["v"], "bilinear", nodata=0.0)
    assert grid(dry) == {(0, 0): 0.0}


def test_dense_regrid_keeps_steps_outside_the_target(spark):
    df = spark.createDataFrame([(1, 0, 0, 1.0), (2, 900, 900, 2.0)], "t int, y_idx long, x_idx long, v double")
    out, dst = reproject(df, SRC, WEB_MERCATOR, ["v"], keys=["t"], dense=True)
    assert {r.t: r["count"] for r in out.groupBy("t").count().collect()} == {1: dst.cells, 2: dst.cells}


def test_dense_regrid_lists_every_cell(cells):
    df = cells([[1, 2], [3, ...]]).withColumn("t", F.lit(1)).unionByName(cells([[5]]).withColumn("t", F.lit(2)))
    out, dst = reproject(df, SRC, WEB_MERCATOR, ["v"], keys=["t"], dense=True)
    assert out.count() == 2 * dst.cells


def test_reproject_back_to_lonlat_from_metres(cells):
    src = GridSpec(EQUIDISTANT_EU, 4_800_000.0, 50_000.0, 1_200_000.0, -50_000.0, 8, 6)
    df = cells([[y + x for x in range(8)] for y in range(6)])
    out, dst = reproject(df, src, LONLAT, ["v"])
    assert grid(out) == brute(grid(df), src, dst, "nearest")


GRID = GridSpec(EQUIDISTANT_EU, 4_700_000.0, 6_500.0, 1_000_000.0, -6_500.0, 30, 30)


def places(n, seed):
    rng = random.Random(seed)
    return [(i, rng.uniform(9.0, 12.5), rng.uniform(41.0, 43.5)) for i in range(1, n + 1)]


def brute_points(points, dst, radius):
    out = {}
    for i in range(dst.ny):
        for j in range(dst.nx):
            lon, lat = project_point(dst.x0 + (j + 0.5) * dst.dx, dst.y0 + (i + 0.5) * dst.dy, dst.crs, LONLAT)
            best = min((arc(lat, lon, p[2], p[1]), p[0]) for p in points)
            if best[0] <= radius:
                out[(i, j)] = best[1]
    return out


def arc(lat_a, lon_a, lat_b, lon_b):
    p, q = math.radians(lat_a), math.radians(lat_b)
    a = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon_b - lon_a) / 2) ** 2
    return 2 * 6371e3 * math.asin(math.sqrt(a))


@pytest.mark.parametrize("radius", [5_000.0, 50_000.0])
def test_nearest_points_against_brute_force(spark, radius):
    points = places(60, 3)
    # A crowd at one place, with larger ids: it must neither win ties nor cost pairs.
    crowd = [(1000 + i, points[0][1], points[0][2]) for i in range(300)]
    df = spark.createDataFrame(points + crowd, "location_id long, lon double, lat double")
    got = grid(nearest_points(df, GRID, radius), "location_id")
    assert got == brute_points(points, GRID, radius) and got


@pytest.mark.parametrize("dst", [
    GridSpec("EPSG:3857", 1_080_000.0, 500.0, 5_970_000.0, -500.0, 90, 90),
    GridSpec(LONLAT, 9.8, 0.01, 47.2, -0.01, 45, 45),
    GridSpec(LONLAT, -180.0, 0.01, 72.1, -0.01, 40, 30),
])
def test_reach_follows_the_map_scale(spark, dst):
    points = [(1, 10.0, 47.0), (2, 10.03, 47.01), (3, 179.95, 72.0)]
    df = spark.createDataFrame(points, "location_id long, lon double, lat double")
    got = grid(nearest_points(df, dst, 5_000.0), "location_id")
    assert got == brute_points(points, dst, 5_000.0) and got


@pytest.mark.parametrize("name", sorted(EQUI7_GRIDS))
def test_equidistant_grids_go_there_and_back(name):
    crs = EQUI7_GRIDS[name]
    given = dict(p.split("=") for p in crs.replace("+", "").split() if "=" in p)
    lat, lon = float(given["lat_0"]), float(given["lon_0"])
    assert project_point(lon, lat, LONLAT, crs) == pytest.approx((float(given["x_0"]), float(given["y_0"])), abs=1e-6)
    place = lon + 7, min(lat + 6, 84)
    assert project_point(*project_point(*place, LONLAT, crs), crs, LONLAT) == pytest.approx(place, abs=1e-4)
    with pytest.raises(ValueError):
        project_point(0, 0, LONLAT, crs.replace("WGS84", "NAD27"))


FAR_AZIMUTHAL = "+proj=aeqd +lat_0=50 +lon_0=10 +x_0=0 +y_0=0 +datum=WGS84 +units=m"


@pytest.mark.parametrize("crs, lon, lat, radius", [
    ("ESRI:54009", 12.0, 46.0, 5_000.0), ("ESRI:54009", -179.9, 71.0, 20_000.0), ("ESRI:54009", 100.0, -84.0, 9_000.0),
    (EQUIDISTANT_EU, 10.0, 45.0, 5_000.0), (FAR_AZIMUTHAL, 178.0, 49.0, 30_000.0), (FAR_AZIMUTHAL, -179.99, 48.0, 30_000.0),
    (FAR_AZIMUTHAL, 130.0, 5.0, 12_000.0),
])
def test_reach_in_space_on_any_map(spark, crs, lon, lat, radius):
    """Mollweide, an azimuthal grid 80 degrees and more from its centre, and across the date line."""
    x, y = project_point(lon, lat, LONLAT, crs)
    dst = GridSpec(crs, x - 15 * radius / 6, radius / 6, y + 15 * radius / 6, -radius / 6, 30, 30)
    rng = random.Random(4)
    wrap = lambda d: (d + 180) % 360 - 180
    spread = radius / 111_000
    points = [(k, wrap(lon + rng.uniform(-6, 6) * spread), max(-89.99, min(89.99, lat + rng.uniform(-3, 3) * spread))) for k in range(40)]
    df = spark.createDataFrame(points, "location_id long, lon double, lat double")
    got = grid(nearest_points(df, dst, radius), "location_id")
    assert got == brute_points(points, dst, radius) and got


def test_points_without_position_are_ignored(spark):
    df = spark.createDataFrame([(1, None, 42.0), (2, 10.0, None)], "location_id long, lon double, lat double")
    assert nearest_points(df, GRID, 5000.0).count() == 0


def test_resample_points_keeps_missing_and_fills(spark):
    lon, lat = project_point(4_800_000.0, 900_000.0, EQUIDISTANT_EU, LONLAT)
    points = spark.createDataFrame([(1, lon, lat)], "location_id long, lon double, lat double")
    obs = spark.createDataFrame([(1, "a", 0.5), (1, "b", None)], "location_id long, time string, sm double")
    sparse = resample_points(points, obs, GRID, 5_000.0, ["sm"]).collect()
    assert {(r.time, r.sm) for r in sparse} == {("a", 0.5), ("b", None)}
    dense = resample_points(points, obs, GRID, 5_000.0, ["sm"], fill=0.0, dense=True)
    assert dense.count() == 2 * GRID.cells
    assert dense.where("time = 'b' and sm is null").count() == len(sparse) // 2
    assert dense.where("time = 'a' and sm = 0").count() == GRID.cells - len(sparse) // 2
