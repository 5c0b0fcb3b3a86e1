"""Bins, nearest steps, ragged series, the by-day store and streams."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eocube.functions.calendar import epoch_micros, to_minute
from eocube.functions.projection import LONLAT
from eocube.model import Extent, GridSpec
from eocube.operators import nearest, ragged
from eocube.operators.resample import resample_time
from eocube.plans import ingest
from eocube.sources import store
from eocube.sources.archive import land_archive
from eocube.sources.catalog import Catalog, CellSource, attrs_of
from eocube.sources.files import file_catalog, list_files
from eocube.sources.tables import read_colours, read_legend
from eocube.sources.vector import read_geojson
from eocube.streaming import accumulate, cache, steps
from eocube.streaming.sink import StatefulSink

T0 = dt.datetime(2024, 1, 1)


def test_bins_start_at_the_first_day_and_keep_gaps(spark):
    rows = [(dt.datetime(2024, 1, 5, 13), 0, 0, 1.0), (dt.datetime(2024, 1, 14, 23), 0, 0, 3.0),
            (dt.datetime(2024, 1, 15), 0, 0, None), (dt.datetime(2024, 1, 30), 0, 1, 7.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, y_idx int, x_idx int, v double")
    got = {(r.time.day, r.x_idx): r.v for r in resample_time(df, 10, "v").collect()}
    assert got == {(5, 0): 2.0, (15, 0): None, (25, 0): None, (5, 1): None, (15, 1): None, (25, 1): 7.0}
    sparse = resample_time(df, 10, "v", fill=False).count()
    assert sparse == 3
    given = resample_time(df, 10, "v", span=(dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    assert sorted({r.time.day for r in given.collect()}) == [1, 11, 21, 31]


def test_time_functions_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 15, 250000),)], "t timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = df.select(epoch_micros(F.col("t")).alias("m"), to_minute(F.col("t")).alias("u")).first()
            assert r.m == 1710037815250000
            assert r.u == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("crowd", [0, 40])
def test_nearest_label_against_brute_force(spark, crowd):
    rng = random.Random(5)
    axis = sorted({T0 + dt.timedelta(hours=rng.randrange(0, 2000)) for _ in range(25)})
    # labels that crowd within a second beside ones that lie weeks apart
    axis = sorted({*axis, *(T0 + dt.timedelta(microseconds=17 * i) for i in range(crowd))})
    times = [T0 + dt.timedelta(minutes=rng.randrange(-9000, 140_000)) for _ in range(300)]
    times += [a + (b - a) / 2 for a, b in zip(axis, axis[1:])] + axis
    df = spark.createDataFrame(list(enumerate(times)), "id int, time timestamp_ntz")
    labels = spark.createDataFrame([(a,) for a in axis], "label timestamp_ntz")
    got = {r.id: r.label for r in nearest.nearest_label(df, labels).collect()}
    assert len(got) == len(times)
    for i, t in enumerate(times):
        assert got[i] == min(axis, key=lambda a: (abs(a - t), -a.timestamp()))


def test_crowded_labels_do_not_multiply_rows(spark):
    """A row meets three stretches of every width at most, also where all labels share a second."""
    labels = spark.range(2000).select((F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") / 1e4)).alias("label"))
    far = spark.createDataFrame([(T0 + dt.timedelta(days=3650),)], "label timestamp_ntz")
    df = labels.withColumnRenamed("label", "time")
    out = nearest.nearest_label(df, labels.union(far))
    assert out.where("label = time").count() == 2000 == out.count()


def test_rows_without_time_get_no_label(spark):
    df = spark.createDataFrame([(1, None), (2, T0)], "id int, time timestamp_ntz")
    axis = spark.createDataFrame([(T0,)], "label timestamp_ntz")
    assert {(r.id, r.label) for r in nearest.nearest_label(df, axis).collect()} == {(1, None), (2, T0)}


def test_nearest_on_a_single_label(spark):
    df = spark.createDataFrame([(T0 - dt.timedelta(days=900),), (T0 + dt.timedelta(days=900),)], "time timestamp_ntz")
    axis = spark.createDataFrame([(T0,)], "label timestamp_ntz")
    assert [r.label for r in nearest.nearest_label(df, axis).collect()] == [T0, T0]


def test_steps_of_an_axis(spark):
    cube = spark.createDataFrame([(t, x, 1.0) for t in (3, 1, 2) for x in (0, 1)], "time int, x_idx int, v double")
    assert {r.time for r in nearest.first_step(cube).collect()} == {1}
    assert {r.time for r in nearest.nth_step(cube, 2).collect()} == {3}
    assert nearest.nth_step(cube, 3).count() == 0


def ragged_tables(spark, sizes):
    """One file: locations with given ids and sizes, one observation per slot."""
    locs = spark.createDataFrame(
        [(1, p, i, n) for p, (i, n) in enumerate(sizes)], "file_id int, pos int, location_id long, row_size long"
    )
    obs, at = [], 0
    for i, n in sizes:
        for k in range(n):
            obs.append((1, at, T0 + dt.timedelta(minutes=k), float(i * 1000 + k)))
            at += 1
    return locs, spark.createDataFrame(obs, "file_id int, obs_idx long, time timestamp_ntz, sm double")


@pytest.mark.parametrize("chunk", [3, 10, 65_536])
def test_ragged_decode(spark, monkeypatch, chunk):
    monkeypatch.setattr(ragged, "OBS_CHUNK", chunk)
    monkeypatch.setattr(ragged, "LOCATION_BLOCK", 2)
    sizes = [(0, 2), (1, 0), (2, 25), (3, 1), (5, 0), (7, 4), (9, 1)]
    locs, obs = ragged_tables(spark, sizes)
    offsets = ragged.ragged_offsets(locs)
    assert [(r.cum_sum, r.offset) for r in offsets.orderBy("pos").collect()] == [
        (2, 0), (2, 2), (27, 2), (28, 27), (28, 28), (32, 28), (33, 32)
    ]
    owned = ragged.decode_ragged(offsets, obs).collect()
    assert len(owned) == 33
    assert all(r.sm // 1000 == r.location_id for r in owned)
    # Observations behind the last location belong to nobody.
    extra = obs.unionByName(obs.limit(1).withColumn("obs_idx", F.lit(40).cast("long")))
    assert ragged.decode_ragged(offsets, extra).count() == 33


def test_ragged_order_is_that_of_the_file(spark):
    """Ids out of order, two padding ids, one location without observations."""
    sizes = [(20, 2), (-1, 3), (0, 1), (-1, 2), (30, 0), (10, 3)]
    locs, obs = ragged_tables(spark, sizes)
    owned = ragged.decode_ragged(ragged.ragged_offsets(locs), obs).collect()
    want = [i for i, n in sizes for _ in range(n)]
    assert [r.location_id for r in sorted(owned, key=lambda r: r.obs_idx)] == want
    places = locs.where("location_id > 0")
    lengths = ragged.series_length(obs.join(spark.createDataFrame(list(enumerate(want)), "obs_idx long, location_id long"), "obs_idx"),
                                   locations=places, order=("file_id", "pos"))
    assert {(r.location_id, r.n) for r in lengths.collect()} == {(20, 2), (30, 0), (10, 3)}
    tied = lengths.where("n > 0").withColumn("n", F.lit(1))
    assert ragged.longest_series(tied, order=("file_id", "pos")).first().location_id == 20


def test_align_to_the_longest_series(spark):
    def series(loc, minutes):
        return [(loc, i, T0 + dt.timedelta(minutes=m, seconds=10), float(m)) for i, m in enumerate(minutes)]

    rows = series(2, [0, 10, 20]) + series(1, [0, 30, 60]) + series(3, [31, 33])
    obs = spark.createDataFrame(rows, "location_id long, obs_idx long, time timestamp_ntz, sm double")
    got = {(r.location_id, r.time.minute + 60 * r.time.hour): r.sm for r in ragged.align_to_axis(obs).collect()}
    # Equal lengths: the first location gives the axis; the last write stays.
    assert got == {(1, 0): 0.0, (1, 30): 30.0, (1, 60): 60.0, (2, 0): 10.0, (2, 30): 20.0, (3, 30): 33.0}
    dense = ragged.align_to_axis(obs, dense=True)
    assert dense.count() == 9 and dense.where("sm is null").count() == 3


GRID = GridSpec(LONLAT, 0.0, 1.0, 2.0, -1.0, 2, 2)


def hourly(spark, days, value=1.0):
    rows = [(dt.date(2024, 1, d), h, 0, x, value * d) for d in days for h in range(3) for x in (0, 1)]
    return spark.createDataFrame(rows, "day date, step int, y_idx long, x_idx long, tp double")


@pytest.mark.parametrize("in_a_range", [200_000, 7, 1])
def test_nearest_of_crowded_labels(spark, monkeypatch, in_a_range):
    """Labels and rows at all distances, many at one time, against a comparison with every label."""
    monkeypatch.setattr(nearest, "RANGE_TIMES", in_a_range)
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    at = lambda: base + dt.timedelta(microseconds=rng.choice([rng.randrange(50), rng.randrange(10**6), rng.randrange(10**12)]))
    labels = sorted({at() for _ in range(60)})
    times = [at() for _ in range(80)] + [base] * 40 + [labels[5]] * 3 + [base - dt.timedelta(days=9), base + dt.timedelta(days=900)]
    df = spark.createDataFrame(list(enumerate(times)), "id long, time timestamp_ntz").repartition(3)
    axis = spark.createDataFrame([(x,) for x in labels], "time timestamp_ntz")
    got = sorted((r.id, r.label) for r in nearest.nearest_label(df, axis).collect())
    want = [(i, min(labels, key=lambda x: (abs(x - t), -x.toordinal(), -(x - base)))) for i, t in enumerate(times)]
    assert got == want
    placed = {r.time: r.step for r in nearest.axis_positions(axis.union(axis)).collect()}
    assert placed == {x: i for i, x in enumerate(labels)}
    found = nearest.first_index_of(axis, df.withColumnRenamed("time", "request")).collect()
    assert sorted((r.id, r["index"]) for r in found) == [(i, labels.index(x)) for i, x in want]


def test_each_row_is_joined_once(spark):
    """No row is copied, and no window runs without partition."""
    df = spark.range(1000).selectExpr("id", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id) as time")
    axis = df.where("id % 7 = 0").select("time")
    plan = nearest.nearest_label(df, axis)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window [" in plan and ", [_micros" in plan
    assert nearest.nearest_label(df, axis).count() == 1000


def test_store_fills_only_uncovered_days(spark, tmp_path):
    root = str(tmp_path / "store")
    box = Extent(0, 0, 2, 2)
    get = lambda src, a, b: ingest.cached_get(
        spark, root, src, "tp", GRID, box, dt.date(2024, 1, a), b and dt.date(2024, 1, b), steps=3
    )
    first = get(hourly(spark, [1, 2, 3]), 1, 2)
    assert {(r.day.day, r.tp) for r in first.collect()} == {(1, 3.0), (2, 6.0)}
    # Days 1 and 2 are kept as they are although the source has changed.
    again = get(hourly(spark, [1, 2, 3, 4], value=10.0), 1, 4)
    assert {(r.day.day, r.tp) for r in again.collect()} == {(1, 3.0), (2, 6.0), (3, 90.0), (4, 120.0)}
    assert get(hourly(spark, [4], 99.0), 4, None).count() == 2
    flags = store.read_coverage(spark, root)
    assert sorted(r.day.day for r in flags.collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        ingest.fill_days(spark, root, hourly(spark, [1]), "snow", store.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1)))


def test_a_day_in_parts_is_done_again_until_complete(spark, tmp_path):
    root, whole = str(tmp_path / "store"), hourly(spark, [1])
    day = store.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    total = lambda: {r.tp for r in spark.read.parquet(f"{root}/cube").collect()}
    flag = lambda: [r.covered for r in store.read_coverage(spark, root).collect()]
    ingest.fill_days(spark, root, whole.where("step < 1"), "tp", day, steps=3)
    assert (total(), flag()) == ({1.0}, [0])
    ingest.fill_days(spark, root, whole, "tp", day, steps=3)
    assert (total(), flag()) == ({3.0}, [1])
    ingest.fill_days(spark, root, hourly(spark, [1], 9.0), "tp", day, steps=3)
    assert (total(), flag()) == ({3.0}, [1])


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "cube")
    df = hourly(spark, [1, 2]).where("step = 0").drop("step")
    store.upsert_days(df, path)
    store.upsert_days(df.where("day = '2024-01-02'").withColumn("tp", F.lit(5.0)), path)
    store.upsert_days(df.where("day = '2024-01-02'").withColumn("tp", F.lit(5.0)), path)
    assert sorted((r.day.day, r.tp) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (1, 1.0), (2, 5.0), (2, 5.0)]


def test_write_fails_if_the_target_exists(spark, tmp_path):
    path = str(tmp_path / "cube")
    df = hourly(spark, [1])
    store.write_cube(df, path, partition_by=["day"])
    with pytest.raises(PySparkException):
        store.write_cube(df, path, partition_by=["day"])
    store.write_cube(df, path, overwrite=True, partition_by=["day"])


def test_global_grid(spark):
    g = store.GLOBAL_GRID
    assert (g.ny, g.nx, g.cells) == (1801, 3600, 6_483_600)
    assert store.calendar(spark).count() == 3288
    lat = spark.range(1).select(g.center_y(F.lit(0)).alias("n"), g.center_y(F.lit(1800)).alias("s"), g.center_x(F.lit(0)).alias("w")).first()
    assert (lat.n, lat.s, lat.w) == pytest.approx((90.0, -90.0, -180.0))


def rain(spark):
    values = {0: [1.0, 2.0, 3.0, 4.0], 1: [1.0, None, 3.0, 4.0], 2: [None, 1.0, 1.0, 1.0]}
    rows = [(dt.date(2024, 1, d + 1), 0, x, v) for x, vs in values.items() for d, v in enumerate(vs)]
    return spark.createDataFrame(rows, "day date, y_idx long, x_idx long, tp double")


def total_run(spark, schema, landing, out, check, **kw):
    return steps.run_to_files(accumulate.running_accumulate(steps.file_stream(spark, landing, schema, **kw)), out, check)


def test_stream_equals_batch(spark, tmp_path):
    from eocube.operators.running import accumulate as batch

    cells, landing, out, check = rain(spark), *(str(tmp_path / p) for p in ("in", "out", "check"))
    for numbers in ([1], [2, 3], [4]):
        days = [dt.date(2024, 1, d) for d in numbers]
        steps.land_files(cells, landing, days)
        steps.mark_whole(spark, landing, cells.schema, days)
        total_run(spark, cells.schema, landing, out, check)
    got = {(r.day, r.x_idx): r.tp for r in spark.read.parquet(out).collect()}
    want = {(r.day, r.x_idx): r.tp for r in batch(cells, "tp", time="day", skipna=False).collect()}
    assert got == want and len(got) == 12
    fine, spec = accumulate.close_stream(spark.read.parquet(out), GRID, resolution=20_000.0)
    assert spec.crs == "EPSG:3857" and fine.count() > 0


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_totals_do_not_depend_on_the_zone(spark, tmp_path, zone):
    cells, landing, out, check = rain(spark), *(str(tmp_path / p) for p in ("in", "out", "check"))
    days, before = [dt.date(2024, 1, d) for d in (1, 2)], spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for day in days:
            steps.land_files(cells, landing, [day])
            steps.mark_whole(spark, landing, cells.schema, [day])
            total_run(spark, cells.schema, landing, out, check)
        got = {(r.day, r.x_idx): r.tp for r in spark.read.parquet(out).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {k[0] for k in got} == set(days) and got[days[1], 0] == 3000.0


def test_days_cut_across_batches(spark, tmp_path):
    """80 files that each hold all ten days, 30 a batch: no day is whole before the last batch."""
    landing, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    cells = spark.range(4000).selectExpr(
        "date_add(date'2024-01-01', int(id % 10)) as day", "id div 10 div 20 as y_idx", "70 + id div 10 % 20 as x_idx", "double(id % 7) as tp"
    )
    days = [dt.date(2024, 1, d) for d in range(1, 11)]
    steps.land_files(cells, landing, days, files=80)
    total_run(spark, cells.schema, landing, out, check, files_per_batch=30)
    assert spark.read.schema(cells.schema).parquet(out).count() == 0  # held back until their end marks
    steps.mark_whole(spark, landing, cells.schema, days[:9])
    total_run(spark, cells.schema, landing, out, check, files_per_batch=30)
    assert {r.day.day for r in spark.read.parquet(out).select("day").distinct().collect()} == set(range(1, 10))
    steps.mark_whole(spark, landing, cells.schema, days[9:])
    total_run(spark, cells.schema, landing, out, check, files_per_batch=30)
    want = cells.selectExpr("day", "y_idx", "x_idx", "sum(tp * 1000) over (partition by y_idx, x_idx order by day) as tp")
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, want.collect()))


def test_late_day_fails_the_stream(spark, tmp_path):
    cells, landing, out, check = rain(spark), *(str(tmp_path / p) for p in ("in", "out", "check"))
    second, first = dt.date(2024, 1, 2), dt.date(2024, 1, 1)
    steps.land_files(cells, landing, [second])
    steps.mark_whole(spark, landing, cells.schema, [second])
    total_run(spark, cells.schema, landing, out, check)
    assert spark.read.parquet(out).count() == 3
    steps.land_files(cells, landing, [first])
    with pytest.raises(PySparkException):
        total_run(spark, cells.schema, landing, out, check)


def test_a_step_is_one_whole_day(spark, tmp_path):
    """However many files a day has, and after a restart."""
    cells, root, check = rain(spark), str(tmp_path / "in"), str(tmp_path / "check")
    seen = {}

    def send(batch, batch_id):
        seen[batch_id] = sorted((r.day.day, r.x_idx, r.tp) for r in batch.where("y_idx is not null").collect())

    for numbers in ([2, 1], [3], [4]):
        steps.land_steps(cells, root, [dt.date(2024, 1, d) for d in numbers], files=3)
        steps.run_each(send, steps.step_stream(spark, root, cells.schema, marks=len(numbers) == 2), check)
    want = {d - 1: sorted((d, r.x_idx, r.tp) for r in cells.collect() if r.day.day == d) for d in range(1, 5)}
    assert {k: len(v) for k, v in seen.items()} == {k: 3 for k in range(4)}
    assert {k: [x[:2] for x in v] for k, v in seen.items()} == {k: [x[:2] for x in v] for k, v in want.items()}


def test_totals_of_a_step_stream(spark, tmp_path):
    cells, root, out, check = rain(spark), *(str(tmp_path / p) for p in ("in", "out", "check"))
    steps.land_steps(cells, root, [dt.date(2024, 1, d) for d in (1, 2)], files=2)
    steps.run_to_files(accumulate.running_accumulate(steps.step_stream(spark, root, cells.schema, marks=True)), out, check)
    got = {(r.day.day, r.x_idx): r.tp for r in spark.read.parquet(out).collect()}
    assert got == {(1, 0): 1000.0, (2, 0): 3000.0, (1, 1): 1000.0, (2, 1): None, (1, 2): None, (2, 2): None}


def test_stream_fills_the_store(spark, tmp_path):
    landing, root, check = (str(tmp_path / p) for p in ("in", "store", "check"))
    src = hourly(spark, [1, 2])
    src.write.parquet(landing)
    stream = steps.file_stream(spark, landing, src.schema)
    fill = lambda: cache.fill_from_stream(stream, root, "tp", check, steps=3)
    fill()
    assert [r.rows for r in steps.progress(spark, check).collect()] == [12]
    fill()
    assert spark.read.parquet(f"{root}/cube").count() == 4
    # a day in two deliveries, and one slice that lands twice
    third = hourly(spark, [3])
    for part in ("step < 2", "step > 0"):
        third.where(part).write.mode("append").parquet(landing)
        fill()
    assert {r.tp for r in spark.read.parquet(f"{root}/cube").where("day = '2024-01-03'").collect()} == {9.0}
    covered = {r.day.day: r.covered for r in spark.read.parquet(f"{root}/coverage").collect()}
    assert covered == {1: 1, 2: 1, 3: 1}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    day = hourly(spark, [5])
    read = lambda: sorted(map(tuple, spark.read.parquet(f"{root}/cube").select("y_idx", "x_idx", "tp", "n", "steps").collect()))
    ingest.add_slices(spark, root, day.where("step < 2"), "tp", steps=3)
    first = read()
    ingest.add_slices(spark, root, day.where("step < 2"), "tp", steps=3)
    assert read() == first
    ingest.add_slices(spark, root, day, "tp", steps=3)
    ingest.fill_days(spark, str(tmp_path / "whole"), day, "tp", day.select("day").distinct(), steps=3)
    assert read() == sorted(map(tuple, spark.read.parquet(f"{tmp_path}/whole/cube").select("y_idx", "x_idx", "tp", "n", "steps").collect()))


def test_what_a_batch_reads_follows_what_arrived(spark, tmp_path):
    """After 20 batches of one day each, a batch reads its own rows and the stored cells of its day."""
    from eocube.sources import store as stored

    landing, root, check = (str(tmp_path / p) for p in ("in", "store", "check"))
    days = [dt.date(2024, 1, d) for d in range(1, 21)]
    src = hourly(spark, range(1, 21))
    for d in days:
        steps.land_files(src, landing, [d], files=1)
    asked = []

    def reading(spark, path, schema, real=ingest.read_or_empty):
        df = real(spark, path, schema)
        asked.append((path, df))
        return df

    ingest.read_or_empty = reading
    try:
        cache.fill_from_stream(steps.file_stream(spark, landing, src.schema, files_per_batch=1), root, "tp", check, steps=3)
    finally:
        ingest.read_or_empty = stored.read_or_empty
    assert all(not path.startswith(landing) for path, _ in asked) and len(asked) == 20
    assert spark.read.parquet(f"{root}/cube").count() == 40


def test_a_sink_commits_whole_batches(spark, tmp_path):
    """A batch that fails on the way or is sent again leaves no trace; a new sink goes on."""
    root, fail = str(tmp_path / "sink"), []

    def total(state, batch):
        after = state.unionByName(batch).groupBy("k").agg(F.sum("v").alias("v"))
        rows = after.join(batch.select("k").distinct(), "k", "left_semi")
        return (after if not fail else after.select("k", F.raise_error("lost").cast("bigint").alias("v"))), rows

    sink = lambda: StatefulSink(spark, root, "k string, v bigint", total)
    batch = lambda *rows: spark.createDataFrame(rows, "k string, v long")
    kept = lambda: sorted(map(tuple, sink().close().collect()))
    assert sink().state().count() == 0
    with pytest.raises(ValueError):
        sink().close()
    sink().send(batch(("a", 1), ("b", 2)), 0)
    fail.append(1)
    with pytest.raises(PySparkException):
        sink().send(batch(("a", 5)), 1)
    fail.clear()
    assert kept() == [("a", 1), ("b", 2)] and {r.k: r.v for r in sink().state().collect()} == {"a": 1, "b": 2}
    for _ in range(2):
        sink().send(batch(("a", 5)), 1)
    sink().send(batch(("a", 99)), 0)
    assert kept() == [("a", 1), ("a", 6), ("b", 2)] and {r.k: r.v for r in sink().state().collect()} == {"a": 6, "b": 2}


@pytest.mark.parametrize("step, steps_a_day", [(64, 24), (-1, 24), (0, 96)])
def test_steps_beyond_the_bits_are_an_error(spark, tmp_path, step, steps_a_day):
    day = hourly(spark, [1]).withColumn("step", F.lit(step))
    with pytest.raises((PySparkException, ValueError)):
        ingest.fill_days(spark, str(tmp_path), day, "tp", day.select("day").distinct(), steps=steps_a_day)


def test_progress_of_a_long_run(spark, tmp_path):
    """150 batches in two runs; no setting of the session changes."""
    landing, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    settings = lambda: {k: v for k, v in spark.conf.getAll.items() if "streaming" in k}
    before = settings()
    stream = lambda: steps.file_stream(spark, landing, "id long", files_per_batch=1)
    for part, batches in ((0, 90), (1, 60)):
        spark.range(part * 10_000, (part + 1) * 10_000).repartition(batches).write.mode("append").parquet(landing)
        steps.run_to_files(stream(), out, check)
    rows = steps.progress(spark, check).collect()
    assert sorted(r.batch for r in rows) == list(range(150)) and sum(r.rows for r in rows) == 20_000
    assert settings() == before


def test_catalogue(spark):
    cube = hourly(spark, [1, 2, 3]).where("step = 0")
    source = CellSource(lambda: cube, "tp", GRID, time="day", attrs={"resolution": 7, "location": "here"})
    catalog = Catalog(spark).register("rain", source)
    got = catalog.get("rain", Extent(0, 1, 1, 2), dt.date(2024, 1, 2))
    assert [(r.day.day, r.y_idx, r.x_idx) for r in got.collect()] == [(2, 0, 0)]
    assert attrs_of(got, "tp")["resolution"] == 7
    assert attrs_of(got.where("tp > 0"), "tp")["location"] == "here"
    assert catalog.describe().first()["attrs"] == {"resolution": "7", "location": "here"}
    with pytest.raises(ValueError):
        catalog.get("snow")


def test_file_listing(spark, tmp_path):
    from eocube.functions.text import FLOOD_LEVELS, scene_name

    for version in ("V0M2R3", "V0M1R0"):
        folder = tmp_path / version / "EQUI7_AS020M" / "E039N012T3"
        folder.mkdir(parents=True)
        (folder / "FLOOD_20220818_VV.tif").write_bytes(b"x")
        (folder / "notes.txt").write_bytes(b"x")
    files = file_catalog(list_files(spark, str(tmp_path), "*.tif"), scene_name, FLOOD_LEVELS).collect()
    assert [(r.grid_name, r.tile_name, r.day) for r in files] == [("AS", "E039N012T3", dt.date(2022, 8, 18))]


def test_naming_conventions(spark):
    from eocube.functions import text

    paths = [
        "/lc/Corine_Land_Cover/2018/E048N012T6/CLC_2018_EU500M_E048N012T6.tif",
        "/lc/CCI_Land_Cover/V1M0R1/EQUI7_EU500M/E048N012T6/ESACCI_LC_L4_LCCS_Map_300m_P1Y_2015_v2_EU500M_E048N012T6.tif",
        "/dem/V01R01/EQUI7_AS020M/E039N012T3/DEM.tif",
        "/other/short.tif",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    one = file_catalog(df, text.landcover_name, ["Corine_Land_Cover", *text.LANDCOVER_LEVELS]).collect()
    assert [(r.var_name, r.grid_name, r.tile_name) for r in one] == [("CLC", "EU500M", "E048N012T6")]
    two = file_catalog(df, text.cci_name, text.CCI_LEVELS).first()
    assert (two.product, two.type, two.resolution, two.time, two.tile_name) == ("ESACCI", "LCCS-Map", "300m", "2015", "E048N012T6")
    assert file_catalog(df, text.scene_name, text.DEM_LEVELS).count() == 1
    # Names with too few parts give missing fields.
    short = file_catalog(df.where("path like '%short%'"), text.cci_name).first()
    assert short.product == "short" and short.tile_name is None


def test_dataset_at_a_path(spark, tmp_path):
    from eocube.sources import catalog as cat

    path = str(tmp_path / "dem")
    spark.createDataFrame([(0, 0, -9999.0), (0, 1, 12.0)], "y_idx long, x_idx long, dem double").write.parquet(path)
    got = cat.find_dem(cat.at_path(cat.DEM, spark, path))
    assert sorted((r.x_idx, r.dem) for r in got.collect()) == [(0, None), (1, 12.0)]
    assert attrs_of(got, "dem")["location"] == "central-site"


def test_geojson(spark, tmp_path):
    ring = [[0, 0], [4, 0], [4, 4], [0, 0]]
    features = [
        {"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [ring, [[1, 0.5], [2, 0.5], [2, 1], [1, 0.5]]]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [[[9, 9], [10, 9], [10, 10], [9, 9]]]]}},
    ]
    path = tmp_path / "a.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = read_geojson(spark, str(path))
    assert got.groupBy("poly_id").count().orderBy("poly_id").collect() == [("0/0", 8), ("1/0", 4), ("1/1", 4)]
    assert {r.poly_id for r in read_geojson(spark, str(path), Extent(8, 8, 11, 11)).collect()} == {"1/1"}


def test_a_large_document_is_read_by_several_tasks(spark, tmp_path):
    """Members in any order, features without polygons, texts that look like keys."""
    ring = lambda k: [[k, 0], [k + 1, 0], [k + 1, 1], [k, 0]]
    features = []
    for k in range(300):
        shapes = [
            {"type": "Polygon", "coordinates": [ring(k)]}, {"coordinates": [[ring(k)], [ring(k + 7)]], "type": "MultiPolygon"},
            {"type": "MultiLineString", "coordinates": [ring(k)]}, {"type": "Point", "coordinates": [1, 2]}, None,
        ]
        members = [("geometry", shapes[k % 5]), ("type", "Feature"), ("properties", {"name": "geometry", "{": "}", "text": "x" * (k % 90)})]
        features.append(dict(members if k % 2 else members[::-1]))
    path = tmp_path / "large.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    want = {}
    for i, f in enumerate(features):
        kind, points = (f["geometry"] or {}).get("type"), (f["geometry"] or {}).get("coordinates")
        for j, rings in enumerate({"Polygon": [points], "MultiPolygon": points}.get(kind, [])):
            want[f"{i}/{j}"] = [tuple(map(float, p)) for p in rings[0]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5_000)
    try:
        text = spark.read.option("lineSep", '"geometry"').text(str(path))
        assert text.rdd.getNumPartitions() > 5
        got = {}
        for r in read_geojson(spark, str(path)).orderBy("poly_id", "seq").collect():
            got.setdefault(r.poly_id, []).append((r.x, r.y))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want


def test_gaps_of_a_cube(spark):
    rng = random.Random(2)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    there = {(d, y, x) for d in days[:2] for y in range(4) for x in range(6) if rng.random() < 0.6}
    df = spark.createDataFrame([*there, *there, (days[0], 9, 0), (dt.date(2030, 1, 1), 0, 0)], "day date, y_idx long, x_idx long")
    axis = spark.createDataFrame([(d,) for d in days], "day date")
    small = GridSpec(LONLAT, 0.0, 1.0, 4.0, -1.0, 6, 4)
    gaps = store.gap_runs(store.covered_runs(df), small, axis).collect()
    got = {(r.day, r.y_idx, x) for r in gaps for x in range(r.x_from, r.x_to)}
    assert got == {(d, y, x) for d in days for y in range(4) for x in range(6)} - there
    assert sum(r.x_to - r.x_from for r in gaps) == len(got)  # no cell twice
    none = df.where("1 = 0")
    runs = store.gap_runs(store.covered_runs(none), store.GLOBAL_GRID, axis)
    assert runs.count() == 3 * 1801 and runs.agg(F.sum(F.col("x_to") - F.col("x_from"))).first()[0] == 3 * 6_483_600


def test_text_tables(spark, tmp_path):
    colours = tmp_path / "c.ct"
    colours.write_text("".join(f"{i % 256} {i // 2} 7\n" for i in range(230)))
    table = {r.bin: r.hex for r in read_colours(spark, str(colours)).collect()}
    assert len(table) == 200 and table[1] == "#000007" and table[200] == "#c76307"
    legend = tmp_path / "l.txt"
    legend.write_text('111 "Continuous urban fabric" 230-000-077\n112   "Discontinuous"  x y \n')
    assert [tuple(r) for r in read_legend(spark, str(legend)).collect()] == [
        (111, "230-000-077", "Continuous urban fabric"), (112, "x y", "Discontinuous")
    ]


def test_workspace_uses_the_shared_folder(spark):
    assert store.workspace(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_job_from_the_command_line(spark, tmp_path):
    from eocube import jobs

    landing, target = str(tmp_path / "landing"), str(tmp_path / "store")
    hourly(spark, [1, 2, 3]).write.parquet(landing)
    jobs.main(["retrieve", landing, target, "--value", "tp", "--start", "2024-01-01", "--end", "2024-01-02"])
    assert sorted({r.day.day for r in spark.read.parquet(f"{target}/cube").collect()}) == [1, 2]
    cells, out = str(tmp_path / "built"), str(tmp_path / "out")
    GRID.spine(spark).withColumn("built", F.lit(3.0)).write.parquet(cells)
    jobs.main(["built", cells, out, "--grid", "EPSG:4326;0;1;2;-1;2;2", "--extent", "0,0,2,2,EPSG:4326"])
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(SystemExit):
        jobs.main(["melt", cells, out])


def test_flood_job(spark, tmp_path):
    from eocube import jobs

    scenes, land, out = (str(tmp_path / p) for p in ("scenes", "land.geojson", "out"))
    name = "/V0M2R3/EQUI7_AF020M/{}T3/FLOOD_202208{}_VV_{}.tif".format
    rows = [(name("E033N051", 18, b), y, x, float(b)) for b in (0, 1) for y in (0, 1) for x in (0, 1)]
    # another day, a tile that does not meet the extent, another version of the archive
    rows += [(name("E033N051", 30, 0), 0, 0, 5.0), (name("E003N051", 18, 0), 0, 0, 6.0)]
    rows.append((name("E033N051", 18, 0).replace("V0M2R3", "V0M1R0"), 0, 0, 7.0))
    land_archive(spark.createDataFrame(rows, "path string, y_idx long, x_idx long, flood double"), scenes, 4)
    ring = [[0, 0], [1, 0], [1, 2], [0, 2], [0, 0]]
    with open(land, "w") as f:
        json.dump({"features": [{"geometry": {"type": "Polygon", "coordinates": [ring]}}]}, f)
    jobs.main(["flood", scenes, out, "--grid", "EPSG:4326;0;1;2;-1;2;2", "--extent", "0,0,2,2,EPSG:4326",
               "--start", "2022-08-18", "--polygons", land])
    got = {(r.y_idx, r.x_idx): r.flood for r in spark.read.parquet(out).collect()}
    assert got == {(0, 0): 1.0, (1, 0): 1.0, (0, 1): None, (1, 1): None}
