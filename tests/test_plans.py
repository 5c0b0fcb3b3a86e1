"""Shapes that must not appear in the plans of queries that move cells."""

from __future__ import annotations

import re

import pytest

from eocube import bindings

FOLDER = "/root/testdata/sf0.001"
QUERIES = bindings.queries()
#: Queries that write or stream while they are built return a plain scan.
EAGER = {
    "running_accumulator", "stream_accumulate", "stream_close", "stream_progress", "step_stream", "run_stream",
    "stream_sink", "cache_fill", "jobs", "predicted_rain_get", "retrieve_swvl1", "restructure_4dmed",
    "restructure_ascat", "align_to_axis", "materialize", "cube_write", "region_upsert", "dims_append",
    "daily_landing_read", "vector_read", "text_dims_read", "head_n", "ramp_bin", "global_median", "restructure_flood", "restructure_dem", "restructure_landcover", "restructure_cci",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_no_python(spark, key):
    plan = plan_of(QUERIES[key](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)


#: Windows over a time axis or a chunk-total table may run in one task; their
#: inputs are bounded.  Windows over cells may not.
@pytest.mark.parametrize(
    "key", ["accumulate_rain", "accumulate_strict", "hillshade", "ragged_cumsum", "ragged_decode", "polygon_clip"]
)
def test_windows_over_rows_are_partitioned(spark, key):
    plan = plan_of(QUERIES[key](spark, FOLDER))
    for m in re.finditer(r"Window \[.*", plan):
        below = plan[m.end():].split("\n", 4)[1:4]
        assert not any("SinglePartition" in line for line in below), below


def test_box_and_columns_reach_the_scan(spark, tmp_path):
    import datetime as dt

    from eocube.bindings.fixtures import RAIN
    from eocube.model import Extent
    from eocube.sources.catalog import CellSource

    path = str(tmp_path / "cube")
    spark.range(1000).selectExpr(
        "id % 50 as y_idx", "id % 30 as x_idx", "id * 1.0D as tp", "id * 2.0D as other",
        "date_add(date'2024-01-01', int(id % 20)) as day",
    ).write.partitionBy("day").parquet(path)
    source = CellSource(lambda: spark.read.parquet(path), "tp", RAIN, time="day")
    plan = plan_of(source.get(Extent(65.2, 29.0, 66.0, 30.0), dt.date(2024, 1, 3), dt.date(2024, 1, 5)))
    assert "other" not in plan
    assert re.search(r"PartitionFilters: \[.*day", plan)
    assert "LessThanOrEqual(y_idx," in plan


def test_separable_nearest_regrid_does_not_shuffle_cells(spark, cells):
    from eocube.functions.projection import LONLAT, WEB_MERCATOR
    from eocube.model import GridSpec
    from eocube.operators.regrid import reproject

    src = GridSpec(LONLAT, 10.0, 0.5, 50.0, -0.5, 4, 4)
    out, _ = reproject(cells([[1, 2], [3, 4]]), src, WEB_MERCATOR, ["v"])
    assert "hashpartitioning" not in plan_of(out)


def test_normalize_scans_once(spark):
    """The minimum and maximum reuse the shuffle of the values they stretch."""
    df = QUERIES["normalize"](spark, FOLDER)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
