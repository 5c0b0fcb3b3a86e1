"""Streaming queries: steps land, a stream runs them dry, the result is read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from eocube import jobs
from eocube.bindings import sqltext as q
from eocube.bindings.fixtures import BUILT, RAIN
from eocube.bindings.registry import Tables, i64, q6, query, rounded
from eocube.functions.projection import LONLAT, WEB_MERCATOR
from eocube.model import GridSpec
from eocube.operators.combine import concat
from eocube.operators.reduce import coarsen
from eocube.sources import catalog as cat
from eocube.sources import store
from eocube.streaming import accumulate as acc
from eocube.streaming import steps
from eocube.streaming.cache import fill_from_stream
from eocube.streaming.sink import StatefulSink

#: The days arrive in three deliveries; the stream runs after each.
DELIVERIES = 3
#: Files of one micro-batch; a delivery of more is cut in the middle of its days.
FILES_PER_BATCH = 64


def _days(cells) -> list[dt.date]:
    """The calendar of a table, in order."""
    return [r.day for r in cells.select("day").distinct().orderBy("day").collect()]


def _parts(days: list[dt.date]) -> list[list[dt.date]]:
    cut = [len(days) * i // DELIVERIES for i in range(DELIVERIES + 1)]
    return [days[a:b] for a, b in zip(cut, cut[1:])]


def _deliver(t: Tables, run, *, marks: bool = False):
    """Land the calendar delivery by delivery, each in files that mix its days, and run the stream after each."""
    root = store.workspace(t.spark, "stream")
    cells = t.tp
    landing, out, check = (f"{root}/{p}" for p in ("landing", "out", "checkpoint"))
    for days in _parts(_days(cells)):
        steps.land_files(cells, landing, days)
        if marks:
            steps.mark_whole(t.spark, landing, cells.schema, days)
        run(steps.file_stream(t.spark, landing, cells.schema, files_per_batch=FILES_PER_BATCH), out, check)
    return out, check


STRICT = """
    select day, y_idx, x_idx, case when not bool_or(tp is null) over (partition by y_idx, x_idx order by day)
           then sum(tp * 1000) over (partition by y_idx, x_idx order by day) end as tp from fx_tp"""


@query("step_stream", f"select day, count(*) as cells, {q6('sum(tp)')} as total, row_number() over (order by day) - 1 as step from fx_tp group by 1")
def step_stream(t: Tables):
    """The stream hands on one step at a time, every cell of it, in order."""
    root = store.workspace(t.spark, "steps")
    cells = t.tp
    steps.land_steps(cells, f"{root}/landing", _days(cells))

    def send(batch, batch_id):
        sums = batch.groupBy("day").agg(F.count(F.lit(1)).alias("cells"), F.sum("tp").alias("total"))
        sums.write.mode("overwrite").parquet(f"{root}/out/step={batch_id}")

    steps.run_each(send, steps.step_stream(t.spark, f"{root}/landing", cells.schema), f"{root}/checkpoint")
    return rounded(i64(t.spark.read.parquet(f"{root}/out"), "step"), "total")


@query("run_stream", f"select y_idx, x_idx, count(*) as days, {q6('max(tp)')} as top from fx_tp group by 1, 2")
def run_stream(t: Tables):
    """Source, process and sink run to exhaustion; the process drops nothing."""
    out, _ = _deliver(t, lambda s, path, check: steps.run_to_files(s.withColumn("mm", F.col("tp") * 1000), path, check))
    cells = t.spark.read.parquet(out).groupBy("y_idx", "x_idx")
    return rounded(cells.agg(F.count(F.lit(1)).alias("days"), F.max(F.col("mm") / 1000).alias("top")), "top")


def _totals(t: Tables):
    out, _ = _deliver(t, lambda s, path, check: steps.run_to_files(acc.running_accumulate(s), path, check), marks=True)
    return t.spark.read.parquet(out)


@query("running_accumulator", f"select day, y_idx, x_idx, {q6('tp')} as tp from ({STRICT})")
def running_accumulator(t: Tables):
    return rounded(_totals(t), "tp")


_FINE = RAIN.project(WEB_MERCATOR, 5_000.0)


@query("stream_close", f"""
    with totals as (select day, y_idx, x_idx, nullif(tp, 0) as tp from ({STRICT}))
    select day, y_idx, x_idx, {q6('coalesce(tp, 0)', 3)} as tp from ({q.bilinear(q.mercator_lookup(RAIN, _FINE), 'totals', 'day', 'tp')})""")
def stream_close(t: Tables):
    cells, _ = acc.close_stream(_totals(t), RAIN, resolution=5_000.0)
    return rounded(cells, "tp", digits=3)


@query("stream_progress", "select count(*) as rows from fx_tp")
def stream_progress(t: Tables):
    """Rows that the micro-batches of all three runs report."""
    _, check = _deliver(t, steps.run_to_files)
    return steps.progress(t.spark, check).agg(F.sum("rows").alias("rows"))


@query("cache_fill", f"""
    select day, y_idx, x_idx, {q6('coalesce(sum(tp), 0)')} as tp from fx_hourly group by 1, 2, 3""")
def cache_fill(t: Tables):
    """Hourly slices land in deliveries that cut days in two and overlap; each day is stored whole."""
    root = store.workspace(t.spark, "cache")
    hourly, landing = t.hourly, f"{root}/landing"
    parts = _parts(_days(hourly))
    for i, days in enumerate(parts):
        # the first day of the next delivery has already landed up to noon
        early = hourly.where(F.col("day").isin(parts[i + 1][:1]) & (F.col("step") < 12)) if i + 1 < len(parts) else hourly.limit(0)
        hourly.where(F.col("day").isin(days)).unionByName(early).write.mode("append").parquet(landing)
        stream = steps.file_stream(t.spark, landing, hourly.schema, files_per_batch=FILES_PER_BATCH)
        fill_from_stream(stream, f"{root}/store", "tp", f"{root}/checkpoint")
    return rounded(t.spark.read.parquet(f"{root}/store/cube").select("day", "y_idx", "x_idx", "tp"), "tp")


@query("transformer", f"select day, y_idx, x_idx, {q6('tp * 1000')} as tp from fx_tp")
def transformer(t: Tables):
    """A user transformer is a function of a DataFrame."""

    class ToMillimetres:
        def __call__(self, df):
            return df.withColumn("tp", F.col("tp") * 1000)

    return rounded(t.tp.transform(ToMillimetres()), "tp")


@query("stream_sink", """
    select day, y_idx, x_idx, count(*) over (partition by y_idx, x_idx order by day) as wet_days from fx_tp where tp > 0.05e0""")
def stream_sink(t: Tables):
    """A user sink whose state is each cell's number of wet days; every delivery meets a new sink on the same folder."""

    def count_wet(state, batch):
        wet = batch.where(F.col("tp") > 0.05).select("day", "y_idx", "x_idx")
        place = F.row_number().over(Window.partitionBy("y_idx", "x_idx").orderBy("day"))
        before = wet.join(state, ["y_idx", "x_idx"], "left").withColumn("before", F.coalesce("n", F.lit(0).cast("bigint")))
        rows = before.select("day", "y_idx", "x_idx", (F.col("before") + place).cast("bigint").alias("wet_days"))
        counts = wet.groupBy("y_idx", "x_idx").agg(F.count(F.lit(1)).alias("n"))
        return state.unionByName(counts).groupBy("y_idx", "x_idx").agg(F.sum("n").alias("n")), rows

    root = store.workspace(t.spark, "sink")
    kept = lambda: StatefulSink(t.spark, f"{root}/out", "y_idx bigint, x_idx bigint, n bigint", count_wet)
    for days in _parts(_days(t.tp)):
        steps.land_files(t.tp, f"{root}/landing", days)
        steps.run_each(kept().send, steps.file_stream(t.spark, f"{root}/landing", t.tp.schema), f"{root}/checkpoint")
    return kept().close()


@query("source_protocol", f"""
    select y_idx, x_idx, {q6('max(tp)')} as tp from fx_tp where day between date '2024-01-03' and date '2024-01-09' group by 1, 2""")
def source_protocol(t: Tables):
    """A user source in the catalogue: yields the wettest day of each cell."""

    class Wettest:
        def get(self, extent, start, end=None):
            days = t.tp.where(F.col("day").between(F.lit(start), F.lit(end or start)))
            return days.groupBy("y_idx", "x_idx").agg(F.max("tp").alias("tp"))

    catalog = cat.Catalog(t.spark).register("wettest", Wettest())
    return rounded(catalog.get("wettest", None, dt.date(2024, 1, 3), dt.date(2024, 1, 9)), "tp")


METHODS = {"mean": "avg(s.built)", "max": "max(s.built)", "min": "min(s.built)", "median": "median(s.built)", "sum": "coalesce(sum(s.built), 0)"}


@query("method_dispatch", " union all ".join(
    f"select '{m}' as method, y_idx, x_idx, {q6('built')} as built from ({q.coarse('fx_built', 'built', 100, BUILT, a)})"
    for m, a in METHODS.items()))
def method_dispatch(t: Tables):
    parts = [coarsen(t.built, BUILT, 100, m, "built")[0].withColumn("method", F.lit(m)) for m in METHODS]
    return rounded(concat(parts), "built").select("method", "y_idx", "x_idx", "built")


_BUILT_CROP = GridSpec(LONLAT, 65.5, 0.01, 30.0, -0.01, 200, 600)
_BUILT_CROP_MERC = GridSpec(WEB_MERCATOR, 7291426.646959418, 1237.2153585972333, 3503549.843504374, -1237.2153585972333, 180, 607)


@query("jobs", f"""
    with cut as (select y_idx - 100 as y_idx, x_idx - 50 as x_idx, built from fx_built where 65e0 + 0.01e0 * (x_idx + 0.5e0) between 65.5025e0 and 67.4975e0 and 31e0 - 0.01e0 * (y_idx + 0.5e0) between 24.0025e0 and 29.9975e0)
    select y_idx, x_idx, {q6('built')} as built from ({q.nearest(q.mercator_lookup(_BUILT_CROP, _BUILT_CROP_MERC), 'cut', '', 'built')})""")
def jobs_(t: Tables):
    """The batch job for built-up land, written and read back."""
    root = store.workspace(t.spark, "job")
    t.built.write.parquet(f"{root}/in")
    jobs.built(t.spark, f"{root}/in", f"{root}/out", BUILT, "65.5025, 24.0025, 67.4975, 29.9975, EPSG:4326", WEB_MERCATOR)
    return rounded(t.spark.read.parquet(f"{root}/out").select("y_idx", "x_idx", "built"), "built")
