"""Nearest-in-time lookup and positions on a time axis.

The lookup is an as-of merge of the distinct times of the rows with the labels of the axis.
Both are cut into the same ranges of time, of about as many times each; inside a range running
windows in either direction give the label before and the label after a time, and the ranges
hand their first and last labels on to their neighbours.  The rows then take the label of their
time by an equi-join: every row once, however the labels or the rows crowd.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from eocube.functions.calendar import epoch_micros
from eocube.operators.sizing import small_side
from eocube.sources.store import materialize

#: Times of one range of the merge, about.
RANGE_TIMES = 200_000


def time_axis(df: DataFrame, time: str = "time") -> DataFrame:
    """The distinct time labels of a cube."""
    return df.select(time).distinct()


def step_dates(df: DataFrame, time: str = "time") -> DataFrame:
    """Ordered list of step dates."""
    return df.select(F.to_date(time).alias("day")).distinct().orderBy("day")


def _ranges(times: DataFrame, count: int) -> tuple[Column, int]:
    """The range of ``_micros`` that each of ``count`` times belongs to, and how many ranges there are."""
    n = -(-count // RANGE_TIMES)
    if n <= 1:
        return F.lit(0), 1
    cuts = times.agg(F.percentile_approx("_micros", [i / n for i in range(1, n)], 100 * n)).first()[0]
    cuts = sorted(set(cuts))
    return F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= F.col("_micros"))), len(cuts) + 1


def _by_range(values: list, part: Column) -> Column:
    """One of a few numbers, by the range."""
    return F.element_at(F.lit(values).cast("array<bigint>"), part + 1)


def axis_positions(axis: DataFrame, time: str = "time", to: str = "step") -> DataFrame:
    """Zero-based position of each label: its place in its range of time, behind the ranges before."""
    labels = materialize(axis.select(time, epoch_micros(F.col(time)).alias("_micros")).distinct(), "axis")
    part, n = _ranges(labels, labels.count())
    placed = labels.withColumn("_range", part)
    sizes = dict.fromkeys(range(n), 0)
    if n > 1:
        sizes |= {r["_range"]: r["count"] for r in placed.groupBy("_range").count().collect()}
    before = [0, *accumulate(sizes[i] for i in range(n))][:n]
    place = F.row_number().over(Window.partitionBy("_range").orderBy(F.col("_micros").asc_nulls_first())) - 1
    return placed.select(time, (place + _by_range(before, F.col("_range"))).cast("int").alias(to))


def _nearest_of(times: DataFrame, n: int, part: Column, label: str) -> DataFrame:
    """``(_micros, label)`` of every time of ``(_micros, _label)``, where ``_label`` is null beside the labels."""
    ranged = times.withColumn("_range", part)
    upward = Window.partitionBy("_range").orderBy("_micros").rowsBetween(Window.unboundedPreceding, 0)
    downward = Window.partitionBy("_range").orderBy(F.desc("_micros")).rowsBetween(Window.unboundedPreceding, 0)
    before, after = F.last("_label", ignorenulls=True).over(upward), F.last("_label", ignorenulls=True).over(downward)
    if n > 1:
        # one row per range comes here: the first and the last label of each
        kind = times.schema["_label"].dataType
        edges = {r["_range"]: (r["lo"], r["hi"]) for r in ranged.groupBy("_range").agg(F.min("_label").alias("lo"), F.max("_label").alias("hi")).collect()}
        first, last = ([edges.get(i, (None, None))[k] for i in range(n)] for k in (0, 1))
        behind, ahead = [None] * n, [None] * n
        for i in range(1, n):
            behind[i] = last[i - 1] if last[i - 1] is not None else behind[i - 1]
        for i in range(n - 2, -1, -1):
            ahead[i] = first[i + 1] if first[i + 1] is not None else ahead[i + 1]
        schema = StructType([StructField("_range", IntegerType()), StructField("_behind", kind), StructField("_ahead", kind)])
        handed = times.sparkSession.createDataFrame(list(zip(range(n), behind, ahead)), schema)
        ranged = ranged.join(small_side(handed, n), "_range")
        before, after = F.coalesce(before, F.col("_behind")), F.coalesce(after, F.col("_ahead"))
    near = ranged.select("_micros", before.alias("_before"), after.alias("_after"))
    early, late = F.col("_micros") - epoch_micros(F.col("_before")), epoch_micros(F.col("_after")) - F.col("_micros")
    # ties go to the later
    return near.select("_micros", F.when(late.isNull() | (early < late), F.col("_before")).otherwise(F.col("_after")).alias(label))


def nearest_label(df: DataFrame, axis: DataFrame, *, time: str = "time", label: str = "label") -> DataFrame:
    """Add to every row the axis label nearest to its time; ties go to the later.

    The distinct times are written once, with the labels among them.  A row without time gets no
    label; with an empty axis only such rows are left.
    """
    axis_label = axis.columns[0]
    labels = axis.select(F.col(axis_label).alias("_label")).where("_label is not null")
    kind = labels.schema["_label"].dataType
    asked = df.select(epoch_micros(F.col(time)).alias("_micros"), F.lit(None).cast(kind).alias("_label")).where("_micros is not null")
    both = labels.select(epoch_micros(F.col("_label")).alias("_micros"), "_label").unionByName(asked)
    times = materialize(both.groupBy("_micros").agg(F.max("_label").alias("_label")), "times")
    count = times.count()
    part, n = _ranges(times, count)
    nearest = _nearest_of(times, n, part, label).where(F.col(label).isNotNull())
    timed = df.where(F.col(time).isNotNull()).withColumn("_micros", epoch_micros(F.col(time)))
    found = timed.join(small_side(nearest, count), "_micros").select(*df.columns, label)
    unlabelled = df.where(F.col(time).isNull()).withColumn(label, F.lit(None).cast(kind))
    return found.unionByName(unlabelled) if df.schema[time].nullable else found


def select_nearest(
    cube: DataFrame, requests: DataFrame, *, time: str = "time", request: str = "request", axis: DataFrame | None = None
) -> DataFrame:
    """For each requested time, the cube at the step nearest to it.

    ``axis`` saves the pass over the cube that lists its steps.
    """
    axis = time_axis(cube, time) if axis is None else axis
    asked = nearest_label(requests.select(request), axis, time=request, label="_label")
    return cube.join(asked.withColumnRenamed("_label", time), time)


def first_step(cube: DataFrame, time: str = "time") -> DataFrame:
    return cube.where(F.col(time) == cube.agg(F.min(time)).scalar())


def nth_step(cube: DataFrame, n: int, time: str = "time", axis: DataFrame | None = None) -> DataFrame:
    """The cube at the n-th label of its time axis, counted from 0."""
    axis = time_axis(cube, time) if axis is None else axis
    first = axis.select(time).distinct().orderBy(time).limit(n + 1)
    at = first.agg(F.when(F.count(F.lit(1)) == n + 1, F.max(time)).alias(time))
    return cube.where(F.col(time) == at.scalar())


def first_index_of(axis: DataFrame, requests: DataFrame, *, time: str = "time", request: str = "request") -> DataFrame:
    """Position on the axis of the label nearest to each requested value."""
    placed = axis_positions(axis, time, to="index")
    asked = nearest_label(requests, axis.select(time).distinct(), time=request, label=time)
    return asked.join(placed, time)
