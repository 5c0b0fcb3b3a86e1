"""Calendar bins: day, 10-day and 15-day means with empty bins kept."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eocube.functions.calendar import day_number, midnight
from eocube.operators.reduce import reducer
from eocube.operators.select import CELL


def resample_time(
    df: DataFrame,
    every_days: int,
    value: str,
    *,
    time: str = "time",
    keys: Sequence[str] = CELL,
    method: str = "mean",
    fill: bool = True,
    span: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Left-closed bins that start at midnight of the cube's first day.

    ``span`` gives the first and last day where they are known, from a request
    or a catalogue, and saves the pass over the times that finds them.

    With ``fill`` every series has every bin between the cube's first and last
    day; a bin without a valid value is missing.  The bins of one series are
    bounded by the calendar, so the filling step groups few small rows.
    """
    if span:
        first, last = (F.lit(d).cast("date") for d in span)
    else:
        ends = df.agg(F.struct(F.to_date(F.min(time)).alias("first"), F.to_date(F.max(time)).alias("last"))).scalar()
        first, last = ends["first"], ends["last"]
    binned = df.select(
        *keys, F.floor(day_number(F.col(time), first) / every_days).cast("int").alias("bin"), value
    )
    means = binned.groupBy(*keys, "bin").agg(reducer(method)(F.col(value)).alias(value))
    if fill:
        n = F.floor(F.datediff(last, first) / every_days).cast("int")
        series = means.groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct("bin", value))).alias("by_bin")
        )
        means = series.select(*keys, "by_bin", F.explode(F.sequence(F.lit(0), n)).alias("bin")).select(
            *keys, "bin", F.try_element_at("by_bin", F.col("bin")).alias(value)
        )
    start = midnight(F.date_add(first, F.col("bin") * every_days))
    return means.select(start.alias(time), *keys, value)


def day_span(df: DataFrame, time: str = "time") -> tuple[dt.date, dt.date]:
    """First and last day of a table, for the ``span`` of several resamplings of it."""
    return tuple(df.agg(F.to_date(F.min(time)), F.to_date(F.max(time))).first())


def resample_daily(df: DataFrame, value: str, **kw) -> DataFrame:
    return resample_time(df, 1, value, **kw)
