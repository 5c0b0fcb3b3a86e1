"""Running totals along time and along positions of long groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.operators.select import CELL


def accumulate(
    df: DataFrame,
    value: str,
    *,
    time: str = "time",
    keys: Sequence[str] = CELL,
    factor: float = 1000.0,
    skipna: bool = True,
) -> DataFrame:
    """Running sum over time per cell, scaled (metres to millimetres).

    ``skipna`` counts a missing step as 0; without it the first missing step
    makes the rest of that cell missing, as the streaming accumulator does.
    A cube holds one row per cell and step, so a window is as long as the time
    axis and no longer.
    """
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    c = F.col(value)
    if skipna:
        total = F.sum(F.coalesce(c, F.lit(0.0))).over(w) * factor
    else:
        broken = F.max(c.isNull()).over(w)
        total = F.when(~broken, F.sum(c * factor).over(w))
    return df.withColumn(value, total)


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: Column,
    to: str,
    *,
    levels: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sum inside each group, without one task per group.

    ``levels`` are columns that grow along ``order``, coarse to fine.  Totals
    are taken per (group, levels), the offset of each is found on that much
    smaller table by the same method with one level less, and rows are only
    ever ordered inside their own (group, levels) chunk.  The chunk totals are
    pre-aggregated before the shuffle, and the offset join and the final window
    share one partitioning.
    """
    if not levels:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(to, F.sum(value).over(w))
    keys = [*group, *levels]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    offsets = running_total(
        totals, group, [levels[-1]], F.col("_total"), "_upto", levels=levels[:-1]
    ).select(*keys, (F.col("_upto") - F.col("_total")).alias("_before"))
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(offsets, keys)
        .withColumn(to, F.sum(value).over(w) + F.col("_before"))
        .drop("_before")
    )
