"""Contiguous ragged arrays: location series packed end to end on one axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eocube.functions.calendar import to_minute
from eocube.operators.nearest import nearest_label
from eocube.operators.running import running_total
from eocube.sources.store import materialize

#: Locations, and observations, ordered together by one task.
LOCATION_BLOCK = 65_536
OBS_CHUNK = 65_536


def ragged_offsets(locations: DataFrame, *, file: str = "file_id", order: str = "pos") -> DataFrame:
    """Add the running total of ``row_size`` and its start, per file, in the stored order.

    ``order`` is the place of a location in its file, from 0; ids need not grow
    with it, and padding ids may repeat.  Compute this before dropping any location: a dropped one still occupies its
    stretch of the observation axis.
    """
    blocked = locations.withColumn("_block", F.floor(F.col(order) / LOCATION_BLOCK))
    total = running_total(blocked, [file], [order], F.col("row_size"), "cum_sum", levels=["_block"])
    return total.drop("_block").withColumn("offset", F.col("cum_sum") - F.col("row_size"))


def decode_ragged(
    locations: DataFrame, obs: DataFrame, *, file: str = "file_id", location: str = "location_id", position: str = "obs_idx"
) -> DataFrame:
    """Give every observation the location whose ``[offset, cum_sum)`` holds it.

    The axis is cut into chunks of fixed length.  A location marks its start,
    and the start of every further chunk it reaches into, so each chunk is
    resolved on its own however long one location is.  Observations move once.
    """
    ends = locations.where(F.col("row_size") > 0)
    owner = [F.col(location).alias("_id"), F.col("cum_sum").alias("_end")]
    first, last = (F.floor(c / OBS_CHUNK) for c in (F.col("offset"), F.col("cum_sum") - 1))
    starts = ends.select(file, F.col("offset").alias(position), *owner)
    carried = ends.where(last > first).select(
        file, F.explode(F.sequence(first + 1, last)).alias("_chunk"), *owner
    ).select(file, (F.col("_chunk") * OBS_CHUNK).alias(position), "_id", "_end")
    marks = starts.unionByName(carried).withColumn("_mark", F.lit(True))
    both = obs.unionByName(marks, allowMissingColumns=True).withColumn(
        "_chunk", F.floor(F.col(position) / OBS_CHUNK)
    )
    w = (
        Window.partitionBy(file, "_chunk")
        .orderBy(position, F.col("_mark").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    owned = both.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("_id", "_end")})
    return owned.where(F.col("_mark").isNull() & (F.col(position) < F.col("_end"))).select(
        *obs.columns, F.col("_id").alias(location)
    )


def series_length(
    obs: DataFrame, location: str = "location_id", *, locations: DataFrame | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Observations per location; with ``locations`` also of those without any, and their order columns."""
    counts = obs.groupBy(location).agg(F.count(F.lit(1)).alias("n"))
    if locations is None:
        return counts
    if order:
        firsts = locations.groupBy(location).agg(F.min(F.struct(*order)).alias("_o"))
        every = firsts.select(location, *(F.col(f"_o.{c}").alias(c) for c in order))
    else:
        every = locations.select(location).distinct()
    return every.join(counts, location, "left").select(location, *order, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def longest_series(lengths: DataFrame, location: str = "location_id", *, order: Sequence[str] = ()) -> DataFrame:
    """The location with most observations, the first of equals by ``order``, else by id; one row."""
    return lengths.orderBy(F.col("n").desc(), *(order or [location])).limit(1)


def last_write_wins(df: DataFrame, value: str, *keys: str, position: str = "obs_idx") -> DataFrame:
    """Of several writes to one slot, the one with the highest position stays."""
    return df.groupBy(*keys).agg(F.max_by(value, position).alias(value))


def align_to_axis(
    obs: DataFrame,
    value: str = "sm",
    *,
    location: str = "location_id",
    time: str = "time",
    position: str = "obs_idx",
    locations: DataFrame | None = None,
    order: Sequence[str] = (),
    dense: bool = False,
) -> DataFrame:
    """Snap every series to the time axis of the longest one.

    ``locations`` lists the locations wanted, also those without observations;
    ``order`` are its columns that say which of equally long series is the first.
    The axis is cut to whole minutes, which bounds its length by the calendar;
    it is written before the observations are matched with it.
    The result lists filled slots; ``dense`` adds the unfilled ones as missing.
    """
    lengths = series_length(obs, location, locations=locations, order=order)
    longest = longest_series(lengths, location, order=order).select(location).scalar()
    minutes = obs.where(F.col(location) == longest).select(to_minute(F.col(time)).alias("label"))
    axis = materialize(minutes.distinct(), "axis")
    snapped = nearest_label(obs, axis, time=time, label="label")
    slots = last_write_wins(snapped, value, location, "label", position=position)
    slots = slots.withColumnRenamed("label", time)
    if not dense:
        return slots
    labels = axis.agg(F.sort_array(F.collect_set("label"))).scalar()
    spine = (obs if locations is None else locations).select(location).distinct().withColumn(time, F.explode(labels))
    return spine.join(slots, [location, time], "left")
