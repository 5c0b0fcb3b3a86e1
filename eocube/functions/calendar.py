"""Calendar Columns that give the same answer in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def midnight(day: Column) -> Column:
    """Start of the day as a time-zone-free timestamp."""
    return day.cast("date").cast("timestamp_ntz")


def to_minute(ts: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.lit(0)
    )


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01, read off the wall clock."""
    seconds = F.extract(F.lit("SECOND"), ts) * 1_000_000
    return (
        F.unix_date(F.to_date(ts)) * F.lit(MICROS_PER_DAY)
        + F.hour(ts) * F.lit(3_600_000_000)
        + F.minute(ts).cast("bigint") * F.lit(60_000_000)
        + seconds.cast("bigint")
    )


def day_number(ts: Column, origin: Column) -> Column:
    """Whole days from the origin's date to this one's."""
    return F.datediff(F.to_date(ts), F.to_date(origin))


def days_between(first: Column, last: Column) -> Column:
    """Every day from first to last, both included, as an array."""
    return F.sequence(F.to_date(first), F.to_date(last))
