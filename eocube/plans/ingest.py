"""Fill a by-day store only for the days it does not cover."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.model import Extent, GridSpec
from eocube.operators.select import CELL, in_box
from eocube.sources.store import calendar, materialize, missing_days, read_coverage, read_or_empty, upsert_days

#: How a day's slices become one value, by variable.
DAILY = {"tp": "sum", "swvl1": "mean"}
#: Slices of a complete day.
STEPS = 24
#: Steps that the bits of a stored cell can tell apart.
MOST_STEPS = 63


def cube_schema(value: str) -> str:
    return f"y_idx bigint, x_idx bigint, {value} double, day date"


def _step_bit(step: str, steps: int) -> Column:
    """The bit of a step; steps are numbered from 0 to 62."""
    if not 0 < steps <= MOST_STEPS:
        raise ValueError(f"a day has 1 to {MOST_STEPS} steps, not {steps}")
    inside = F.col(step).between(0, MOST_STEPS - 1)
    wrong = F.raise_error(F.concat(F.lit(f"a step is beyond 0 to {MOST_STEPS - 1}: "), F.coalesce(F.col(step).cast("string"), F.lit("null"))))
    return F.when(inside, F.expr(f"shiftleft(1L, int({step}))")).otherwise(wrong.cast("bigint"))


def _store(spark: SparkSession, root: str, cells: DataFrame, value: str, steps: int) -> None:
    """Replace the days of ``(y_idx, x_idx, total, n, steps, day)``, the cube before its flags."""
    rule = {"sum": F.col("total"), "mean": F.when(F.col("n") > 0, F.col("total") / F.col("n"))}[DAILY[value]]
    ready = materialize(cells.select(*CELL, rule.alias(value), "total", "n", "steps", "day"), "daily")
    upsert_days(ready, f"{root}/cube")
    full = F.bit_count(F.bit_or("steps")) >= steps
    flags = ready.groupBy("day").agg(full.cast("tinyint").alias("covered")).select("covered", "day")
    upsert_days(flags, f"{root}/coverage")


def _partials(slices: DataFrame, value: str, bit: Column) -> DataFrame:
    """Mergeable aggregates of a day's slices per cell: sum, number of values, steps seen as bits."""
    return slices.groupBy("day", *CELL).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).cast("double").alias("total"),
        F.count(value).alias("n"),
        F.bit_or(bit).alias("steps"),
    )


def fill_days(
    spark: SparkSession, root: str, hourly: DataFrame, value: str, days: DataFrame, *, step: str = "step", steps: int = STEPS
) -> None:
    """Aggregate the uncovered ones of ``days`` and store them with their flag.

    ``hourly`` holds all slices landed so far of these days, numbered by ``step``
    from 0 to 62; another number is an error.  It is read once: a cell keeps the steps it has
    seen as bits.  A day is covered once ``steps`` different steps are there; until then it is
    stored as far as it has come and done again the next time.  The cube is written before the
    flags, so a job that dies in between leaves days uncovered and the next run redoes them.
    """
    if value not in DAILY:
        raise ValueError(f"no daily rule for variable {value!r}")
    todo = materialize(missing_days(days, read_coverage(spark, root)), "todo")
    landed = hourly.join(todo, "day", "left_semi")
    _store(spark, root, _partials(landed, value, _step_bit(step, steps)), value, steps)


def add_slices(
    spark: SparkSession, root: str, slices: DataFrame, value: str, *, step: str = "step", steps: int = STEPS
) -> None:
    """Add slices of any days to what the store has of them.

    Slices of a cell and step that the store has already are left out, of several in ``slices``
    the largest value counts.  Reads ``slices`` and the stored cells of their days.
    """
    if value not in DAILY:
        raise ValueError(f"no daily rule for variable {value!r}")
    bit = _step_bit(step, steps)
    once = materialize(slices.groupBy("day", *CELL, step).agg(F.max(value).alias(value)), "slices")
    # the days of one delivery, a calendar at most
    days = [r.day for r in once.select("day").distinct().collect()]
    stored = read_or_empty(spark, f"{root}/cube", "y_idx bigint, x_idx bigint, total double, n bigint, steps bigint, day date")
    stored = stored.select("day", *CELL, "total", "n", "steps").where(F.col("day").isin(days))
    seen = stored.select("day", *CELL, F.col("steps").alias("seen"))
    fresh = once.join(seen, ["day", *CELL], "left").where(F.coalesce(F.col("seen"), F.lit(0)).bitwiseAND(bit) == 0)
    merged = stored.unionByName(_partials(fresh, value, bit)).groupBy("day", *CELL).agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.bit_or("steps").alias("steps")
    )
    _store(spark, root, merged, value, steps)


def cached_get(
    spark: SparkSession,
    root: str,
    hourly: DataFrame,
    value: str,
    spec: GridSpec,
    extent: Extent,
    start: dt.date,
    end: dt.date | None = None,
    *,
    steps: int = STEPS,
) -> DataFrame:
    """Make the store cover the days asked for, then read them in the box, numbered on the store's grid."""
    end = end or start
    fill_days(spark, root, hourly, value, calendar(spark, start, end), steps=steps)
    cube = read_or_empty(spark, f"{root}/cube", cube_schema(value))
    return in_box(cube.where(F.col("day").between(F.lit(start), F.lit(end))), spec, extent).select(
        "day", "y_idx", "x_idx", value
    )
