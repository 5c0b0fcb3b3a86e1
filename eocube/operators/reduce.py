"""Block, band, day and whole-array reductions.

Dense outputs are completed by adding the output grid's spine as rows without
values *before* the aggregation: one shuffle, no join back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eocube.model import GridSpec
from eocube.operators.select import CELL
from eocube.sources.store import materialize


def majority_flag(c: Column) -> Column:
    """``median > 0`` of a non-negative raster, from two counters.

    At least half of the valid values are positive exactly when the median (the
    mean of the two middle values on an even count) is positive.  A group with
    no valid value is not flagged.
    """
    positive = F.count(F.when(c > 0, True))
    return F.when((positive > 0) & (positive * 2 >= F.count(c)), 1.0).otherwise(0.0)


#: Reducers by name.  ``median`` is exact and keeps a value histogram per group,
#: so it is meant for blocks of unique cells; ``flag`` needs two counters.
REDUCERS: dict[str, Callable[[Column], Column]] = {
    "median": F.median,
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "mode": lambda c: F.mode(c, True),
    "flag": majority_flag,
}


def reducer(method: str) -> Callable[[Column], Column]:
    if method not in REDUCERS:
        raise ValueError(f"unknown reduction {method!r}, known: {sorted(REDUCERS)}")
    return REDUCERS[method]


def coarsen(
    df: DataFrame,
    spec: GridSpec,
    k: int,
    method: str,
    value: str,
    *,
    boundary: str = "trim",
    keys: Sequence[str] = (),
    dense: bool | None = None,
    labels: Mapping[str, Sequence] | None = None,
    keep_missing: bool = False,
) -> tuple[DataFrame, GridSpec]:
    """Reduce k x k blocks; returns the blocks and their grid.

    Without ``keys`` every block of the grid is present in the output.  With
    ``keys`` (days, bands) only blocks that hold a row are, unless ``labels``
    lists the labels of each key; then every block of each is.  ``keep_missing``
    leaves a flag missing where a block has no valid cell.
    """
    dense = not keys if dense is None else dense
    if dense and keys and not labels:
        raise ValueError("a dense result with keys needs their labels")
    if labels is not None and set(labels) != set(keys):
        raise ValueError("labels are given for every key or none")
    dense = dense or bool(labels)
    out = spec.coarsen(k, boundary)
    c = F.col(value)
    blocks = df.where(F.col("y_idx").between(0, out.ny * k - 1) & F.col("x_idx").between(0, out.nx * k - 1)).select(
        *keys,
        F.floor(F.col("y_idx") / k).alias("y_idx"),
        F.floor(F.col("x_idx") / k).alias("x_idx"),
        value,
    )
    if dense:
        spine = out.spine(df.sparkSession).withColumn(value, F.lit(None).cast(df.schema[value].dataType))
        for key, known in (labels or {}).items():
            spine = spine.withColumn(key, F.explode(F.array(*(F.lit(v).cast(df.schema[key].dataType) for v in known))))
        blocks = blocks.unionByName(spine)
    agg = reducer(method)(c)
    if keep_missing:
        agg = F.when(F.count(c) > 0, agg)
    return blocks.groupBy(*keys, *CELL).agg(agg.alias(value)), out


def global_reduce(df: DataFrame, value: str, method: str) -> DataFrame:
    """One row: the whole array's median flag ('flag'), mean, min, max or sum."""
    if method == "median":
        raise ValueError("use exact_median: a whole-array histogram does not fit one task")
    return df.agg(reducer(method)(F.col(value)).alias(value))


def exact_median(df: DataFrame, value: str, *, finish_rows: int = 1_000_000) -> float | None:
    """Exact median of a whole column without collecting it.

    The column is read three times: for its size and two approximate quantiles
    that bracket both middle ranks, for what lies below and on them, and to
    write what lies strictly between.  That rest, a 500th whatever the
    distribution, is bracketed again where it is still large, and then ranked.
    A bracket that misses a rank is made wider.
    """
    c = F.col(value)
    valid = df.select(c.cast("double").alias(value)).where(c.isNotNull())
    margin = 0.001  # ten times the rank error of the approximate quantiles
    total, ends = valid.agg(F.count(value), F.percentile_approx(c, [0.5 - margin, 0.5 + margin], 10_000)).first()
    if total == 0:
        return None
    ranks = sorted({(total - 1) // 2, total // 2})
    middle = _values_at_ranks(valid, value, total, ranks, ends, finish_rows)
    return sum(middle) / len(middle)


def _values_at_ranks(df: DataFrame, value: str, n: int, ranks: list[int], ends, finish_rows: int) -> list[float]:
    """The values at one or two neighbouring ranks of ``n`` rows; ``ends`` is a first guess around them."""
    c = F.col(value)
    margin = 0.001
    while n > finish_rows:
        lo, hi = ends
        between = (c > lo) & (c < hi)
        below, on_lo, inner, on_hi = df.agg(
            F.count_if(c < lo), F.count_if(c == lo), F.count_if(between), F.count_if((c == hi) & (c != lo))
        ).first()
        if ranks[0] < below or ranks[-1] >= below + on_lo + inner + on_hi:
            margin *= 10
            near = [max(0.0, ranks[0] / n - margin), min(1.0, ranks[-1] / n + margin)]
            ends = df.agg(F.percentile_approx(c, near, 10_000)).first()[0] if margin < 1 else df.agg(F.min(c), F.max(c)).first()
            continue
        known = {r: lo for r in ranks if r < below + on_lo} | {r: hi for r in ranks if r >= below + on_lo + inner}
        rest = [r for r in ranks if r not in known]
        if rest:
            inside = materialize(df.where(between), "between")
            at = [r - below - on_lo for r in rest]
            near = [max(0.0, at[0] / inner - 0.001), min(1.0, at[-1] / inner + 0.001)]
            guess = inside.agg(F.percentile_approx(c, near, 10_000)).first()[0] if inner > finish_rows else None
            known |= dict(zip(rest, _values_at_ranks(inside, value, inner, at, guess, finish_rows)))
        return [known[r] for r in ranks]
    counts = df.groupBy(value).count()
    upto = counts.withColumn(
        "upto", F.sum("count").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    )
    return list(upto.agg(*(F.min(F.when(F.col("upto") > r, F.col(value))) for r in ranks)).first())


def composite_max(df: DataFrame, value: str, keys: Sequence[str] = CELL) -> DataFrame:
    """Overlapping scenes: the largest valid value per cell."""
    return df.groupBy(*keys).agg(F.max(value).alias(value))


def daily_sum(df: DataFrame, value: str, day: str = "day", keys: Sequence[str] = CELL) -> DataFrame:
    """Sum of a day's steps; an all-missing day counts as 0."""
    return df.groupBy(day, *keys).agg(REDUCERS["sum"](F.col(value)).alias(value))


def daily_mean(df: DataFrame, value: str, day: str = "day", keys: Sequence[str] = CELL) -> DataFrame:
    return df.groupBy(day, *keys).agg(F.avg(value).alias(value))


def min_max(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def normalize(df: DataFrame, value: str) -> DataFrame:
    """Stretch the whole cube to 0..1; a constant cube becomes missing.

    The two scalars enter as uncorrelated subqueries: no join, no window.
    """
    ends = min_max(df, value).select(F.struct("lo", "hi")).scalar()
    lo, hi = ends["lo"], ends["hi"]
    return df.withColumn(value, F.try_divide(F.col(value) - lo, hi - lo))


def total_bounds(vertices: DataFrame) -> DataFrame:
    """Bounding box of all polygons, one row."""
    return vertices.agg(
        F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y")
    )
