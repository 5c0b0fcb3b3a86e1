"""Class overlays, labels and colour bins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eocube.functions.missing import exceeds
from eocube.operators.select import CELL

# Class codes and their labels.
BUILT_THRESHOLD = 10
OVERLAY_CLASSES = {0: "other", 1: "flooded", 2: "built"}
FLOOD_CLASSES = {0: "non-flooded", 1: "flooded"}
LANDCOVER_CLASSES = {
    1: "Artificial surfaces",
    2: "Agricultural areas",
    3: "Forest and seminatural areas",
    4: "Wetlands",
    5: "Water bodies",
}
RAMP_BINS = 200


def overlay_flood_built(
    flood: DataFrame, built: DataFrame, threshold: float = BUILT_THRESHOLD, *, keys: tuple[str, ...] = ()
) -> DataFrame:
    """0 other, 1 flooded, 2 built; never missing, since a missing built is 0."""
    two = F.when(exceeds(F.col("built"), threshold), 2.0).otherwise(0.0)
    both = flood.join(built.select(*CELL, "built"), list(CELL), "left")  # built does not depend on the keys
    return both.select(*keys, *CELL, F.greatest(F.col("flood"), two).alias("class"))


def class_label(code: Column, labels: Mapping[int, str]) -> Column:
    """Label of a code from a short fixed table; unknown codes are missing."""
    table = F.create_map(*(F.lit(v) for kv in labels.items() for v in kv))
    return F.try_element_at(table, code.cast("int"))


def join_labels(df: DataFrame, legend: DataFrame, code: str, legend_code: str = "code") -> DataFrame:
    """Labels from a legend table; its size decides how Spark joins it."""
    return df.join(legend.withColumnRenamed(legend_code, code), code, "left")


def major_class(code: Column) -> Column:
    """Major land-cover class 1..5 of a three-digit code."""
    return F.floor(code / 100)


def ramp_bin(v: Column, lo: float | Column, hi: float | Column, bins: int = RAMP_BINS) -> Column:
    """Colour bin 1..bins; below the range or missing is no colour, above it the last."""
    lo, hi = (F.lit(e) if isinstance(e, (int, float)) else e for e in (lo, hi))
    step = F.try_divide(v - lo, hi - lo) * bins
    return F.when(v >= lo, F.least(F.lit(bins), F.floor(step) + 1).cast("int"))
