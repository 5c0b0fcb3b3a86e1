"""File listings and multi-file reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Paths below a folder; only the listing is read, never the contents."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path")
    )


def file_catalog(paths: DataFrame, convention, levels: Sequence[str] = (), also: Sequence[str] = ()) -> DataFrame:
    """Parse names by a convention and keep paths that match every level pattern.

    ``convention`` turns the path Column into a struct of fields, which become
    columns (see :mod:`eocube.functions.text`).  Columns named in ``also`` are carried along.
    """
    keep = F.lit(True)
    for level in levels:
        keep = keep & F.col("path").rlike(f"(^|/){level}")
    fields: Column = convention(F.col("path"))
    return paths.where(keep).select("path", *also, fields.alias("_f")).select("path", "_f.*", *also)


def read_many(spark: SparkSession, paths: Sequence[str], band: str | None = "band") -> DataFrame:
    """Open many Parquet files as one table; ``band`` holds the file of each row."""
    df = spark.read.parquet(*paths)
    return df if band is None else df.withColumn(band, F.col("_metadata.file_path"))


def read_landing_day(spark: SparkSession, root: str, day: str, variable: str) -> DataFrame:
    """Hourly slices of one landed day: one partition directory, one variable."""
    return spark.read.parquet(root).where(F.col("day") == F.to_date(F.lit(day))).select(
        "day", "step", "y_idx", "x_idx", variable
    )


def raster_roi_read(df: DataFrame, spec, extent, band: int = 0):
    """One band of a raster, cropped to a box; cells and the cropped grid."""
    from eocube.operators.select import clip_box

    cells, cut = clip_box(df.where(F.col("band") == band), spec, extent)
    return cells.drop("band"), cut
