"""Colour tables and legends as dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.functions.text import parse_legend, rgb_hex
from eocube.operators.overlay import RAMP_BINS


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one small file with their position, in file order."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "line")).where(F.trim("line") != "")


def head_lines(lines: DataFrame, n: int = RAMP_BINS) -> DataFrame:
    return lines.where(F.col("pos") < n)


def read_colours(spark: SparkSession, path: str, n: int = RAMP_BINS) -> DataFrame:
    """``(bin, hex)``: the first n lines ``r g b`` of a colour table."""
    return head_lines(numbered_lines(spark, path), n).select(
        (F.col("pos") + 1).alias("bin"), rgb_hex(F.col("line")).alias("hex")
    )


def read_legend(spark: SparkSession, path: str) -> DataFrame:
    """``(code, rest, label)`` from lines ``id "label" rest``."""
    return numbered_lines(spark, path).select(parse_legend(F.col("line")).alias("_l")).select("_l.*")
