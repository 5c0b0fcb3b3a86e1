"""Size rule for broadcast sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side is hinted for broadcast only when its row count is known, from a grid
#: spec or by counting, and stays below this; otherwise Spark picks the join
#: from statistics and may shuffle both sides.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a side whose row count is known to be at most ``rows``."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def measured_side(df: DataFrame) -> DataFrame:
    """Hint a side after counting it; counting stops just above the limit.

    For tables made from few input rows whose size plan statistics cannot tell,
    joined to a side that is too large to shuffle for nothing.
    """
    return small_side(df, df.limit(BROADCAST_ROWS + 1).count())
