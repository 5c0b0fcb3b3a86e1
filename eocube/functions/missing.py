"""Missing-value rules: NULL is missing, NaN never gets past the readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def drop_nan(df: DataFrame, nodata: float | None = None) -> DataFrame:
    """Turn NaN, and a declared no-data value, into NULL in float columns."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = no_nan(F.col(f.name))
            out[f.name] = c if nodata is None else F.nullif(c, F.lit(nodata).cast(f.dataType))
    return df.withColumns(out) if out else df


def exceeds(c: Column, threshold: float) -> Column:
    """``c > threshold`` where a missing value compares false."""
    return F.coalesce(c > F.lit(threshold), F.lit(False))


def mask_and_scale(raw: Column, fill: float, scale: float = 1.0, offset: float = 0.0) -> Column:
    """Decode a packed raster value: the fill value becomes missing."""
    return F.when(raw != F.lit(fill), raw * F.lit(float(scale)) + F.lit(float(offset)))


def encode_int16(c: Column, fill: int = -9999, scale: float = 1.0) -> Column:
    """Pack to 16 bits; missing or out-of-range values become the fill value."""
    packed = F.rint(c / F.lit(float(scale))).try_cast("smallint")
    return F.coalesce(packed, F.lit(fill).cast("smallint"))


def constant_like(df: DataFrame, names: Sequence[str], value: float | None = 0.0, kind: str = "double") -> DataFrame:
    """The same cells with the named variables set to one value or missing."""
    return df.withColumns({n: F.lit(value).cast(kind) for n in names})
