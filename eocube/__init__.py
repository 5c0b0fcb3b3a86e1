"""Earth-observation analytics on Spark DataFrames.

A raster is a table with one row per cell, ``(y_idx, x_idx, value...)``, and a
cube adds a time column.  A missing value is NULL; a NaN never enters.  The
georeference lives in :class:`~eocube.model.GridSpec`, not in the rows.
"""

from eocube.model import Extent, GridSpec

__all__ = ["Extent", "GridSpec"]
