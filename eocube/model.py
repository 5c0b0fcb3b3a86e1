"""Extents and grid specifications: small driver-side descriptions of space."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.functions.projection import LONLAT, WEB_MERCATOR, project_point

#: Web mercator ends at this latitude.
MERCATOR_LIMIT = 85.0511287798066
#: Edge spacing, in units of the extent's own system, when a box is densified.
SEGMENT = 25_000.0


@dataclass(frozen=True)
class Extent:
    """A box; corners given in any order are put right."""

    min_x: float
    min_y: float
    max_x: float
    max_y: float
    crs: str | None = None

    def __post_init__(self):
        for low, high in (("min_x", "max_x"), ("min_y", "max_y")):
            a, b = float(getattr(self, low)), float(getattr(self, high))
            object.__setattr__(self, low, min(a, b))
            object.__setattr__(self, high, max(a, b))

    @classmethod
    def parse(cls, text: str) -> Extent:
        """Read ``"min_x, min_y, max_x, max_y[, crs]"``."""
        fields = text.split(",")
        if len(fields) not in (4, 5):
            raise ValueError(f"an extent has 4 numbers and an optional crs: {text!r}")
        crs = fields.pop().strip() if len(fields) == 5 else None
        return cls(*(float(f) for f in fields), crs)

    def corners(self) -> tuple[float, float, float, float]:
        return self.min_x, self.min_y, self.max_x, self.max_y

    def polygon(self) -> list[tuple[float, float]]:
        """Closed ring, anticlockwise from the lower left corner."""
        x0, y0, x1, y1 = self.corners()
        return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]

    def contains(self, x: Column, y: Column) -> Column:
        """Inclusive on every side; a missing coordinate is outside."""
        hit = x.between(self.min_x, self.max_x) & y.between(self.min_y, self.max_y)
        return F.coalesce(hit, F.lit(False))

    def to(self, crs: str, segment: float = SEGMENT) -> Extent:
        """Envelope of the box's densified outline in another system.

        Web mercator holds only what lies between its limiting latitudes.
        """
        src = self.crs or LONLAT
        box = self
        if (src, crs) == (LONLAT, WEB_MERCATOR):
            low, high = (min(max(y, -MERCATOR_LIMIT), MERCATOR_LIMIT) for y in (self.min_y, self.max_y))
            box = replace(self, min_y=low, max_y=high)
        ring = [(round(x, 6), round(y, 6)) for x, y in box.polygon()]
        xs, ys = [], []
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            # At least 20 pieces, so that a box in degrees follows curved edges.
            n = max(20, math.ceil(math.hypot(bx - ax, by - ay) / segment))
            for i in range(n):
                px, py = project_point(ax + (bx - ax) * i / n, ay + (by - ay) * i / n, src, crs)
                xs.append(px)
                ys.append(py)
        return Extent(min(xs), min(ys), max(xs), max(ys), crs)


@dataclass(frozen=True)
class GridSpec:
    """A regular grid: ``(x0, y0)`` is the outer corner of cell (0, 0)."""

    crs: str
    x0: float
    dx: float
    y0: float
    dy: float
    nx: int
    ny: int
    nodata: float | None = None

    @classmethod
    def over(cls, extent: Extent, dx: float, dy: float | None = None, nodata: float | None = None) -> GridSpec:
        """North-up grid of square cells covering a box."""
        dy = dx if dy is None else dy
        nx = max(1, math.ceil((extent.max_x - extent.min_x) / dx - 1e-9))
        ny = max(1, math.ceil((extent.max_y - extent.min_y) / dy - 1e-9))
        return cls(extent.crs or LONLAT, extent.min_x, dx, extent.max_y, -dy, nx, ny, nodata)

    @property
    def cells(self) -> int:
        return self.nx * self.ny

    def affine(self) -> tuple[float, float, float, float, float, float]:
        return self.x0, self.dx, 0.0, self.y0, 0.0, self.dy

    def bounds(self) -> Extent:
        return Extent(
            self.x0, self.y0, self.x0 + self.nx * self.dx, self.y0 + self.ny * self.dy, self.crs
        )

    def center_x(self, x_idx: Column) -> Column:
        return F.lit(self.x0) + (x_idx + 0.5) * self.dx

    def center_y(self, y_idx: Column) -> Column:
        return F.lit(self.y0) + (y_idx + 0.5) * self.dy

    def pixel_x(self, x: Column) -> Column:
        """Fractional column position; its floor is the cell index."""
        return (x - self.x0) / self.dx

    def pixel_y(self, y: Column) -> Column:
        return (y - self.y0) / self.dy

    def inside(self, x_idx: Column, y_idx: Column) -> Column:
        return x_idx.between(0, self.nx - 1) & y_idx.between(0, self.ny - 1)

    def index_window(self, extent: Extent) -> tuple[int, int, int, int]:
        """``(y_lo, y_hi, x_lo, x_hi)`` of cells whose centre lies in the box."""

        def span(lo, hi, origin, step, n):
            a, b = sorted(((lo - origin) / step - 0.5, (hi - origin) / step - 0.5))
            return max(0, math.ceil(a - 1e-9)), min(n - 1, math.floor(b + 1e-9))

        y_lo, y_hi = span(extent.min_y, extent.max_y, self.y0, self.dy, self.ny)
        x_lo, x_hi = span(extent.min_x, extent.max_x, self.x0, self.dx, self.nx)
        return y_lo, y_hi, x_lo, x_hi

    def window(self, y_lo: int, y_hi: int, x_lo: int, x_hi: int) -> GridSpec:
        """The grid of a block of cells, both ends included."""
        ny, nx = max(0, y_hi - y_lo + 1), max(0, x_hi - x_lo + 1)
        return replace(self, x0=self.x0 + x_lo * self.dx, y0=self.y0 + y_lo * self.dy, nx=nx, ny=ny)

    def coarsen(self, k: int, boundary: str = "trim") -> GridSpec:
        """The grid of k x k blocks; 'exact' refuses partial blocks."""
        if boundary not in ("trim", "exact"):
            raise ValueError(f"unknown boundary rule: {boundary!r}")
        if boundary == "exact" and (self.nx % k or self.ny % k):
            raise ValueError(f"{self.ny} x {self.nx} cells do not divide into blocks of {k}")
        return replace(self, dx=self.dx * k, dy=self.dy * k, nx=self.nx // k, ny=self.ny // k)

    def project(self, crs: str, resolution: float | None = None) -> GridSpec:
        """Grid in another system; by default the diagonal keeps its cell count."""
        if crs == self.crs and resolution is None:
            return self
        box = self.bounds().to(crs)
        if resolution is None:
            diagonal = math.hypot(box.max_x - box.min_x, box.max_y - box.min_y)
            resolution = diagonal / math.hypot(self.nx, self.ny)
        return GridSpec.over(box, resolution, nodata=self.nodata)

    def spine(self, spark: SparkSession) -> DataFrame:
        """Every cell of the grid, generated in parallel and never stored."""
        return spark.range(self.cells).select(
            F.floor(F.col("id") / self.nx).alias("y_idx"), (F.col("id") % self.nx).alias("x_idx")
        )
