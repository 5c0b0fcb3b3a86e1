"""Polygon masks by scan lines.

Edges are cut at the centre line of every grid row they cross.  The sorted cuts
of a polygon pair up into stretches that lie inside it, so cells meet a short
list of stretches of their own row and block instead of every edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eocube.functions.projection import project
from eocube.functions.text import extent_ring
from eocube.model import SEGMENT, Extent, GridSpec
from eocube.operators.sizing import measured_side
from eocube.sources.store import materialize

#: Least number of cells of one row that share a join key, and the most such
#: blocks a row is cut into.
SPAN_BLOCK = 256
ROW_BLOCKS = 8


def to_crs(vertices: DataFrame, src: str, dst: str) -> DataFrame:
    return project(vertices, F.col("x"), F.col("y"), src, dst, ("x", "y"))


def edges(vertices: DataFrame) -> DataFrame:
    """Consecutive vertex pairs per ring, closing each ring.

    An equi-join on the next position, so one very long ring is spread over
    tasks like any other vertices.
    """
    ring = ["poly_id", "ring_id"]
    sizes = vertices.groupBy(*ring).agg(F.count(F.lit(1)).alias("n"))
    here = vertices.join(sizes, ring).select(
        *ring, F.col("x").alias("x1"), F.col("y").alias("y1"), F.pmod(F.col("seq") + 1, F.col("n")).alias("seq")
    )
    there = vertices.select(*ring, F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("seq").cast("bigint").alias("seq"))
    return here.withColumn("seq", F.col("seq").cast("bigint")).join(there, [*ring, "seq"]).drop("seq")


def inside_spans(vertices: DataFrame, spec: GridSpec) -> DataFrame:
    """(y_idx, x_from, x_to): where each grid row lies inside any polygon.

    Even-odd rule per polygon, so rings inside rings are holes; stretches of
    overlapping polygons are merged.  A cell is inside when its centre is.
    """
    e = edges(vertices)
    rows = [spec.pixel_y(F.col(c)) - 0.5 for c in ("y1", "y2")]
    lo = F.greatest(F.lit(0), F.floor(F.least(*rows)))
    hi = F.least(F.lit(spec.ny - 1), F.ceil(F.greatest(*rows)))
    cy = spec.center_y(F.col("y_idx"))
    cuts = (
        e.where(F.col("y1") != F.col("y2"))
        .withColumn("y_idx", F.explode(F.when(hi >= lo, F.sequence(lo, hi))))
        .where((F.col("y1") > cy) != (F.col("y2") > cy))
        .select(
            "poly_id",
            "y_idx",
            (F.col("x1") + (cy - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("cut"),
        )
    )
    line = Window.partitionBy("poly_id", "y_idx").orderBy("cut")
    spans = (
        cuts.withColumns({"k": F.row_number().over(line), "x_to": F.lead("cut").over(line)})
        .where(F.col("k") % 2 == 1)
        .select("y_idx", F.col("cut").alias("x_from"), "x_to")
    )
    row = Window.partitionBy("y_idx").orderBy("x_from", "x_to")
    before = row.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("x_to").over(before)
    return (
        spans.withColumn("starts", F.when(reach.isNull() | (F.col("x_from") > reach), 1).otherwise(0))
        .withColumn("island", F.sum("starts").over(row.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("y_idx", "island")
        .agg(F.min("x_from").alias("x_from"), F.max("x_to").alias("x_to"))
        .drop("island")
    )


def clip_polygon(
    df: DataFrame, spec: GridSpec, vertices: DataFrame, values: list[str], *, keep_shape: bool = True
) -> DataFrame:
    """Blank the cells outside the polygons, or drop them.

    The stretches are written and counted first: the polygons of a region give
    few, which are then broadcast, and the raster is not shuffled.

    Vertices are ``(poly_id, ring_id, seq, x, y)`` with ``seq`` from 0, in the
    grid's own reference system (see :func:`to_crs`).
    """
    spans = inside_spans(vertices, spec)
    block = max(SPAN_BLOCK, -(-spec.nx // ROW_BLOCKS))
    ends = [F.floor(spec.pixel_x(F.col(c)) / block) for c in ("x_from", "x_to")]
    # A stretch may lie beyond the grid; only blocks that hold cells are listed.
    lo = F.greatest(F.lit(0), F.least(*ends))
    hi = F.least(F.lit((spec.nx - 1) // block), F.greatest(*ends))
    blocks = materialize(spans.withColumn("_block", F.explode(F.when(hi >= lo, F.sequence(lo, hi)))), "spans")
    cells = df.withColumn("_block", F.floor(F.col("x_idx") / block))
    cx = spec.center_x(F.col("l.x_idx"))
    hit = (
        (F.col("l.y_idx") == F.col("r.y_idx"))
        & (F.col("l._block") == F.col("r._block"))
        & (cx >= F.col("r.x_from"))
        & (cx < F.col("r.x_to"))
    )
    joined = cells.alias("l").join(measured_side(blocks).alias("r"), hit, "left" if keep_shape else "inner")
    inside = F.col("r.y_idx").isNotNull()
    return joined.select(
        *(
            F.when(inside, F.col(f"l.{c}")).alias(c) if c in values else F.col(f"l.{c}")
            for c in df.columns
        )
    )


def transform_extents(
    df: DataFrame, extent: str, keys: list[str], src: str, dst: str, segment: float = SEGMENT
) -> DataFrame:
    """Boxes of a struct column in another system: densified edges, envelope.

    Corners count to six decimals. An edge is cut into pieces of at most ``segment``
    units, and into 20 at least, as :meth:`Extent.to` does.  Returns the keys and ``min_x, min_y, max_x, max_y``, one row per box.
    """
    ring = extent_ring(F.col(extent))
    sides = df.select(*keys, F.explode(F.arrays_zip(F.slice(ring, 1, 4).alias("a"), F.slice(ring, 2, 4).alias("b"))).alias("s"))
    end = lambda p, c: F.round(F.col(f"s.{p}.{c}"), 6)
    step = lambda c: end("b", c) - end("a", c)
    pieces = F.greatest(F.lit(20), F.ceil(F.hypot(step("x"), step("y")) / segment))
    along = sides.withColumn("n", pieces).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n"))))
    at = lambda c: end("a", c) + step(c) * F.col("i") / F.col("n")
    moved = project(along, at("x"), at("y"), src, dst, ("x", "y"))
    return moved.groupBy(*keys).agg(
        F.min("x").alias("min_x"), F.min("y").alias("min_y"), F.max("x").alias("max_x"), F.max("y").alias("max_y")
    )


def polygons_meeting(vertices: DataFrame, extent: Extent) -> DataFrame:
    """Vertices of the polygons whose own box meets the extent."""
    boxes = vertices.groupBy("poly_id").agg(
        F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y")
    )
    meets = (
        (F.col("min_x") <= extent.max_x) & (F.col("max_x") >= extent.min_x)
        & (F.col("min_y") <= extent.max_y) & (F.col("max_y") >= extent.min_y)
    )
    return vertices.join(boxes.where(meets).select("poly_id"), "poly_id", "left_semi")
