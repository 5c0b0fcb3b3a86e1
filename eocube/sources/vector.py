"""Polygons from GeoJSON as vertex tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.model import Extent
from eocube.operators.clip import polygons_meeting
from eocube.operators.sizing import small_side
from eocube.sources.store import materialize

_POINT = "array<double>"
_RING = f"array<{_POINT}>"
_GEOMETRY = "type string, coordinates string"


def _geometries(spark: SparkSession, path: str) -> DataFrame:
    """``(feature, type, text)``: the features of a document in order, cut from it at their geometries.

    The document is read as text that is split at the key of the geometries, so large files are
    read by several tasks; a feature's object of type and coordinates follows its key whatever the
    order of the members.  The pieces are written once and numbered by their places.
    """
    pieces = spark.read.option("lineSep", '"geometry"').text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    # a geometry's key has a colon behind it, unlike the same word as a value
    keyed = pieces.where(F.col("value").rlike(r"^\s*:")).withColumns(
        {"value": F.regexp_extract("value", r"^\s*:\s*(\{[^{}]*\})", 1), "id": F.monotonically_increasing_id()}
    )
    cut = materialize(keyed, "features")
    # one row per stretch of a file: few, and they say how many features lie before each
    stretches = cut.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).collect()
    before, rows = 0, []
    for r in sorted(stretches, key=lambda r: (r.file, r.block)):
        rows.append((r.file, r.block, before - r.first))
        before += r.n
    shifts = spark.createDataFrame(rows, "file string, block bigint, shift bigint")
    placed = cut.join(small_side(shifts, len(rows)), ["file", "block"])
    geometry = F.from_json("value", _GEOMETRY)
    return placed.select((F.col("id") + F.col("shift")).alias("feature"), geometry["type"].alias("type"), geometry["coordinates"].alias("text"))


def read_geojson(spark: SparkSession, path: str, extent: Extent | None = None) -> DataFrame:
    """Vertices ``(poly_id, ring_id, seq, x, y)`` of all (multi)polygons.

    One row per vertex; with ``extent`` only polygons whose box meets it.
    """
    features = _geometries(spark, path)
    single = F.array(F.from_json("text", f"array<{_RING}>"))
    multi = F.from_json("text", f"array<array<{_RING}>>")
    shape = F.when(F.col("type") == "Polygon", single).when(F.col("type") == "MultiPolygon", multi)
    parts = features.select("feature", F.posexplode(shape).alias("part", "rings"))
    rings = parts.select(
        F.concat_ws("/", "feature", "part").alias("poly_id"), F.posexplode("rings").alias("ring_id", "points")
    )
    vertices = rings.select("poly_id", "ring_id", F.posexplode("points").alias("seq", "p")).select(
        "poly_id", "ring_id", "seq", F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y")
    )
    return vertices if extent is None else polygons_meeting(vertices, extent)


def vertices_of(spark: SparkSession, polygons: list[list[tuple[float, float]]]) -> DataFrame:
    """Vertex table of a few polygons given as single rings."""
    rows = [
        (str(p), 0, i, float(x), float(y)) for p, ring in enumerate(polygons) for i, (x, y) in enumerate(ring)
    ]
    return spark.createDataFrame(rows, "poly_id string, ring_id int, seq int, x double, y double")
