"""The by-day cube store: Parquet partitions, coverage flags and grid tables.

Layout of a store: ``<root>/cube`` partitioned by day, ``<root>/coverage``
partitioned by day, ``<root>/grid`` with static values per cell.
"""

from __future__ import annotations

import atexit
import datetime as dt
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eocube.functions.calendar import days_between
from eocube.functions.geodesy import GLOBAL_STEP_DEG, cell_area, cell_area_exact
from eocube.functions.projection import LONLAT
from eocube.model import GridSpec

# The global 0.1 degree grid, its days and the storage blocks.
GLOBAL_GRID = GridSpec(LONLAT, -180.05, 0.1, 90.05, -0.1, 3600, 1801)
FIRST_DAY, LAST_DAY = dt.date(2015, 1, 1), dt.date(2024, 1, 1)
BLOCK = 1000
COVERAGE_SCHEMA = "covered tinyint, day date"


_homes: set[str] = set()


def _drop(spark: SparkSession, conf, home: str) -> None:
    """Delete a session's folder; a cluster that is gone already keeps it for its own clean-up."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(home)
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM may have ended before the interpreter
        pass


def workspace(spark: SparkSession, name: str = "eocube") -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    All folders of a session share one parent, which is deleted when the driver
    ends.  Without the setting a local folder is made, which only a local
    session can use.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eocube-")
        spark.conf.set("spark.checkpoint.dir", root)
    home = f"{root.rstrip('/')}/eocube-{spark.sparkContext.applicationId}"
    if home not in _homes:
        _homes.add(home)
        atexit.register(_drop, spark, spark._jsc.hadoopConfiguration(), home)
    return f"{home}/{name}-{uuid.uuid4().hex}"


def rechunk(df: DataFrame, block: int = BLOCK, keys: Sequence[str] = ()) -> DataFrame:
    """Bring the cells of one spatial block, per key, together before writing.

    A block holds at most ``block`` squared cells, so no partition outgrows it
    however much lands on one day, and each day gets one file per block.
    """
    return df.repartition(*keys, F.floor(F.col("y_idx") / block), F.floor(F.col("x_idx") / block))


def materialize(df: DataFrame, name: str = "result") -> DataFrame:
    """Compute once and read back from the shared folder.

    For results that feed several branches; unlike a cached one, a written
    table outlives the executors that computed it.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_cube(
    df: DataFrame, path: str, *, overwrite: bool = False, partition_by: Sequence[str] = (), block: int = BLOCK
) -> None:
    """Persist cells by block, sorted for row-group pruning; fails if the target exists."""
    ordered = rechunk(df, block, partition_by).sortWithinPartitions(*partition_by, "y_idx", "x_idx")
    writer = ordered.write.mode("overwrite" if overwrite else "errorifexists")
    writer.partitionBy(*partition_by).parquet(path)


def upsert_days(df: DataFrame, path: str, day: str = "day", block: int = BLOCK) -> None:
    """Replace exactly the days present in ``df``; repeating it changes nothing."""
    if "y_idx" in df.columns:
        df = rechunk(df, block, [day]).sortWithinPartitions(day, "y_idx", "x_idx")
    else:
        df = df.repartition(day)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def grid_table(spark: SparkSession, spec: GridSpec = GLOBAL_GRID) -> DataFrame:
    """Static values per cell: labels and both cell areas."""
    lat, lon = spec.center_y(F.col("y_idx")), spec.center_x(F.col("x_idx"))
    step = abs(spec.dx) if spec.crs == LONLAT else GLOBAL_STEP_DEG
    return spec.spine(spark).select(
        "y_idx", "x_idx", lat.alias("latitude"), lon.alias("longitude"),
        cell_area(lat, lon, step).cast("float").alias("area"), cell_area_exact(lat, step).alias("area_exact"),
    )


def append_dims(spark: SparkSession, root: str, spec: GridSpec = GLOBAL_GRID) -> None:
    """Add the static grid table to a store."""
    grid_table(spark, spec).write.mode("overwrite").parquet(f"{root}/grid")


def calendar(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """Daily calendar, both ends included."""
    return spark.range(1).select(
        F.explode(days_between(F.lit(first), F.lit(last))).alias("day")
    )


def empty_cube(spark: SparkSession, spec: GridSpec, days: DataFrame, value: str) -> DataFrame:
    """The cube before any data: every cell and day, value missing, flag 0.

    Virtual: generated where it is used, never written.
    """
    dates = days.agg(F.sort_array(F.collect_set("day"))).scalar()
    return spec.spine(spark).select(
        F.explode(dates).alias("day"), "y_idx", "x_idx",
        F.lit(None).cast("double").alias(value), F.lit(0).cast("tinyint").alias("covered"),
    )


def covered_runs(cells: DataFrame, day: str = "day") -> DataFrame:
    """``(day, y_idx, x_from, x_to)``: the runs of columns that a cube's rows have, ends exclusive."""
    once = cells.select(day, "y_idx", "x_idx").distinct()
    place = F.row_number().over(Window.partitionBy(day, "y_idx").orderBy("x_idx"))
    runs = once.withColumn("_run", F.col("x_idx") - place).groupBy(day, "y_idx", "_run")
    return runs.agg(F.min("x_idx").alias("x_from"), (F.max("x_idx") + 1).alias("x_to")).drop("_run")


def gap_runs(runs: DataFrame, spec: GridSpec, days: DataFrame, day: str = "day") -> DataFrame:
    """``(day, y_idx, x_from, x_to)``: what runs leave of the grid on the given days.

    A row per day and line of the grid and a row per run, never one per cell.
    """
    lines = days.select(day).distinct().withColumn("y_idx", F.explode(F.sequence(F.lit(0), F.lit(spec.ny - 1)))).select(
        day, F.col("y_idx").cast("bigint").alias("y_idx"), F.lit(spec.nx).cast("bigint").alias("x_from"), F.lit(spec.nx).cast("bigint").alias("x_to")
    )
    inside = runs.where(F.col("y_idx").between(0, spec.ny - 1) & (F.col("x_from") < spec.nx) & (F.col("x_to") > 0))
    both = lines.unionByName(inside.join(days.select(day).distinct(), day, "left_semi").select(day, "y_idx", "x_from", "x_to"))
    order = Window.partitionBy(day, "y_idx").orderBy("x_from", F.desc("x_to"))
    left = F.coalesce(F.lag("x_to").over(order), F.lit(0))
    gaps = both.select(day, "y_idx", left.alias("x_from"), F.least("x_from", F.lit(spec.nx)).alias("x_to"))
    return gaps.where("x_from < x_to")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows before anything has been written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_coverage(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/coverage", COVERAGE_SCHEMA)


def uncovered(coverage: DataFrame) -> DataFrame:
    """Days whose flag is not 1."""
    return coverage.where(F.coalesce(F.col("covered") != 1, F.lit(True)))


def missing_days(days: DataFrame, coverage: DataFrame) -> DataFrame:
    """Requested days without a coverage flag of 1."""
    done = coverage.where(F.col("covered") == 1).select("day")
    return days.select("day").join(done, "day", "left_anti")
