"""Reading the given tables and writing results that later steps read again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eocube.sources.store import workspace


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` of the whole table ``documents``."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write below ``spark.checkpoint.dir`` and read back: cuts lineage, survives lost executors.

    Also where a grouping is joined with the rows it was made from: adaptive execution
    splits a hot key of a join only where both sides come straight from a shuffle, not
    where one is still being aggregated in the same stage.
    """
    path = workspace(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Files whose numbers go to every task; with more, the rows are written with their numbers instead.
NUMBERED_FILES = 100_000


def numbered(rows: DataFrame, name: str = "row") -> DataFrame:
    """The rows with a number each that stays the same whenever, and by whatever splits, they are read.

    Rows that come straight from files are numbered by file and place in it, and are not
    written; all others are written once with their numbers.
    """
    try:
        files = rows.select(F.col("_metadata.file_path").alias("_file")).distinct()
        count = files.count()
    except AnalysisException:
        count = None
    if not count or count > NUMBERED_FILES:
        return written(rows.withColumn(name, F.monotonically_increasing_id()), "numbered")
    known = written(files.select("_file", F.row_number().over(Window.orderBy("_file")).cast("bigint").alias("_no")), "files")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    number = F.shiftleft(F.col("_no"), 40).bitwiseOR(F.col("_index"))
    return placed.join(F.broadcast(known), "_file").withColumn(name, number).drop("_file", "_no", "_index")


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text) -> "F.Column":
    """A-Z lower-cased, every other character untouched."""
    c = F.col(text) if isinstance(text, str) else text
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
