"""An archive of scene files: a manifest of what it holds, and cells of chosen files only.

A file holds the cells ``(y_idx, x_idx, value…)`` of one scene or tile.  The manifest has one row
per file: its path, the fields of its name and the rows and columns its cells span.  Plans choose
files in the manifest and open just those, so the bytes read follow the choice and not the archive.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eocube.model import GridSpec
from eocube.sources.files import file_catalog, list_files
from eocube.sources.store import read_or_empty

#: Opens files by their paths and returns their cells; with ``True`` each keeps its ``path``.
Opener = Callable[[Sequence[str], bool], DataFrame]
BOUNDS = "y_from bigint, y_to bigint, x_from bigint, x_to bigint"
#: Rows of a row group of a landed file.
GROUP_ROWS = 1 << 20
# Fixed values of partition folders: the name of a missing value, and signs that are escaped.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def one_slash(path: Column) -> Column:
    """The same path however many slashes follow its scheme."""
    return F.regexp_replace(path, r"^([a-zA-Z0-9+.-]+):/+", "$1:/")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``(path, file)``: the names that conventions parse, without the folders' column names, and the file behind each.

    Only folders are listed.  A scene written as a folder of part files has a row for each of them.
    """
    found = list_files(spark, root, "*.parquet").select(one_slash(F.col("path")).alias("file"))
    name = F.regexp_replace(F.regexp_replace("file", r"/p[0-9]+=", "/"), r"/part-[^/]*$", "")
    return found.select(name.alias("path"), "file")


def catalogue(spark: SparkSession, root: str, convention, levels: Sequence[str] = ()) -> DataFrame:
    """The archive's files by the fields of their names: ``path``, ``file`` and what the convention parses."""
    # a task of a listing takes few files, so an archive of many would have thousands of tasks
    names = listing(spark, root).coalesce(spark.sparkContext.defaultParallelism)
    return file_catalog(names, convention, levels, ["file"])


def opener(spark: SparkSession, schema: str) -> Opener:
    """Opens Parquet files that hold cells of a schema."""

    def open_files(files: Sequence[str], keep_path: bool = False) -> DataFrame:
        cells = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
        if not keep_path:
            return cells
        return cells.withColumn("file", one_slash(F.col("_metadata.file_path")) if files else F.lit(None).cast("string"))

    return open_files


def update_manifest(spark: SparkSession, root: str, target: str, convention, levels: Sequence[str], schema: str) -> DataFrame:
    """Add the files that a manifest does not list yet, with the bounds of their cells, and return all of it.

    A file is read once, when it is new: two columns of it.  Rows of files that left the archive
    are not returned.
    """
    files = catalogue(spark, root, convention, levels)
    kinds = ", ".join(f"{c} {k}" for c, k in files.dtypes)
    known = read_or_empty(spark, target, f"{kinds}, {BOUNDS}")
    new = files.join(known.select("file"), "file", "left_anti")
    paths = [r.file for r in new.select("file").collect()]
    if paths:
        cells = opener(spark, schema)(paths, True)
        bounds = cells.groupBy("file").agg(
            F.min("y_idx").alias("y_from"), (F.max("y_idx") + 1).alias("y_to"), F.min("x_idx").alias("x_from"), (F.max("x_idx") + 1).alias("x_to")
        )
        new.join(bounds, "file", "left").select(*files.columns, "y_from", "y_to", "x_from", "x_to").write.mode("append").parquet(target)
    return spark.read.schema(f"{kinds}, {BOUNDS}").parquet(target).join(files.select("file"), "file", "left_semi") if paths else known


def meeting(files: DataFrame, spec: GridSpec, cut: GridSpec) -> DataFrame:
    """Files whose cells may lie in a crop of their grid; files without bounds may."""
    if "y_from" not in files.columns:
        return files
    y, x = round((cut.y0 - spec.y0) / spec.dy), round((cut.x0 - spec.x0) / spec.dx)
    apart = (F.col("y_from") >= y + cut.ny) | (F.col("y_to") <= y) | (F.col("x_from") >= x + cut.nx) | (F.col("x_to") <= x)
    return files.where(~F.coalesce(apart, F.lit(False)))


def _qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system; fails if it exists."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place):
        raise ValueError(f"an archive is landed in a new folder: {path} exists")
    return files.makeQualified(place).toString()


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified path, and the path within it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _folder(scene: str | None, levels: int) -> str:
    """The partition folders of a scene's name."""
    parts = [None] * levels if scene is None else scene.split("/")
    if len(parts) < levels:
        raise ValueError(f"the path of a scene has {levels} parts: {scene}")
    value = lambda x: _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", x) if x else NO_VALUE
    return "/".join(f"p{i}={value(x)}" for i, x in enumerate(parts))


class _SceneFile:
    """One file of the archive, written beside its place and moved there when it is whole."""

    def __init__(self, files: pafs.FileSystem, folder: str, name: str):
        files.create_dir(folder, recursive=True)
        self.files, self.path, self.made = files, f"{folder}/{name}", f"{folder}/_{uuid.uuid4().hex}"
        self.writer: pq.ParquetWriter | None = None
        self.held: list[pa.RecordBatch] = []
        self.rows = 0

    def add(self, part: pa.RecordBatch) -> None:
        self.held.append(part)
        self.rows += part.num_rows
        if self.rows >= GROUP_ROWS:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            group = pa.Table.from_batches(self.held)
            self.writer = self.writer or pq.ParquetWriter(self.made, group.schema, filesystem=self.files)
            self.writer.write_table(group, row_group_size=GROUP_ROWS)
        self.held, self.rows = [], 0

    def close(self) -> None:
        self._flush()
        self.writer.close()
        if self.files.get_file_info(self.path).type != pafs.FileType.NotFound:  # of an earlier attempt
            self.files.delete_file(self.path)
        self.files.move(self.made, self.path)


def land_archive(cells: DataFrame, root: str, levels: int) -> None:
    """Write cells ``(path, …)`` as one folder per path of ``levels`` parts, as an archive that has arrived.

    The cells of a path meet in one task, which writes its scenes one after the other with Arrow:
    an archive has as many files as scenes, and Spark's own writer needs some 30 ms for each.
    A file is named after its partition and appears when it is whole, so a repeated task replaces its files.
    """
    where = _qualified(cells.sparkSession, root)

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, base = _filesystem(where)
        name = f"part-{TaskContext.get().partitionId():05d}.parquet"
        scene, out, landed, rows = None, None, 0, 0
        for b in batches:
            names = b.column("_scene")
            data = b.drop_columns(["_scene"])
            codes = pc.fill_null(names.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), b.num_rows] if b.num_rows else []
            for i, j in zip(starts, starts[1:]):
                if out is None or names[i].as_py() != scene:
                    if out is not None:
                        out.close()
                    scene = names[i].as_py()
                    out = _SceneFile(files, f"{base}/{_folder(scene, levels)}", name)
                    landed += 1
                out.add(data.slice(i, j - i))
            rows += b.num_rows
        if out is not None:
            out.close()
        yield pa.record_batch([pa.array([landed]), pa.array([rows])], names=["files", "rows"])

    scene = F.substring_index(F.regexp_replace("path", "^/+", ""), "/", levels)
    placed = cells.withColumn("_scene", scene).drop("path").repartition("_scene").sortWithinPartitions("_scene")
    placed.mapInArrow(land, "files bigint, rows bigint").write.parquet(f"{root}/_landed")
