"""A cube as a stream of time steps, and the drivers that run one dry.

Steps land with a manifest: the files of a day are written first, then one small file that lists
them.  :func:`step_stream` reads the manifests, one a micro-batch, so each batch is one whole day
however many files it has, and where the stream has got to is in Spark's own checkpoint.
:func:`file_stream` reads a folder as it fills, files of any days together.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from eocube.sources.files import list_files


class StreamSink(Protocol):
    """A user sink: one call per micro-batch, and one at the end."""

    def send(self, batch: DataFrame, batch_id: int) -> None: ...

    def close(self) -> DataFrame: ...


#: Files of one micro-batch of a plain file stream.
FILES_PER_BATCH = 64
MANIFEST = "day date, path string"
PROGRESS = "batch bigint, rows bigint, started string, ms bigint"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def land_files(df: DataFrame, path: str, days: list, day: str = "day", *, files: int | None = None) -> None:
    """Append the given days to a folder, as their arrival would; ``files`` fixes the number of files."""
    landed = df.where(F.col(day).isin(days))
    (landed if files is None else landed.repartition(files)).write.mode("append").parquet(path)


def mark_whole(spark: SparkSession, path: str, schema: StructType, days: list, day: str = "day") -> None:
    """Land end marks behind the files of some days: rows with nothing but the day."""
    rows = spark.createDataFrame([(d,) for d in sorted(days)], "day date").coalesce(1)
    rows.select(*(F.col("day") if f.name == day else F.lit(None).cast(f.dataType).alias(f.name) for f in schema)).write.mode(
        "append"
    ).parquet(path)


def land_steps(df: DataFrame, root: str, days: list, day: str = "day", *, files: int | None = None) -> None:
    """Land whole days with their manifests, in order; a landing that fails on the way lists nothing."""
    spark, folder = df.sparkSession, f"{root}/cells/landing={uuid.uuid4().hex}"
    rows = df.where(F.col(day).isin(days)).withColumn("_day", F.col(day))
    (rows if files is None else rows.repartition(files)).write.partitionBy("_day").parquet(folder)
    found = list_files(spark, folder, "*.parquet").withColumn("day", F.regexp_extract("path", "_day=([0-9-]+)", 1).cast("date"))
    listed = found.select("day", "path").collect()
    for d in sorted(days):
        # a manifest a day, one after the other: the stream takes them in the order of their times
        own = [(d, r.path) for r in listed if r.day == d]
        spark.createDataFrame([*own, (d, None)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/steps")


def step_stream(spark: SparkSession, root: str, schema: StructType, *, marks: bool = False) -> DataFrame:
    """The landed days, one whole day a micro-batch; ``marks`` adds an end mark to each.

    The files of a day are read by as many tasks as there are files and shuffle partitions.
    """
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for day, path in zip(b.column("day").to_pylist(), b.column("path").to_pylist()):
                if path is None:
                    if marks:
                        row = {f.name: [day if f.name == "day" else None] for f in target}
                        yield pa.RecordBatch.from_pydict(row, schema=target)
                    continue
                if path.startswith("file:/") and not path.startswith("file://"):
                    path = "file://" + path[len("file:") :]
                place, name = pafs.FileSystem.from_uri(path)
                with place.open_input_file(name) as f:
                    for part in pq.ParquetFile(f).iter_batches(batch_size=65_536, columns=target.names):
                        yield pa.Table.from_batches([part]).select(target.names).cast(target).combine_chunks().to_batches()[0]

    listed = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", 1).parquet(f"{root}/steps")
    return listed.repartition("path").mapInArrow(read, schema)


def file_stream(spark: SparkSession, path: str, schema, *, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Cells that land in a folder, oldest files first, at most ``files_per_batch`` files a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


class _Recorder(StreamingQueryListener):
    """Writes one file per micro-batch of one query, named by the batch, so that a repeated batch replaces its row."""

    def __init__(self, spark: SparkSession, name: str, folder: str):
        self.spark, self.name, self.folder = spark, name, folder
        self.run_id, self.ended = None, threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name:
            return
        row = {"batch": p.batchId, "rows": p.numInputRows, "started": p.timestamp, "ms": p.batchDuration}
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch-{p.batchId:012d}.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()


@contextmanager
def _state_store(spark: SparkSession):
    """Queries that start inside keep their state where keyed maps and timers can; a query copies the settings it starts with."""
    before = spark.conf.get(_STATE_STORE, None)
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_STATE_STORE, before) if before else spark.conf.unset(_STATE_STORE)


def _progress_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-progress"


def _run(writer, spark: SparkSession, checkpoint: str) -> StreamingQuery:
    """Start a query, record its progress and wait until it has taken all that has landed."""
    name = f"eocube-{uuid.uuid4().hex}"
    recorder = _Recorder(spark, name, _progress_folder(checkpoint))
    spark.streams.addListener(recorder)
    try:
        with _state_store(spark):
            query = writer.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            recorder.ended.wait(60)  # events come in order: the last batch's is behind us
    finally:
        spark.streams.removeListener(recorder)
    return query


def run_to_files(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process all that has landed into a Parquet folder, then stop."""
    return _run(stream.writeStream.format("parquet").option("path", path).outputMode(mode), stream.sparkSession, checkpoint)


def run_each(send: Callable[[DataFrame, int], None], stream: DataFrame, checkpoint: str) -> StreamingQuery:
    return _run(stream.writeStream.foreachBatch(send), stream.sparkSession, checkpoint)


def run_to_sink(stream: DataFrame, sink: StreamSink, checkpoint: str) -> DataFrame:
    """Send every micro-batch to a user sink and return what it closes with."""
    run_each(sink.send, stream, checkpoint)
    return sink.close()


def progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(batch, rows, started, ms)`` of every micro-batch that the functions above ran with a checkpoint, over all runs."""
    return spark.read.schema(PROGRESS).json(_progress_folder(checkpoint))
