"""A user sink with state of its own, committed batch by batch.

A micro-batch is written in two steps.  First its rows and the state after it go to folders of
their own; then one small file names both, made only if the batch has none yet.  What no commit
names is never read, so a batch that fails on the way, or is sent again, leaves no trace, and a
new sink on the same folder goes on from the last commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: From the state before a batch and the batch: the state after it and the rows to keep.
Update = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


class StatefulSink:
    """``send`` a batch, ``close`` with all rows kept; ``state`` is a table that ``update`` carries on."""

    def __init__(self, spark: SparkSession, root: str, state: str, update: Update):
        self.spark, self.root, self.schema, self.update = spark, root.rstrip("/"), state, update

    def _path(self, batch_id: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/batch-{batch_id:012d}.json")

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commits(self) -> DataFrame:
        """``(batch, out, state)`` of the batches that are whole."""
        folder = self._path(0).getParent()
        if not self._fs(folder).exists(folder):
            return self.spark.createDataFrame([], "batch bigint, out string, state string")
        return self.spark.read.schema("batch bigint, out string, state string").json(folder.toString())

    def state(self) -> DataFrame:
        """The state after the last whole batch; empty before the first."""
        last = self._commits().orderBy("batch", ascending=False).first()
        if last is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(last.state)

    def send(self, batch: DataFrame, batch_id: int) -> None:
        path = self._path(batch_id)
        if self._fs(path).exists(path):
            return
        name = uuid.uuid4().hex
        out, state = f"{self.root}/out/{name}", f"{self.root}/state/{name}"
        batch = batch.persist()  # two results are made of it
        try:
            after, rows = self.update(self.state(), batch)
            rows.write.parquet(out)
            after.write.parquet(state)
        finally:
            batch.unpersist()
        stream = self._fs(path).create(path, False)
        stream.write(bytearray(json.dumps({"batch": batch_id, "out": out, "state": state}).encode()))
        stream.close()

    def close(self) -> DataFrame:
        """The rows of all whole batches."""
        folders = [r.out for r in self._commits().orderBy("batch").collect()]
        if not folders:
            raise ValueError("the sink has kept nothing")
        return self.spark.read.parquet(*folders)
