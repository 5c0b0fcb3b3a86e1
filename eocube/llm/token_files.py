"""Token ids in Arrow files of equal-length sequences.

A shard covers a range of ``doc_id`` and is two Arrow IPC files: ``seq-*.arrow`` with
record batches of fixed-size lists, ``ids`` (padded with 0) and ``mask`` (true where an id
is real), and ``doc-*.arrow`` with ``doc_id``, ``start`` (within the shard) and ``n_tokens``.
All batches but the last of a file have the same number of sequences, so sequence ``k`` is
row ``k % batch`` of batch ``k // batch``, and its ids are a view of the mapped file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eocube.llm.encode import encoder

MANIFEST = "seq_file string, doc_file string, shard bigint, n_docs bigint, n_ids bigint, width bigint, batch bigint"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a local path or URI, and the path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


def _schema(width: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, width)), ("mask", pa.list_(pa.bool_(), width))])


class _ShardWriter:
    def __init__(self, folder: str, width: int, batch: int, kind: pa.DataType):
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        name = uuid.uuid4().hex  # a name per attempt: files of failed attempts are never listed
        self.paths = [f"{folder}/{k}-{name}.arrow" for k in ("seq", "doc")]
        self.width, self.batch, self.kind = width, batch, kind
        self.sinks = [fs.open_output_stream(f"{base}/{k}-{name}.arrow") for k in ("seq", "doc")]
        self.seq = pa.ipc.new_file(self.sinks[0], _schema(width, kind))
        self.doc = pa.ipc.new_file(self.sinks[1], INDEX)
        self.rest: list[np.ndarray] = []
        self.held = self.n_ids = self.n_docs = 0

    def add(self, doc_id: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> None:
        start = pa.array(offsets[:-1] + self.n_ids)
        self.doc.write_batch(pa.record_batch([doc_id, start, pa.array(np.diff(offsets))], schema=INDEX))
        self.n_docs += len(doc_id)
        self.n_ids += len(ids)
        self.rest.append(ids.astype(self.kind.to_pandas_dtype()))
        self.held += len(ids)
        full = self.width * self.batch
        if self.held >= full:
            flat = np.concatenate(self.rest)
            for i in range(0, len(flat) - full + 1, full):
                self._write(flat[i : i + full], full)
            self.rest = [flat[len(flat) // full * full :]]
            self.held = len(self.rest[0])

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.width) for x in (flat, mask)]
        self.seq.write_batch(pa.record_batch(lists, schema=_schema(self.width, self.kind)))

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.rest)
            self._write(np.pad(flat, (0, -len(flat) % self.width)), len(flat))
        for x in (self.seq, self.doc, *self.sinks):
            x.close()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, *, end_id: int, width: int = 2048, batch: int = 64, wide: bool = False
) -> DataFrame:
    """Encode ``(doc_id, text)`` and write the ids in ascending ``doc_id`` order; returns the manifest.

    ``width`` is the sequence length, ``batch`` the sequences of a record batch; ids are
    16 bit unless ``wide``. The rows are range-partitioned by ``doc_id``, each partition
    streams its shard, and Spark's own commit of the manifest decides which files count,
    so a repeated or lost task leaves at most an unlisted file. A null text is empty, a
    null ``doc_id`` comes first, rows with one ``doc_id`` stay side by side in any order;
    an empty table gives an empty manifest. Other columns are ignored.
    """
    kind = pa.uint32() if wide else pa.uint16()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, enc = None, encoder(tokenizer)
        for b in batches:
            if b.num_rows == 0:
                continue
            shard = shard or _ShardWriter(folder, width, batch, kind)
            doc_id = b.column("doc_id").cast(pa.int64())
            for i, ids, offsets in enc.encode(b.column("text"), end_id):
                if len(ids) and not wide and int(ids.max()) > 0xFFFF:
                    raise ValueError("an id needs more than 16 bits: write with wide=True")
                shard.add(doc_id.slice(i, len(offsets) - 1), ids, offsets)
        if shard:
            shard.close()
            row = [*shard.paths, TaskContext.get().partitionId(), shard.n_docs, shard.n_ids, width, batch]
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            yield pa.record_batch([pa.array([x]) for x in row], names=names)

    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    path = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(path)
    # range partitions are numbered in key order: their numbers order the shards
    base = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    listed = docs.sparkSession.read.schema(MANIFEST).parquet(path)
    return listed.withColumn("base", F.coalesce(base, F.lit(0)))


def sequence(seq_file: str, k: int, batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence ``k`` of a shard, the ids without a copy."""
    fs, path = filesystem(seq_file)
    source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
    rows = pa.ipc.open_file(source).get_batch(k // batch)
    ids, mask = rows.column("ids")[k % batch].values, rows.column("mask")[k % batch].values
    return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)


def read_documents(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files of a manifest.

    ``start`` counts the ids of all documents before it; the checksum is over the ids as
    little-endian unsigned 32-bit integers. A shard is read batch by batch.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                yield from _read_shard(row)

    n = max(1, manifest.count())
    rows = manifest.repartition(n)
    return rows.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _read_shard(row: dict) -> Iterator[pa.RecordBatch]:
    fs, seq_path = filesystem(row["seq_file"])
    _, doc_path = filesystem(row["doc_file"])
    with fs.open_input_file(seq_path) as f, fs.open_input_file(doc_path) as g:
        seq, docs = pa.ipc.open_file(f), pa.ipc.open_file(g)
        size, at, ids = row["width"] * row["batch"], -1, None
        for k in range(docs.num_record_batches):
            index = docs.get_batch(k)
            start, count = index.column("start").to_numpy(), index.column("n_tokens").to_numpy()
            sums = []
            for s, n in zip(start.tolist(), count.tolist()):
                crc, end = 0, s + n
                while s < end:
                    if s // size != at:
                        at = s // size
                        ids = seq.get_batch(at).column("ids").values.to_numpy().astype("<u4")
                    part = ids[s - at * size : end - at * size]
                    crc = zlib.crc32(part, crc)
                    s += len(part)
                sums.append(crc)
            yield pa.record_batch(
                [index.column("doc_id"), pa.array(start + row["base"]), pa.array(count), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )
