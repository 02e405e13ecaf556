"""Token ids in Arrow files of equal-length sequences, written and read by Spark tasks.

A file holds record batches of three fixed-size lists per row: ``ids`` (16 bits, or 32 for larger
vocabularies), ``mask`` (whether a place holds an id) and ``ends`` (whether it closes a document), and
``doc_ids``, the documents that end in the row. All rows but a file's last are full, so row i of a
memory-mapped file is found by arithmetic and read without copying.

Documents are dealt to tasks by ranges of doc_id and, of one doc_id or none, of a hash of the text; each task writes one file under a name of its own, and only
the names that finished tasks return count, so a task may be run again. Where each file's ids begin follows
from the counts of the files, one row each.

Defined cases: null or empty texts are one closing id; a missing doc_id comes first; rows that share a doc_id
stand in the order of a hash of their texts; other columns do no harm; empty tables give no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import filesystem
from ..sources.scratch import new_folder
from . import tokens
from .repeats import staged

LENGTH, END_ID, ROWS = 2048, 2, 64

_FILES = "task int, name string, documents long, ids long"
_RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    lists = [pa.field(n, pa.list_(pa.field("item", t, nullable=False), length)) for n, t in (("ids", kind), ("mask", pa.bool_()), ("ends", pa.bool_()))]
    return pa.schema([*lists, pa.field("doc_ids", pa.list_(pa.int64()))])


class _Writer:
    """Turns a stream of documents into full rows; the last row is padded."""

    def __init__(self, sink, length: int, kind: pa.DataType):
        self.schema, self.length, self.kind = _schema(length, kind), length, kind
        self.file = pa.ipc.new_file(sink, self.schema)
        self.ids, self.ends, self.docs, self.held = [], [], [], 0
        self.documents = self.written = 0

    def add(self, ids: np.ndarray, at: np.ndarray, doc_ids: list) -> None:
        ends = np.zeros(len(ids), bool)
        ends[at[1:] - 1] = True
        self.ids.append(ids)
        self.ends.append(ends)
        self.docs += doc_ids
        self.held += len(ids)
        self.documents += len(doc_ids)
        self.written += len(ids)
        if self.held >= ROWS * self.length:
            self._flush(self.held // self.length)

    def _flush(self, rows: int, pad: int = 0) -> None:
        ids, ends = np.concatenate(self.ids), np.concatenate(self.ends)
        size = rows * self.length - pad
        self.ids, self.ends, self.held = [ids[size:]], [ends[size:]], len(ids) - size
        for low in range(0, rows, ROWS):
            part = slice(low * self.length, min((low + ROWS) * self.length, size))
            n = min(ROWS, rows - low)
            self._write(n, ids[part], ends[part])

    def _write(self, rows: int, ids: np.ndarray, ends: np.ndarray) -> None:
        room = rows * self.length
        whole = [np.zeros(room, self.kind.to_pandas_dtype()), np.zeros(room, bool), np.zeros(room, bool)]
        whole[0][: len(ids)], whole[1][: len(ids)], whole[2][: len(ids)] = ids, True, ends
        closed = whole[2].reshape(rows, self.length).sum(axis=1)
        offsets = np.append(0, np.cumsum(closed))
        doc_ids, self.docs = self.docs[: offsets[-1]], self.docs[offsets[-1] :]
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type) for v, f in zip(whole, self.schema, strict=False)]
        named = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(doc_ids, pa.int64()))
        self.file.write_batch(pa.RecordBatch.from_arrays([*lists, named], schema=self.schema))

    def close(self) -> None:
        if self.held:
            rows = -(-self.held // self.length)
            self._flush(rows, rows * self.length - self.held)
        self.file.close()


def write_ids(docs: DataFrame, folder: str, length: int = LENGTH, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write all ids below ``folder``, which all executors reach; gives the list of files."""
    path = path or tokens.default_path()
    kind = pa.uint16() if tokens._tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else pa.uint32()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = sink = None
        name = f"ids-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            for row, ids, at in tokens.encoded(batch["text"], path, end_id):
                if writer is None:
                    task = batch["task"][0].as_py()
                    store, root, _ = filesystem(folder)
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(f"{root}/{name}")
                    writer = _Writer(sink, length, kind)
                writer.add(ids, at, batch["doc_id"].slice(row, len(at) - 1).to_pylist())
        if writer is not None:
            writer.close()
            sink.close()
            columns = ([task], [name], [writer.documents], [writer.written])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["task", "name", "documents", "ids"])

    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id", F.xxhash64("text"))
    ranged = ranged.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return staged(ranged.withColumn("task", F.spark_partition_id()).mapInArrow(write, _FILES), "files")


def sequences(folder: str, name: str, memory_map: bool = True) -> pa.ipc.RecordBatchFileReader:
    """Random access to the batches of one file; a local file is mapped, not read."""
    store, root, _ = filesystem(folder)
    place = f"{root}/{name}"
    return pa.ipc.open_file(pa.memory_map(place) if memory_map and isinstance(store, fs.LocalFileSystem) else store.open_input_file(place))


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """Per document of the written files: doc_id, start, n_tokens, ids_crc32."""
    listed = sorted(files.select("task", "name", "ids").collect())  # one row per file
    begin = dict(zip((r["name"] for r in listed), np.cumsum([0, *(r["ids"] for r in listed)]).tolist(), strict=False))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["name"].to_pylist():
                yield from _documents(sequences(folder, name), begin[name])

    many = max(1, len(listed))
    return files.select("name").repartition(many, "name").mapInArrow(read, _RESULT)


def _documents(file: pa.ipc.RecordBatchFileReader, start: int) -> Iterator[pa.RecordBatch]:
    crc = size = 0
    for i in range(file.num_record_batches):
        batch = file.get_batch(i)
        ids, mask, ends = (batch[c].values.to_numpy(zero_copy_only=False) for c in ("ids", "mask", "ends"))
        used = int(mask.sum())
        little, stops = ids[:used].astype("<u4"), np.flatnonzero(ends[:used]) + 1
        rows, low = [], 0
        for stop, doc_id in zip(stops.tolist(), batch["doc_ids"].flatten().to_pylist(), strict=True):
            size += stop - low
            rows.append((doc_id, start, size, zlib.crc32(little[low:stop].tobytes(), crc)))
            start, crc, size, low = start + size, 0, 0, stop
        crc, size = zlib.crc32(little[low:].tobytes(), crc), size + used - low
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def arrow_ids(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, path: str | None = None, folder: str | None = None) -> DataFrame:
    """Write the ids of all documents and give what the files hold, per document."""
    folder = folder or new_folder(docs.sparkSession, "llm-arrow-ids")
    return read_ids(write_ids(docs, folder, length, end_id, path), folder)
