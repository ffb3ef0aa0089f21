"""Token ids as Arrow files of equal-length sequences.

Each shard is one Arrow IPC file: record batches of up to BATCH rows with two
fixed-size-list columns, `ids` and `mask` (false: padding at the shard's end).
Sequence s is row s % BATCH of batch s // BATCH, so a memory-mapped shard gives any
sequence without copying. Ids take 16 bits where the vocabulary allows. An index
table says where each document begins.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.chunks import file_encoder

BATCH = 256
INDEX = "doc_id long, shard int, at long, n_tokens long, path string"


def _schema(length: int, wide: bool) -> pa.Schema:
    kind = pa.uint32() if wide else pa.uint16()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Collects ids and writes a batch whenever one is full; the file gets its name once it is whole."""

    def __init__(self, folder: str, shard: int, length: int, wide: bool):
        from pyarrow import fs

        self.fs, base = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(base)
        self.path = f"{base}/shard-{shard:06d}.arrow"
        self.part = f"{base}/_{shard:06d}-{uuid.uuid4().hex}"
        self.schema, self.length, self.size = _schema(length, wide), length, 0
        self.type = np.uint32 if wide else np.uint16
        self.sink = self.fs.open_output_stream(self.part)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.held_size = 0

    def add(self, ids: np.ndarray) -> int:
        """Place of the first id in the shard."""
        at = self.size
        self.held.append(ids.astype(self.type))
        self.size += len(ids)
        self.held_size += len(ids)
        if self.held_size >= BATCH * self.length:
            self._flush(False)
        return at

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, self.type)
        step = BATCH * self.length
        while len(ids) >= step or last and len(ids):
            taken, ids = ids[:step], ids[step:]
            padded = -(-len(taken) // self.length) * self.length
            mask = np.arange(padded) < len(taken)
            taken = np.concatenate([taken, np.zeros(padded - len(taken), self.type)])
            arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (taken, mask)]
            self.file.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
        self.held, self.held_size = [ids], len(ids)

    def close(self) -> str:
        self._flush(True)
        self.file.close()
        self.sink.close()
        self.fs.move(self.part, self.path)
        return self.path


class ShardReader:
    """Ids by place in a shard; only the batches that hold them are touched."""

    def __init__(self, folder: str, path: str):
        from pyarrow import fs

        files, _ = fs.FileSystem.from_uri(folder)
        local = isinstance(files, fs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(path) if local else files.open_input_file(path))
        self.length = self.file.schema.field("ids").type.list_size
        self.batch, self.ids = -1, np.empty(0)

    def sequence(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        batch, row = self.file.get_batch(s // BATCH), s % BATCH
        ids, mask = (c.flatten()[row * self.length : (row + 1) * self.length] for c in batch.columns)
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def ids_at(self, at: int, n: int) -> np.ndarray:
        step, parts = BATCH * self.length, []
        while n:
            k, inside = divmod(at, step)
            if k != self.batch:
                self.batch, self.ids = k, self.file.get_batch(k).column(0).flatten().to_numpy()
            parts.append(self.ids[inside : inside + n])
            at, n = at + len(parts[-1]), n - len(parts[-1])
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = 2048, wide: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Writes the shards in ascending id order and returns the index (lazily: evaluating it writes the files).

    Documents are range-partitioned and sorted by id (nulls first; equal ids by text); each partition is a
    shard. A null or empty text is the end id alone. A task that runs twice replaces its own shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard, writer = file_encoder(tokenizer), TaskContext.get().partitionId(), None
        index: list[tuple] = []
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                writer = writer or ShardWriter(folder, shard, length, wide)
                index.append((key, writer.add(np.append(ids, end_id)), len(ids) + 1))
        if writer:
            path = writer.close()
            keys, at, sizes = zip(*index, strict=True)
            arrays = [pa.array(keys, pa.int64()), pa.array([shard] * len(keys), pa.int32()), pa.array(at, pa.int64())]
            arrays += [pa.array(sizes, pa.int64()), pa.array([path] * len(keys))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "shard", "at", "n_tokens", "path"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, INDEX)


def read(index: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start among the ids of all documents, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, reader = None, None
        for batch in batches:
            at, sizes = batch.column("at").to_pylist(), batch.column("n_tokens").to_pylist()
            crcs = []
            for p, a, n in zip(batch.column("path").to_pylist(), at, sizes, strict=True):
                if p != path:
                    path, reader = p, ShardReader(folder, p)
                crcs.append(zlib.crc32(reader.ids_at(a, n).astype("<u4").tobytes()))
            arrays = [batch.column(c) for c in ("doc_id", "shard", "at", "n_tokens")] + [pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "shard", "at", "n_tokens", "ids_crc32"])

    found = index.mapInArrow(run, "doc_id long, shard int, at long, n_tokens long, ids_crc32 long")
    # One row per shard file goes through the window.
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return found.join(bases, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
