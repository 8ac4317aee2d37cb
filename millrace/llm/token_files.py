"""Token files: ids packed at a fixed width, with block offsets.

A file, written by one task for one range of doc_ids:

    magic (8 bytes) | width, ids a block (two u4)
    blocks: ``block_ids`` ids each (the last may have fewer), ``width`` bits an id, most significant bit first, padded to a byte
    footer: doc_id (i8 each), doc_id is null (u1 each), first id of each document in this file (i8 each), offset of each block (u8 each)
    place of the footer, documents, blocks, ids (four u8) | magic

All integers are little-endian; width = bits of the largest id of the vocabulary. Since a block's
place is in the footer and an id's bits are at a fixed place in its block, any id range is read
with one seek and unpacked by numpy without a loop.

Files carry the attempt's unique name; the manifest, a table with a row for each file of a
finished task, says which count. A lost executor's files are simply not in it.

Defined results: null text is empty (its one id is the end id). Rows go in ascending doc_id
order, nulls first, equal doc_ids in the table's order. ``docs`` is read more than once and should be a table, so that its rows
come in the same order each time. Other columns are ignored. An empty table writes no file and reads back as no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from .common import cut, shared_dir, shuffle_partitions

MAGIC = b"MRTOKEN1"
BLOCK_IDS = 4096
READ_IDS = 1 << 20
#: Text in a file, at most about this; the footer of a file is held while it is written or read.
FILE_BYTES = 512 << 20


def pack(ids: np.ndarray, width: int) -> bytes:
    if width == 16:
        return ids.astype(">u2").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]
    return np.packbits(bits.reshape(-1)).tobytes()


def unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    if width == 16:
        return np.frombuffer(raw, ">u2", n).astype("<u4")
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * width).reshape(n, width)
    whole = np.zeros((n, 32), np.uint8)
    whole[:, 32 - width :] = bits
    return np.packbits(whole, axis=1).view(">u4").reshape(-1).astype("<u4")


class Writer:
    def __init__(self, sink, width: int, block_ids: int = BLOCK_IDS):
        self.sink, self.width, self.block_ids = sink, width, block_ids
        self.docs, self.nulls, self.starts, self.blocks = [], [], [], []
        self.count, self.ids, self.waiting, self.n_waiting = 0, 0, [], 0
        self.sink.write(MAGIC + struct.pack("<II", width, block_ids))
        self.at = len(MAGIC) + 8

    def add(self, doc_ids: pa.Array, ids: np.ndarray, edges: np.ndarray) -> None:
        """Documents with all their ids, one after another, and the edges of each one's."""
        self.docs.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.nulls.append(doc_ids.is_null().to_numpy(zero_copy_only=False).astype("u1"))
        self.starts.append((self.ids + edges[:-1]).astype("<i8"))
        self.count += len(doc_ids)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= 64 * self.block_ids:
            self._flush(self.n_waiting // self.block_ids)

    def _flush(self, blocks: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        for k in range(blocks):
            raw = pack(ids[k * self.block_ids : (k + 1) * self.block_ids], self.width)
            self.blocks.append(self.at)
            self.sink.write(raw)
            self.at += len(raw)
        rest = ids[blocks * self.block_ids :]
        self.waiting, self.n_waiting = ([rest] if len(rest) else []), len(rest)

    def close(self) -> None:
        self._flush(-(-self.n_waiting // self.block_ids))
        foot = b"".join(x.tobytes() for x in (*self.docs, *self.nulls, *self.starts)) + np.array(self.blocks, "<u8").tobytes()
        self.sink.write(foot + struct.pack("<QQQQ", self.at, self.count, len(self.blocks), self.ids) + MAGIC)
        self.sink.close()


class Reader:
    def __init__(self, source):
        self.source = source
        size = source.size()
        head, tail = source.read_at(16, 0), source.read_at(40, size - 40)
        if head[:8] != MAGIC or tail[-8:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        self.width, self.block_ids = struct.unpack("<II", head[8:])
        self.end, docs, blocks, self.ids = struct.unpack("<QQQQ", tail[:32])
        foot = source.read_at(size - 40 - self.end, self.end)
        self.docs = np.frombuffer(foot, "<i8", docs)
        self.nulls = np.frombuffer(foot, "u1", docs, 8 * docs).astype(bool)
        self.starts = np.frombuffer(foot, "<i8", docs, 9 * docs)
        self.blocks = np.append(np.frombuffer(foot, "<u8", blocks, 17 * docs), np.uint64(self.end)).astype(np.int64)

    def range(self, start: int, stop: int) -> np.ndarray:
        """The ids at start .. stop-1 of the file."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        raw = self.source.read_at(int(self.blocks[last + 1] - self.blocks[first]), int(self.blocks[first]))
        edges, have = self.blocks[first : last + 2] - self.blocks[first], min(self.ids, (last + 1) * self.block_ids) - first * self.block_ids
        if self.block_ids * self.width % 8 == 0:
            ids = unpack(raw, have, self.width)
        else:
            ids = np.concatenate([unpack(raw[edges[k] : edges[k + 1]], min(self.block_ids, have - k * self.block_ids), self.width) for k in range(last - first + 1)])
        return ids[start - first * self.block_ids : stop - first * self.block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, first id's place and ids of each document; reads at least a document, and about READ_IDS ids, at a time."""
        stops = np.append(self.starts[1:], self.ids)
        k = 0
        while k < len(self.docs):
            upto = max(k + 1, int(np.searchsorted(stops, self.starts[k] + READ_IDS, "right")))
            base = int(self.starts[k])
            ids = self.range(base, int(stops[upto - 1]))
            for j in range(k, upto):
                a, b = int(self.starts[j]), int(stops[j])
                yield None if self.nulls[j] else int(self.docs[j]), a, ids[a - base : b - base]
            k = upto


def _open(path: str):
    return pa.fs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str, tokenizer_path: str, block_ids: int = BLOCK_IDS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the files below ``folder`` (a URI that all executors reach) and return the manifest: part, path, docs, ids, start."""

    def write_part(batches):
        from pyspark import TaskContext

        encoder = bpe.encoder(tokenizer_path)
        width = max(1, (encoder.vocabulary - 1).bit_length())
        writer, path, part = None, None, TaskContext.get().partitionId()
        for batch in batches:
            for k, ids, edges in encoder.runs(batch.column(1)):
                if writer is None:
                    path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok"
                    fs, at = _open(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    writer = Writer(fs.open_output_stream(at), width, block_ids)
                writer.add(batch.column(0).slice(k, len(edges) - 1), ids, edges)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [path], "docs": [writer.count], "ids": [writer.ids]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    files = max(shuffle_partitions(docs.sparkSession), -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // file_bytes))
    # The row's own number parts rows that are equal, or have no doc_id, however many they are.
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(files, "doc_id", "row").sortWithinPartitions("doc_id", "row")
    manifest = cut(rows.select("doc_id", "text").mapInArrow(write_part, "part int, path string, docs long, ids long"), "manifest")
    # A row for each file; their running sum is small.
    return manifest.withColumn("start", F.sum("ids").over(Window.orderBy("part")) - F.col("ids"))


def read_back(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, from the files alone."""

    def read_part(batches):
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = _open(path)
                with fs.open_input_file(at) as source:
                    rows = []
                    for doc_id, start, ids in Reader(source).documents():
                        rows.append((doc_id, first + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    files = manifest.select("path", "start").repartition(shuffle_partitions(spark), "path")
    return files.mapInArrow(read_part, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame, tokenizer_path: str | None = None, folder: str | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens"
    return read_back(spark, write(docs, folder, tokenizer_path or bpe.default_path(), block_ids))
