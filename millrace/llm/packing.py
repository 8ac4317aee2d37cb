"""Best-fit packing of token pieces into sequences, by exact complements.

A plan for packing depends only on how many pieces have each length, and there are at most
``capacity`` lengths. So the driver gets that histogram (2048 counts at most, whatever the
corpus), makes the plan, and Spark gives each piece its place:

1. Documents are tokenised and cut; the pieces are written once to the shared folder.
2. Plan: from the longest length down, the gap that a piece leaves is looked up among the single
   lengths, the sums of pairs, then the sums of triples that are still available; a combination
   that fills the gap exactly is used as often as its counts allow. Every use exhausts a length, so the
   plan has a few patterns for each length at most. What has no exact complement is packed best-fit: longest
   first, then the longest that still fits, again and again.
3. Pieces of a length are numbered: in hash buckets, so that a length which a third of all pieces
   share is numbered by many tasks, with the bucket's offset added. A piece's number gives its
   pattern and place by binary search in the plan.

Defined results: null text is empty and packs as the end id alone. Only documents longer than the
capacity are cut; their first piece takes the remainder. Repeated doc_ids, ties and identical rows are
all packed, each in its own place; which piece of a length gets which place follows the order of the written pieces.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import cut

CAPACITY = 2048
PIECES_A_BUCKET = 1_000_000


def cut_up(edges: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each piece of documents with these edges: the document's number, the piece's, its start in the document and its length. A first piece takes the remainder."""
    sizes = np.diff(edges)
    count = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = (sizes - (count - 1) * capacity)[doc]
    return doc, piece, np.where(piece == 0, 0, first + (piece - 1) * capacity), np.where(piece == 0, first, capacity)


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, memo_parts: int = bpe.MEMO_PARTS, chunk_bytes: int = bpe.CHUNK_BYTES, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, ``with_ids``, ids (little-endian unsigned 32-bit): the tokenised documents, each with the end id, cut to the capacity."""
    tokenizer_path = tokenizer_path or bpe.default_path()

    def each(batches):
        encoder = bpe.encoder(tokenizer_path, memo_parts, chunk_bytes)
        for batch in batches:
            doc_ids = batch.column(0)
            for k, ids, edges in encoder.runs(batch.column(1)):
                doc, piece, start, length = cut_up(edges, capacity)
                at = 4 * (edges[doc] + start)
                raw = memoryview(ids).cast("B")
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                columns = {"doc_id": doc_ids.take(pa.array(doc + k)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crcs, pa.int64())}
                if with_ids:
                    offsets = np.append(at, len(raw)).astype(np.int32)
                    columns["ids"] = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(each, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def find_complement(gap: int, left: np.ndarray, pair_sums: np.ndarray) -> tuple[int, ...] | None:
    """Available lengths (with their counts in ``left``) that sum to the gap: one, else two, else three; the longest first. pair_sums: true where two available lengths may have that sum."""

    def pair(total: int, most: int) -> tuple[int, int] | None:
        a = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        ok = (left[a] > 0) & (left[total - a] > 0) & ((2 * a != total) | (left[a] > 1))
        k = int(ok.argmax()) if len(a) else 0
        return (int(a[k]), int(total - a[k])) if len(a) and ok[k] else None

    if gap > 0 and left[gap] > 0:
        return (gap,)
    if gap > 1 and pair_sums[gap] and (found := pair(gap, gap)):
        return found
    if gap > 2:
        a = np.arange(gap - 2, (gap - 1) // 3, -1)
        for x in a[(left[a] > 0) & pair_sums[gap - a]].tolist():
            left[x] -= 1
            found = pair(gap - x, x)
            left[x] += 1
            if found:
                return (x, *found)
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with the number of sequences of each; uses every piece once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...]) -> None:
        times = min(int(left[x]) // k for x, k in Counter(pattern).items())
        for x in pattern:
            left[x] -= times
        patterns.append((pattern, times))

    def sums() -> np.ndarray:
        there = (left > 0).astype(np.float64)
        size = 1 << (2 * capacity + 1).bit_length()
        return np.fft.irfft(np.fft.rfft(there, size) ** 2, size)[: capacity + 1] > 0.5

    pair_sums, known = sums(), left > 0
    for length in range(capacity, 0, -1):
        while left[length]:
            if length == capacity:
                use((length,))
                continue
            left[length] -= 1
            if not np.array_equal(known, left > 0):
                pair_sums, known = sums(), left > 0
            found = find_complement(capacity - length, left, pair_sums)
            left[length] += 1
            if not found:
                break
            use((length, *found))
    for length in range(capacity, 0, -1):
        while left[length]:
            pattern, gap = [length], capacity - length
            left[length] -= 1
            while gap and len(fits := np.flatnonzero(left[1 : gap + 1])):
                pattern.append(int(fits[-1]) + 1)
                left[pattern[-1]] -= 1
                gap -= pattern[-1]
            for x in pattern:
                left[x] += 1
            use(tuple(pattern))
    return patterns


def places(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank), and for each the first rank, first sequence and offset."""
    used, rows, sequence = Counter(), [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length << 44 | used[length], used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack(slim: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``slim`` (length and others; read more than once, so a written table) with sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in slim.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    keys, ranks, sequences, offsets = places(plan(histogram, capacity))
    buckets = max(64, -(-sum(histogram.values()) // PIECES_A_BUCKET))
    # The row's own number parts rows that are equal, or have no doc_id, however many they are.
    rows = slim.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets).cast("long")).cast("int"))
    before = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = before.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row"))
    rows = rows.withColumn("_inside", inside - 1).join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_inside"))
    rows = rows.select(*slim.columns, "_rank")

    def place(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            length, rank = table["length"].to_numpy(), table["_rank"].to_numpy()
            at = np.searchsorted(keys, length << 44 | rank, "right") - 1
            table = table.drop_columns(["_rank"]).append_column("sequence_id", pa.array(sequences[at] + rank - ranks[at])).append_column("offset", pa.array(offsets[at]))
            yield from table.to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema) + ", sequence_id long, offset long"
    return rows.mapInArrow(place, schema)


def run(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, memo_parts: int = bpe.MEMO_PARTS, chunk_bytes: int = bpe.CHUNK_BYTES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut(pieces(docs, tokenizer_path, capacity, memo_parts, chunk_bytes, with_ids=False), "pieces"), capacity)


def sequences(made: DataFrame, packed: DataFrame) -> DataFrame:
    """sequence_id, ids (array): the packed sequences themselves. made: ``pieces``; each (doc_id, start) must be unique."""
    found = made.join(packed.select("doc_id", "start", "sequence_id", "offset"), ["doc_id", "start"])
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))  # a sequence's pieces: at most ``capacity`` ids
    return found.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))
