"""Near copies by similarity: SimHash with Golay keys and MinHash bands find candidates, five-word Jaccard similarity decides.

A changed word changes five shingles, but one distinct word. So ``TABLES`` SimHash fingerprints, of 64 bits each and with their own seed, are taken over a text's distinct
words, where copies with single words changed differ in few bits. A fingerprint has three segments. For each of them a key is made of all its bits and a Golay
codeword near the segment after it (the first follows the last), for each of the (one or six) codewords that ``simhash.Golay`` decodes that to; two segments that
differ in two bits always share one of these codewords, and about six in ten of those that differ in three or four. In a first round each node goes to the fullest of a fingerprint's keys, and
what differs from one of the key's pivots in ``BITS`` bits or fewer of the key's fingerprint is confirmed on the full sets and linked. Of the test's pairs and those of sf0.1 that are similar and share such a key none
differs in more; such a pair, and one that shares another key only, is not dropped, but met in the later rounds, which take all keys.

A block of words that is put in, cut or moved changes as many distinct words as it has, but few shingles. So the bands of ``minhash`` are keys as well: texts of a similarity of 0.8
share one with a probability of 0.9996, whatever the edit is.

Texts with equal sets of shingles are one node. The nodes of a key meet and are confirmed on the full sets by the rounds of ``minhash.groups``: every pair that shares a key
is met, unless it is joined up before, and no pairs are made inside a key. Components of links are groups.

Defined results: words are runs without white space, with A-Z in lower case; with fewer than five words the whole sequence is the only shingle, and texts
without words (null, empty) are copies of each other. Of each group the row with the smallest doc_id stays, nulls last; of repeated
rows the first. All columns are kept. An empty table gives an empty result. Very long texts cost time in proportion.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from . import minhash
from .common import LOWER_TABLE, cut
from .simhash import SEGMENTS, golay

PERCENT = 80
TABLES = 2
#: Bits in which a pair's fingerprints may differ in the first round.
BITS = 9
#: Rows of a batch that a task works on at once.
SLICE = 1000


def fingerprints(text: bytes, tables: int = TABLES) -> np.ndarray:
    """One fingerprint a table, over the distinct words; zero without words."""
    own = set(text.translate(LOWER_TABLE).split())
    base = np.fromiter(map(xxhash.xxh64_intdigest, own), np.uint64, len(own))
    found = np.zeros(tables, np.uint64)
    for k in range(tables):
        h = base + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift in (30, 27):
            h = (h ^ h >> np.uint64(shift)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        found[k] = np.packbits(2 * bits > len(own), bitorder="little").view("<u8")[0]
    return found


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints (rows: nodes, columns: tables), and the row that each is of."""
    code, keys, owners = golay(), [], []
    rows = np.arange(len(fps))
    for table in range(fps.shape[1]):
        parts = [(fps[:, table] >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
        for a in range(3):
            near, more = code.codewords(parts[(a + 1) % 3])
            words = np.concatenate([near[:, None], more], axis=1)
            at, column = np.nonzero(words >= 0)
            keys.append((((3 * table + a) << 22 | parts[a][at]) << 12) | words[at, column])
            owners.append(rows[at])
    return np.concatenate(keys), np.concatenate(owners)


def _numbered(docs: DataFrame, tables: int) -> DataFrame:
    """_row (the whole row), id, digest, sketch, fps, keys: written, so that a row's number is fixed. Texts without words have an empty digest."""
    place = [c.lower() for c in docs.columns].index("text")
    added = ["digest", "sketch", "fps", "keys"]

    def each(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                some = batch.slice(k, SLICE)
                texts = [(t or "").encode() for t in pc.cast(pc.struct_field(some.column("_row"), [place]), pa.string()).to_pylist()]
                _, digest, sketch, bands = minhash.describe(texts)
                fps = np.array([fingerprints(t, tables) for t in texts], np.uint64).reshape(-1, tables)
                keys, owners = keys_of(fps)
                keys = np.concatenate([bands.values.to_numpy(), keys])  # bands first
                owners = np.concatenate([np.repeat(np.arange(len(texts)), minhash.BANDS), owners])
                edges = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(texts)))])
                keys = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(keys[np.argsort(owners, kind="stable")]))
                yield pa.RecordBatch.from_arrays([*some.columns, digest.fill_null(b""), sketch, minhash.lists(fps.view(np.int64).reshape(-1), tables), keys], [*some.schema.names, *added])
        pa.default_memory_pool().release_unused()  # the worker lives on beside later stages

    rows = docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("id"))
    longs = ArrayType(LongType())
    fields = [StructField(n, BinaryType() if n == "digest" else longs) for n in added]
    return cut(rows.mapInArrow(each, StructType([*rows.schema.fields, *fields])), "numbered")


def prints(described: DataFrame) -> DataFrame:
    """id, key, fp: the Golay keys, which follow the bands, each with the fingerprint that it is of."""
    keyed = described.select("id", "fps", F.explode(F.slice("keys", minhash.BANDS + 1, F.size("keys") - minhash.BANDS)).alias("key"))
    return keyed.select("id", "key", F.expr("fps[int(shiftright(key, 34) div 3)]").alias("fp"))


def keep(docs: DataFrame, tables: int = TABLES, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, one of each group, with all their columns."""
    rows = _numbered(docs, tables)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")
    own = rows.select("id", "digest", F.col("_row.doc_id").cast("long").alias("doc_id"))
    nodes = cut(own.groupBy("digest").agg(F.min("id").alias("id"), F.min(order).alias("best")), "nodes")
    worded = nodes.where(F.octet_length("digest") > 0).select("id")
    texts = rows.select("id", F.coalesce(F.col("_row.text").cast("string"), F.lit("")).cast("binary").alias("text"))
    described = cut(rows.select("id", "sketch", "fps", "keys").join(worded, "id", "left_semi"), "described")
    groups = minhash.groups(described.drop("fps"), lambda ids: texts.join(ids, "id", "left_semi"), percent, prints=prints(described), bits=BITS)
    if groups is not None:
        nodes = nodes.join(groups.select(F.col("node").alias("id"), "label"), "id", "left")
        nodes = nodes.groupBy(F.coalesce("label", "id").alias("label")).agg(F.min("best").alias("best"))
    gone = cut(own.select("id").join(nodes.select(F.col("best.id").alias("id")), "id", "left_anti"), "gone")
    return rows.join(gone, "id", "left_anti").select("_row.*")
