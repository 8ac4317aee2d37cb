"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints of 64 bits are linked when two bits or fewer differ. They are split into three
segments of 22, 21 and 21 bits. With two wrong bits at most, some ordered pair of segments (a, b) has none in a
and one at most in b (pigeonhole). Each b is decoded by the perfect Golay code (23, 12): every vector has
exactly one codeword within three bits, and one that is three bits from it has five more at four bits. So if two b
differ in one bit, the nearest codeword of one is among the six of the other. A fingerprint is stored under
(a, b, a's bits, b's nearest codeword) and looked up under all of b's codewords: 6 stored keys of 34 bits
and at most 36 lookups, whatever the corpus.

Equal fingerprints are merged before keys are made. A key that is looked up by two fingerprints or more and stored by one makes
all of them candidates. Pairs are not made inside a key, so that a family of near copies costs no more than its size: candidates meet at
values one bit away. Each emits itself and its 64 one-bit neighbours; two fingerprints are within two bits just when they share such a value, at most 65
share one, and each that meets another there is verified by its distance from the smallest and linked to it. This is the same for keys of every size.

Defined results: a text without words (null, empty) has fingerprint zero and is linked like any other;
with fewer words than a shingle the whole sequence is the only shingle. Component ids are the smallest non-null doc_id; a component with
null doc_ids only has a null id. Repeated rows link like copies. Very long texts are hashed a bounded number of shingles at a time. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER_TABLE, cut
from .components import components

SHINGLE = 3
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(LOWER_TABLE).split()  # bytes.split() parts at \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    starts, stops = starts[:n].tolist(), stops[-n:].tolist()
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 15):
        parts = map(joined.__getitem__, map(slice, starts[k : k + (1 << 15)], stops[k : k + (1 << 15)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a signed long)."""

    def each(batches):
        for batch in batches:
            got = np.fromiter((fingerprint(x or b"", shingle) for x in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(each, "doc_id long, fp long")


class Golay:
    """The perfect binary Golay code (23, 12), from its generator polynomial."""

    def __init__(self):
        self.of_bit = []
        for i in range(23):
            x = 1 << i
            for k in range(22, 10, -1):
                if x >> k & 1:
                    x ^= GENERATOR << (k - 11)
            self.of_bit.append(x)
        #: By syndrome: the error of three bits at most, and, where it has three, those of four bits.
        self.nearest = np.zeros(2048, np.int64)
        self.further = np.full((2048, 5), -1, np.int64)
        found = np.zeros(2048, np.int64)
        for weight in range(5):
            for places in combinations(range(23), weight):
                s = 0
                for i in places:
                    s ^= self.of_bit[i]
                error = sum(1 << i for i in places)
                if weight <= 3:
                    self.nearest[s] = error
                elif bin(self.nearest[s]).count("1") == 3:
                    self.further[s, found[s]] = error
                    found[s] += 1

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        s = np.zeros_like(v)
        for i, x in enumerate(self.of_bit):
            s ^= (v >> i & 1) * x
        return s

    def codewords(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the nearest codeword, and (n, 5) of those at four bits, -1 where there is none."""
        s = self.syndrome(v)
        more = self.further[s]
        return (v ^ self.nearest[s]) >> 11, np.where(more < 0, -1, (v[:, None] ^ more) >> 11)


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys that fingerprints look up, the fingerprints they belong to, and whether they are stored under them."""
    code, bits = golay(), fps.view(np.uint64)
    parts = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    words = [code.codewords(x) for x in parts]
    keys, owners, stored = [], [], []
    for a in range(3):
        for b in range(3):
            if a != b:
                base = ((3 * a + b) << 22 | parts[a]) << 12
                near, more = words[b]
                row, column = np.nonzero(more >= 0)
                keys += [base | near, base[row] | more[row, column]]
                owners += [fps, fps[row]]
                stored += [np.ones(len(fps), bool), np.zeros(len(row), bool)]
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(stored)


def candidates(fps: DataFrame) -> DataFrame:
    """fp: the fingerprints that share a key which one of them is stored under."""

    def each(batches):
        for batch in batches:
            keys, owners, stored = keys_of(batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners), pa.array(stored)], ["key", "fp", "stored"])

    keyed = fps.select("fp").mapInArrow(each, "key long, fp long, stored boolean")
    shared = keyed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.max("stored").alias("stored"))
    shared = shared.where("low < high AND stored").select("key")
    return keyed.select("key", "fp").join(shared, "key", "left_semi").select("fp").distinct()


def links(fps: DataFrame) -> DataFrame:
    """u, v: distinct fingerprints within two bits, enough of them to connect what all such pairs would."""
    flips = F.expr("transform(sequence(0, 64), i -> IF(i = 64, fp, fp ^ shiftleft(1L, i)))")
    met = candidates(fps).select("fp", F.explode(flips).alias("value"))
    met = met.withColumn("v", F.min("fp").over(Window.partitionBy("value")))  # at most 65 rows a value
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))).between(1, 2)).select(F.col("fp").alias("u"), "v").distinct()


def assign(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint, component_id: a row for each document."""
    made = cut(fingerprints(docs, shingle), "fingerprints")
    own = cut(made.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    nodes = components(links(own))
    joined = nodes.join(own, F.col("node") == F.col("fp"))
    smallest = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    found = nodes.join(smallest, "label").select(F.col("node").alias("fp"), "component_id", F.lit(True).alias("linked"))
    by_fp = own.join(found, "fp", "left").select("fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"))
    # Written, so that the last join shuffles both its sides and adaptive execution can split a fingerprint that very many documents share.
    return made.join(cut(by_fp, "components"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
