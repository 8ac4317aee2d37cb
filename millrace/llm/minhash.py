"""MinHash near-dedup: universal hash minima, banding, signature verification, exact confirmation, star components.

1. A text's set is its distinct five-word shingles, as 64-bit hashes. Texts with equal sets are one node; only nodes go on.
2. ``MINIMA`` strongly universal hashes (a * x + b over 64 bits, upper half, x of 32 bits) each give their minimum over the set. ``ROWS`` minima
   make a band, and a band's hash is a key. Two sets of similarity s share one of the ``BANDS`` keys with probability 1 - (1 - s^5)^20:
   0.999992 at 0.85, 0.9996 at 0.8.
3. The lowest bit of every minimum makes a sketch of two longs. Equal minima agree in it, others half the time. So sets of similarity s differ in
   (1 - s) / 2 of the bits, and a pair that differs in 5.5 standard deviations more than the limit would is left out; of pairs at the limit less than one in a million is.
4. What is left is confirmed on the full sets: 100 * intersection >= percent * union, in integers.
5. Confirmed pairs are links, and their components come from alternating large-star and small-star steps.

The pairs of a key are not made by a join. Of each key's nodes that with the most and that with the least company are its pivots, and first only these meet the others, and only nodes that have
another label:

0. Where a caller has keys of fingerprints (``near_copies``), each node goes to the fullest key of each fingerprint, and the key's pivots meet the nodes whose fingerprints are near enough.
1. The pivots of ``FIRST`` bands meet the nodes of their keys. That settles most families of near copies: links are joined up, and a node gets its component as label.
2. In all bands, in keys whose nodes have several labels, whole labels meet by their heaviest nodes, as long as that links any.
3. In the keys that are still open all nodes meet that have different labels, on their full sets: in pairs of blocks of bounded size, where a node's intersections with all
   others are counted at once, and no more links are given out than join the labels up.

So every pair that shares a key is met, or joined up before; nothing is capped.

A pair is confirmed where its two texts meet. They are fetched from the documents for each of the three steps. Joins that carry texts are shuffled on
both sides, so that a pivot that very many meet can be split.

Defined results: a text with fewer than five words has its whole word sequence as its only shingle; one without words (or null) has an empty set, is linked with
nothing, and is its own component. Component ids are the smallest non-null doc_id, null where all are null; ``kept`` is false for a null doc_id. Repeated rows are
one node and have the same result. Very long texts are hashed a bounded number of shingles at a time. Other columns, whatever their names, are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, cut
from .components import components

SHINGLE = 5
PERCENT = 85
ROWS, BANDS, FIRST = 5, 20, 4
#: Nodes of a block, about, where all nodes of a key meet.
BLOCK = 256
MINIMA = 128
_A = np.array([xxhash.xxh64_intdigest(b"a%d" % k) | 1 for k in range(MINIMA)], np.uint64)[:, None]
_B = np.array([xxhash.xxh64_intdigest(b"b%d" % k) for k in range(MINIMA)], np.uint64)[:, None]


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; words are runs without white space, with A-Z in lower case."""
    words = text.translate(LOWER_TABLE).split()  # bytes.split() parts at \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    n = max(1, len(words) - size + 1)
    starts, stops, found = starts[:n].tolist(), stops[-n:].tolist(), []
    for k in range(0, n, 1 << 15):
        parts = map(joined.__getitem__, map(slice, starts[k : k + (1 << 15)], stops[k : k + (1 << 15)]))
        found.append(np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64)))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over a set (not empty), as 32-bit numbers."""
    x = hashes >> np.uint64(32)
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(x), 512):
        h = _A * x[k : k + 512]
        h += _B
        np.minimum(least, h.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(least: np.ndarray) -> list[int]:
    raw, step = least.astype("<u4").tobytes(), 4 * ROWS
    return [xxhash.xxh64_intdigest(raw[k * step : (k + 1) * step], k) for k in range(BANDS)]


def sketch(least: np.ndarray) -> np.ndarray:
    return np.packbits(least.astype(np.uint8) & 1, bitorder="little").view("<i8")


def differing(percent: int) -> int:
    """Bits of the sketches in which sets that are similar enough may differ."""
    p = (100 - percent) / 200
    return ceil(MINIMA * p + 5.5 * sqrt(MINIMA * p * (1 - p)))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def lists(values: np.ndarray, width: int) -> pa.Array:
    """Rows of a flat array of longs, ``width`` to a row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, width), pa.int32()), pa.array(values))


#: What ``described`` adds to a row.
DESCRIPTION = "n_shingles long, digest binary, sketch array<long>, keys array<long>"


def describe(texts: list[bytes | None], size: int = SHINGLE) -> list[pa.Array]:
    """The columns of DESCRIPTION; without words the digest is null, and the others are of no meaning."""
    n, digests = np.zeros(len(texts), np.int64), []
    sketches, keys = np.zeros((len(texts), MINIMA // 64), np.int64), np.zeros((len(texts), BANDS), np.uint64)
    for k, text in enumerate(texts):
        own = shingle_set(text or b"", size)
        n[k] = len(own)
        digests.append(xxhash.xxh3_128_digest(own.astype("<u8").tobytes()) if len(own) else None)
        if len(own):
            least = minima(own)
            sketches[k], keys[k] = sketch(least), band_keys(least)
    return [pa.array(n), pa.array(digests, pa.binary()), lists(sketches.reshape(-1), MINIMA // 64), lists(keys.view(np.int64).reshape(-1), BANDS)]


def described(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """A written table with a row for each document: id (a number for the row), doc_id, text_md5, and DESCRIPTION."""

    def each(batches):
        for batch in batches:
            found = describe(batch.column("text").to_pylist(), size)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "doc_id", "text_md5")), *found], ["id", "doc_id", "text_md5", "n_shingles", "digest", "sketch", "keys"])

    text = F.col("text").cast("string").cast("binary")
    rows = docs.select(F.monotonically_increasing_id().alias("id"), F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_md5"), text.alias("text"))
    return cut(rows.mapInArrow(each, f"id long, doc_id long, text_md5 string, {DESCRIPTION}"), "described")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, size: int = SHINGLE) -> DataFrame:
    """u, v: the pairs (id, pivot) of texts (id, text) whose sets are similar."""

    def each(batches):
        at, own = None, None
        for batch in batches:
            found = []
            for id, pivot, text, other in zip(batch.column("id").to_pylist(), batch.column("pivot").to_pylist(), batch.column("text"), batch.column("other")):
                if pivot != at:
                    at, own = pivot, shingle_set(other.as_py(), size)
                if similar(own, shingle_set(text.as_py(), size), percent):
                    found.append((id, pivot))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])
        pa.default_memory_pool().release_unused()  # the worker lives on beside later stages

    met = pairs.select("id", "pivot").join(texts.hint("merge"), "id").join(texts.select(F.col("id").alias("pivot"), F.col("text").alias("other")).hint("merge"), "pivot")
    return met.select("id", "pivot", "text", "other").mapInArrow(each, "u long, v long")


def _apart(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(1, MINIMA // 64)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


class Rounds:
    """Rounds of pivots. ``fetch`` gives the texts (id, text binary) of a table's ids."""

    def __init__(self, fetch: Callable[[DataFrame], DataFrame], percent: int, size: int):
        self.fetch, self.percent, self.size = fetch, percent, size
        self.groups: DataFrame | None = None  # node, label
        self.tested: DataFrame | None = None  # high, low
        self.texts: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        """The rows (id, and others) with the label of their node."""
        if self.groups is None:
            return rows.withColumn("label", F.col("id"))
        return rows.join(self.groups.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))

    def heads_meet(self, described: DataFrame) -> bool:
        """In each key that has several labels let the heaviest nodes of two of them meet, those of the least and the greatest label. Whether that linked anything.

        ``described``: id, keys, weight, sketch, written.
        """
        own = self.labelled(described)
        pairs = _open(own.select("label", F.explode("keys").alias("key"))).select("low", "high").distinct()
        head = own.groupBy("label").agg(F.max(F.struct("weight", F.negate("id").alias("minus_id"), "sketch")).alias("h"))
        head = cut(head.select("label", F.negate("h.minus_id").alias("id"), "h.sketch"), "label_heads")
        met = cut(pairs, "label_pairs").join(head.select(F.col("label").alias("low"), F.col("id").alias("pivot"), F.col("sketch").alias("pivot_sketch")), "low")
        met = met.join(head.withColumnRenamed("label", "high"), "high").where(_apart("sketch", "pivot_sketch") <= differing(self.percent))
        return self._test(met)

    def pivots_meet(self, keyed: DataFrame, sketches: DataFrame, bits: int | None = None) -> DataFrame:
        """Let the pivots of each key meet the key's other nodes. ``keyed``: id, key, and, with ``bits``, the fingerprint fp that the key is of. Gives id, weight, sketch."""
        several = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").select("key", "n")
        keyed = cut(keyed.join(cut(several, "several"), "key"), "shared")
        if bits is not None:  # a node goes to the fullest key of each of its fingerprints, or a pair would meet in very many
            keyed = cut(keyed.groupBy("id", "fp").agg(F.max(F.struct("n", "key")).alias("k")).select("id", "fp", "k.n", "k.key"), "fullest")
        weights = cut(keyed.groupBy("id").agg(F.sum("n").alias("weight")).join(sketches, "id"), "weights")
        self.meet(cut(self.labelled(keyed.drop("n").join(weights, "id")), "keyed"), bits)
        return weights

    def meet(self, keyed: DataFrame, bits: int | None = None) -> None:
        """The same for ``keyed`` (key, id, label, weight, sketch and, with ``bits``, fp), written. Only fingerprints that differ in so many bits at most meet."""
        own = ["label", "sketch"] if bits is None else ["label", "sketch", "fp"]
        node = [F.negate("id").alias("minus_id"), *own]
        ends = keyed.groupBy("key").agg(F.max(F.struct("weight", *node)).alias("most"), F.max(F.struct(F.negate("weight").alias("weight"), *node)).alias("least"))
        heads = ends.select("key", F.explode(F.array_distinct(F.array(*[F.struct(f"{e}.minus_id", *[f"{e}.{c}" for c in own]) for e in ("most", "least")]))).alias("head"))
        heads = cut(heads.select("key", F.negate("head.minus_id").alias("pivot"), *[F.col(f"head.{c}").alias(f"pivot_{c}") for c in own]), "heads")
        near = (F.col("label") != F.col("pivot_label")) & (_apart("sketch", "pivot_sketch") <= differing(self.percent))
        if bits is not None:
            near &= F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot_fp"))) <= bits
        self._test(keyed.join(heads, "key").where(near))

    def all_meet(self, keyed: DataFrame) -> None:
        """Let all nodes of each key meet that have different labels: in pairs of blocks, on their full sets. ``keyed``: key, n (its nodes), id, label, written."""
        if keyed.isEmpty():
            return
        self.want(keyed.select("id").distinct())
        size, percent = self.size, self.percent

        def sets(batches):
            for batch in batches:
                found = [shingle_set(t.as_py(), size).astype("<u8").tobytes() for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], ["id", "own"])

        own = cut(self.texts.select("id", "text").mapInArrow(sets, "id long, own binary"), "sets")
        blocks = F.ceil(F.col("n") / BLOCK)
        dealt = keyed.withColumn("at", F.pmod(F.xxhash64("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        dealt = dealt.select("key", F.least("at", "other").alias("p"), F.greatest("at", "other").alias("q"), "at", "id", "label").join(own.hint("merge"), "id")
        dealt = dealt.select("key", "p", "q", "at", "id", "label", "own").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

        def each(batches):
            group, rows = None, []
            for batch in batches:
                for *place, at, id, label, one in zip(*(batch.column(c).to_pylist() for c in ("key", "p", "q", "at", "id", "label")), batch.column("own")):
                    if place != group and rows:
                        yield _links(rows, group[1] == group[2], percent)
                        rows = []
                    group = place
                    rows.append((at, id, label, np.frombuffer(one.as_py(), "<u8")))
            if rows:
                yield _links(rows, group[1] == group[2], percent)

        self._join(cut(dealt.mapInArrow(each, "u long, v long").distinct(), "links"))

    def _test(self, met: DataFrame, fetched: bool = False) -> bool:
        """Confirm pairs (id, pivot) that have not been tested, and link them. Whether there was a link."""
        # A pair that meets in several keys is one, with either of its nodes as the pivot.
        pairs = met.groupBy(F.greatest("id", "pivot").alias("high"), F.least("id", "pivot").alias("low")).agg(F.min("pivot").alias("pivot"))
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["high", "low"], "left_anti")
        pairs = cut(pairs.withColumn("id", F.col("high") + F.col("low") - F.col("pivot")), "pairs")
        done = pairs.select("high", "low")
        self.tested = done if self.tested is None else self.tested.union(done)
        return not pairs.isEmpty() and self._link(pairs, fetched)

    def want(self, ids: DataFrame) -> None:
        """Fetch the texts of the ids that are not there yet."""
        if self.texts is not None:
            ids = ids.join(self.texts.select("id"), "id", "left_anti")
        more = cut(self.fetch(cut(ids, "wanted")), "texts")
        self.texts = more if self.texts is None else self.texts.union(more)

    def _link(self, pairs: DataFrame, fetched: bool) -> bool:
        if not fetched:
            self.want(pairs.select("id").union(pairs.select("pivot")).distinct())
        return self._join(cut(confirmed(pairs, self.texts, self.percent, self.size), "links"))

    def _join(self, links: DataFrame) -> bool:
        """Join the groups up by more links. Whether there were any."""
        linked = not links.isEmpty()
        if linked:
            before = self.groups
            self.groups = components(links if before is None else links.union(before.where("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v"))))
        return linked


def _links(rows: list[tuple], alone: bool, percent: int) -> pa.RecordBatch:
    """Links (u, v) of a pair of blocks: rows of (block, id, label, set); ``alone`` if both are one block. As many as join its labels up."""
    block, ids, labels = (np.array(c) for c in list(zip(*rows))[:3])
    sizes = np.array([len(r[3]) for r in rows])
    # By hash the rows that have it; a row's intersections with all others are counted at once.
    _, codes, held = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(len(rows)), sizes)[np.argsort(codes, kind="stable")]
    first = np.cumsum(held) - held
    edges = np.concatenate([[0], np.cumsum(sizes)])
    root = {x: x for x in labels.tolist()}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    found = []
    for i in range(len(rows)):
        own = codes[edges[i] : edges[i + 1]]
        own = own[held[own] > 1]
        counts = held[own]
        at = np.repeat(first[own] - (np.cumsum(counts) - counts), counts)
        at += np.arange(len(at))
        both = np.bincount(holders[at], minlength=len(rows))
        near = (100 * both >= percent * (sizes[i] + sizes - both)) & (labels != labels[i]) & ((block != block[i]) | alone)
        for j in np.flatnonzero(near[:i]):
            a, b = find(int(labels[i])), find(int(labels[j]))
            if a != b:
                root[a] = b
                found.append((int(ids[i]), int(ids[j])))
    u, v = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def groups(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int, size: int = SHINGLE, prints: DataFrame | None = None, bits: int | None = None) -> DataFrame | None:
    """node, label: the components of linked nodes; None where nothing is linked. ``nodes``: id, sketch, keys (any number), written.

    ``prints``: id, key, fp (the fingerprint that the key is of), for a first round of pivots whose fingerprints differ in ``bits`` at most. It may leave out keys and nodes; what shares one of the
    nodes' keys is met in any case.
    """
    rounds = Rounds(fetch, percent, size)
    sketches = nodes.select("id", "sketch")
    if prints is not None:
        rounds.pivots_meet(prints, sketches, bits)
    weights = rounds.pivots_meet(nodes.select("id", F.explode(F.slice("keys", 1, FIRST)).alias("key")), sketches)

    described = cut(nodes.join(weights.select("id", "weight"), "id", "left").fillna(0, "weight"), "described")
    while rounds.heads_meet(described):
        pass
    keyed = rounds.labelled(described).select("id", "label", F.explode("keys").alias("key"))
    keyed = cut(keyed.join(cut(_open(keyed).select("key", "n"), "open"), "key"), "keyed")
    rounds.all_meet(keyed)
    return rounds.groups


def _open(keyed: DataFrame) -> DataFrame:
    """The keys whose nodes have several labels, with the least and the greatest, and the number of nodes."""
    return keyed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high")


def assign(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each document."""
    made = described(docs, size)
    nodes = made.where("digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("id", "doc_id", "text_md5")).alias("row"), F.min("doc_id").alias("first"))
    nodes = cut(nodes.select("digest", "first", "row.*"), "nodes")
    known = nodes.select("id", F.col("doc_id").alias("of"), F.col("text_md5").alias("md5"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).withColumn("text_md5", F.md5("text"))

    def fetch(ids: DataFrame) -> DataFrame:
        # One of the rows that have the node's doc_id and text; they differ in nothing that is read here.
        wanted = known.join(ids, "id")
        found = own.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_md5") == F.col("md5")))
        return found.groupBy("id").agg(F.any_value("text").alias("text"))

    described_nodes = cut(made.select("id", "sketch", "keys").join(nodes.select("id"), "id", "left_semi"), "described_nodes")
    found = groups(described_nodes, fetch, percent, size)
    if found is None:
        by_digest = nodes.select("digest", F.col("first").alias("component_id"))
    else:
        labelled = nodes.select("digest", "first", F.col("id").alias("node")).join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
        labelled = cut(labelled.select("digest", "first", "label"), "labelled")
        by_digest = labelled.join(labelled.groupBy("label").agg(F.min("first").alias("component_id")), "label").select("digest", "component_id")
    # Written, so that the join shuffles both its sides and a set that very many documents share can be split.
    by_digest = cut(by_digest, "components")
    rows = made.select("doc_id", "n_shingles", F.coalesce("digest", F.unhex(F.concat(F.lit("00"), F.hex("id")))).alias("digest"))
    joined = rows.join(by_digest, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
