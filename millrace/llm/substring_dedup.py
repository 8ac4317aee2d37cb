"""Substring dedup by difference-cover anchors.

A window is ``WINDOW`` consecutive words. {0, 1, 3} is a difference cover modulo 7: for any two positions there
is one shift below 7 that takes both to cover positions. So two equal windows of 13 words share an anchor, 7
words that start at a cover position of both texts, and only 3 of 7 positions need hashing.

1. Texts with the words of a text with a smaller doc_id are known copies and stop here.
2. Anchors: each remaining text sends the hashes of its anchors. Those that two texts send are shared.
3. Extension: a text that gets its shared anchors back extends each to the windows of 13 words that hold it, and sends
   their 96-bit hashes. A window is covered when a text with a smaller doc_id sends it too.
4. Covered windows go back to the texts, whose covered words are removed.

No pairs are made. Python tasks combine what they send over a bounded number of rows first: an
anchor that two texts of a batch hold is known to be shared there and then, and of equal windows only
those of the smallest doc_id have anything to ask; so a passage in a third of all texts sends one row a batch. Hashes
find candidates by 48 bits; coverage is decided by 96 bits of the whole window.

Texts travel once, compressed, in one exchange by doc_id that the three joins on it reuse.

Defined results: null text has no words. Windows of rows with the same doc_id do not cover each other. A null
doc_id counts as larger than all others; each such row is placed by its own number, however many there are, so ``docs`` should be a table, whose rows
come in the same order each time. Rows that share a doc_id are placed together. Repeated rows give equal results. Very long texts cost time in
proportion. Other columns are ignored by ``measure`` and carried by ``apply``, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import cut

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Rows that a task holds to combine them.
HELD = 500_000
#: Rows without a doc_id are placed below this; no doc_id may be.
NULLS_BELOW = -(1 << 63) + (1 << 61)


def spans(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by a space, and where each starts and stops."""
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return b" ".join(words), np.concatenate([[0], stops[:-1] + 1]), stops


def anchors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 48-bit hashes of a text's anchors."""
    n = len(words) - ANCHOR + 1
    if len(words) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    at = at[np.isin(at % PERIOD, COVER)]
    joined, starts, stops = spans(words)
    parts = map(joined.__getitem__, map(slice, starts[at].tolist(), stops[at + ANCHOR - 1].tolist()))
    return at, (np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(at)) >> np.uint64(16)).astype(np.int64)


def windows(words: list[bytes], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that hold a shared anchor, with their hashes in two parts."""
    at, hashes = anchors(words)
    at = at[np.isin(hashes, shared)]
    mark = np.zeros(len(words) + 2, np.int64)
    np.add.at(mark, np.maximum(at - (WINDOW - ANCHOR), 0), 1)
    np.add.at(mark, at + 1, -1)
    begin = np.flatnonzero(np.cumsum(mark)[: len(words) - WINDOW + 1] > 0)
    joined, starts, stops = spans(words)
    parts = map(joined.__getitem__, map(slice, starts[begin].tolist(), stops[begin + WINDOW - 1].tolist()))
    raw = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), np.uint8).reshape(-1, 16)
    return begin, raw[:, :8].copy().view("<i8")[:, 0], raw[:, 8:12].copy().view("<i4")[:, 0]


def _arrays(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _prepare(batches):
    compressor = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raws = [x or b"" for x in batch.column("text").to_pylist()]
        words = [x.split() for x in raws]
        out = {f: batch.column(f) for f in batch.schema.names if f != "text"}
        out["n_words"] = pa.array(map(len, words), pa.int64())
        out["sha"] = pa.array([hashlib.sha256(b" ".join(w)).digest() for w in words], pa.binary())
        out["body"] = pa.array([compressor.compress(x) for x in raws], pa.binary())
        yield _arrays(out)


def _digests(batches):
    for batch in batches:
        shas = [hashlib.sha256(b" ".join((x or b"").split())).digest() for x in batch.column("text").to_pylist()]
        yield _arrays({"ord": batch.column("ord"), "sha": pa.array(shas, pa.binary())})


def _words(body: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(body).split()


def _anchor_rows(batches):
    """k, ord, many: an anchor that one text of those held has; with null ord, one that several have; with ``many``, a text's anchors of that kind."""

    def send(held):
        ords = np.array([o for o, _ in held], np.int64)
        sizes = [len(h) for _, h in held]
        hashes, owner = np.concatenate([h for _, h in held]), np.repeat(np.arange(len(held)), sizes)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(hashes)))
        alone = first[count == 1]
        yield _arrays({"k": pa.array(hashes[alone]), "ord": pa.array(ords[owner[alone]]), "many": pa.nulls(len(alone), pa.binary())})
        known = hashes[first[count > 1]]
        if len(known):
            yield _arrays({"k": pa.array(known), "ord": pa.nulls(len(known), pa.int64()), "many": pa.nulls(len(known), pa.binary())})
            inside = np.repeat(count > 1, count)
            hashes, owner = hashes[inside], owner[inside]
            order = np.argsort(owner, kind="stable")
            hashes, owner = hashes[order], owner[order]
            texts, at = np.unique(owner, return_index=True)
            lists = [x.tobytes() for x in np.split(hashes, at[1:])]
            spread = [xxhash.xxh64_intdigest(x) >> 1 for x in lists]
            yield _arrays({"k": pa.array(spread, pa.int64()), "ord": pa.array(ords[texts]), "many": pa.array(lists, pa.binary())})

    held, n = [], 0
    for batch in batches:
        for o, words, body in zip(batch.column("ord").to_pylist(), batch.column("n_words").to_pylist(), batch.column("body").to_pylist()):
            if words < WINDOW:
                continue
            hashes = np.unique(anchors(_words(body))[1])
            if len(hashes):
                held.append((o, hashes))
                n += len(hashes)
            if n >= HELD:
                yield from send(held)
                held, n = [], 0
    if held:
        yield from send(held)


def _window_batch(k, k2, ords, p, more) -> pa.RecordBatch:
    n = len(k)
    return _arrays(
        {
            "k": pa.array(k),
            "k2": pa.nulls(n, pa.int32()) if k2 is None else pa.array(k2, pa.int32()),
            "ord": pa.array(ords),
            "p": pa.nulls(n, pa.int32()) if p is None else pa.array(p, pa.int32()),
            "more": pa.nulls(n, pa.binary()) if more is None else pa.array(more, pa.binary()),
        }
    )


def _window_rows(batches):
    """k, k2, ord, p, more: a window of one text, at its place p; or, where it has several or the tag is not 0, with ``more``: tag and places as 32-bit numbers. With null k2, places whose windows are covered for certain."""

    def send(held):
        ords, tags = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int32)
        rank = np.where(ords < NULLS_BELOW, np.iinfo(np.int64).max, ords)
        owner = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
        at, k, k2 = (np.concatenate([h[j] for h in held]) for j in (2, 3, 4))
        order = np.lexsort((at, owner, rank[owner], k2, k))
        owner, at, k, k2 = owner[order], at[order].astype("<i4"), k[order], k2[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (k2[1:] != k2[:-1])])
        least = rank[owner][np.flatnonzero(new)][np.cumsum(new) - 1]  # sorted by rank within a window
        ask = np.flatnonzero(rank[owner] == least)
        head = np.concatenate([[True], new[ask][1:] | (owner[ask][1:] != owner[ask][:-1])])
        heads, count = ask[head], np.diff(np.append(np.flatnonzero(head), len(ask)))
        plain = (count == 1) & (tags[owner[heads]] == 0)
        one, other = heads[plain], heads[~plain]
        yield _window_batch(k[one], k2[one], ords[owner[one]], at[one], None)
        if len(other):
            places = [at[a : a + n] for a, n in zip(other.tolist(), count[~plain].tolist())]  # a window's places in a text are neighbours
            yield _window_batch(k[other], k2[other], ords[owner[other]], None, [tags[owner[a]].tobytes() + x.tobytes() for a, x in zip(other.tolist(), places)])
        rest = np.setdiff1d(np.arange(len(at)), ask, assume_unique=True)
        if len(rest):
            rest = rest[np.argsort(owner[rest], kind="stable")]
            texts, first = np.unique(owner[rest], return_index=True)
            more = [tags[t].tobytes() + x.tobytes() for t, x in zip(texts.tolist(), np.split(at[rest], first[1:]))]
            spread = np.array([xxhash.xxh64_intdigest(x) >> 1 for x in more], np.int64)
            yield _window_batch(spread, None, ords[texts], None, more)

    held, n = [], 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("ord", "tag", "body", "ks", "many")]
        for o, tag, body, ks, many in zip(*columns):
            shared = np.concatenate([np.array(ks, np.int64), *(np.frombuffer(x, np.int64) for x in many)])
            begin, k, k2 = windows(_words(body), shared)
            if len(begin):
                held.append((o, tag, begin, k, k2))
                n += len(begin)
            if n >= HELD // 2:
                yield from send(held)
                held, n = [], 0
    if held:
        yield from send(held)


def _finish(batches):
    decompressor = zstandard.ZstdDecompressor()
    for batch in batches:
        removed, shas, texts = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("n_words", "sha", "body", "copy", "tag", "ps", "more")]
        for n, sha, body, copy, tag, ps, more in zip(*columns):
            mark = np.zeros(n + 1, np.int64)
            if copy and n >= WINDOW:
                mark[0] = 1
            elif ps or more:
                lists = [x[1:] for x in (np.frombuffer(m, "<i4") for m in more) if x[0] == tag]
                begin = np.unique(np.concatenate([np.array(ps if tag == 0 else [], np.int64), *lists])).astype(np.int64)
                np.add.at(mark, begin, 1)
                np.add.at(mark, begin + WINDOW, -1)
            gone = np.cumsum(mark)[:n] > 0
            removed.append(int(gone.sum()))
            if removed[-1]:
                words = decompressor.decompress(body).split()
                text = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                sha = hashlib.sha256(text).digest()
            elif "text" in batch.schema.names:
                text = decompressor.decompress(body)
            else:
                text = None
            shas.append(sha.hex())
            texts.append(text)
        out = {f: batch.column(f) for f in batch.schema.names if f in ("doc_id", "_row", "n_words")}
        out["n_removed"] = pa.array(removed, pa.int64())
        out["kept_sha256"] = pa.array(shas, pa.string())
        if "text" in batch.schema.names:
            out["text"] = pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string())
        yield _arrays(out)


def _run(docs: DataFrame, whole: bool) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    own_place = F.lit(-(1 << 63)) + F.monotonically_increasing_id()
    order = F.when(doc_id.isNull(), own_place).when(doc_id < NULLS_BELOW, F.raise_error(F.lit("doc_id too small"))).otherwise(doc_id).cast("long").alias("ord")
    columns = [doc_id.alias("doc_id"), order, F.col("text").cast("binary").alias("text")]
    row = []
    if whole:
        columns.insert(0, F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_row"))
    chosen = docs.select(*columns)
    if whole:
        row = [chosen.schema["_row"]]
    prepared = StructType([*row, *_fields("doc_id long, ord long, n_words long, sha binary, body binary")])
    # No place is null; said here, or tests for null are pushed below some of the exchanges of ``texts`` and not below others, and they differ.
    base = chosen.mapInArrow(_prepare, prepared).where("ord IS NOT NULL")

    versions = cut(docs.select(order, F.col("text").cast("binary").alias("text")).mapInArrow(_digests, "ord long, sha binary").distinct(), "digests")
    # Written, so that the join has two bare exchanges and adaptive execution can split a text that very many documents share.
    least = cut(versions.groupBy("sha").agg(F.min(F.when(F.col("ord") >= NULLS_BELOW, F.col("ord"))).alias("least")), "least")
    versions = versions.join(least, "sha").groupBy("ord").agg(F.array_sort(F.collect_list(F.struct("sha", "least"))).alias("versions"))  # the texts under one doc_id: one, as a rule
    texts = base.join(versions, "ord", "left")
    sha = F.coalesce("sha", F.lit(b""))  # never null; else a test for null is pushed below two of the three exchanges of ``texts``, and they differ
    texts = texts.withColumn("tag", F.coalesce((F.array_position(F.transform("versions", lambda v: v["sha"]), sha) - 1).cast("int"), F.lit(0)))
    first = F.col("versions")[F.col("tag")]["least"]
    texts = texts.withColumn("copy", F.coalesce((first < F.col("ord")) | (first.isNotNull() & (F.col("ord") < NULLS_BELOW)), F.lit(False))).drop("versions")

    # All three uses of the texts take all their columns and leave no filter to push below, so that they are the same exchange to Spark, which then makes it once.
    own = [*(["_row"] if whole else []), "doc_id", "ord", "n_words", "sha", "body"]
    sent = texts.where(~F.col("copy")).select(*own).mapInArrow(_anchor_rows, "k long, ord long, many binary")
    by_anchor = Window.partitionBy("k")
    sent = sent.withColumn("n", F.sum(F.when(F.col("many").isNull(), F.when(F.col("ord").isNull(), 2).otherwise(1)).otherwise(0)).over(by_anchor))
    shared = sent.where("ord IS NOT NULL AND (many IS NOT NULL OR n > 1)")
    shared = shared.groupBy("ord").agg(F.collect_list(F.when(F.col("many").isNull(), F.col("k"))).alias("ks"), F.collect_list("many").alias("many"))

    found = texts.where(~F.col("copy")).join(shared, "ord").select(*own, "tag", "ks", "many")
    found = found.mapInArrow(_window_rows, "k long, k2 int, ord long, p int, more binary")
    least = F.min(F.when(F.col("k2").isNotNull() & (F.col("ord") >= NULLS_BELOW), F.col("ord"))).over(Window.partitionBy("k", "k2"))
    covered = found.withColumn("least", least).where(f"k2 IS NULL OR ord > least OR (least IS NOT NULL AND ord < {NULLS_BELOW})")
    # Narrow rows travel; a text's lists are made where they arrive.
    covered = covered.select("ord", "p", "more").repartition("ord").groupBy("ord").agg(F.collect_list("p").alias("ps"), F.collect_list("more").alias("more"))

    done = texts.join(covered, "ord", "left")
    done = done.select(*own, "copy", "tag", "ps", "more", *([F.lit("").alias("text")] if whole else []))
    return done.mapInArrow(_finish, StructType([*row, *_fields("doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * whole)]))


def _fields(columns: str) -> list[StructField]:
    kinds = {"long": LongType(), "string": StringType(), "binary": BinaryType()}
    return [StructField(name, kinds[kind]) for name, kind in (c.split() for c in columns.split(", "))]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: a row for each document."""
    return _run(docs, False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def apply(docs: DataFrame) -> DataFrame:
    """The documents without their covered words. A text that loses words is what is left, joined by a space; others stay as they are. n_chars, where there is one, follows."""
    done = _run(docs, True)
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("text"))
        elif name == "n_chars":
            columns.append(F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"_row.`{name}`").alias(name))
    return done.select(*columns)
