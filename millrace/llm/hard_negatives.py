"""Hard-negative mining by segment summaries.

Vectors are cut into segments. For each segment of length L the mean m and the deviation d (root of the summed squares around the mean) are kept. For two vectors
the inner product over a segment is L * m1 * m2 plus a rest of at most d1 * d2 (Cauchy and Schwarz), so the sums over all segments of
L * m1 * m2 - d1 * d2 and L * m1 * m2 + d1 * d2 bound the whole product from below and above. Longer segments come first; what the bounds do not decide is
refined with shorter ones (``LEVELS``: parts of a vector), and what is left is scored exactly.

1. Positives: among the rows of an anchor's label the fifth greatest lower bound is a floor that each of the best five reaches; rows whose upper bound is below it go.
2. Negatives: the positives fix the scores that can count, from least * lowest positive to the highest. Rows of other labels whose bounds lie outside go.

Anchors and rows are dealt into blocks of bounded size, and each pair of an anchor block and a row block is a task's group, so that a group's size does not depend on any label
and work is spread evenly whatever the labels are. Both passes return a few rows for each anchor and block, and the best of those are taken. Every anchor meets every
row; bounds leave out only what cannot be among the results.

Components are floor(scale * x), as integers, and scores are exact: in floating point where all products and sums stay below 2^53, else in Python's
integers. A score beyond 64 bits is an error.

Defined results: rows with a null label or vector, or with a null or non-finite component, take no part. Of vectors of unequal length the shorter counts as zeros beyond its
end. Ties go to the smaller vec_id, null vec_ids last, equal ones in the order of their rows; repeated rows are rows of their own, and are each other's "other rows". A null vec_id is
no anchor and does not shift its label. Other columns, whatever their names, are ignored. An empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

ANCHOR_EVERY = 100
TOP = 5
#: Least and greatest score of a negative, in hundredths of its positive's.
LEAST, GREATEST = 80, 100
SCALE = 256
#: Anchors and rows of a block, about; a group has at most twice the values that their vectors take.
ANCHOR_BLOCK, ROW_BLOCK = 2048, 16384
#: Parts that a vector is cut into, one level after another.
LEVELS = (1, 4, 16, 32)
#: Rows of a block that bounds are made for at once.
STRIPE = 4096


class Vectors:
    """Integer vectors of a block with the segment summaries of each level."""

    def __init__(self, table: pa.Table, width: int):
        values = table.column("vec").combine_chunks()
        if isinstance(values, pa.ChunkedArray):
            values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], pa.list_(pa.float64()))
        sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = values.flatten().to_numpy(zero_copy_only=False)
        self.real = np.zeros((len(values), width))
        at = np.repeat(np.arange(len(values)), sizes)
        self.real[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        self.row = table.column("row").to_numpy()
        self.label = table.column("label").to_numpy()
        ids = table.column("vec_id")
        self.no_id = ids.is_null().to_numpy().astype(np.int8)
        self.vec_id = ids.fill_null(0).to_numpy()
        self.levels = [self._level(parts) for parts in LEVELS if parts < width]

    def _level(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) of means times the root of the length, and of deviations."""
        width = self.real.shape[1]
        edges = np.linspace(0, width, parts + 1).astype(int)
        means, spread = np.zeros((len(self.real), parts)), np.zeros((len(self.real), parts))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            some = self.real[:, a:b]
            mean = some.mean(axis=1)
            means[:, k] = mean * np.sqrt(b - a)
            spread[:, k] = np.sqrt(((some - mean[:, None]) ** 2).sum(axis=1))
        return means, spread

    def __len__(self) -> int:
        return len(self.real)


def bounds(a: Vectors, b: Vectors, level: int, i, j) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of the pairs (i, j); for index arrays of the shape (n, 1) and (m,) of all n * m, by two products of matrices."""
    (m1, d1), (m2, d2) = a.levels[level], b.levels[level]
    if np.ndim(i) == 2:
        middle, rest = m1[i[:, 0]] @ m2[j].T, d1[i[:, 0]] @ d2[j].T
    else:
        middle, rest = np.einsum("ij,ij->i", m1[i], m2[j]), np.einsum("ij,ij->i", d1[i], d2[j])
    slack = 1e-9 * (np.abs(middle) + rest) + 1e-6  # more than rounding can take
    return middle - rest - slack, middle + rest + slack


def exact(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The scores of the pairs, as 64-bit integers."""
    if not len(i):
        return np.zeros(0, np.int64)
    most = float(np.abs(a.real).max(initial=0)) * float(np.abs(b.real).max(initial=0)) * a.real.shape[1]
    if most < 2**53:
        if len(i) * 8 > len(a) * len(b):  # most of them are wanted
            return (a.real @ b.real.T)[i, j].astype(np.int64)
        return np.concatenate([np.einsum("ij,ij->i", a.real[i[k : k + 65536]], b.real[j[k : k + 65536]]) for k in range(0, len(i), 65536)]).astype(np.int64)
    found = [sum(int(x) * int(y) for x, y in zip(a.real[p], b.real[q])) for p, q in zip(i, j)]
    if max(map(abs, found)) >= 2**63:
        raise OverflowError("a score does not fit into 64 bits")
    return np.array(found, np.int64)


def best(anchor: np.ndarray, score: np.ndarray, b: Vectors, j: np.ndarray, top: int) -> np.ndarray:
    """Places in the pairs of each anchor's first ``top``, in their order."""
    order = np.lexsort((b.row[j], b.vec_id[j], b.no_id[j], -score, anchor))
    own = anchor[order]
    first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
    rank = np.arange(len(own)) - np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
    return order[rank < top]


def refined(a: Vectors, b: Vectors, rows: np.ndarray, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, top: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs whose scores may lie in [low, high] of their anchor, a stripe of rows at a time; with ``top``, the best ``top`` of each anchor and maybe more."""
    low = low.copy()
    for k in range(0, len(rows), STRIPE):
        some = rows[k : k + STRIPE]
        i, j = np.repeat(np.arange(len(anchors)), len(some)), np.tile(some, len(anchors))
        whole = True
        for level in range(len(a.levels)):
            below, above = bounds(a, b, level, anchors[:, None], some) if whole else bounds(a, b, level, anchors[i], j)
            if whole and top and len(some) >= top:
                low = np.maximum(low, np.partition(below, len(some) - top, axis=1)[:, len(some) - top])
            below, above = below.reshape(-1), above.reshape(-1)
            left = (above >= low[i]) & (below <= high[i])
            whole = whole and 4 * left.sum() > len(left)  # bounds of all pairs cost less than picking them while many are left
            if not whole:
                i, j = i[left], j[left]
        if whole and len(a.levels):
            i, j = i[left], j[left]
        own = anchors[i]
        yield own, j


def positives_in(a: Vectors, b: Vectors, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anchor, row, score: the best ``top`` rows of its label for each anchor, the anchor itself left out."""
    found = []
    for label in np.unique(a.label):
        anchors, rows = np.flatnonzero(a.label == label), np.flatnonzero(b.label == label)
        everything = np.full(len(anchors), np.inf)
        for i, j in refined(a, b, rows, anchors, -everything, everything, top + 1):  # one more, since the anchor itself may be among them
            own = a.row[i] == b.row[j]
            i, j = i[~own], j[~own]
            score = exact(a, b, i, j)
            keep = best(i, score, b, j, top)
            found.append((i[keep], j[keep], score[keep]))
    return _joined(found, b, top)


def _joined(found: list, b: Vectors, top: int):
    i, j, score = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    keep = best(i, score, b, j, top)
    return i[keep], j[keep], score[keep]


def negatives_in(a: Vectors, b: Vectors, aims: list[list[int]], top: int, least: int, greatest: int) -> tuple[np.ndarray, ...]:
    """anchor, aim (the place of the positive's score in ``aims``), row, score: the best ``top`` rows of other labels within each positive's limits."""
    # low * 100 >= least * aim, as integers: the least score that counts, and the greatest.
    floors = [[-(-least * s // 100) for s in own] for own in aims]
    ceilings = [[greatest * s // 100 for s in own] for own in aims]
    valid = [[lo <= hi for lo, hi in zip(f, c)] for f, c in zip(floors, ceilings)]
    found = []
    for label in np.unique(a.label):
        anchors = np.array([k for k in np.flatnonzero(a.label == label) if any(valid[k])], np.int64)
        if not len(anchors):
            continue
        rows = np.flatnonzero(b.label != label)
        low = np.array([min(lo for lo, ok in zip(floors[k], valid[k]) if ok) for k in anchors], float)
        high = np.array([max(hi for hi, ok in zip(ceilings[k], valid[k]) if ok) for k in anchors], float)
        for i, j in refined(a, b, rows, anchors, low, high):
            score = exact(a, b, i, j)
            for aim in range(max(map(len, aims), default=0)):
                lo = np.array([f[aim] if aim < len(f) and ok[aim] else 1 for f, ok in zip(floors, valid)], np.int64)
                hi = np.array([c[aim] if aim < len(c) and ok[aim] else 0 for c, ok in zip(ceilings, valid)], np.int64)
                fit = np.flatnonzero((score >= lo[i]) & (score <= hi[i]))
                keep = fit[best(i[fit], score[fit], b, j[fit], top)]
                found.append((i[keep] * TOP_AIMS + aim, j[keep], score[keep]))
    key, j, score = _joined(found, b, top)
    return key // TOP_AIMS, key % TOP_AIMS, j, score


#: More than the positives of an anchor.
TOP_AIMS = 1 << 20


def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """row (a number), vec_id, label, vec (whole numbers, as doubles): a written table of the rows that take part."""
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    whole = F.expr(f"transform(cast(embedding AS array<double>), x -> CAST(floor(CAST({scale} AS double) * x) AS double))")
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("vec")), "prepared")


def _blocked(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))


def mine(
    vectors: DataFrame, anchor_every: int = ANCHOR_EVERY, top: int = TOP, least: int = LEAST, greatest: int = GREATEST, scale: int = SCALE, anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = prepared(vectors, scale)
    anchors = cut(rows.where(F.col("vec_id") % anchor_every == 0), "anchors")
    (n, width), m = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first(), anchors.count()
    width, a_blocks, r_blocks = width or 1, max(1, -(-m // anchor_block)), max(1, -(-n // row_block))
    # Every row meets every anchor block, and every anchor every row block.
    dealt = _blocked(rows, r_blocks, "r").withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(a_blocks - 1)))).groupBy("a", "r")

    def first(key, own, other):
        if not len(own) or not len(other):
            return _table(["row", "vec_id", "other", "other_id", "score"])
        a, b = Vectors(own, width), Vectors(other, width)
        i, j, score = positives_in(a, b, top)
        return _table(["row", "vec_id", "other", "other_id", "score"], a.row[i], a.vec_id[i], b.row[j], _ids(b, j), score)

    everywhere = F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1)))
    met = _blocked(anchors, a_blocks, "a").withColumn("r", everywhere).groupBy("a", "r").cogroup(dealt)
    order = [F.desc("score"), F.asc_nulls_last("other_id"), F.asc("other")]
    near = met.applyInArrow(first, "row long, vec_id long, other long, other_id long, score long")
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= top)
    near = cut(near, "positives")
    aims = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("aims"))  # ``top`` at most
    aimed = anchors.join(cut(aims.select("row", "aims.score"), "aims"), "row")

    def second(key, own, other):
        if not len(own) or not len(other):
            return _table(["row", "aim", "other", "other_id", "score"])
        a, b = Vectors(own, width), Vectors(other, width)
        i, aim, j, score = negatives_in(a, b, own.column("score").to_pylist(), top, least, greatest)
        return _table(["row", "aim", "other", "other_id", "score"], a.row[i], aim + 1, b.row[j], _ids(b, j), score)

    far = _blocked(aimed, a_blocks, "a").withColumn("r", everywhere).groupBy("a", "r").cogroup(dealt).applyInArrow(second, "row long, aim long, other long, other_id long, score long")
    far = far.withColumn("place", F.row_number().over(Window.partitionBy("row", "aim").orderBy(*order))).where(F.col("place") <= top)
    positives = near.select("row", F.col("rank").cast("long").alias("aim"), F.col("vec_id").alias("anchor_id"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = far.withColumnRenamed("score", "negative_score").join(positives, ["row", "aim"])
    return found.select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", "negative_score")


def _ids(b: Vectors, j: np.ndarray) -> pa.Array:
    return pa.array(b.vec_id[j], pa.int64(), mask=b.no_id[j].astype(bool))


def _table(names: list[str], *columns) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) if not isinstance(c, pa.Array) else c for c in columns] or [pa.array([], pa.int64())] * len(names), names=names)
