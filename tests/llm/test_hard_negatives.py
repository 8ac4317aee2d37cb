"""Hard negatives against a plain loop over all pairs, and the bounds of segment summaries."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import hard_negatives as hn


def slow(rows, top=5):
    """rows: (vec_id, embedding, label)"""
    own = []
    for vec_id, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        own.append((vec_id, label, [math.floor(256 * x) for x in vec]))
    last = (1, 0)
    key = lambda v: last if v is None else (0, v)
    found = []
    for k, (a, label, vec) in enumerate(own):
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vec, v)), key(i), j) for j, (i, _, v) in enumerate(own) if j != k]
        scored.sort()
        positives = [s for s in scored if own[s[2]][1] == label][:top]
        for minus, _, p in positives:
            fit = [s for s in scored if own[s[2]][1] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus][:top]
            found += [(a, own[p][0], r + 1, own[s[2]][0], -minus, -s[0]) for r, s in enumerate(fit)]
    return sorted(found, key=str)


def made(seed, n=700, width=16, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for k in range(n):
        c = rng.choice(centres)
        vec = [float(np.float32(scale * (x + rng.gauss(0, 0.5)) / 6)) for x in c]
        if rng.random() < 0.1:
            vec = [float(round(x, 1)) for x in vec]  # ties
        rows.append((k * 5, vec, rng.choice([0, 1, 1, 1, 9])))
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (None, rows[4][1], 1), (None, rows[5][1], 0)]
    rows += [(200, None, 1), (300, rows[1][1], None), (400, [*rows[1][1][:-1], None], 1), (500, [*rows[1][1][:-1], float("nan")], 1), (600, [*rows[1][1][:-1], float("inf")], 1)]
    rows += [(900, rows[0][1][:5], 0), (905, [], 1), rows[7], rows[7], (-100, rows[9][1], 9)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed,blocks", [(1, {}), (2, {"anchor_block": 7, "row_block": 60})])
def test_plain_loop(spark, seed, blocks):
    rows = made(seed)
    got = result(hn.mine(frame(spark, rows), **blocks))
    assert got and got == slow(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = made(3, 120, 4, 1e6)
    assert result(hn.mine(frame(spark, rows, "double"))) == slow(rows)
    with pytest.raises(Exception, match="64 bits"):
        hn.mine(frame(spark, [(100, [1e9, 1e9], 1), (101, [1e9, 1e9], 1)], "double")).collect()


def test_empty_tables_no_anchor_and_clashing_columns(spark):
    assert hn.mine(frame(spark, [])).collect() == []
    assert hn.mine(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)])).collect() == []
    assert hn.mine(frame(spark, [(100, [1.0], 1)])).collect() == []
    rows = made(4, 150)
    more = frame(spark, rows).selectExpr("*", "'x' AS row", "1 AS r", "2 AS a", "3 AS vec", "4 AS rank", "5 AS score")
    assert result(hn.mine(more)) == slow(rows)


def block(vectors):
    n = len(vectors)
    table = pa.table({"row": pa.array(range(n), pa.int64()), "vec_id": pa.array(range(n), pa.int64()), "label": pa.array([0] * n, pa.int64()), "vec": pa.array([list(map(float, v)) for v in vectors], pa.list_(pa.float64()))})
    return hn.Vectors(table, len(vectors[0]))


@pytest.mark.parametrize("width", [1, 5, 64, 100])
def test_bounds_hold_and_tighten(width):
    rng = np.random.default_rng(width)
    a, b = (block(rng.integers(-300, 300, (60, width)) + rng.integers(-200, 200, (60, 1))) for _ in range(2))
    score = a.real @ b.real.T
    i, j = np.repeat(np.arange(60), 60), np.tile(np.arange(60), 60)
    gaps = []
    for level in range(len(a.levels)):
        low, high = hn.bounds(a, b, level, np.arange(60)[:, None], np.arange(60))
        assert (low <= score).all() and (score <= high).all()
        again = hn.bounds(a, b, level, i, j)
        assert np.allclose(low.reshape(-1), again[0]) and np.allclose(high.reshape(-1), again[1])
        gaps.append((high - low).mean())
    assert gaps == sorted(gaps, reverse=True)


def test_refining_leaves_out_rows_far_from_the_limits():
    rng = np.random.default_rng(8)
    near = rng.normal(100, 3, (20, 64)).round()
    far = rng.normal(-100, 3, (2000, 64)).round()
    a, b = block(near[:2]), block(np.concatenate([near[2:], far]))
    everything = np.full(2, np.inf)
    pairs = sum(len(i) for i, _ in hn.refined(a, b, np.arange(len(b)), np.arange(2), -everything, everything, 5))
    assert pairs <= 2 * 18
