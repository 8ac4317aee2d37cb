"""MinHash near-dedup against brute force over all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import minhash


def slow_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def slow(rows, percent=85):
    """rows: (doc_id, text) -> doc_id, n_shingles, component_id, kept of each"""
    sets = [slow_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[root(k)] = min(d, least.get(root(k), d))
    out = []
    for k, (d, _) in enumerate(rows):
        c = least.get(root(k)) if sets[k] else d
        out.append((d, len(sets[k]), c, d is not None and d == c))
    return out


def edited(rng, words, rate):
    """Replaced, inserted, cut and moved words."""
    words, n = list(words), max(1, int(len(words) * rate))
    kind = rng.choice(["replace", "insert", "cut", "move"])
    at = rng.randrange(len(words))
    if kind == "replace":
        for k in rng.sample(range(len(words)), n):
            words[k] = f"x{rng.random()}"
    elif kind == "insert":
        words[at:at] = [f"y{rng.random()}" for _ in range(n)]
    elif kind == "cut":
        del words[at : at + n]
    else:
        block = words[at : at + n]
        del words[at : at + n]
        words[rng.randrange(len(words) + 1) : 0] = block
    return words


def made(seed, families=12):
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{f}x{rng.randrange(4000)}" for _ in range(rng.randint(5, 300))]
        for _ in range(rng.randint(1, 14)):
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(edited(rng, base, rng.choice([0.004, 0.01, 0.03, 0.1, 0.14])))))
        base = rows[-1][1].split()  # a chain: each a copy of the one before
        for _ in range(rng.randint(0, 4)):
            base = edited(rng, base, 0.02)
            rows.append((len(rows), " ".join(base).upper()))
    rows += [(10_000 + k, t) for k, t in enumerate(["", None, "one", "ONE", "one two", "a b c d e", "A b C d E", "a b c d e f", " \n "])]
    rows += [(None, rows[0][1]), (None, rows[3][1] + " more"), (None, None), (None, "alone and without an id")]
    rows += rows[:6] + [(rng.randrange(20), rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, minhash.assign(docs).collect()), key=str)
    assert got == sorted(slow(rows), key=str)


def test_family_of_unlike_members_is_met_pair_by_pair(spark):
    """Nodes that share a key but are unlike their pivots: every pair is met before the key is done."""
    rng = random.Random(9)
    stem = [f"s{k}" for k in range(60)]
    rows = []
    for k in range(40):
        own = [f"t{k // 2}_{j}" for j in range(45)]
        rows.append((k, " ".join(stem + own + ([] if k % 2 else ["end"]))))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, minhash.assign(docs).collect()))
    assert got == sorted(slow(rows)) and len({c for _, _, c, _ in got}) == 20


def test_one_key_for_all(spark):
    """Groups alone, with one key that all nodes share, so that only the rounds decide."""
    rows = [(k, t) for k, (_, t) in enumerate(made(4, 5)) if t and t.split()]
    rows = list({slow_set(t): (k, t) for k, t in rows}.values())
    texts = spark.createDataFrame([(k, t.encode()) for k, t in rows], "id long, text binary")
    sketches = [(k, [int(x) for x in minhash.sketch(minhash.minima(minhash.shingle_set(t.encode())))]) for k, t in rows]
    sketches = spark.createDataFrame(sketches, "id long, sketch array<long>")
    nodes = sketches.selectExpr("*", "array(7L) AS keys").cache()
    got = {r.node: r.label for r in minhash.groups(nodes, lambda ids: texts.join(ids, "id"), 85).collect()}
    want = {d: c for d, _, c, _ in slow(rows)}
    assert {d: got.get(d, d) for d, _ in rows} == want


def test_no_words_empty_table_and_clashing_columns(spark):
    shape = "doc_id long, text string, id string, key string, label string, digest string, keys string"
    assert minhash.assign(spark.createDataFrame([], shape)).collect() == []
    rows = [(1, None, *"abcde"), (2, "", *"abcde"), (3, "x y", *"abcde"), (4, "X  y", *"abcde")]
    got = sorted(map(tuple, minhash.assign(spark.createDataFrame(rows, shape)).collect()))
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False)]


def test_long_text(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(50_000)}" for _ in range(120_000)]
    other = words[:60_000] + ["new"] * 3 + words[60_000:]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    assert [(r.doc_id, r.component_id) for r in minhash.assign(docs).orderBy("doc_id").collect()] == [(1, 1), (2, 1)]


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_limit_share_a_key_and_pass_the_sketch(percent):
    rng = np.random.default_rng(percent)
    met = passed = 0
    for _ in range(400):
        n = int(rng.integers(100, 600))
        both = -(-percent * n // 100)
        x = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        a, b = x[: both + (n - both) // 2], np.concatenate([x[:both], x[both + (n - both) // 2 : n]])
        la, lb = minhash.minima(a), minhash.minima(b)
        met += bool(set(minhash.band_keys(la)) & set(minhash.band_keys(lb)))
        apart = np.unpackbits((minhash.sketch(la) ^ minhash.sketch(lb)).view(np.uint8)).sum()
        passed += int(apart) <= minhash.differing(percent)
    assert met >= 399 and passed == 400


def test_minima_are_those_of_the_universal_hashes():
    hashes = np.array([3 << 32, 9 << 33 | 5, (1 << 64) - 1], np.uint64)
    a, b = minhash._A[:, 0].tolist(), minhash._B[:, 0].tolist()
    want = [min((p * (int(h) >> 32) + q) % (1 << 64) >> 32 for h in hashes) for p, q in zip(a, b)]
    assert minhash.minima(hashes).tolist() == want
