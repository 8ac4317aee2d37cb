"""Golay codes, fingerprints and components against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash
from millrace.llm.components import components


def slow_fingerprint(text, size=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(items):
    """items: (doc_id, fp)"""
    parent = list(range(len(items)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in combinations(range(len(items)), 2):
        if bin(items[i][1] ^ items[j][1]).count("1") <= 2:
            parent[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(items):
        if d is not None:
            least[root(k)] = min(d, least.get(root(k), d))
    return [least.get(root(k)) for k in range(len(items))]


def test_code_is_perfect_and_neighbours_share_a_codeword():
    code = simhash.golay()
    v = np.random.default_rng(0).integers(0, 1 << 23, 3000)
    near, more = code.codewords(v)
    assert len(np.unique(code.nearest)) == 2048
    for bit in range(23):
        other_near, other_more = code.codewords(v ^ (1 << bit))
        mine = np.column_stack([near, more])
        assert (mine == other_near[:, None]).any(axis=1).all()
        assert (np.column_stack([other_near, other_more]) == near[:, None]).any(axis=1).all()


def test_keys_meet_within_two_bits():
    rng = random.Random(5)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 2)):
            y ^= 1 << b
        fps = np.array([x, y], np.uint64).view(np.int64)
        keys, _, stored = simhash.keys_of(fps[:1])
        assert set(keys[stored].tolist()) & set(simhash.keys_of(fps[1:])[0].tolist())


@pytest.mark.parametrize("text", ["", " \t\x0b\x0c\r\n", "One", "one two", "A b c", "É b c d e", "a b\x1cc d\xa0e f " * 50, "the same words " * 12000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    items = [(r.doc_id, slow_fingerprint(r.text)) for r in rows]
    want = {(d, f"{fp:016x}", c) for (d, fp), c in zip(items, slow_components(items))}
    assert {tuple(r) for r in simhash.assign(docs).collect()} == want


def family(seed, n):
    """Fingerprints in chains and crowds of one- and two-bit steps."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        x = rng.choice(out) if out and rng.random() < 0.9 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << b
        out.append(x)
    return out


@pytest.mark.parametrize("seed", [1, 3, 32])
def test_links_connect_what_all_pairs_would(spark, seed):
    fps = sorted(set(family(seed, 250)))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = [(r.u, r.v) for r in simhash.links(frame).collect()]
    mask = (1 << 64) - 1
    assert all(bin((u ^ v) & mask).count("1") in (1, 2) for u, v in edges)
    label = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    got = [label.get(x, x) for x in signed]
    assert got == slow_components(list(zip(signed, fps)))


def test_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1000)], "u long, v long")
    label = {r.node: r.label for r in components(edges).collect()}
    assert label == {k: 0 for k in range(201)} | {1000: 1000, 1001: 1000}
    assert components(edges.limit(0)).collect() == []


def test_edge_cases(spark):
    rows = [(5, None, 1), (2, "", 1), (9, "a b c d", 1), (9, "a b c d", 2), (None, "a b c d", 1), (None, "other words here", 1), (7, "x " * 40000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(simhash.assign(docs).collect(), key=str)
    items = [(d, slow_fingerprint(t)) for d, t, _ in rows]
    want = [(d, f"{fp:016x}", c) for (d, fp), c in zip(items, slow_components(items))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.assign(docs.limit(0)).collect() == []
