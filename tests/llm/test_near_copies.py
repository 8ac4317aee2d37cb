"""Near copies: keys and groups against brute force, planted copies of every kind of edit, and the operator's edge cases."""

import random
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import minhash, near_copies
from millrace.llm.common import cut


def slow_shingles(text, size=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def slow_similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def slow_groups(rows, least=0.8):
    """doc_ids (unique) of each group of (doc_id, text)."""
    sets = {d: slow_shingles(t) for d, t in rows}
    group = {d: {d} for d in sets}
    for a, b in combinations(sets, 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small >= least * large and slow_similarity(sets[a], sets[b]) >= least and group[a] is not group[b]:
            group[a] |= group[b]
            for d in group[b]:
                group[d] = group[a]
    return list({id(g): g for g in group.values()}.values())


def prose(rng, n):
    return [rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("klmnprst") + rng.choice("aeiou") * rng.randint(0, 2) + str(rng.randint(0, 9)) for _ in range(n)]


def edited(rng, words, changes):
    words = list(words)
    for k in rng.sample(range(len(words)), changes):
        words[k] = f"new{rng.randint(0, 10**6)}"
    return words


def changed(rng, words, kind, share):
    """A copy with ``share`` of its words replaced one by one, or one block of as many put in, cut or moved."""
    n = max(1, round(len(words) * share))
    at = rng.randrange(len(words) - n + 1)
    if kind == "replaced":
        return edited(rng, words, n)
    if kind == "inserted":
        return words[:at] + prose(rng, n) + words[at:]
    rest = words[:at] + words[at + n :]
    if kind == "cut":
        return rest
    to = rng.randrange(len(rest) + 1)
    return rest[:to] + words[at : at + n] + rest[to:]


def test_keys_share_what_they_promise():
    rng = random.Random(2)
    for _ in range(200):
        x = rng.getrandbits(64)
        clean = rng.randrange(3)
        other = (clean + 1) % 3
        y = x
        for segment in {0, 1, 2} - {clean}:
            at, n = near_copies.SEGMENTS[segment]
            for b in rng.sample(range(n), 2 if segment == other else rng.randint(0, 12)):
                y ^= 1 << at + b
        keys = [set(near_copies.keys_of(np.array([[v]], np.uint64))[0].tolist()) for v in (x, y)]
        assert keys[0] & keys[1]


def planted(seed, texts=40, shares=(0.02, 0.05, 0.1, 0.15, 0.2)):
    """doc_id, text of originals and copies; the kind of edit, share and doc_id of the copies that are similar enough, by the original's doc_id."""
    rng = random.Random(seed)
    rows, pairs = [], []
    for k in range(texts):
        base = prose(rng, rng.choice([60, 200, 600, 2000]))
        rows.append((100 * k, " ".join(base)))
        for kind in ("replaced", "inserted", "cut", "moved"):
            share = rng.choice(shares)
            text = " ".join(changed(rng, base, kind, share))
            if slow_similarity(slow_shingles(" ".join(base)), slow_shingles(text)) >= 0.8:
                pairs.append((kind, share, 100 * k, 100 * k + 1 + len(pairs) % 90))
                rows.append((pairs[-1][3], text))
    rng.shuffle(rows)
    return rows, pairs


@pytest.mark.parametrize("seed", [3, 4])
def test_planted_copies_of_every_edit_are_caught(spark, seed):
    rows, pairs = planted(seed)
    assert {k for k, *_ in pairs} == {"replaced", "inserted", "cut", "moved"} and len(pairs) > 60
    stay = {r.doc_id for r in near_copies.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert stay == {min(g) for g in slow_groups(rows)}


def test_crowd(spark):
    """Very many copies of one text, which one key holds together."""
    rng = random.Random(4)
    base = prose(rng, 300)
    rows = [(k, " ".join(edited(rng, base, 2))) for k in range(200)] + [(500 + k, "the same text here and there") for k in range(50)] + [(900, " ".join(prose(rng, 300)))]
    stay = {r.doc_id for r in near_copies.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert stay == {0, 500, 900}


def test_edge_cases(spark):
    rng = random.Random(5)
    long = prose(rng, 60000)
    rows = [(5, None), (2, ""), (None, " \n"), (9, "a b c"), (9, "A b c"), (None, "a b c"), (4, "a b d"), (7, " ".join(long)), (3, " ".join(edited(rng, long, 500))), (None, "only null ids"), (None, "only null ids")]
    docs = spark.createDataFrame([(*r, 1, 2, [3], "k", "l") for r in rows], "doc_id long, text string, _row int, id int, fps array<int>, keys string, label string")
    got = near_copies.keep(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r._row, r.id) for r in got.collect()), key=str) == sorted([(2, 1, 2), (9, 1, 2), (4, 1, 2), (3, 1, 2), (None, 1, 2)], key=str)
    assert near_copies.keep(docs.limit(0)).collect() == []


def test_first_round_takes_golay_keys_by_distance(spark):
    """Nodes that share no other key: what meets in a key of a fingerprint is linked if it is similar and its fingerprints are near."""
    rng = random.Random(6)
    base = prose(rng, 300)
    texts = [" ".join(edited(rng, base, 2)) for _ in range(4)] + [" ".join(prose(rng, 300))]
    sketches = minhash.describe([t.encode() for t in texts])[2].to_pylist()
    nodes = spark.createDataFrame([(k, s, [k]) for k, s in enumerate(sketches)], "id long, sketch array<long>, keys array<long>")
    body = spark.createDataFrame([(k, t.encode()) for k, t in enumerate(texts)], "id long, text binary")
    near, far = (1 << near_copies.BITS) - 1, (1 << near_copies.BITS + 1) - 1
    prints = spark.createDataFrame([(0, 7, 0), (1, 7, near), (2, 8, 0), (3, 8, far), (0, 9, 5), (4, 9, 5)], "id long, key long, fp long")
    found = minhash.groups(cut(nodes, "nodes"), lambda ids: body.join(ids, "id", "left_semi"), near_copies.PERCENT, prints=prints, bits=near_copies.BITS)
    assert sorted(map(tuple, found.collect())) == [(0, 0), (1, 0)]


def test_each_golay_key_has_its_fingerprint(spark):
    rng = random.Random(7)
    fps = np.array([[rng.getrandbits(64), rng.getrandbits(64)] for _ in range(20)], np.uint64)
    keys, owners = near_copies.keys_of(fps)
    rows = [(k, [1] * minhash.BANDS + keys[owners == k].tolist(), fps[k].view(np.int64).tolist()) for k in range(len(fps))]
    got = near_copies.prints(spark.createDataFrame(rows, "id long, keys array<long>, fps array<long>")).collect()
    want = {(k, int(key), int(fps[k, t].view(np.int64))) for t in (0, 1) for k in range(len(fps)) for key in near_copies.keys_of(fps[k : k + 1])[0].tolist() if (key >> 34) // 3 == t}
    assert len(got) == len(keys) and {(r.id, r.key, r.fp) for r in got} == want


def test_what_is_too_far_in_the_first_round_is_met_later(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BITS", -1)
    rows, _ = planted(3)
    stay = {r.doc_id for r in near_copies.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert stay == {min(g) for g in slow_groups(rows)}
