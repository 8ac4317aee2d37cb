"""Substring dedup against brute force over all windows."""

import hashlib
import random
import re

import pytest

from millrace.llm import substring_dedup


def slow(rows):
    """rows: (doc_id, text) -> n_words, n_removed, kept_sha256, kept text of each"""
    last = 1 << 63
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, last), last if d is None else d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < (last if d is None else d):
                gone |= set(range(k, k + 13))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def test_cover():
    c, p = substring_dedup.COVER, substring_dedup.PERIOD
    assert all(any((i + s) % p in c and (j + s) % p in c for s in range(p)) for i in range(p) for j in range(p))


def made(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(9)] + ["é", "日本"]
    passages = [rng.choices(vocabulary, k=rng.randint(8, 40)) for _ in range(12)]
    rows = []
    for d in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else rng.choices(vocabulary, k=rng.randint(1, 30))
        rows.append((d if rng.random() > 0.05 else None, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(rng.randrange(n), rng.choice(rows)[1]) for _ in range(15)]  # copies, some under one doc_id
    rows += rows[:5]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, substring_dedup.measure(docs).collect()), key=str) == sorted(slow(rows), key=str)


@pytest.mark.parametrize("held", [1, 20, 10_000])
def test_combining_by_batches(monkeypatch, held):
    """The rows that tasks send, whatever they hold at once."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    monkeypatch.setattr(substring_dedup, "HELD", held)
    rows = [r for r in made(9, 40) if r[0] is not None]
    compress = zstandard.ZstdCompressor().compress
    batch = pa.RecordBatch.from_pydict({"ord": [d for d, _ in rows], "n_words": [len(t.split()) for _, t in rows], "body": [compress(t.encode()) for _, t in rows]})
    alone, known, many = {}, set(), {}
    for out in substring_dedup._anchor_rows(iter([batch])):
        for k, o, m in zip(*(out.column(j).to_pylist() for j in range(3))):
            if m is not None:
                many.setdefault(o, set()).update(np.frombuffer(m, np.int64).tolist())
            elif o is None:
                known.add(k)
            else:
                alone.setdefault(k, []).append(o)
    want = {}
    for d, t in rows:
        for h in set(substring_dedup.anchors(t.encode().split())[1].tolist()):
            want.setdefault(h, []).append(d)
    for h, ds in want.items():
        if len(ds) > 1:
            for d in ds:
                assert h in many.get(d, ()) or (d in alone.get(h, []) and (h in known or len(alone[h]) > 1))


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, substring_dedup.measure(docs).collect())) == sorted(slow(rows))
    out = {r.doc_id: r for r in substring_dedup.apply(docs).collect()}
    assert substring_dedup.apply(docs).columns == docs.columns
    want = {d: (removed, sha) for d, _, removed, sha in slow(rows)}
    for d, text in rows:
        removed, sha = want[d]
        assert out[d].text == text if not removed else hashlib.sha256(out[d].text.encode()).hexdigest() == sha
        assert out[d].n_chars == len(out[d].text)


def test_edge_cases(spark):
    long = " ".join(f"v{k}" for k in range(60000))
    rows = [(4, None), (3, ""), (2, long), (8, "x " + long), (5, "same " * 300), (6, "same " * 20), (1, "a b c")]
    docs = spark.createDataFrame([(d, t, 1, "y") for d, t in rows], "doc_id long, text string, ord int, body string")
    assert sorted(map(tuple, substring_dedup.measure(docs).collect())) == sorted(slow(rows))
    assert substring_dedup.apply(docs).columns == docs.columns
    assert substring_dedup.measure(docs.limit(0)).collect() == []


def test_rows_without_ids_and_odd_names(spark):
    last = (1 << 63) - 1
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(None, f"a{k} {shared}") for k in range(40)] + [(None, shared)] * 3 + [(last, f"z {shared}"), (7, None), (None, None)]
    docs = spark.createDataFrame([(d, t, 1, "y", len(t or "")) for d, t in rows], "doc_id long, text string, `a.b c` int, _row string, n_chars int")
    assert sorted(map(tuple, substring_dedup.measure(docs).collect()), key=str) == sorted(slow(rows), key=str)
    got = substring_dedup.apply(docs)
    assert got.columns == docs.columns
    assert sorted((r.text or "") for r in got.collect() if r.doc_id is None and r.text)[:2] == ["a0", "a1"]
    alone = [r for r in rows if r[0] is None]
    got = substring_dedup.measure(spark.createDataFrame(alone, "doc_id long, text string")).collect()
    assert all(r.n_removed == 0 for r in got)  # none is smaller than another
