"""The permutation, the numbering and the law, by brute force."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 4097])
@pytest.mark.parametrize("seed", [1, 20240229])
def test_permutation(spark, n, seed):
    passes = sharding.walk_bound(spark, n, seed)
    spots = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, passes, seed)).collect()]
    assert sorted(spots) == list(range(n))


def test_shuffles(spark):
    n = 5000
    spots = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, sharding.walk_bound(spark, n))).collect()]
    steps = sum(abs(a - b) for a, b in zip(spots, spots[1:])) / n
    assert 0.28 * n < steps < 0.39 * n  # a third of n for a random order
    other = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, sharding.walk_bound(spark, n, 5), 5)).collect()]
    assert sum(a == b for a, b in zip(spots, other)) < 20


def check(rows, texts, shards=16):
    def size(t):
        raw = (t or "").encode()
        return len(raw) + 1, zlib.crc32(raw)

    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, *size(t)) for d, t in texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sharding.assign(docs).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    again = sharding.assign(docs.repartition(7)).collect()  # the layout of the input does not matter
    assert set(map(tuple, again)) == set(map(tuple, rows))


def test_edge_cases(spark, monkeypatch):
    texts = [(1, None), (1, ""), (None, "é"), (None, "é"), (2, "x" * 100000)] + [(7, "same")] * 300
    docs = spark.createDataFrame([(d, t, 1, "s") for d, t in texts], "doc_id long, text string, size int, bucket string")
    check(sharding.assign(docs).collect(), texts)
    monkeypatch.setattr(sharding, "CHUNK", 7)
    check(sharding.assign(docs, shards=3).collect(), texts, 3)
    assert sharding.assign(docs.limit(0)).collect() == []


def test_write_shards(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sharding.write_shards(docs, f"{tmp_path}/shards", shards=4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in docs.collect()}
    spots = {(r.doc_id, r.shard, r.slot) for r in sharding.assign(docs, shards=4).collect()}
    assert {(r.doc_id, r._shard, r._slot) for r in back.collect()} == spots
