"""Each stage against a brute-force version on the stage's own input, and the run as a whole."""

import hashlib

from tests.llm.test_quality import slow as slow_quality
from tests.llm.test_near_copies import slow_groups
from tests.llm.test_substring import slow as slow_substrings
from tests.llm.test_tokens import check_packing

import corpus_pipeline
from millrace.llm import bpe, exact_dedup, near_copies, quality


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]
    kept = {}
    for name in names[:-1]:
        docs = corpus_pipeline.cut(stages[name](spark, docs, sf), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = docs.collect()
    ids = {n: {r.doc_id for r in rows} for n, rows in kept.items()}
    for r in before:
        if len(r.text) < 2000:
            n, _, _, _, repeats = slow_quality(r.text)
            assert r.doc_id not in ids["quality_rules"] or not (n < 10 or 100 * repeats > 20 * n)
    last = {}
    for r in kept["quality_rules"]:
        last[lower(r.text)] = max(r.doc_id, last.get(lower(r.text), -1))
    assert ids["exact_dedup"] == set(last.values())
    rows = [(r.doc_id, r.text) for r in kept["exact_dedup"]]
    assert ids["simhash_near_dedup"] == {min(g) for g in slow_groups(rows)}
    rows = [(r.doc_id, r.text) for r in kept["simhash_near_dedup"]]
    out = {r.doc_id: r for r in kept["substring_dedup"]}
    assert len(out) == len(rows)
    for (d, text), (_, _, removed, sha) in zip(rows, slow_substrings(rows)):
        assert out[d].text == text if not removed else hashlib.sha256(out[d].text.encode()).hexdigest() == sha
    packed = stages[names[-1]](spark, docs, sf).collect()
    check_packing(packed, [(r.doc_id, r.text) for r in kept["substring_dedup"]], bpe.Encoder(bpe.default_path()), 2048)
    again = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in again.collect()) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_clean_documents_stay(spark, sf):
    """Labelled good documents pass the quality rules, but for those that are too short."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = quality.measure(docs).join(labels.where("quality = 1"), "doc_id").collect()
    assert good and all(r.kept for r in good if not r.base_failed)


def test_exact_dedup_edge_cases(spark):
    rows = [(1, "Aé", "x"), (2, "aé", "x"), (2, "aé", "y"), (3, "aÉ", "x"), (None, "AÉ", "x"), (None, None, "x"), (None, "", "x"), (5, "x" * 100000, "x")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, digest string, keep_id int, content int")

    def want():
        out = []
        for d, t, *_ in rows:
            t = lower(t or "")
            group = [x for x, u, *_ in rows if lower(u or "") == t]
            top = max((x for x in group if x is not None), default=None)
            out.append((d, top, len(group), d == top, hashlib.sha256(t.encode()).hexdigest()))
        return sorted(out, key=str)

    from pyspark.sql import functions as F

    def weak(content):  # nearly all texts collide: contents decide
        return F.substring(F.unhex(F.sha2(content, 256)), 1, 0)

    for digest in (exact_dedup.sha256, weak):
        assert sorted(map(tuple, exact_dedup.assign(docs, digest).collect()), key=str) == want()
        assert sorted((r.doc_id, r.digest) for r in exact_dedup.keep(docs, digest).collect() if r.doc_id) == [(2, "x"), (2, "y"), (3, "x"), (5, "x")]
    assert exact_dedup.assign(docs.limit(0)).collect() == []
    assert exact_dedup.keep(docs).columns == docs.columns


def test_one_row_of_each_group(spark):
    """Repeated rows, rows that differ in other columns only, null doc_ids, and doc_ids in more than one group."""
    words = [" ".join(f"{a}{k}" for k in range(40)) for a in "abcdef"]
    rows = [(1, words[0], "x"), (1, words[0], "x"), (1, words[0], "y"), (None, words[1], "x"), (None, words[1], "x"), (None, words[1].upper(), "y")]
    rows += [(2, words[2], "x"), (3, words[2], "x"), (2, words[3], "x"), (2, words[3], "x"), (None, words[4], "x"), (4, words[4], "x"), (7, None, "x"), (7, "", "x"), (8, words[5], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def heads(best):
        groups = {}
        for d, t, _ in rows:
            groups.setdefault(lower(t or ""), []).append(d)
        return sorted(((t, best((x for x in ids if x is not None), default=None)) for t, ids in groups.items()), key=str)

    def weak(content):
        from pyspark.sql import functions as F

        return F.substring(F.unhex(F.sha2(content, 256)), 1, 0)

    for left, best in ((exact_dedup.keep_one(docs), max), (exact_dedup.keep_one(docs, weak), max), (near_copies.keep(docs), min)):
        got = left.collect()
        assert left.columns == docs.columns and set(map(tuple, got)) <= set(rows)
        assert sorted(((lower(r.text or ""), r.doc_id) for r in got), key=str) == heads(best)
    assert exact_dedup.keep_one(docs.limit(0)).collect() == near_copies.keep(docs.limit(0)).collect() == []


def test_table_ingested_twice(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    for stage in (corpus_pipeline.exact, corpus_pipeline.near):
        once, twice = ([tuple(r) for r in stage(spark, d, sf).collect()] for d in (docs, docs.union(docs)))
        assert sorted(once) == sorted(twice)
