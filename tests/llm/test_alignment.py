"""Alignment and counts against a plain version that encodes whole texts, and the minimal perfect hash."""

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import alignment, bpe, sentencepiece_codec


@pytest.fixture(scope="module")
def tokens():
    return alignment.Tokens(bpe.default_path(), sentencepiece_codec.default_path())


@functools.cache
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(bpe.default_path())
    found.encode_special_tokens = True
    return found


def ids_a(text):
    return library().encode(text, add_special_tokens=False).ids


def plain(tokens, text):
    """A ids, B ids, groups; None without tokens"""
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = ids_a(" " + text), tokens.b.encode(text)
    if b"".join(tokens.bytes_a[x] for x in a) != whole or b"".join(tokens.bytes_b[x] for x in b) != whole:
        return None
    groups, i, j, at_a, at_b = [], 0, 0, 0, 0
    while i < len(a):
        own_a, own_b = [a[i]], [b[j]]
        at_a, at_b, i, j = at_a + len(tokens.bytes_a[a[i]]), at_b + len(tokens.bytes_b[b[j]]), i + 1, j + 1
        while at_a != at_b:
            if at_a < at_b:
                own_a.append(a[i])
                at_a, i = at_a + len(tokens.bytes_a[a[i]]), i + 1
            else:
                own_b.append(b[j])
                at_b, j = at_b + len(tokens.bytes_b[b[j]]), j + 1
        groups.append((own_a, own_b))
    return a, b, groups


def slow(tokens, rows):
    found = [plain(tokens, t) for _, t in rows]
    counts = Counter()
    for x in found:
        if x:
            counts.update({(p, q) for own_a, own_b in x[2] for p in own_a for q in own_b})
    best = {}
    for (p, _), n in counts.items():
        best[p] = max(n, best.get(p, 0))
    out = []
    for (d, _), x in zip(rows, found):
        if x is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(p, q) for own_a, own_b in x[2] for p in own_a for q in own_b]
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in x[2])
        out.append((d, len(x[0]), len(x[1]), len(x[2]), len(links), sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [
    "a  b", " lead", "trail ", "   ", " ", "\n", "a\n b", "a \n b", "\t x\t y ", "x  y", "x  y", "x　 y", "a\x0bb \x0c c", "\x1c \x1d a", "\x85 b", "a \x85",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<s> </s> <unk> <0x41>", "▁", "a▁b", "a ▁ b", "日本語のテキスト と 空白", "naïve café 🙂🙂 👩‍👩‍👧", "=" * 300, "=" * 77 + " " + "-" * 99,
    "don't I'll we've 123456789 3.14", "​ zero", "\u0000 nul", "é combining", "x" * 5000, "ab" * 3000 + " end", "﻿bom", "line\r\n next\r\n", "  \n\n  deep\n   indent",
]


def made(seed):
    rng = random.Random(seed)
    words = ["the", "Token", "izer's", "aligned,", "größe", "数据", "foo_bar", "(x)", "12,000", "🙂", "qzxv"]
    rows = [(k, t) for k, t in enumerate(ODD)] + [(500, None), (501, ""), (None, "null id"), (None, None)]
    for k in range(80):
        n = rng.randint(1, 60)
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", ", ", ""]) for _ in range(n))
        rows.append((1000 + k, text if rng.random() < 0.5 else text.strip().replace("  ", " ")))
    rows += rows[40:46] + [(1000, "other text")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,kinds", [(1, {}), (2, {"memo_units": 30, "segment_pairs": 40, "part_rows": 5})])
def test_plain_version(spark, tokens, seed, kinds):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, alignment.align(docs, **kinds).collect()), key=str) == slow(tokens, rows)


def test_given_documents(spark, sf, tokens):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, alignment.align(docs).collect()), key=str) == slow(tokens, list(map(tuple, docs.collect())))


def test_empty_table_texts_without_tokens_and_clashing_columns(spark):
    shape = "doc_id long, text string, pair string, n string, segment string, counts string"
    assert alignment.align(spark.createDataFrame([], shape)).collect() == []
    rows = [(1, None, *"abcd"), (2, "", *"abcd"), (3, "a▁", *"abcd")]
    assert sorted(map(tuple, alignment.align(spark.createDataFrame(rows, shape)).collect())) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]


@pytest.mark.parametrize("text", ODD)
def test_cuts_change_no_ids(tokens, text):
    units, edges, plain = alignment.cut_units(pa.array([" " + text], pa.large_string()))
    units = units.to_pylist()
    assert "".join(units) == " " + text and edges.tolist() == [0, len(units)]
    a, n_a, b, n_b = tokens.encode(units, plain)
    assert a.tolist() == ids_a(" " + text) and n_a.sum() == len(a)
    if alignment.MARK not in text:
        assert b.tolist() == tokens.b.encode(text) and n_b.sum() == len(b)
        assert [tokens.b.encode(u[1:]) for u in units] == [x.tolist() for x in np.split(b, np.cumsum(n_b)[:-1])]


def test_merges_are_those_of_the_library(tokens):
    rng = random.Random(6)
    letters = "aeiou thxqzé日ﬁ🙂'0123._-=\n\t" + "".join(map(chr, range(0x250, 0x270)))
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 40)))
        assert tokens.a.encode_to_numpy(text, disallowed_special=()).tolist() == ids_a(text)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n))
    made = alignment.PerfectHash.build(keys)
    again = alignment.PerfectHash.from_bytes(made.to_bytes())
    assert sorted(made.index(keys).tolist()) == list(range(len(keys)))
    assert (again.index(keys) == made.index(keys)).all()
    if n == 50_000:
        assert len(made.to_bytes()) * 8 < 5 * n


def test_other_keys_are_told_apart():
    keys = np.arange(1000) * 7
    made = alignment.PerfectHash.build(keys)
    placed = np.zeros(1000, "<i8")
    placed[made.index(keys)] = keys
    segment = alignment.Segment(made.to_bytes(), placed.tobytes())
    assert (segment.places(keys) >= 0).all() and (segment.places(keys + 1) == -1).all()


def test_tree_sum_of_parts(spark):
    rows = [(k % 50, 1 + k % 3) for k in range(1000)]
    counts = spark.createDataFrame(rows, "pair long, n long").withColumn("segment", alignment._segment_column(3)).cache()
    tables = alignment.hashed(counts.select("segment", "pair").distinct()).cache()
    got = {}
    for r in tables.join(alignment.summed(counts, tables, 40), "segment").collect():
        got |= dict(zip(np.frombuffer(r.pairs, "<i8").tolist(), np.frombuffer(r.counts, "<i8").tolist()))
    want = Counter()
    for pair, n in rows:
        want[pair] += n
    assert got == want
