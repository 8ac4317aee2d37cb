"""Base counts against a plain reading of their contract; bands by example."""

import base64
import random
import re
from collections import Counter

import pytest
import zstandard

from millrace.llm import quality


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times = Counter(windows)
    marked = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        dups += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(marked)


def slow_verdict(text):
    """kept, whole ratio, share of chunks outside; written from the module's docstring."""
    raw, ratio = text.encode(), lambda x: len(zstandard.compress(x, 3)) / len(x)
    _, low, high, chunk_low, chunk_high = [b for b in quality.BANDS if b[0] <= len(raw)][-1]
    cuts = [k for k in range(0, len(raw), 4096) if k == 0 or len(raw) - k >= 1024]
    chunks = [ratio(raw[a:b]) for a, b in zip(cuts, [*cuts[1:], len(raw)])]
    outside = sum(r < chunk_low or r > chunk_high for r in chunks) / len(chunks)
    return low <= ratio(raw) <= high and outside <= 0.2, ratio(raw), outside


def random_text(seed):
    rng = random.Random(seed)
    return "".join(rng.choices(["a", "b", "é", "日本", " ", " ", " ", "\n", "\t", "\x1c", "\xa0", "#", "|", "<", "\r\n", "a b a b a b a"], k=rng.randint(0, 80)))


@pytest.mark.parametrize("seed", range(60))
def test_base(seed):
    text = random_text(seed)
    assert quality.base(text.encode()) == slow(text)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in quality.measure(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        n, chars, symbols, dups, repeats = want = slow(r.text)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert (g.kept, g.whole_ratio, g.chunks_outside) == ((False, None, None) if g.base_failed else slow_verdict(r.text))
    kept = {r.doc_id for r in quality.keep(docs).collect()}
    assert kept == {d for d, r in got.items() if r.kept}


def test_bands():
    rng, c = random.Random(2), zstandard.ZstdCompressor(level=3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    plain = " ".join(rng.choices(words, k=4000)).encode()
    noise = base64.b64encode(rng.randbytes(30000))
    for n in (40, 100, 300, 2000, 20000):
        assert quality.verdict(plain[:n], c)[0], n
    assert not quality.verdict(noise, c)[0]
    assert not quality.verdict(b"the same words over and over " * 500, c)[0]
    assert not quality.verdict(plain + b"x" * 20000, c)[0]  # half of its chunks say nothing


@pytest.mark.parametrize("size", sorted({n for b in quality.BANDS if b[0] >= 128 for n in (b[0], b[0] * 5 // 4)} | {b[0] - 1 for b in quality.BANDS if b[0] > 128}))
def test_noise_in_every_band(size):
    rng, c = random.Random(size), zstandard.ZstdCompressor(level=3)
    for width, gap in ((size, ""), (76, "\n"), (20, " "), (8, " ")):
        for _ in range(20):
            code = base64.b64encode(rng.randbytes(size)).decode()
            noise = gap.join(code[k : k + width] for k in range(0, size, width)).encode()[:size]
            assert not quality.verdict(noise, c)[0], (width, quality.verdict(noise, c))


def test_noise_in_a_third_of_the_chunks():
    rng, c = random.Random(3), zstandard.ZstdCompressor(level=3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    plain = " ".join(rng.choices(words, k=9000)).encode()[: 8 * quality.CHUNK]
    code = base64.b64encode(rng.randbytes(4 * quality.CHUNK)).decode()
    noise = " ".join(code[k : k + 8] for k in range(0, len(code), 8)).encode()[: 4 * quality.CHUNK]
    assert quality.verdict(plain, c)[0] and not quality.verdict(plain + noise, c)[0]


@pytest.mark.parametrize("rest", [1, 500, 1023, 1024, 4095])
def test_last_chunk_is_judged(rest):
    rng, c = random.Random(rest), zstandard.ZstdCompressor(level=3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    raw = " ".join(rng.choices(words, k=9000)).encode()[: 2 * quality.CHUNK + rest]
    assert quality.verdict(raw, c) == slow_verdict(raw.decode())
    sizes = [len(x) for x in (raw[: quality.CHUNK], raw[quality.CHUNK :])] if rest < 1024 else [quality.CHUNK, quality.CHUNK, rest]
    assert len(quality.ratios(raw, c)[1]) == len(sizes)


def test_edge_cases(spark):
    rows = [(1, None, "k"), (1, None, "k"), (None, "few words", "k"), (2, "word " * 200000, "k"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = quality.measure(docs).collect()
    assert len(got) == 5 and not any(r.kept for r in got) and all(r.base_failed for r in got)
    assert quality.keep(docs).columns == docs.columns and quality.keep(docs).count() == 0
    assert quality.measure(docs.limit(0)).collect() == []
