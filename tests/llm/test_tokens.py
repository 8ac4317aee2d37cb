"""Token files and packing against brute force."""

import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import bpe, packing, token_files

DOCS = "doc_id long, text string, ids int, piece string"
TEXTS = [
    (3, "It's we'll see, again and again."),
    (1, ""),
    (2, None),
    (9, "a  b\n \n c   d \n"),
    (7, "word " * 5000),
    (7, "word " * 5000),
    (None, "no id"),
    (5, "<|endoftext|> café naïve 12,345.6 x"),
    (6, "x" * 30000),
]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.default_path())


def brute(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_memo_gives_the_library_ids(encoder):
    rng = random.Random(1)
    parts = ["a", "b", " ", " ", "\n", "\t", ".", ",", "'s", "é", "1", "　", "<|endoftext|>", "\x1c", "words"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    for given in (texts, *([t] for t in texts[:200])):  # many at once, and alone
        ids, edges = encoder.batch(pa.array(given))
        for k, text in enumerate(given):
            assert ids[edges[k] : edges[k + 1]].tolist() == brute(encoder, text), repr(text)


def test_memo_stays_small():
    small = bpe.Encoder(bpe.default_path(), memo_parts=10)
    for k in range(50):
        text = " ".join(f"w{k}x{j}" for j in range(20))
        assert small.batch(pa.array([text]))[0].tolist() == brute(small, text)
        assert len(small.after_space) + len(small.bare) <= 10 + 6 * 21


def test_runs_of_bounded_bytes(encoder):
    texts = ["a b c. d" * k for k in (0, 1, 50, 3, 2, 0, 80)]
    runs = list(bpe.Encoder(bpe.default_path(), 1000, 100).runs(pa.array(texts)))
    assert [k for k, _, _ in runs] == [0, 2, 3, 6]
    assert [ids[e[j] : e[j + 1]].tolist() for _, ids, e in runs for j in range(len(e) - 1)] == [brute(encoder, t) for t in texts]


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    other = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Some  words here", "", "It's\nnot the same"]
    ids, edges = other.batch(pa.array(texts))
    assert not other.cuttable
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [brute(other, t) for t in texts]


@pytest.mark.parametrize("width", [1, 3, 11, 16, 17, 31, 32])
@pytest.mark.parametrize("block", [5, 8, 64])
def test_file_format_any_width(width, block):
    rng = np.random.default_rng(width)
    docs = [(k if k % 3 else None, rng.integers(0, 1 << width, rng.integers(0, 40), dtype=np.uint64).astype("<u4")) for k in range(30)]

    class Keep(io.BytesIO):
        def close(self):
            pass

    sink = Keep()
    writer = token_files.Writer(sink, width, block)
    for some in (docs[:7], docs[7:8], docs[8:]):
        writer.add(pa.array([d for d, _ in some], pa.int64()), np.concatenate([i for _, i in some]), np.cumsum([0, *(len(i) for _, i in some)]))
    writer.close()
    reader = token_files.Reader(pa.PythonFile(io.BytesIO(sink.getvalue()), "r"))
    assert [(d, i.tolist()) for d, _, i in reader.documents()] == [(d, i.tolist()) for d, i in docs]
    whole = np.concatenate([i for _, i in docs])
    for a, b in [(0, 0), (3, 4), (1, len(whole)), (block, 2 * block), (len(whole) - 1, len(whole))]:
        assert reader.range(a, b).tolist() == whole[a:b].tolist()
    with pytest.raises(ValueError):
        token_files.Reader(pa.PythonFile(io.BytesIO(sink.getvalue()[:-3]), "r"))


def test_token_files(spark, encoder):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in TEXTS], DOCS)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.round_trip(docs).collect()), key=lambda r: r[1])
    want, at = [], 0
    for d, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = brute(encoder, t)
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    assert token_files.round_trip(docs.limit(0)).collect() == []


def test_token_files_of_rows_without_ids(spark, encoder):
    docs = spark.createDataFrame([(None, "same text")] * 500 + [(k, "other") for k in range(20)], "doc_id long, text string").repartition(3)
    made = token_files.write(docs, f"{token_files.shared_dir(spark)}/tokens", bpe.default_path())
    assert made.where("docs > 300").count() == 0  # equal rows are spread over the files
    got = token_files.read_back(spark, made).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 500 + list(range(20))
    assert {(r.n_tokens, r.ids_crc32) for r in got if r.doc_id is None} == {(len(brute(encoder, "same text")), crc(brute(encoder, "same text")))}


def check_packing(rows, texts, encoder, capacity):
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for d, group in Counter(d for d, _ in texts).items():
        wanted = []
        for t in [t for x, t in texts if x == d]:
            ids = brute(encoder, t)
            edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
            wanted += [(k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[d]) == sorted(wanted)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def test_packing(spark, encoder):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in TEXTS], DOCS)
    check_packing(packing.run(docs).collect(), TEXTS, encoder, 2048)
    check_packing(packing.run(docs, capacity=7).collect(), TEXTS, encoder, 7)
    assert packing.run(docs.limit(0)).collect() == []


def test_packing_many_equal_lengths(spark, encoder):
    texts = [(k, "same words " * 3) for k in range(300)] + [(1000 + k, "a " * (k % 50)) for k in range(200)]
    rows = packing.run(spark.createDataFrame(texts, "doc_id long, text string"), capacity=64).collect()
    used = check_packing(rows, texts, encoder, 64)
    assert used <= -(-sum(r.length for r in rows) // 64) * 1.03 + 1


def test_sequences(spark, encoder):
    texts = [(1, "one two three"), (2, "word " * 30), (3, None)]
    made = packing.pieces(spark.createDataFrame(texts, "doc_id long, text string"), capacity=16).cache()
    packed = packing.pack(made, 16)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(made, packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == np.frombuffer(r.ids, "<u4").tolist()
    made.unpersist()


def test_exact_complements():
    counts = {10: 5, 6: 3, 4: 8, 3: 4, 2: 2, 1: 9}
    patterns = packing.plan(counts, 10)
    used = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 10
        for x in pattern:
            used[x] += times
    assert used == counts
    assert ((6, 4), 3) in patterns  # a single fills the gap
    left = np.zeros(21, np.int64)
    left[[3, 4, 9]] = 1, 1, 1
    sums = np.ones(21, bool)
    assert packing.find_complement(7, left, sums) == (4, 3)
    assert packing.find_complement(16, left, sums) == (9, 4, 3)
    assert packing.find_complement(6, left, sums) is None  # 3 is there once only


def test_plan_is_close_to_the_bound():
    rng = random.Random(3)
    counts = Counter(min(512, max(1, int(rng.lognormvariate(4.5, 0.9)))) for _ in range(5000))
    assert sum(t for _, t in packing.plan(counts, 512)) <= -(-sum(k * v for k, v in counts.items()) // 512) * 1.01
