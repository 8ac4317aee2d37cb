"""The codec against the library: with the model's type set to unigram, and its decoding."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from millrace.llm import sentencepiece_codec as sc


@pytest.fixture(scope="module")
def codec():
    return sc.Codec(sc.default_path())


@pytest.fixture(scope="module")
def unigram():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(sc.default_path(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def ids(codec, text):
    return np.frombuffer(codec.ids(text), "<u4").tolist()


def lattice(unigram, text):
    """The library's best path through its lattice."""
    return unigram.nbest_encode_as_ids(text, 2)[0] if text else []


def exact_in_single(codec, pieces):
    """Whether the library's single-precision sums are exact: no unknown character, and no lone mark (its score is -1e9)."""
    gain = {v[2]: v[1] for v in codec.automaton.values()}
    return all(i in gain for i in pieces) and sum(gain[i] for i in pieces) > -(1 << 24)


def total(codec, pieces):
    gain = {v[2]: v[1] for v in codec.automaton.values()}
    return sum(gain[i] for i in pieces)


SAMPLES = ["", " ", "a", "Hello world", "  two  spaces ", "tab and newline", "日本語テキスト", "naïve café", "<0x0A> </s>", "1234567", "ﬁ ligature", "é"]


@pytest.mark.parametrize("text", SAMPLES)
def test_samples(codec, unigram, text):
    own = ids(codec, text)
    assert own == lattice(unigram, text) or not exact_in_single(codec, own)


def test_random_words(codec, unigram):
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choices(["th", "e", "an", " ", "ing", "é", "x", "日", "q", "."], k=rng.randint(1, 25)))
        own = ids(codec, text)
        assert own == lattice(unigram, text) or not exact_in_single(codec, own), text


def test_documents(spark, sf, codec, unigram):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    compared = same = 0
    for text in texts.values():
        short = " ".join(text[:400].split("\n"))  # no unknown characters; the library sums in single precision, which is exact for so few pieces
        own = ids(codec, short)
        if exact_in_single(codec, own):
            theirs = lattice(unigram, short)
            assert total(codec, own) == total(codec, theirs)
            compared, same = compared + 1, same + (own == theirs)
    assert compared > len(texts) / 4 and same > 0.9 * compared  # the rest are ties
    got = {r.doc_id: r for r in sc.round_trip(docs).collect()}
    assert len(got) == len(texts)
    for d, text in texts.items():
        own = codec.ids(text)
        assert got[d].ids_crc32 == zlib.crc32(own) and got[d].n_pieces == len(own) // 4
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert codec.library.decode(np.frombuffer(own, "<u4").tolist()) == text


def brute(codec, text):
    """Best score by trying every cut."""
    known = {w: v[1] for w, v in codec.automaton.items()}
    best = [0.0] + [float("-inf")] * len(text)
    for e in range(1, len(text) + 1):
        for s in range(e):
            gain = known.get(text[s:e], codec.unknown_score if e - s == 1 else float("-inf"))
            best[e] = max(best[e], best[s] + gain)
    return best[-1]


def test_best_by_brute_force(codec):
    rng = random.Random(8)
    for _ in range(50):
        text = sc.MARK + "".join(rng.choices("thenaiqzé\n😀", k=rng.randint(1, 14)))
        pieces = codec.best(text)
        known, total, raw = {v[2]: v[1] for v in codec.automaton.values()}, 0.0, []
        for i in [*pieces, None]:
            if i in codec.byte_of:
                raw.append(codec.byte_of[i])
            else:
                total += codec.unknown_score * len(bytes(raw).decode()) + (known[i] if i is not None else 0)
                raw = []
        assert total == pytest.approx(brute(codec, text), rel=1e-14)


@pytest.mark.parametrize("seed", range(5))
def test_decode_any_ids(codec, seed):
    rng = np.random.default_rng(seed)
    some = rng.integers(3, len(codec.pieces), 60)
    some[rng.integers(0, 60, 20)] = rng.integers(3, 259, 20)
    assert codec.decode(some) == codec.library.decode(some.tolist())


def test_edge_cases(spark, codec):
    rows = [(1, None, 0), (None, "word", 0), (1, "", 1), (2, "longer " * 30000, 1), (2, "longer " * 30000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sc.round_trip(docs).collect()
    assert sorted(r.decoded_chars for r in got) == [0, 0, 4, 210000, 210000]
    assert sc.round_trip(docs.limit(0)).collect() == []


def test_memo_is_bounded():
    small = sc.Codec(sc.default_path(), memo_words=5)
    for k in range(40):
        small.ids(f"some word{k} x{k}")
        assert len(small.memo) <= 5 + 3
