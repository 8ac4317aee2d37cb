"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives Viterbi.

The automaton reads a text once. At each position its output links give every piece that ends there, the
longest first, and each relaxes the best score of that position. A character that no piece covers alone may
be unknown, at the lowest score less ten; an unknown character becomes its UTF-8 bytes where the model has byte pieces.
Equal scores keep the longest piece, as the library does. Scores are summed in double precision.

That is the unigram method. It runs on any model's pieces and scores; for a model whose file says
``unigram`` its ids are the library's best. piece_bpe_32k.model says ``bpe``: its library ids come from merges, and
those of this codec are the best-scoring segmentation instead (the first path of the library's n-best lattice when
the file's type is set to unigram; the tests compare with that). Both decode to the same text.

Where no piece goes from a character into a following word mark, as in that model, words are independent and a
bounded memo keeps those seen.

Defined results: null text encodes as empty. Texts may hold anything; the mark U+2581 itself decodes as a space, as
in the library. Repeated rows are encoded alike. An empty table gives an empty result.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_WORDS = 300_000
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
# The piece types of the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.prefix = model.normalizer_spec.add_dummy_prefix
        pieces = [(p.piece, p.score, p.type) for p in model.pieces]
        self.pieces = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        normal = [s for _, s, k in pieces if k == NORMAL]
        self.unknown_score = min(normal) - UNKNOWN_PENALTY
        self.unknown_id = next(i for i, k in enumerate(self.kinds) if k == UNKNOWN)
        self.bytes_ids = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes_ids.items()}
        self.automaton = ahocorasick.Automaton()
        for i, (p, score, kind) in enumerate(pieces):
            if kind in (NORMAL, USER_DEFINED):
                self.automaton.add_word(p, (len(p), len(p) * max(normal) - 0.1 if kind == USER_DEFINED else score, i))
        self.automaton.make_automaton()
        self.by_word = not any(MARK in p.lstrip(MARK) for p, _, k in pieces if k in (NORMAL, USER_DEFINED))
        self.memo_words, self.memo = memo_words, {}

    def best(self, text: str) -> list[int]:
        """Ids of the best segmentation of normalised text."""
        n = len(text)
        score, piece, start = [0.0] + [float("-inf")] * n, [self.unknown_id] * (n + 1), [0] * (n + 1)
        at, single = 0, True  # the position being relaxed, and whether a piece of one character ends there

        def unknown(upto: int) -> None:
            nonlocal at, single
            while at < upto:
                if not single and (s := score[at - 1] + self.unknown_score) > score[at]:
                    score[at], piece[at], start[at] = s, self.unknown_id, at - 1
                at, single = at + 1, False

        for last, (length, gain, i) in self.automaton.iter(text):
            if last + 1 > at:
                unknown(last + 1)
            if length == 1:
                single = True
            if (s := score[at - length] + gain) > score[at]:
                score[at], piece[at], start[at] = s, i, at - length
        unknown(n + 1)
        out = []
        while n:
            i = piece[n]
            if i == self.unknown_id and self.bytes_ids:
                out.extend(self.bytes_ids[b] for b in reversed(text[start[n] : n].encode("utf-8", "surrogatepass")))
            else:
                out.append(i)
            n = start[n]
        return out[::-1]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        text = self.library.normalize(text) if text else ""
        words = _WORDS.findall(text) if self.by_word else [text]
        found = list(map(self.memo.get, words))
        if None in found:
            if len(self.memo) > self.memo_words:
                self.memo.clear()
            for w in dict.fromkeys(words):
                if w not in self.memo:
                    self.memo[w] = np.array(self.best(w), "<u4").tobytes()
            found = map(self.memo.__getitem__, words)
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: byte pieces are UTF-8 (bytes that are not become U+FFFD each), marks are spaces, the prefix mark goes."""
        out, raw = [], bytearray()
        for i in ids.tolist():
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw.clear()
            kind = self.kinds[i]
            out.append("" if kind == CONTROL else " ⁇ " if kind == UNKNOWN else self.pieces[i])
        if raw:
            out.append(_utf8(bytes(raw)))
        text = "".join(out)
        if self.prefix and text.startswith(MARK):
            text = text[1:]
        return text.replace(MARK, " ")


def _utf8(raw: bytes) -> str:
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode() + "�")
            raw = raw[e.start + 1 :]
    return "".join(out)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One for each Python worker and file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit)."""
    path = path or default_path()

    def each(batches):
        c = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.ids(t or "") for t in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, text."""
    path = path or default_path()

    def each(batches):
        c = codec(path)
        for batch in batches:
            texts = [c.decode(np.frombuffer(x, "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(each, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, decoded_chars, decoded_sha256: each document encoded, then decoded from its ids."""
    back = decode(encode(docs, path), path)
    return back.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.char_length("text").cast("long").alias("decoded_chars"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
