"""Byte-level BPE ids by the ``tokenizers`` library, with a bounded memo for repeated words.

Under the pre-tokeniser of byte_bpe_50k.json a token never runs across the place before a space that
a non-space follows, and what stands on one side of it does not change the ids on the other. So texts are cut there into
parts (by Arrow, many texts at once), and only parts not met before are encoded. Those are cut further into
pre-tokens (word, number, marks, white space), since a new word often stands beside known marks; new pre-tokens
are encoded together, in one call, and told apart by the tokens that start with a space.

The ids of parts lie in one array, and those of a text are gathered from it by numpy. Whether a tokenizer
file has this pre-tokeniser is read from the file; with any other one each text is encoded whole, by the library alone.
"""

from __future__ import annotations

import json
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

END_ID = 0
MEMO_PARTS = 700_000
#: Bytes of text that are cut up at once.
CHUNK_BYTES = 8 << 20
#: Words and marks in one call of the library, which holds about 100 bytes for each of their tokens.
CALL_TOKENS = 20_000
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"  # every character that any of the libraries takes for white space
#: A space in a longer run of white space; other spaces can be cut at without a look at what follows.
_RUN = f"{_SPACE} (?:{_SPACE}|\\z)"
_CUT = re.compile(r" (?=\S)")
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters whose classes are the same in every version of Unicode that the libraries may have.
LAST_STABLE = "ɏ"
_STABLE = re.compile(f"[\t\n\r\x20-\x7e\xa1-{LAST_STABLE}]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cuttable(path: str) -> bool:
    """Whether the file's tokenizer is the one that the cuts are right for."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pre, model = d.get("pre_tokenizer") or {}, d["model"]
    return (
        d.get("normalizer") is None
        and d.get("post_processor") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in d.get("added_tokens", []))
    )


class Pool:
    """Runs of ids, one after another, found by number."""

    def __init__(self):
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0
        self.starts, self.sizes, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """The number of the first of the runs added."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(sizes) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        first = self.count
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[first : first + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first : first + len(sizes)] = sizes
        self.used, self.count = self.used + len(ids), first + len(sizes)
        return first

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs' ids, one after another, and their sizes."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.ids[at], sizes


def totals(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of the values between successive edges."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[edges])


class Encoder:
    def __init__(self, path: str, memo_parts: int = MEMO_PARTS, chunk_bytes: int = CHUNK_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.memo_parts, self.chunk_bytes = memo_parts, chunk_bytes
        self.cuttable = cuttable(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = "".join(c for c in string.punctuation if not any(c in a for a in self.added))
        self.spaced_id = np.zeros(self.vocabulary, bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.spaced_id[k] = token.startswith("Ġ")  # how this kind of file writes a space
        self._forget()

    def _forget(self) -> None:
        self.pool = Pool()
        self.end = self.pool.add(np.array([END_ID], "<u4"), np.array([1]))
        #: Numbers in the pool, by part: those that follow a space, and those that do not.
        self.after_space: dict[str, int] = {}
        self.bare: dict[str, int] = {}

    def runs(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Texts (strings without nulls) a run at a time, of ``chunk_bytes`` or of one text: the first one's place, all ids, each text's with the end id, and the edges of each."""
        texts = texts.cast(pa.large_string())
        edges = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
        k = 0
        while k < len(texts):
            upto = max(k + 1, int(np.searchsorted(edges, edges[k] + self.chunk_bytes, "right")) - 1)
            run = texts.slice(k, upto - k)
            yield k, *(self._cut(run) if self.cuttable else self._whole(run.to_pylist()))
            k = upto

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with the end id, and the edges of each text's ids."""
        found = [(ids, np.diff(edges)) for _, ids, edges in self.runs(texts)]
        return np.concatenate([np.zeros(0, "<u4"), *(f[0] for f in found)]), np.cumsum(np.concatenate([[0], *(f[1] for f in found)]), dtype=np.int64)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [[*self.tokenizer.encode(t, add_special_tokens=False).ids, END_ID] for t in texts]
        return np.fromiter((x for f in found for x in f), "<u4"), np.cumsum([0, *map(len, found)])

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.after_space) + len(self.bare) > self.memo_parts:
            self._forget()
        if pc.any(pc.match_substring_regex(texts, _RUN)).as_py():
            cut = pa.array([_CUT.split(t) for t in texts.to_pylist()], pa.large_list(pa.large_string()))
        else:
            cut = pc.split_pattern(texts, " ")
        edges = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        parts = cut.flatten().dictionary_encode()
        numbers = self._numbers(parts.dictionary.to_pylist(), self.after_space, " ")[parts.indices.to_numpy()]
        first = parts.take(pa.array(edges[:-1])).cast(pa.large_string()).to_pylist()
        numbers[edges[:-1]] = self._numbers(first, self.bare, "")
        numbers = np.insert(numbers, edges[1:], self.end)
        ids, sizes = self.pool.gather(numbers)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[edges + np.arange(len(edges))]

    def _numbers(self, parts: list[str], memo: dict[str, int], before: str) -> np.ndarray:
        """The parts' numbers in the pool; learns those not there."""
        found = list(map(memo.get, parts))
        if None in found:
            self._learn(list(dict.fromkeys(p for p, x in zip(parts, found) if x is None)), memo, before)
            found = list(map(memo.__getitem__, parts))
        return np.array(found, np.int64)

    def _learn(self, parts: list[str], memo: dict[str, int], before: str) -> None:
        """Put parts into the memo: a word with marks behind it, as most are, is cut by string methods, others by the pre-tokeniser's pattern."""
        words, tails, other = [], [], []
        for p in parts:
            word = p.rstrip(self.marks)
            if word.isalpha() and word[-1] <= LAST_STABLE:
                words.append(word)
                tails.append(p[len(word) :])
            else:
                other.append(p)
        self._encode(dict.fromkeys(w for w in words if w not in memo), memo, before)
        self._encode([t for t in set(tails) if t not in self.bare], self.bare, "")
        marked = [k for k, t in enumerate(tails) if t]
        pairs = np.empty((len(marked), 2), np.int64)
        pairs[:, 0] = [memo[words[k]] for k in marked]
        pairs[:, 1] = [self.bare[tails[k]] for k in marked]
        self._compose([words[k] + tails[k] for k in marked], memo, pairs.reshape(-1), np.arange(0, 2 * len(marked) + 1, 2))

        cut = [_PRE_TOKEN.findall(before + p) if _STABLE.fullmatch(p) and not any(a in p for a in self.added) else [before + p] for p in other]
        tokens = {t for own in cut for t in own}
        spaced = {t[1:] for t in tokens if t[:1] == " "}
        self._encode([t for t in spaced if t not in self.after_space], self.after_space, " ")
        self._encode([t for t in tokens if t[:1] != " " and t not in self.bare], self.bare, "")
        numbers = np.array([self.after_space[t[1:]] if t[:1] == " " else self.bare[t] for own in cut for t in own], np.int64)
        self._compose(other, memo, numbers, np.cumsum([0, *map(len, cut)]))

    def _compose(self, parts: list[str], memo: dict[str, int], numbers: np.ndarray, edges: np.ndarray) -> None:
        """Put parts into the memo whose ids are those of pre-tokens, one after another."""
        ids, sizes = self.pool.gather(numbers)
        first = self.pool.add(ids, totals(sizes, edges))
        memo.update(zip(parts, range(first, first + len(parts))))

    def _encode(self, tokens, memo: dict[str, int], before: str) -> None:
        """Encode pre-tokens, or parts that are not cut further, and put them into the memo."""
        tokens = list(tokens)
        if before:  # words after a space are told apart by it; what is or holds white space is encoded alone
            alone = [t for t in tokens if not t or not t.isalpha() and re.search(r"\s", t)]
            if alone:
                rest = set(alone)
                tokens = [t for t in tokens if t not in rest]
            for k in range(0, len(tokens), CALL_TOKENS):
                some = tokens[k : k + CALL_TOKENS]
                ids = np.asarray(self.tokenizer.encode(before + before.join(some), add_special_tokens=False).ids, dtype="<u4")
                begin = np.flatnonzero(self.spaced_id[ids])
                if len(begin) != len(some):
                    raise ValueError("tokens that start with a space do not part the words")
                first = self.pool.add(ids, np.diff(np.append(begin, len(ids))))
                memo.update(zip(some, range(first, first + len(some))))
            tokens = alone
        for k in range(0, len(tokens), CALL_TOKENS):
            some = tokens[k : k + CALL_TOKENS]
            found = [e.ids for e in self.tokenizer.encode_batch_fast([before + t for t in some], add_special_tokens=False)]
            first = self.pool.add(np.fromiter((x for f in found for x in f), "<u4"), np.fromiter(map(len, found), np.int64, len(found)))
            memo.update(zip(some, range(first, first + len(some))))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*parameters) -> Encoder:
    """One for each Python worker and set of parameters; a part of the memo takes about 250 bytes."""
    if parameters not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[parameters] = Encoder(*parameters)
    return _ENCODERS[parameters]
