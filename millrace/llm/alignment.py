"""Cross-tokenizer alignment with corpus-wide pair counts by minimal perfect hashing.

Both tokenizers cover the same bytes. Where a token of A and one of B end at the same byte, the tokens are cut into groups, and every A-B pair of token occurrences of
one group is linked.

Alignment by units. A unit is a space and what follows it up to the next space between two characters that are no white space. Neither tokenizer has a token across such
a place, nor does what stands on one side change the tokens on the other (A's pre-tokeniser starts a word at the space; no piece of B has the space mark behind another
character). So a unit's tokens, groups and links are always the same, both tokenizers end at its end, and a text's are those of its units, one after another. Units are
encoded and aligned once and kept in a bounded memo; texts are gathered from it by numpy.

Counts. The first pass gives, for each task, its distinct pairs and in how many of its documents each is linked.

1. The distinct pairs are dealt by hash into segments of about ``SEGMENT_PAIRS``, and each segment gets a minimal perfect hash: at each level the pairs left are hashed
   into ``GAMMA`` places for each; those alone at their place take it, the others go on to the next level. A pair's index is the number of taken places before its own,
   over all levels. The pairs stand beside it in the order of their indices, so that a look-up can be verified.
2. The tasks' counts are summed as dense vectors that the hash indexes: for each segment a vector for every part of the rows, then the vectors of ``FAN_IN`` parts
   together, level by level, until one is left.
3. The second pass aligns the documents again and looks their pairs up. Segments lie in the shared folder and are read by tasks as they need them; a worker keeps as many as
   ``CACHE_PAIRS`` allow. Only the greatest count of each A id is given to all tasks, which the vocabulary bounds.

Defined results: texts that are null or empty, or whose tokens' bytes are not a space and the text (as where U+2581 itself stands in it), have no tokens and zeros. Equal doc_ids and
repeated rows are documents of their own, and each counts. Texts of any length are worked on whole; a text without any place to cut at is one unit. Other columns, whatever their
names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections import OrderedDict
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, sentencepiece_codec
from .common import cut

MARK = "▁"
#: Units that a worker remembers.
MEMO_UNITS = 250_000
#: Bytes of text that are worked on at once.
CHUNK_BYTES = 2 << 20
#: Units that are encoded in one call.
CALL_UNITS = 500
SEGMENT_PAIRS = 1 << 17
GAMMA = 2
FAN_IN = 16
#: Rows of the tasks' counts that go into one vector, about.
PART_ROWS = 1 << 20
#: Pairs of the segments that a worker keeps; each takes 16 bytes.
CACHE_PAIRS = 6_000_000
#: Link rows that are made at once.
SLICE_LINKS = 1 << 21
_WHITE = r"\s\x0b\x1c-\x1f\x85\p{Z}"  # every character that any of the libraries takes for white space
_CUT = regex.compile(rf"(?<=[^{_WHITE}])(?= [^{_WHITE}])")
#: A unit that begins and ends as a word does.
_PLAIN = regex.compile(rf" [^{_WHITE}](?s:.*[^{_WHITE}])?")
#: The pattern that a byte-level pre-tokeniser of this kind has.
PRE_TOKEN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_WHITE_RE2 = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: A space beside white space, or at the end; in texts without it every space but the first character is a place to cut at.
_UNEVEN = rf"{_WHITE_RE2} | {_WHITE_RE2}| \z"
_EMPTY, _SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())


class Runs:
    """Runs of values, one after another, found by number."""

    def __init__(self, dtype):
        self.values, self.used = np.zeros(1 << 16, dtype), 0
        self.starts, self.sizes, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while self.count + len(sizes) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.values[self.used : self.used + len(values)] = values
        self.starts[self.count : self.count + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.count : self.count + len(sizes)] = sizes
        self.used, self.count = self.used + len(values), self.count + len(sizes)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs' values, one after another, and their sizes."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.values[at], sizes


class Numbers:
    """Growing columns with a number for each unit."""

    def __init__(self, width: int):
        self.values, self.count = np.zeros((1 << 12, width), np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        while self.count + len(rows) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[self.count : self.count + len(rows)] = rows
        self.count += len(rows)


def sums(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Column sums between successive edges."""
    return np.diff(np.concatenate([np.zeros((1, rows.shape[1]), rows.dtype), np.cumsum(rows, axis=0)])[edges], axis=0)


def unicode_bytes() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, the others in order from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The bytes of a byte-level BPE file's tokens by id, if each merge's token has the next id, so that a lower id is an earlier merge."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte_of, vocabulary = unicode_bytes(), model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocabulary.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)):
        return None
    made = [*byte_of, *(a + b for a, b in pairs)]
    return {bytes(byte_of[c] for c in token): vocabulary[token] for token in made}


class Tokens:
    """Both tokenizers, and the bytes of their tokens. Of A the vocabulary is read from its file, and its merges are made by ``tiktoken``, whose ids are those of ``tokenizers`` and come as arrays."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        ranks = merge_ranks(path_a) if bpe.cuttable(path_a) else None
        if ranks is None:
            raise ValueError("the first tokenizer is not a byte-level BPE whose words begin at a space")
        self.a = tiktoken.Encoding("a", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("the second tokenizer has pieces that run across words")
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.bytes_a[k] = token
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)]
        self.lengths_a = np.array([len(x) for x in self.bytes_a])
        self.lengths_b = np.array([len(x) for x in self.bytes_b])
        digits = [str(k).encode() + b"," for k in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.digits = Runs(np.uint8)
        self.digits.add(np.frombuffer(b"".join(digits), np.uint8), np.array([len(d) for d in digits]))

    def encode(self, units: list[str], plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of units, one after another, and how many each unit has. Units start with a space, which B adds itself.

        Units that begin and end as a word does (all, if ``plain``) are encoded together, as if they followed each other in a text; the others alone.
        """
        alike = [plain or bool(_PLAIN.fullmatch(u)) for u in units]
        runs = [[k] for k, ok in enumerate(alike) if not ok]
        many = [k for k, ok in enumerate(alike) if ok]
        runs += [many[k : k + CALL_UNITS] for k in range(0, len(many), CALL_UNITS)]
        sizes = np.array([len(u.encode()) for u in units], np.int64)
        a, b = self._encode(units, runs)
        # Where a run's tokens are not its bytes, as where U+2581 itself stands in it, its units cannot be told apart by bytes.
        bad = [k for k, run in enumerate(runs) if len(run) > 1 and not self.lengths_a[a[k]].sum() == self.lengths_b[b[k]].sum() == sizes[run].sum()]
        if bad:
            alone = [[k] for at in bad for k in runs[at]]
            more_a, more_b = self._encode(units, alone)
            runs, a, b = ([x for k, x in enumerate(own) if k not in set(bad)] + more for own, more in ((runs, alone), (a, more_a), (b, more_b)))
        order, out = np.fromiter(chain.from_iterable(runs), np.int64, len(units)), []
        single = np.array([len(run) == 1 for run in runs])
        for found, lengths in ((a, self.lengths_a), (b, self.lengths_b)):
            counts = np.array(list(map(len, found)), np.int64)
            ids = np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int64)
            # In a run each unit's tokens end at its last byte; a unit alone has all of its run.
            edges = np.concatenate([[0], np.cumsum(lengths[ids])])
            starts = edges[np.cumsum(counts) - counts]
            within = [np.array([n]) if alone else np.searchsorted(edges, at + np.cumsum(sizes[run]), "left") - first for n, alone, at, run, first in zip(counts, single, starts, runs, np.cumsum(counts) - counts)]
            out += [ids, np.concatenate([np.zeros(0, np.int64), *(np.diff(np.concatenate([[0], w])) for w in within)]).astype(np.int64)]
        back = np.argsort(order)
        return *_reordered(out[0], out[1], back), *_reordered(out[2], out[3], back)

    def _encode(self, units: list[str], runs: list[list[int]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        texts = ["".join(map(units.__getitem__, run)) for run in runs]
        a = [self.a.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return a, [np.array(x, np.int64) for x in self.b.encode([t[1:] for t in texts], num_threads=1)]


def _reordered(values: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values in another order."""
    runs = Runs(values.dtype)
    runs.add(values, sizes)
    return runs.gather(order)


def cut_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, bool]:
    """The units of texts (strings that start with a space), one after another, the edges of each text's, and whether all units begin and end as a word does."""
    if pc.any(pc.match_substring_regex(texts, _UNEVEN)).as_py():
        found = [_CUT.split(t) for t in texts.to_pylist()]
        return pa.array([u for own in found for u in own], pa.large_string()), np.cumsum([0, *map(len, found)]), False
    split = pc.split_pattern(pc.utf8_slice_codeunits(texts, 1), " ")
    return pc.binary_join_element_wise(_EMPTY, split.flatten(), _SPACE), split.offsets.to_numpy() - split.offsets[0].as_py(), True


class Aligner:
    """Aligns units once. By unit: n_a, n_b, n_groups, n_links, valid; links as numbers of pairs with how often; with ``texts`` the groups as text too."""

    def __init__(self, path_a: str, path_b: str, memo_units: int = MEMO_UNITS):
        self.tokens, self.memo_units = Tokens(path_a, path_b), memo_units
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.pairs: dict[int, int] = {}
        self.figures = Numbers(5)
        self.links, self.often, self.texts = Runs(np.int32), Runs(np.int32), Runs(np.uint8)

        self.known: tuple[str, Known] | None = None

    def known_for(self, run: str, most: dict[int, int]) -> Known:
        """What is known of the units' counts in a run."""
        if self.known is None or self.known[0] != run:
            self.known = (run, Known(most))
        return self.known[1]

    def full(self) -> bool:
        return len(self.memo) > self.memo_units

    def numbers(self, units: pa.Array, plain: bool = False) -> np.ndarray:
        """The units' numbers; learns those not there."""
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = list(map(self.memo.get, distinct))
        if None in found:
            self._learn([u for u, x in zip(distinct, found) if x is None], plain)
            found = list(map(self.memo.__getitem__, distinct))
        return np.array(found, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]

    def _learn(self, units: list[str], plain: bool) -> None:
        t = self.tokens
        a, n_a, b, n_b = t.encode(units, plain)
        wanted = [u.encode() for u in units]
        sizes = np.array(list(map(len, wanted)), np.int64)
        ok = (sums(t.lengths_a[a][:, None], np.cumsum([0, *n_a]))[:, 0] == sizes) & (sums(t.lengths_b[b][:, None], np.cumsum([0, *n_b]))[:, 0] == sizes)
        whole = b"".join(wanted)
        if not ok.all() or b"".join(map(t.bytes_a.__getitem__, a.tolist())) != whole or b"".join(map(t.bytes_b.__getitem__, b.tolist())) != whole:
            at_a, at_b = np.cumsum([0, *n_a]), np.cumsum([0, *n_b])
            for k, u in enumerate(wanted):
                own_a, own_b = (b"".join(map(of.__getitem__, ids[at[k] : at[k + 1]].tolist())) for of, ids, at in ((t.bytes_a, a, at_a), (t.bytes_b, b, at_b)))
                ok[k] = own_a == u == own_b
        del whole, wanted
        a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
        n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)
        ends_a, ends_b = np.cumsum(t.lengths_a[a]), np.cumsum(t.lengths_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        unit_of = np.repeat(np.arange(len(units)), n_a)
        group_unit = np.zeros(len(ends), np.int64)
        group_unit[group_a] = unit_of
        groups = np.bincount(group_unit, minlength=len(units)) if len(ends) else np.zeros(len(units), np.int64)
        links = np.zeros(len(units), np.int64)
        np.add.at(links, group_unit, in_a * in_b)
        self.figures.add(np.stack([n_a, n_b, groups, links, ok.astype(np.int64)], axis=1))
        pairs, often, per_group = self._links(a, b, group_a, group_b, len(ends))
        per_unit = np.zeros(len(units), np.int64)
        np.add.at(per_unit, group_unit, per_group)
        distinct, place = np.unique(pairs, return_inverse=True)
        numbered = np.array([self.pairs.setdefault(p, len(self.pairs)) for p in distinct.tolist()], np.int64)
        self.links.add(numbered[place], per_unit)
        self.often.add(often, per_unit)
        self.texts.add(*self._texts(a, b, group_a, group_b, in_a, in_b, group_unit, len(units)))
        self.memo.update(zip(units, range(len(self.memo), len(self.memo) + len(units))))

    @staticmethod
    def _links(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The groups' distinct pairs (an A id in the upper half, a B id in the lower), how often each is linked there, and how many a group has."""
        own_a, often_a = np.unique(group_a << 32 | a, return_counts=True)
        own_b, often_b = np.unique(group_b << 32 | b, return_counts=True)
        n_b = np.bincount(own_b >> 32, minlength=groups)
        first_b = np.cumsum(n_b) - n_b
        group = own_a >> 32
        times = n_b[group]
        per_group = np.bincount(group, weights=times, minlength=groups).astype(np.int64)
        pairs, often = [], []
        edges = np.cumsum(np.concatenate([[0], times]))
        k = 0
        while k < len(own_a):  # a slice has SLICE_LINKS rows, or those of one A token
            upto = max(k + 1, int(np.searchsorted(edges, edges[k] + SLICE_LINKS, "right")) - 1)
            some = slice(k, upto)
            at = np.repeat(first_b[group[some]] - (edges[k:upto] - edges[k]), times[some])
            at += np.arange(len(at))
            pairs.append(np.repeat(own_a[some] & 0xFFFFFFFF, times[some]) << 32 | own_b[at] & 0xFFFFFFFF)
            often.append(np.repeat(often_a[some], times[some]) * often_b[at])
            k = upto
        nothing = np.zeros(0, np.int64)
        return np.concatenate([nothing, *pairs]), np.concatenate([nothing, *often]), per_group

    def _texts(self, a, b, group_a, group_b, in_a, in_b, group_unit, units: int) -> tuple[np.ndarray, np.ndarray]:
        """The groups of the units as text, ``a1,a2|b1;``, one after another, and the units' sizes."""
        ids = np.zeros(len(a) + len(b), np.int64)
        before_b = np.cumsum(in_b) - in_b
        ids[np.arange(len(a)) + before_b[group_a]] = a
        ids[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b
        chars, sizes = self.tokens.digits.gather(ids)
        ends = np.cumsum(sizes)
        last_b = np.cumsum(in_a + in_b) - 1
        chars[ends[last_b - in_b] - 1] = ord("|")
        chars[ends[last_b] - 1] = ord(";")
        per_unit = np.zeros(units, np.int64)
        group_sizes = np.diff(np.concatenate([[0], ends[last_b]]))
        np.add.at(per_unit, group_unit, group_sizes)
        return chars, per_unit

    def chunks(self, texts: pa.Array):
        """Texts a chunk at a time: the first one's place, the numbers of all units, and the edges of each text's; null and empty texts have none."""
        texts = texts.cast(pa.large_string())
        edges = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
        k = 0
        while k < len(texts):
            upto = max(k + 1, int(np.searchsorted(edges, edges[k] + CHUNK_BYTES, "right")) - 1)
            some = texts.slice(k, upto - k)
            there = pc.fill_null(pc.greater(pc.binary_length(some), 0), False)
            spaced = pc.binary_join_element_wise(_EMPTY, some.filter(there), _SPACE)
            units, cuts, plain = cut_units(spaced)
            counts = np.zeros(len(some), np.int64)
            counts[there.to_numpy(zero_copy_only=False)] = np.diff(cuts)
            yield k, self.numbers(units, plain), np.concatenate([[0], np.cumsum(counts)])
            k = upto

    def valid(self, numbers: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Whether each text has tokens: it has units, and the bytes of all of them agree."""
        bad = 1 - self.figures.values[numbers, 4:5]
        return (sums(bad, edges)[:, 0] == 0) & (np.diff(edges) > 0)


class Known:
    """Corpus-wide counts of an aligner's pairs, and by unit: n_best, count_sum, and links without a count."""

    def __init__(self, most: dict[int, int]):
        self.most = np.zeros(max(most, default=0) + 1, np.int64)
        self.most[np.fromiter(most, np.int64, len(most))] = np.fromiter(most.values(), np.int64, len(most))
        self.ids, self.counts, self.sums = np.zeros(0, np.int64), np.zeros(0, np.int64), Numbers(3)

    def learn(self, own: Aligner, look: Counts) -> None:
        if len(own.pairs) > len(self.counts):
            pairs = np.fromiter(own.pairs, np.int64, len(own.pairs))
            self.ids, self.counts = np.minimum(pairs >> 32, len(self.most) - 1), np.concatenate([self.counts, look.of(pairs[len(self.counts) :])])
        if len(own.memo) > self.sums.count:
            units = np.arange(self.sums.count, len(own.memo))
            links, sizes = own.links.gather(units)
            often, _ = own.often.gather(units)
            counts = self.counts[links]
            rows = np.stack([np.where(counts == self.most[self.ids[links]], often, 0), counts * often, np.where(counts == 0, often, 0)], axis=1)
            self.sums.add(sums(rows, np.cumsum(np.concatenate([[0], sizes]))))


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(*parameters) -> Aligner:
    if parameters not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[parameters] = Aligner(*parameters)
    return _ALIGNERS[parameters]


# The minimal perfect hash.


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of 64-bit keys."""
    h = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


class PerfectHash:
    """Levels of bits; a key's index is the number of set bits before the one that it alone set."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [np.cumsum(x) - x for x in levels]
        self.offsets = np.cumsum([0, *(int(x.sum()) for x in levels)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        levels = []
        while len(keys):
            at = mixed(keys, len(levels)) % np.uint64(GAMMA * len(keys))
            alone = np.bincount(at.astype(np.int64), minlength=GAMMA * len(keys)) == 1
            levels.append(alone)
            keys = keys[~alone[at.astype(np.int64)]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Indices of keys; of others any index, or -1."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (mixed(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            found[left[hit]] = self.offsets[k] + self.before[k][at[hit]]
            left = left[~hit]
        return found

    def to_bytes(self) -> bytes:
        return b"".join(len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        levels, at = [], 0
        while at < len(raw):
            n = int.from_bytes(raw[at : at + 8], "little")
            size = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, size, at + 8), count=n).astype(bool))
            at += 8 + size
        return cls(levels)


class Segment:
    def __init__(self, hashed: bytes, keys: bytes, counts: bytes | None = None):
        self.hash, self.keys = PerfectHash.from_bytes(hashed), np.frombuffer(keys, "<i8")
        self.counts = np.frombuffer(counts, "<i8") if counts is not None else None

    def places(self, pairs: np.ndarray) -> np.ndarray:
        """The pairs' indices, verified against the keys; -1 for those that are none."""
        at = self.hash.index(pairs)
        return np.where(self.keys[at] == pairs, at, -1)


def segment_of(pairs: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(pairs, -2) % np.uint64(segments)).astype(np.int64)


class Counts:
    """Looks counts up in the segments of the shared folder; keeps those used last."""

    def __init__(self, paths: dict[int, str], segments: int):
        self.paths, self.segments, self.kept, self.held = paths, segments, OrderedDict(), 0

    def _segment(self, k: int) -> Segment:
        if k in self.kept:
            self.kept.move_to_end(k)
            return self.kept[k]
        fs, at = pa.fs.FileSystem.from_uri(self.paths[k])
        row = pq.read_table(at, filesystem=fs, filters=[("segment", "==", k)], columns=["hashed", "pairs", "counts"])
        found = Segment(*(row.column(c)[0].as_py() for c in ("hashed", "pairs", "counts")))
        self.kept[k] = found
        self.held += len(found.keys)
        while self.held > CACHE_PAIRS and len(self.kept) > 1:
            self.held -= len(self.kept.popitem(last=False)[1].keys)
        return found

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """The pairs' counts; zero for those that no document was counted for."""
        own, found = segment_of(pairs, self.segments), np.zeros(len(pairs), np.int64)
        order = np.argsort(own, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(own[order])) + 1) if len(order) else []:
            if int(own[some[0]]) in self.paths:
                segment = self._segment(int(own[some[0]]))
                at = segment.places(pairs[some])
                found[some] = np.where(at < 0, 0, segment.counts[at])
        return found


# The passes.


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def counted(docs: DataFrame, paths: tuple[str, str], memo_units: int = MEMO_UNITS) -> DataFrame:
    """pair, n: how many of a task's documents link it; a pair has a row for each task, or several."""

    def each(batches):
        own = aligner(*paths, memo_units)
        counts = np.zeros(0, np.int64)

        def found():
            pairs = np.fromiter(own.pairs, np.int64, len(own.pairs))[: len(counts)]
            some = np.flatnonzero(counts)
            for k in range(0, len(some), 1 << 17):
                at = some[k : k + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[at]), pa.array(counts[at])], ["pair", "n"])

        for batch in batches:
            for _, numbers, edges in own.chunks(batch.column("text")):
                per_text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
                good = np.repeat(own.valid(numbers, edges), np.diff(edges))
                links, sizes = own.links.gather(numbers[good])
                distinct = np.unique(np.repeat(per_text[good], sizes) << 40 | links) & (1 << 40) - 1
                more = np.bincount(distinct, minlength=len(own.pairs))
                more[: len(counts)] += counts
                counts = more
                if own.full():
                    yield from found()
                    own.forget()
                    counts = np.zeros(0, np.int64)
        yield from found()

    return cut(_texts(docs).mapInArrow(each, "pair long, n long"), "counted")


def _segment_column(segments: int):
    @F.pandas_udf("long")
    def of(pairs):
        import pandas as pd

        return pd.Series(segment_of(pairs.to_numpy(), segments))

    return of("pair")


def hashed(pairs: DataFrame) -> DataFrame:
    """segment, hashed, pairs: the segments' hashes, and their pairs in the order of the indices. ``pairs``: segment, pair, distinct."""

    def build(key, table):
        keys = table.column("pair").to_numpy()
        made = PerfectHash.build(keys)
        placed = np.zeros(len(keys), "<i8")
        placed[made.index(keys)] = keys
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "hashed": [made.to_bytes()], "pairs": [placed.tobytes()]})

    return pairs.groupBy("segment").applyInArrow(build, "segment long, hashed binary, pairs binary")


def summed(rows: DataFrame, tables: DataFrame, parts: int) -> DataFrame:
    """segment, counts: the tree sum of dense vectors. ``rows``: segment, pair, n; ``tables`` as from ``hashed``, written."""

    def dense(key, counts, table):
        if not len(table) or not len(counts):
            return pa.table({"segment": pa.array([], pa.int64()), "part": pa.array([], pa.int64()), "counts": pa.array([], pa.binary())})
        own = Segment(table.column("hashed")[0].as_py(), table.column("pairs")[0].as_py())
        vector = np.zeros(len(own.keys), "<i8")
        at = own.places(counts.column("pair").to_numpy())
        if at.min() < 0:
            raise KeyError("a pair is not among those of its segment")
        np.add.at(vector, at, counts.column("n").to_numpy())
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": [vector.tobytes()]})

    def add(key, table):
        vector = sum(np.frombuffer(x.as_py(), "<i8") for x in table.column("counts"))
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int64()), "counts": [vector.astype("<i8").tobytes()]})

    shape = "segment long, part long, counts binary"
    dealt = rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts))).groupBy("segment", "part")
    everywhere = tables.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))).groupBy("segment", "part")
    vectors = dealt.cogroup(everywhere).applyInArrow(dense, shape)
    while parts > 1:
        vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("segment", "part").applyInArrow(add, shape)
        parts = -(-parts // FAN_IN)
    return vectors.select("segment", "counts")


def corpus_counts(docs: DataFrame, paths: tuple[str, str], memo_units: int = MEMO_UNITS, segment_pairs: int = SEGMENT_PAIRS, part_rows: int = PART_ROWS) -> tuple[DataFrame, int]:
    """segment, hashed, pairs, counts: a written table with all pairs' counts; and the number of segments."""
    rows = counted(docs, paths, memo_units)
    n, distinct = rows.agg(F.count(F.lit(1)), F.approx_count_distinct("pair", 0.02)).first()
    segments = max(1, -(-distinct // segment_pairs))
    rows = cut(rows.withColumn("segment", _segment_column(segments)), "rows")
    tables = cut(hashed(rows.select("segment", "pair").distinct()), "hashed")
    vectors = summed(rows, tables, max(1, -(-n // (segments * part_rows))))
    return cut(tables.join(vectors, "segment"), "segments"), segments


def greatest(counts: DataFrame) -> dict[int, int]:
    """The greatest count of each A id: as many as A's vocabulary has at most."""

    def each(batches):
        for batch in batches:
            for pairs, own in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                ids = np.frombuffer(pairs, "<i8") >> 32
                order = np.argsort(ids, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) > 0]))
                most = np.maximum.reduceat(np.frombuffer(own, "<i8")[order], first)
                yield pa.RecordBatch.from_arrays([pa.array(ids[order][first]), pa.array(most)], ["a", "n"])

    rows = counts.select("pairs", "counts").mapInArrow(each, "a long, n long").groupBy("a").agg(F.max("n").alias("n"))
    return dict(map(tuple, rows.collect()))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, memo_units: int = MEMO_UNITS, segment_pairs: int = SEGMENT_PAIRS, part_rows: int = PART_ROWS) -> DataFrame:
    """A row for each document: the columns of RESULT."""
    paths = (path_a or bpe.default_path(), path_b or sentencepiece_codec.default_path())
    counts, segments = corpus_counts(docs, paths, memo_units, segment_pairs, part_rows)
    places = {r[0]: r[1] for r in counts.select("segment", F.input_file_name()).collect()}  # a row for each segment
    most = greatest(counts)

    def each(batches):
        own, look = aligner(*paths, memo_units), Counts(places, segments)
        known = own.known_for(places.get(0, ""), most)
        for batch in batches:
            for k, numbers, edges in own.chunks(batch.column("text")):
                known.learn(own, look)
                good = own.valid(numbers, edges)
                figures = sums(np.concatenate([own.figures.values[numbers, :4], known.sums.values[numbers]], axis=1), edges) * good[:, None]
                if figures[:, 6].any():
                    raise KeyError("a document has a pair that was not counted")
                chars, sizes = own.texts.gather(numbers)
                ends = np.concatenate([[0], np.cumsum(sizes)])[edges]
                raw = memoryview(chars.tobytes())
                digests = [hashlib.sha256(raw[x : y - 1]).hexdigest() if ok else "" for x, y, ok in zip(ends[:-1], ends[1:], good)]
                columns = [batch.column("doc_id").slice(k, len(edges) - 1), *map(pa.array, figures[:, :6].T.copy()), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])
                if own.full():
                    own.forget()
                    known = own.known_for(places.get(0, ""), most)

    return _texts(docs).mapInArrow(each, RESULT)

