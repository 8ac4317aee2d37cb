"""License scans: winnowed template fingerprints pick candidates, banded alignment measures them.

Words are runs of ASCII letters and digits, without case. A template's fingerprints are the hashes of its ``GRAM``-word
runs that are the least of ``WINNOW`` successive ones; an inverted index leads from each to the templates and places that hold it.
A text looks up every one of its own runs, so a stretch shared with a template over GRAM + WINNOW - 1 words cannot be missed. A template of at most
``SHORT`` words has all of its runs in the index, of as many words (``GRAM`` at most) as stay together wherever its words are changed or left out, as long as
enough of them are left to be reported; so no such edit is missed. It must also keep the words that tell licences apart: those of its identifier and
``TELLING`` ones, or "released under the X licence" would be a near match of every licence. Hits of one template that agree on where it would begin, within ``BAND`` words (half the template, if that is less), are a candidate;
the template is aligned with that stretch (longest common subsequence within the band) and reported when at
least ``COVERAGE`` of its words match. Of matches that overlap, the one with most matched words stays (then the higher coverage, then the first by
name).

The templates are fixed text in this package, some tens of kilobytes in each task. Texts are read once; there is no shuffle.

Defined results: null text has no matches; a document without matches has no row. Repeated rows are scanned alike. Very long texts
cost time in proportion. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_templates import TEMPLATES

GRAM = 4
WINNOW = 3
BAND = 12
COVERAGE = 0.8
SHORT = 40
#: Words that tell one licence from another.
TELLING = frozenset(
    "affero agpl apache apl artistic attribution boost bsd clause cddl commons creative domain eclipse epl eupl gnu gpl isc lesser lgpl library mit mozilla mpl noderivatives noderivs "
    "noncommercial public sharealike unlicense wtfpl zero zlib".split()
)
_WORD = re.compile(rb"[0-9a-z]+")


class Index:
    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, gram: int = GRAM, winnow: int = WINNOW):
        self.sizes: set[int] = set()
        self.vocabulary: dict[bytes, int] = {}
        self.templates: list[tuple[str, np.ndarray, set[int]]] = []
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for name, texts in templates.items():
            for text in texts:
                words = _WORD.findall(text.lower().encode())
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)
                short = len(ids) <= SHORT
                size = min(gram, unbroken(len(ids))) if short else gram
                hashes = [self.hash(ids[k : k + size]) for k in range(len(ids) - size + 1)]
                width = 1 if short else min(winnow, len(hashes))
                chosen = {min(range(k, k + width), key=lambda j: (hashes[j], -j)) for k in range(len(hashes) - width + 1)}
                for j in sorted(chosen):
                    self.places[hashes[j]].append((len(self.templates), j))
                telling = TELLING.union(re.findall("[0-9a-z]+", name.lower())) if short else ()
                self.templates.append((name, ids, {self.vocabulary[w] for w in words if w.decode() in telling}))
                self.sizes.add(size)

    @staticmethod
    def hash(ids: np.ndarray) -> int:
        return xxhash.xxh64_intdigest(ids.astype("<i8").tobytes())

    def scan(self, words: list[bytes]) -> list[tuple[str, float, int, int, int]]:
        """license, coverage, matched words, first and past-last word of each match, by place."""
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in words), np.int64, len(words))
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        starts = defaultdict(list)
        for size in self.sizes:
            runs = np.flatnonzero(known[size:] - known[:-size] == size) if len(ids) >= size else []
            for p in runs:
                for template, j in self.places.get(self.hash(ids[p : p + size]), ()):
                    starts[template].append(int(p) - j)
        found = []
        for template, begins in starts.items():
            name, own, telling = self.templates[template]
            band = min(BAND, len(own) // 2)  # a short template's repeats stay apart
            begins.sort()
            for group in np.split(begins, np.flatnonzero(np.diff(begins) > band) + 1):
                lo = max(0, int(group[0]) - band)
                part = ids[lo : int(group[-1]) + len(own) + band]
                matched, first, past = align(own, part, int(group[0]) - lo - band, int(group[-1]) - lo + band)
                if matched >= COVERAGE * len(own) and telling <= set(part[first:past].tolist()):
                    found.append((name, matched / len(own), matched, lo + first, lo + past))
        kept: list[tuple[str, float, int, int, int]] = []
        for m in sorted(found, key=lambda m: (-m[2], -m[1], m[0], m[3])):
            if all(m[4] <= k[3] or m[3] >= k[4] for k in kept):
                kept.append(m)
        return sorted(kept, key=lambda m: m[3])


def unbroken(n: int) -> int:
    """The words of the longest run that is left of ``n`` words, wherever as many are lost as ``COVERAGE`` allows."""
    left = math.ceil(COVERAGE * n)
    return max(1, math.ceil(left / (n - left + 1)))


def align(template: np.ndarray, part: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Longest common subsequence with place in part - place in template in low .. high: its length, first and past-last place in part. Of the longest, one that begins last and ends first."""
    width, none = high - low + 1, (0, 0, 0)
    row = [none] * (width + 1)  # (length, first, -past) of the best that ends at or before, by diagonal
    for i, w in enumerate(template.tolist()):
        new, left = [none] * (width + 1), none
        for d in range(width):
            j = i + low + d
            best = max(row[d + 1], left)
            if 0 <= j < len(part) and part[j] == w:
                n, first, _ = row[d]
                best = max(best, (n + 1, first if n else j, -(j + 1)))
            new[d] = left = best
        row = new
    n, first, past = max(row)
    return n, first, -past


_INDEX: list[Index] = []

SCHEMA = "doc_id long, match int, license string, coverage double, matched_words int, start_char long, end_char long"


def scan(docs: DataFrame) -> DataFrame:
    """A row for each match: doc_id, its number in the document, license, coverage, matched words, and the span of characters."""

    def each(batches):
        if not _INDEX:
            _INDEX.append(Index())
        index = _INDEX[0]
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lower = (raw or b"").lower()  # bytes: A-Z only
                matches = index.scan(_WORD.findall(lower))
                if matches:
                    spans = [m.span() for m in _WORD.finditer(lower)]
                    for k, (name, coverage, n, first, past) in enumerate(matches):
                        a, b = (len(raw[:x].decode("utf-8", "surrogatepass")) for x in (spans[first][0], spans[past - 1][1]))
                        rows.append((doc_id, k, name, coverage, n, a, b))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(each, SCHEMA)
