"""Quality rules: base counts and compression bands.

Base counts are exact counts over the whole text. A text that passes the base rules is compressed by
zstandard, whole and in fixed chunks; compressed size / size must lie in a band that depends on the length,
since short texts compress badly whatever they say. Below the band a text repeats itself; above
it, it is noise (such as encoded binary data). A text is rejected when its whole ratio, or over
``CHUNK_SHARE`` of its chunks, lies outside. A last chunk below ``LEAST_CHUNK`` bytes is joined to
the one before. Texts below ``CHUNK`` bytes are their own only chunk.

The upper limits lie 0.01 to 0.02 below the least ratio of base64 (six bits a byte: about 0.74, and more for shorter texts because of
frame and table) at the band's far end, in lines or in words down to eight characters; labelled good documents lie below them. Under 128 bytes
noise and prose are both stored raw, so no limit parts them, nor does one part encodings of four bits a byte (hex) from prose.

Defined results: null text has no words and fails the base rules. Repeated rows and doc_ids are judged one by one. Very long texts
cost time in proportion. ``measure`` ignores other columns, ``keep`` carries them, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES

#: From so many bytes on: lowest and highest ratio of the whole text; lowest and highest of a chunk.
BANDS = (
    (0, 0.00, 99.0, 0.00, 99.0),
    (64, 0.40, 1.25, 0.40, 1.25),
    (128, 0.40, 0.945, 0.40, 0.945),
    (160, 0.40, 0.92, 0.40, 0.92),
    (192, 0.40, 0.895, 0.40, 0.895),
    (224, 0.40, 0.875, 0.40, 0.875),
    (256, 0.35, 0.865, 0.35, 0.865),
    (320, 0.35, 0.84, 0.35, 0.84),
    (384, 0.35, 0.81, 0.35, 0.81),
    (512, 0.35, 0.79, 0.35, 0.79),
    (640, 0.35, 0.775, 0.35, 0.775),
    (768, 0.35, 0.76, 0.35, 0.76),
    (1024, 0.30, 0.745, 0.30, 0.745),
    (1536, 0.30, 0.735, 0.30, 0.735),
    (2560, 0.30, 0.725, 0.30, 0.725),
    (4096, 0.25, 0.72, 0.25, 0.72),
    (65536, 0.18, 0.72, 0.25, 0.72),
)
LEVEL = 3
CHUNK = 4096
LEAST_CHUNK = 1024
CHUNK_SHARE = 0.2
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, first occurrences included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    windows = list(map(joined.__getitem__, map(slice, starts[:n].tolist(), stops[window - 1 :].tolist())))
    if len(set(windows)) == n:
        return 0
    times = Counter(windows)
    again = np.fromiter((times[w] > 1 for w in windows), np.int64, n)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += again
    edges[window : window + n] -= again
    return int((np.cumsum(edges)[:-1] > 0).sum())


def base(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = raw.split()
    chars = len(raw.decode("utf-8", "surrogatepass")) - sum(raw.count(c) for c in SPACES)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def ratios(raw: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    parts = [raw[k : k + CHUNK] for k in range(0, len(raw), CHUNK)]
    if len(parts) > 1 and len(parts[-1]) < LEAST_CHUNK:
        rest = parts.pop()
        parts[-1] += rest
    return len(compressor.compress(raw)) / len(raw), [len(compressor.compress(p)) / len(p) for p in parts]


def verdict(raw: bytes, compressor: zstandard.ZstdCompressor) -> tuple[bool, float, float]:
    """Kept by the bands, ratio of the whole, share of chunks outside theirs."""
    band = next(b for b in reversed(BANDS) if len(raw) >= b[0])
    whole, chunks = ratios(raw, compressor)
    outside = sum(not band[3] <= r <= band[4] for r in chunks) / len(chunks) if chunks else 0.0
    return band[1] <= whole <= band[2] and outside <= CHUNK_SHARE, whole, outside


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, whole_ratio double, chunks_outside double"


def measure(docs: DataFrame) -> DataFrame:
    """A row for each document: the base counts, the verdict, and the ratios (null where the base rules decide)."""

    def each(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = base(raw or b"")
                bad = failed(counts[0], counts[4])
                rows.append((doc_id, *counts, bad, *((False, None, None) if bad else verdict(raw, compressor))))
            yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(each, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 2
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 10, kinds)], names)


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns; one pass, no shuffle."""

    def each(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            stay = []
            for text in texts:
                raw = (text or "").encode()
                counts = base(raw)
                stay.append(not failed(counts[0], counts[4]) and verdict(raw, compressor)[0])
            yield batch.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
