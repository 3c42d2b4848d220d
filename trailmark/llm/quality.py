"""Quality rules: repetition counts and bands of compression ratios.

`quality_rules` judges each text by itself. Incompressible text (keys, noise, encoded data) has a low ratio of bytes to
zstandard bytes, repetitive text a high one. What is normal depends on the length, so the limits are given per length
band; fixed chunks catch a repetitive or incompressible part of a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.text import IS_SPACE, row_sums, text_bytes, text_slices, windows_of, words_of

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


class Band(NamedTuple):
    min_bytes: int
    low: float  # below: incompressible
    high: float  # above: repetitive


# up to 255 bytes keys and noise of 50 words and more measure at most 1.2, but for one in a hundred, prose 1.24 and more
BANDS = (Band(0, 1.2, 4.5), Band(256, 1.05, 4.5), Band(1024, 1.25, 6.0), Band(4096, 1.4, 8.0), Band(16384, 1.5, 12.0))
CHUNK_FROM = 4096  # texts from so many bytes on are judged by chunks as well
# text bytes, chunk bytes and limits: base64 measures at most 1.27 in chunks of 1024 bytes and 1.31 in those of 2048
CHUNKS = ((CHUNK_FROM, Band(1024, 1.3, 6.0)), (8192, Band(2048, 1.35, 7.0)))
BAD_CHUNK_SHARE = 0.1  # of the bytes
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long"
)


def band_of(size: int) -> Band:
    return max(b for b in BANDS if size >= b.min_bytes)


def compression(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, its chunks, those outside their band, and the verdict.

    The last chunk reaches back, so that every byte is judged in a chunk of full size.
    """
    band = band_of(len(data))
    ratio = len(data) / len(compressor.compress(data))
    chunks = bad = bad_bytes = 0
    if len(data) >= CHUNK_FROM:
        limits = max(x for x in CHUNKS if len(data) >= x[0])[1]
        size = limits.min_bytes
        for at in range(0, len(data), size):
            first = min(at, len(data) - size)
            part = size / len(compressor.compress(data[first : first + size]))
            chunks += 1
            if not limits.low <= part <= limits.high:
                bad += 1
                bad_bytes += first + size - at
    return ratio, chunks, bad, band.low <= ratio <= band.high and bad_bytes <= BAD_CHUNK_SHARE * len(data)


def repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated_words(words, n_rows: int, n: int = 3) -> np.ndarray:
    """Words per row that lie in a window of n words found twice or more in the same text."""
    first, hashes = windows_of(words, n)
    hashes = hashes + words.rows[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ordered = np.sort(hashes)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(words.rows), bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
        starts = first[twice[at] == hashes]
        for k in range(n):
            covered[starts + k] = True
    return np.bincount(words.rows[covered], minlength=n_rows)


def _judged(part: pa.RecordBatch, compressor: zstandard.ZstdCompressor) -> list[pa.Array]:
    """The columns after doc_id."""
    data, offsets = text_bytes(part.column("text"))
    words, n = words_of(data, offsets), part.num_rows
    n_words = np.bincount(words.rows, minlength=n)
    repeats = repeated_words(words, n)
    raw = data.tobytes()
    texts = [raw[offsets[i] : offsets[i + 1]] for i in range(n)]
    found = [compression(x, compressor) for x in texts]
    failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    return [
        pa.array(n_words, pa.int64()),
        pa.array(row_sums(~IS_SPACE[data] & (data & 0xC0 != 0x80), offsets), pa.int64()),
        pa.array(row_sums(SYMBOLS[data], offsets), pa.int64()),
        pa.array([repeated_lines(x.decode()) for x in texts], pa.int64()),
        pa.array(repeats, pa.int64()),
        pa.array(failed),
        pa.array(~failed & np.array([x[3] for x in found], bool)),
        pa.array([x[0] for x in found], pa.float64()),
        pa.array([x[1] for x in found], pa.int64()),
        pa.array([x[2] for x in found], pa.int64()),
    ]


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        for part in text_slices(batch):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_judged(part, compressor)], names=names)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        for part in text_slices(batch):
            yield part.filter(_judged(part, compressor)[6])


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text); other columns are ignored, repeated rows are judged alike.

    A null or empty text has no words and fails. Nothing is shuffled; a text is held in memory by one task at a time.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_judge, SCHEMA)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that `quality_rules` keeps, with all their columns, whatever these are named."""
    return docs.mapInArrow(_keep, docs.schema)
