"""Words and their hashes over Arrow batches of texts, on whole byte buffers at a time.

A word is a run of bytes other than the six ASCII white-space characters (0x20, 0x09-0x0D). Those bytes never occur
inside a multi-byte UTF-8 character, so cutting bytes equals cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2_000_000  # texts worked on at once; a longer text is a slice of its own
_PIECE = 1 << 19  # powers are kept up to twice this number
_BASE = 0x9E3779B97F4A7C15 | 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def keep_memory() -> None:
    """Lets this process use memory of arrays below 30 MB again, instead of giving it back at each release.

    The C library raises its limits to the largest block released (mallopt(3)). Below them, the first touch of fresh
    pages can take as long as the work on the arrays.
    """
    np.empty(30 << 20, np.uint8)


class Words(NamedTuple):
    starts: np.ndarray  # byte positions in the slice
    ends: np.ndarray
    rows: np.ndarray  # row of each word
    hashes: np.ndarray  # 64 bits per word


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most `limit` bytes of text, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    totals = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        end = max(int(np.searchsorted(totals, totals[at] + limit, side="right")) - 1, at + 1)
        yield batch.slice(at, end - at)
        at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and the n + 1 offsets into them."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all words."""
    return spans_of(~IS_SPACE[data], offsets)


def spans_of(marked: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the longest runs of marked bytes inside each text."""
    n = len(marked)
    inside = np.zeros(n + 1, bool)
    inside[:-1] = marked
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    starts[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all (the finalizer of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 2 * _PIECE:
            _powers[base] = have
    return have[:n]


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG_SPAN = 256  # bytes from which a span is hashed by itself


def span_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digests of byte spans: their length and each group of 8 bytes go through a mixing that is not linear, so
    that no two texts have equal digests but by chance."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    groups = np.ndarray(len(data) + 1, np.uint64, padded, 0, (1,))
    sizes = ends - starts
    out = mixed(sizes.astype(np.uint64) + np.uint64(_BASE))
    alive = np.flatnonzero((sizes > 0) & (sizes < _LONG_SPAN))
    k = 0
    while len(alive):
        value = groups[starts[alive] + k] & _MASKS[np.minimum(sizes[alive] - k, 8)]
        out[alive] = mixed(out[alive] ^ value) + np.uint64(_BASE)
        k += 8
        alive = alive[sizes[alive] > k]
    for i in np.flatnonzero(sizes >= _LONG_SPAN).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), _BASE & 0xFFFFFFFF)
    return out


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends, rows = word_spans(data, offsets)
    return Words(starts, ends, rows, span_digests(data, starts, ends))


def windows_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of n words inside one text."""
    count = max(len(words.rows) - n + 1, 0)
    first = np.flatnonzero(words.rows[:count] == words.rows[n - 1 : n - 1 + count])
    h = np.zeros(count, np.uint64)
    factor = 1
    for k in range(n):
        h += words.hashes[k : k + count] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    return first, mixed(h[first])


def row_sums(per_byte: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a value per byte over each text."""
    sums = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]
