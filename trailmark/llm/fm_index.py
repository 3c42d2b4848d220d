"""A compressed FM-index over word ids, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector for each bit of a symbol."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            on = (values >> bit) & 1 > 0
            packed = np.packbits(on, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            ones = np.zeros(len(packed) + 1, np.int32)
            np.cumsum(np.bitwise_count(packed), out=ones[1:], dtype=np.int32)
            self.levels.append((bit, packed, ones, int(len(on) - on.sum())))
            values = np.concatenate([values[~on], values[on]])

    def follow(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place below the last level of the symbol's occurrences before `at`."""
        for bit, packed, ones, zeros in self.levels:
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            rank = ones[word] + np.bitwise_count(packed[word] & below)
            at = np.where((symbols >> bit) & 1 > 0, zeros + rank, at - rank)
        return at


class FmIndex:
    """Suffixes of `text` sorted by their first `depth` symbols, which is all that patterns up to `depth` need.

    Symbols are 0 (a separator, in no pattern) to n - 1; the text ends with a separator.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, span = text.astype(np.int64), 1
        while True:
            step = min(span, depth - span)
            if step <= 0:
                break
            later = np.zeros(n, np.int64)
            later[: n - step] = rank[step:]
            key = rank * (int(rank.max()) + 1) + later
            suffixes = np.argsort(key, kind="stable")
            ordered = key[suffixes]
            rank = np.empty(n, np.int64)
            rank[suffixes] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            span += step
        self.suffixes = suffixes.astype(np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])
        symbols = np.arange(len(self.first) - 1)
        self.matrix = WaveletMatrix(text[self.suffixes - 1], max(int(text.max()).bit_length(), 1))
        self.base = self.matrix.follow(symbols, np.zeros(len(symbols), np.int64))

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        both = self.matrix.follow(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        start = self.first[symbols] - self.base[symbols]
        return both[: len(symbols)] + start, both[len(symbols) :] + start


def repeated(index: FmIndex, text: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all patterns text[s : s + n], those that occur more than once: their number in `starts` and interval.

    A pattern is extended from its last word to the left and given up as soon as it has one occurrence, its own.
    """
    which = np.arange(len(starts))
    last = text[starts + n - 1]
    low, high = index.first[last], index.first[last + 1]
    for k in range(n - 2, -1, -1):
        several = high - low > 1
        which, low, high = which[several], low[several], high[several]
        if not len(which):
            break
        low, high = index.extend(text[starts[which] + k], low, high)
    several = high - low > 1
    return which[several], low[several], high[several]
