"""BPE encoding and decoding with an index of pair occurrences.

Words of an Arrow batch are looked up in a cache; the new ones are encoded together. All their symbols lie in one
array. An index maps each adjacent pair that has a rank to all its positions. The lowest active rank is taken from a
heap, its positions are merged at once, and the pairs that arise to the left and right are added to the index. Entries
made stale by a merge are dropped when their rank is reached.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_WORDS = 150_000  # beyond it the cache starts anew; it ends with the task
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# white space of the tokenizer's pattern: the Unicode property, without 0x1C-0x1F, at which str.split() cuts too
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in kept else next(others)) for b in range(256)]


class WordBpe:
    """A vocabulary of words with an end mark, lower-cased, as `word_bpe_49k.json`. Built once per Python worker."""

    _loaded: dict[tuple, WordBpe] = {}

    @classmethod
    def load(cls, path: str, merges: int | None = None) -> WordBpe:
        if (path, merges) not in cls._loaded:
            cls._loaded[path, merges] = cls(path, merges)
        return cls._loaded[path, merges]

    def __init__(self, path: str, merges: int | None = None):
        """`merges`: use only so many of the first merges."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] + r"|\n")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        self.size = max(self.tokens) + 1
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"][:merges]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._rank_type = np.uint16 if len(pairs) < 65536 else np.int64
        keys = self.left * self.size + self.right
        self._order = np.argsort(keys)
        self._keys = keys[self._order]
        self.cache: dict[str, tuple[str, str]] = {}
        self._decimals = list(map(str, range(self.size)))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        keys = left * np.int64(self.size) + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._order[at], -1)

    def pretokens(self, words: list[str]) -> tuple[list[str], list[int]]:
        """Pre-tokens of all words in a row, and where those of each word end. Words hold no line feed."""
        # the final sigma is the one letter whose lower case depends on its neighbours in Python, but not here
        text = unicodedata.normalize("NFC", "\n".join(words)).replace("\u03a3", "\u03c3").lower()
        pieces = self.pattern.findall(text)
        breaks = [i for i, x in enumerate(pieces) if x == "\n"] + [len(pieces)]
        return [x for x in pieces if x != "\n"], [at - k for k, at in enumerate(breaks)]

    def encode_pretokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and the n + 1 offsets of the pieces."""
        raw = [x.encode() for x in pieces]
        return self.encode_bytes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw], dtype=np.int64))

    def encode_bytes(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that lie one after the other in `data`; none is empty."""
        n = len(data)
        sym = self.inner[data].astype(np.int32)
        sym[ends - 1] = self.last[data[ends - 1]]
        nxt = np.arange(1, n + 2, dtype=np.int32)
        nxt[ends - 1] = n  # position n is a sentinel without symbol
        prv = np.arange(-1, n, dtype=np.int32)
        prv[ends[:-1]] = n
        if n:
            prv[0] = n
        sym = np.append(sym, np.int32(-1))
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            """Adds the pairs that start at these positions to the index."""
            at = at[(at < n) & (nxt[at] < n)]
            rank = self.ranks(sym[at], sym[nxt[at]])
            at, rank = at[rank >= 0], rank[rank >= 0].astype(self._rank_type)
            order = np.argsort(rank, kind="stable")  # a radix sort for 16 bits
            at, rank = at[order], rank[order]
            edges = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.concatenate([[0], edges])].tolist() if len(rank) else (), np.split(at, edges)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        note(np.arange(n, dtype=np.int32))
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            left, right, made = self.left[r], self.right[r], self.made[r]
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            at = at[(sym[at] == left) & (sym[nxt[at]] == right)]
            if left == right and len(at) > 1:  # of overlapping pairs the left one is merged
                kept, taken = [], -1
                for p, q in zip(at.tolist(), nxt[at].tolist()):
                    if p != taken:
                        kept.append(p)
                        taken = q
                at = np.array(kept, np.int32)
            if not len(at):
                continue
            gone = nxt[at]
            sym[at] = made
            sym[gone] = -1
            nxt[at] = nxt[gone]
            prv[nxt[at]] = at
            note(np.concatenate([prv[at], at]))
        alive = sym[:n] >= 0
        counts = np.concatenate([[0], np.cumsum(alive)])
        return sym[:n][alive], counts[np.concatenate([[0], ends])]

    def learn(self, words: set[str]) -> None:
        """Encodes the words the cache lacks. Kept are their ids as decimal text and what these decode to."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = list(words - self.cache.keys())
        if not new:
            return
        pieces, ends = self.pretokens(new)
        distinct = {x: k for k, x in enumerate(dict.fromkeys(pieces))}
        ids, offsets = self.encode_pretokens(list(distinct))
        offsets = offsets.tolist()
        text = list(map(self._decimals.__getitem__, ids.tolist()))
        names = list(map(self.tokens.__getitem__, ids.tolist()))
        texts = [" ".join(text[a:b]) for a, b in zip(offsets, offsets[1:])]
        names = [" ".join(names[a:b]) for a, b in zip(offsets, offsets[1:])]
        at = 0
        for w, end in zip(new, ends):
            if end == at + 1:
                k = distinct[pieces[at]]
                self.cache[w] = texts[k], names[k]
            else:
                ks = [distinct[x] for x in pieces[at:end]]
                self.cache[w] = " ".join([texts[k] for k in ks]), " ".join([names[k] for k in ks])
            at = end

    def words(self, text: str) -> list[str]:
        return [x for x in _SPACE.split(text) if x] if _SEPARATORS.search(text) else text.split()

    def parts(self, text: str) -> list[str]:
        """Words and special tokens of a text in order; the latter start with a line feed, which no word does."""
        if "<|" not in text:
            return self.words(text)
        out: list[str] = []
        for k, piece in enumerate(self.cut.split(text)):
            out += ["\n" + piece] if k % 2 else self.words(piece)
        return out

    def encode_batch(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """Ids of each text as decimals, and the tokens they decode to, both joined by one space."""
        parts = [self.parts(x) for x in texts]
        special = {"\n" + t: (str(i), t) for t, i in self.special.items()}
        self.learn(set().union(*parts) - special.keys())
        self.cache.update(special)
        found = [[self.cache[w] for w in x] for x in parts]
        return [" ".join([x[0] for x in row]) for row in found], [" ".join([x[1] for x in row]) for row in found]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _batches(texts: pa.Array, limit: int = 4_000_000) -> Iterator[list[str]]:
    rows: list[str] = []
    size = 0
    for x in texts:
        x = x.as_py() or ""
        rows.append(x)
        size += len(x)
        if size >= limit:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def bpe_encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array of int) of each row's text; null texts have no ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.load(vocabulary)
        for batch in batches:
            at = 0
            for texts in _batches(batch.column("text")):
                ids = [[int(i) for i in x.split()] for x in bpe.encode_batch(texts)[0]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(ids)), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )
                at += len(ids)
        bpe.cache.clear()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        encode, "doc_id long, ids array<int>"
    )


def bpe_decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, text of each row's ids, as the tokens joined by one space."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.load(vocabulary)
        for batch in batches:
            texts = [" ".join(bpe.tokens[i] for i in x.as_py() or []) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def bpe_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of `docs` (doc_id, text), with the digests of its ids and of the text decoded from them.

    A null text counts as empty; other columns are ignored. Special tokens written out in a text are encoded as such.
    Nothing is shuffled.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.load(vocabulary)
        for batch in batches:
            at = 0
            for texts in _batches(batch.column("text")):
                ids, decoded = bpe.encode_batch(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(ids)),
                        pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64()),
                        pa.array([_sha(x) for x in ids], pa.string()),
                        pa.array([_sha(x) for x in decoded], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
                at += len(ids)
        bpe.cache.clear()  # workers are used again

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(digest, SCHEMA)
