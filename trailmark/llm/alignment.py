"""Alignment of two tokenizers over a corpus, with equal texts treated once.

Rows are shuffled by their full text, so that every distinct text is tokenised and aligned once, with the number of its
rows as its weight. Where A and B tokens both end, they are cut into groups. The ends of either kind cut a text into
pieces; each piece lies in one A and one B token, and no two pieces in the same two, so the pieces are the links.

Counts of id pairs are corpus-wide. A block of texts sends each of its distinct pairs once, with the number of rows
that hold it, and gets the pair's count back; so a pair that every document holds arrives once from each block.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trailmark.llm.bpe import byte_symbols
from trailmark.llm.hot_join import with_measures
from trailmark.llm.text import text_slices
from trailmark.scratch import shared_folder, written

BLOCK_BYTES = 16_000_000  # text of a block, or one longer text
SLICE_BYTES = 1_000_000  # text aligned at once
SPACE = "▁"
# fixed value: how byte-level BPE cuts words
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_SPACE = 10_000
_SPACES = re.compile(r"\s{%d}" % LONG_SPACE)

_MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ALIGNED = f"text_key string, copies long, block long, {_MEASURES}, pairs binary, repeats binary"


class Alignment(NamedTuple):
    """Tokens, groups and links of some texts; texts whose bytes the tokens do not give back have none."""

    n_a: list[int]
    n_b: list[int]
    n_groups: list[int]
    groups: list[str]
    links: list[np.ndarray]  # A id * number of B ids + B id, of every link


class TokenizerPair:
    """Byte-level BPE (A) and pieces with byte fallback (B), loaded once per Python worker."""

    _loaded: dict[tuple[str, str], TokenizerPair] = {}

    @classmethod
    def load(cls, a: str, b: str) -> TokenizerPair:
        if (a, b) not in cls._loaded:
            cls._loaded[a, b] = cls(a, b)
        return cls._loaded[a, b]

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        with open(a, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {s: i for i, s in enumerate(byte_symbols())}
        vocabulary = spec["model"]["vocab"] | {x["content"]: x["id"] for x in spec["added_tokens"]}
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.bytes = bytes_a, bytes_b
        self.sizes = tuple(np.array([len(x) for x in t], np.int64) for t in self.bytes)
        # each id as it is written before another token of its side, and at the end of its side of a group
        self.marked = [f"{i}{c}" for t, ends in zip(self.bytes, (",|", ",;")) for i in range(len(t)) for c in ends]
        self.width = len(bytes_b)
        self.fast = self._ranked(spec, vocabulary)

    def _ranked(self, spec: dict, vocabulary: dict[str, int]) -> tiktoken.Encoding | None:
        """The same vocabulary as ranks, which gives the same ids in a third of the time; None if the file's merges are
        not in the order of their ids, or its words are cut in another way."""
        cut, model = spec["pre_tokenizer"], spec["model"]
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        made = [vocabulary[x + y] for x, y in merges]
        plain = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and not spec["normalizer"]
        if not plain or made != sorted(made):
            return None
        added = {x["id"] for x in spec["added_tokens"]}
        ranks = {self.bytes[0][i]: i for i in vocabulary.values() if i not in added}
        return tiktoken.Encoding("a", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ids_a(self, text: str) -> list[int]:
        # the pattern's look-ahead has a stack that very long white space would fill
        if self.fast is None or (len(text) >= LONG_SPACE and _SPACES.search(text)):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def align(self, texts: list[str]) -> Alignment:
        spaced = [" " + x for x in texts]
        ids_a = list(map(self._ids_a, spaced))
        ids_b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(spaced):
            raw = text.encode()
            if not texts[k] or any(b"".join(map(t.__getitem__, x[k])) != raw for t, x in zip(self.bytes, (ids_a, ids_b))):
                ids_a[k], ids_b[k] = [], []
        return self._aligned(ids_a, ids_b)

    def _aligned(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> Alignment:
        """All texts in a row; both kinds of tokens cover the same bytes of each."""
        n_a, n_b = ([len(x) for x in ids] for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64, sum(n)) for ids, n in ((ids_a, n_a), (ids_b, n_b)))
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.zeros((2, int(end_a[-1]) + 1 if len(end_a) else 1), bool)
        ends[0][end_a] = True
        ends[1][end_b] = True
        pieces = np.flatnonzero(ends[0] | ends[1])
        is_a, is_b = ends[0][pieces], ends[1][pieces]
        both = is_a & is_b
        done_a, done_b = np.cumsum(is_a), np.cumsum(is_b)
        links = a[done_a - is_a] * self.width + b[done_b - is_b]
        group = np.cumsum(both) - both
        # A tokens of a group come after the B tokens of the groups before it, B tokens after the A tokens of their own
        stop_a, stop_b = done_a[both], np.concatenate([[0], done_b[both]])
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + stop_b[group[is_a]]] = 2 * a + both[is_a]
        codes[np.arange(len(b)) + stop_a[group[is_b]]] = 2 * (len(self.bytes[0]) + b) + both[is_b]
        marks = list(map(self.marked.__getitem__, codes.tolist()))
        tokens = np.concatenate([[0], np.cumsum(np.add(n_a, n_b, dtype=np.int64))]).tolist()
        # where the last piece of each text ends
        last = np.concatenate([[0], end_a])[np.cumsum(np.array(n_a, np.int64))]
        stops = np.searchsorted(pieces, last, side="right")
        cuts = np.concatenate([[0], stops]).tolist()
        n_groups = np.diff(np.concatenate([[0], np.cumsum(both)])[cuts]).tolist()
        return Alignment(
            n_a,
            n_b,
            n_groups,
            ["".join(marks[s:e])[:-1] for s, e in zip(tokens, tokens[1:])],
            [links[s:e] for s, e in zip(cuts, cuts[1:])],
        )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of the batches with the number of the block they belong to."""
    block, size = 0, 0
    for batch in batches:
        for part in text_slices(batch, limit=SLICE_BYTES):
            size += part.column("text").nbytes
            yield block, part
            if size >= BLOCK_BYTES:
                block, size = block + 1, 0


def aligned_texts(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row per distinct non-empty text of `docs` (text): its digest, number of rows, block, measures, and its
    distinct pairs of ids with how often they are linked in it."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''")
    texts = texts.groupBy("text").agg(F.count("*").alias("copies"))
    texts = texts.select("text", "copies", F.spark_partition_id().alias("part"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = TokenizerPair.load(a, b)
        for block, part in _blocks(batches):
            found = part.column("text").to_pylist()
            got = pair.align(found)
            lists = [np.unique(x, return_counts=True) for x in got.links]
            keys = [hashlib.sha256(x.encode()).hexdigest() for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    part.column("copies"),
                    pa.array([(part.column("part")[0].as_py() << 32) + block] * len(found), pa.int64()),
                    pa.array(got.n_a, pa.int64()),
                    pa.array(got.n_b, pa.int64()),
                    pa.array(got.n_groups, pa.int64()),
                    pa.array([len(x) for x in got.links], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in got.groups], pa.string()),
                    pa.array([x.tobytes() for x, _ in lists], pa.binary()),
                    pa.array([n.astype(np.uint32).tobytes() for _, n in lists], pa.binary()),
                ],
                names=[x.split()[0] for x in _ALIGNED.split(", ")],
            )

    return texts.mapInArrow(align, _ALIGNED)


def _lists(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in column]


def _block_pairs(table: pa.Table) -> pa.Table:
    """The distinct pairs of a block, and how many rows hold each."""
    lists = _lists(table.column("pairs"), np.int64)
    weight = np.repeat(table.column("copies").to_numpy(), [len(x) for x in lists])
    pairs, number = np.unique(np.concatenate(lists), return_inverse=True)
    rows = np.zeros(len(pairs), np.int64)
    np.add.at(rows, number, weight)
    block = pa.array([table.column("block")[0].as_py()] * len(pairs), pa.int64())
    return pa.table({"block": block, "pair": pa.array(pairs), "rows": pa.array(rows)})


def _measured(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """n_best and count_sum of each text of a block, from the counts of the block's pairs."""
    none = np.zeros(0, np.int64)
    lists = _lists(texts.column("pairs"), np.int64)
    repeats = np.concatenate([none, *_lists(texts.column("repeats"), np.uint32)])
    pair = counts.column("pair").to_numpy()
    order = np.argsort(pair)
    count, best = counts.column("count").to_numpy()[order], counts.column("best").to_numpy()[order]
    at = np.searchsorted(pair[order], np.concatenate([none, *lists]))
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])

    def totals(values: np.ndarray) -> pa.Array:
        sums = np.concatenate([[0], np.cumsum(values)])
        return pa.array(sums[ends[1:]] - sums[ends[:-1]])

    return pa.table(
        {
            "text_key": texts.column("text_key"),
            "n_best": totals(repeats * best[at]),
            "count_sum": totals(repeats * count[at]),
        }
    )


def pair_counts(block_pairs: DataFrame, width: int) -> DataFrame:
    """pair, count, best: in how many documents each pair of ids is linked, and whether no pair with its A id has more."""
    counts = block_pairs.groupBy("pair").agg(F.sum("rows").alias("count"))
    a = F.expr(f"pair div {width}")
    highest = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    joined = counts.withColumn("a", a).join(highest, "a")
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))


def align_tokenizers(docs: DataFrame, a: str, b: str, folder: str | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `a` is a byte-level BPE file of the tokenizers library, `b` a sentencepiece model with byte fallback. A text that is
    null or empty, or that its tokens do not give back, has zeros and an empty digest. Rows that repeat an id, or a text,
    are documents of their own and all count; null ids are passed on, other columns ignored; no rows give no rows.
    """
    folder = folder or shared_folder(docs.sparkSession)
    aligned = written(aligned_texts(docs, a, b), folder, "aligned")
    pairs = aligned.where("n_links > 0").select("block", "copies", "pairs").groupBy("block")
    pairs = written(pairs.applyInArrow(_block_pairs, "block long, pair long, rows long"), folder, "pairs")
    counts = written(pair_counts(pairs, TokenizerPair.load(a, b).width), folder, "counts")
    known = pairs.join(counts, "pair").select("block", "pair", "count", "best")
    texts = aligned.where("n_links > 0").select("block", "text_key", "pairs", "repeats")
    sums = texts.groupBy("block").cogroup(known.groupBy("block"))
    sums = written(sums.applyInArrow(_measured, "text_key string, n_best long, count_sum long"), folder, "sums")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    measures = aligned.drop("block", "pairs", "repeats").join(sums, "text_key", "left")
    measures = written(measures.fillna(0, names), folder, "measures")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.when(F.col("text").cast("string") != "", F.col("text").cast("string")), 256).alias("text_key"),
    )
    rows = written(rows, folder, "rows")
    empty = rows.where("text_key is null").select(
        "doc_id", *[F.lit(0).cast("long").alias(x) for x in names], F.lit("").alias("groups_sha256")
    )
    return with_measures(rows, measures, "text_key", "copies").select("doc_id", *names, "groups_sha256").unionByName(empty)
