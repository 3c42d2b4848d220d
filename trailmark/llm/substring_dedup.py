"""Removal of repeated passages: FM-indexes over shards of the text, searched for the documents' windows.

A window is WINDOW consecutive words. Equal windows must meet in one shard. Each window is dealt out by its minimizer, the
run of GRAM words in it with the smallest hash; consecutive windows with the same minimizer travel together as a segment.

1. Documents are put into blocks. Each block reports its minimizers, and learns which of them occur elsewhere too.
2. Segments of those minimizers are sent to their shards; equal segments of one block once, for the first of them. Those
   of a very frequent minimizer are dealt out window by window, so that different contexts of a common phrase part.
3. Each shard indexes its segments and searches every window of them backwards, from its last word to its first. The
   interval at length WINDOW holds all occurrences, of which the first stays.
4. Blocks remove the words under all other occurrences.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.fm_index import FmIndex, repeated
from trailmark.llm.text import mixed, powers, text_bytes, text_slices, words_of

WINDOW = 20
GRAM = 6
FREQUENT = 1000  # different segments of a minimizer, beyond which they are dealt out by window
_NULL = np.iinfo(np.int64).min  # order of a null id


class Block:
    """The distinct (doc_id, text) of a block in order of ids, and the windows of all their words."""

    def __init__(self, table: pa.Table):
        table = table.select(["doc_id", "text"]).combine_chunks()
        self.table = table
        ids = pc.fill_null(table.column("doc_id"), int(_NULL)).to_numpy()
        hashes, counts = [], []
        for part in table.to_batches():
            for piece in text_slices(part):
                data, offsets = text_bytes(piece.column("text"))
                words = words_of(data, offsets)
                hashes.append(words.hashes)
                counts.append(np.bincount(words.rows, minlength=piece.num_rows))
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        begins = np.concatenate([[0], np.cumsum(counts)])
        sums = _sums(hashes)
        whole = _content(sums, begins[:-1], begins[1:])
        # rows of the same id and text are one document here
        order = np.lexsort((whole, ids))
        same = np.concatenate([[False], (ids[order][1:] == ids[order][:-1]) & (whole[order][1:] == whole[order][:-1])])
        number = np.cumsum(~same) - 1
        self.number = np.empty(len(ids), np.int64)  # of each row's document
        self.number[order] = number
        first = order[~same]
        self.ids, self.counts = ids[first], counts[first]
        at = np.repeat(begins[first] - np.concatenate([[0], np.cumsum(self.counts)[:-1]]), self.counts)
        self.hashes = hashes[at + np.arange(len(at))]
        self.begins = np.concatenate([[0], np.cumsum(self.counts)])
        self.sums = _sums(self.hashes)

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of windows and minimizer of each segment."""
        n = len(self.hashes)
        if n < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        docs = np.repeat(np.arange(len(self.counts)), self.counts)
        starts = np.arange(n - GRAM + 1)
        grams = _content(self.sums, starts, starts + GRAM)
        first = np.flatnonzero(docs[: n - WINDOW + 1] == docs[WINDOW - 1 :])
        if not len(first):
            return first, first, np.zeros(0, np.uint64)
        view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
        least = np.concatenate([view[a : a + 100_000].argmin(1) for a in range(0, len(view), 100_000)])
        least = first + least[first]
        new = np.concatenate([[True], (np.diff(least) != 0) | (np.diff(first) != 1)])
        at = np.flatnonzero(new)
        return first[at], np.diff(np.append(at, len(first))), grams[least[at]]

    def contents(self, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
        return _content(self.sums, first, first + windows + WINDOW - 1)


def _sums(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(len(hashes) + 1)[: len(hashes)], out=out[1:])
    return out


def _content(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the words start to stop, of whatever number."""
    inverse = powers(len(sums), pow(int(powers(2)[1]), -1, 1 << 64))
    return mixed((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))


def _split(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that groups keys by bucket, and the n + 1 edges of the buckets."""
    bucket = (mixed(keys) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def _binary(rows: list[tuple], names: list[str]) -> pa.Table:
    ints = {"bucket", "block"}
    return pa.table(
        {
            name: pa.array([x[i] for x in rows], pa.int32() if name in ints else pa.binary())
            for i, name in enumerate(names)
        }
    )


def _asks(n_shards: int):
    """Each block's minimizers by shard, with the number of different segments of each (up to 255)."""

    def ask(table: pa.Table) -> pa.Table:
        block = Block(table)
        first, windows, keys = block.segments()
        pairs = np.unique(np.stack([keys, block.contents(first, windows)], 1), axis=0)[:, 0]
        keys, counts = np.unique(pairs, return_counts=True)
        order, edges = _split(keys, n_shards)
        number = table.column("block")[0].as_py()
        rows = []
        for b in range(n_shards):
            at = order[edges[b] : edges[b + 1]]
            if len(at):
                rows.append((b, number, keys[at].tobytes(), np.minimum(counts[at], 255).astype(np.uint8).tobytes()))
        return _binary(rows, ["bucket", "block", "keys", "counts"])

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """To each block, which of its minimizers occur in more than one segment (1), and very often (2)."""
    asked = table.to_pylist()
    keys = [np.frombuffer(x["keys"], np.uint64) for x in asked]
    counts = np.concatenate([np.frombuffer(x["counts"], np.uint8) for x in asked])
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(back, weights=counts, minlength=len(distinct))[back]
    kind = np.where(totals > FREQUENT, 2, np.where(totals > 1, 1, 0)).astype(np.uint8)
    ends = np.cumsum([len(x) for x in keys])
    out = []
    for row, k, mine in zip(asked, keys, np.split(kind, ends[:-1])):
        shared = mine > 0
        if shared.any():
            out.append((row["block"], k[shared].tobytes(), mine[shared].tobytes()))
    return _binary(out, ["block", "keys", "kinds"])


_UNITS = "bucket int, block int, windows binary, words binary, ids binary, starts binary, docs binary, done binary"


def _units(n_shards: int):
    """Segments of shared minimizers to their shards; windows of later copies in the block as already found."""

    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in _UNITS.split(", ")]
        if not docs.num_rows:
            return _binary([], names)
        number = docs.column("block")[0].as_py()
        block = Block(docs)
        first, windows, keys = block.segments()
        known = [np.frombuffer(x, np.uint64) for x in answers.column("keys").to_pylist()]
        kinds = [np.frombuffer(x, np.uint8) for x in answers.column("kinds").to_pylist()]
        known = np.concatenate(known) if known else np.zeros(0, np.uint64)
        kinds = np.concatenate(kinds) if kinds else np.zeros(0, np.uint8)
        order = np.argsort(known)
        known, kinds = np.append(known[order], np.uint64(0)), np.append(kinds[order], np.uint8(0))
        at = np.minimum(np.searchsorted(known[:-1], keys), len(known) - 1)
        kind = np.where(known[at] == keys, kinds[at], 0)
        # segments whose only other copies are in this block are settled here
        content = block.contents(first, windows)
        ordered = np.sort(content)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        kind = np.where((kind == 0) & np.isin(content, twice), 1, kind)
        wide = kind == 2
        spread_first = np.repeat(first[wide], windows[wide])
        steps = np.arange(len(spread_first)) - np.repeat(np.cumsum(windows[wide]) - windows[wide], windows[wide])
        spread_first = spread_first + steps
        ones = np.ones(len(spread_first), np.int64)
        spread = block.contents(spread_first, ones)
        keep = kind == 1
        first = np.concatenate([first[keep], spread_first])
        windows = np.concatenate([windows[keep], ones])
        content, keys = np.concatenate([content[keep], spread]), np.concatenate([keys[keep], spread])
        doc = np.searchsorted(block.begins, first, side="right") - 1
        start = first - block.begins[doc]
        ids = block.ids[doc]
        order = np.lexsort((start, ids, content))
        new = np.concatenate([[True], np.diff(content[order]) != 0])[: len(order)]
        leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        # a copy at the same place of another row of this id is not earlier, and has to ask for itself
        later = np.zeros(len(order), bool)
        later[order] = (ids[order] != ids[leader]) | (start[order] != start[leader])
        sent = np.flatnonzero(~later)
        rows = []
        by_shard, edges = _split(keys[sent], n_shards)
        low = block.hashes.astype(np.uint32)
        for b in range(n_shards):
            at = sent[by_shard[edges[b] : edges[b + 1]]]
            if len(at):
                size = windows[at] + WINDOW - 1
                place = np.repeat(first[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                rows.append(
                    (
                        b,
                        number,
                        windows[at].astype(np.uint8).tobytes(),
                        low[place].tobytes(),
                        ids[at].tobytes(),
                        start[at].astype(np.int32).tobytes(),
                        doc[at].astype(np.int32).tobytes(),
                        b"",
                    )
                )
        at = np.flatnonzero(later)
        if len(at):
            done = np.stack([doc[at], start[at], windows[at]], 1).astype(np.int32)
            rows.append((number % n_shards, number, b"", b"", b"", b"", b"", done.tobytes()))
        return _binary(rows, names)

    return send


def _search(table: pa.Table) -> pa.Table:
    """Windows of a shard that occur earlier too, to their blocks: document, first word and number of windows."""
    rows = table.to_pylist()
    out = [(x["block"], x["done"]) for x in rows if x["done"]]
    rows = [x for x in rows if not x["done"]]
    if rows:
        windows = np.concatenate([np.frombuffer(x["windows"], np.uint8) for x in rows]).astype(np.int64)
        words = np.concatenate([np.frombuffer(x["words"], np.uint32) for x in rows])
        ids, starts, docs = (
            np.concatenate([np.frombuffer(x[k], t) for x in rows])
            for k, t in (("ids", np.int64), ("starts", np.int32), ("docs", np.int32))
        )
        blocks = np.repeat([x["block"] for x in rows], [len(x["windows"]) for x in rows])
        # each segment is followed by a separator, 0
        size = windows + WINDOW - 1
        _, numbers = np.unique(words, return_inverse=True)
        text = np.zeros(len(words) + len(size), np.int64)
        text[np.arange(len(words)) + np.repeat(np.arange(len(size)), size)] = numbers + 1
        begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        unit = np.repeat(np.arange(len(windows)), windows)
        step = np.arange(len(unit)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = begin[unit] + step
        # order of all windows by document and place
        place = starts[unit] + step
        sort = np.lexsort((place, ids[unit]))
        rank = np.empty(len(at), np.int64)
        new = (np.diff(ids[unit][sort]) != 0) | (np.diff(place[sort]) != 0)
        rank[sort] = np.concatenate([[0], np.cumsum(new)])
        index = FmIndex(text, WINDOW)
        which, low, high = repeated(index, text, at, WINDOW)
        if len(which):
            by_place = np.full(len(text), np.iinfo(np.int64).max)
            by_place[at] = rank
            ordered = np.append(by_place[index.suffixes], np.iinfo(np.int64).max)
            lows, back = np.unique(low, return_inverse=True)
            highs = np.empty(len(lows), np.int64)
            highs[back] = high
            earliest = np.minimum.reduceat(ordered, np.stack([lows, highs], 1).ravel())[::2][back]
            found = which[earliest < rank[which]]
            # runs of windows in one segment
            found = np.sort(found)
            new = np.concatenate([[True], (np.diff(found) != 1) | (np.diff(unit[found]) != 0)])[: len(found)]
            heads = np.flatnonzero(new)
            runs = np.stack(
                [docs[unit[found[heads]]], place[found[heads]], np.diff(np.append(heads, len(found)))], 1
            ).astype(np.int32)
            owner = blocks[unit[found[heads]]]
            out += [(int(b), runs[owner == b].tobytes()) for b in np.unique(owner)]
    return _binary(out, ["block", "runs"])


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _removed(docs: pa.Table, found: pa.Table) -> tuple[Block, np.ndarray]:
    block = Block(docs)
    runs = [np.frombuffer(x, np.int32).reshape(-1, 3) for x in found.column("runs").to_pylist()]
    runs = np.concatenate(runs).astype(np.int64) if runs else np.zeros((0, 3), np.int64)
    edge = np.zeros(len(block.hashes) + 1, np.int64)
    first = block.begins[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, first, 1)
    np.add.at(edge, first + runs[:, 2] + WINDOW - 1, -1)
    return block, np.cumsum(edge)[:-1] > 0


def _kept(docs: pa.Table, found: pa.Table):
    """doc_id, words and what is removed of them, for each row of a block."""
    block, removed = _removed(docs, found)
    for row, number in enumerate(block.number.tolist()):
        raw = (block.table.column("text")[row].as_py() or "").encode()
        words = raw.split()  # bytes are split at the same six characters
        gone = removed[block.begins[number] : block.begins[number + 1]]
        yield block.table.column("doc_id")[row].as_py(), words, gone


def _digests(docs: pa.Table, found: pa.Table) -> pa.Table:
    rows = []
    for doc_id, words, gone in _kept(docs, found):
        n = int(gone.sum())
        kept = [w for w, x in zip(words, gone.tolist()) if not x] if n else words
        rows.append((doc_id, len(words), n, hashlib.sha256(b" ".join(kept)).hexdigest()))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in _RESULT.split(", ")]
    return pa.table({name: pa.array([x[i] for x in rows], t) for i, (name, t) in enumerate(zip(names, types))})


def _texts(docs: pa.Table, found: pa.Table) -> pa.Table:
    rows = [(i, b" ".join(w for w, x in zip(words, gone) if not x).decode()) for i, words, gone in _kept(docs, found)]
    return pa.table({"doc_id": pa.array([x[0] for x in rows], pa.int64()), "text": pa.array([x[1] for x in rows], pa.string())})


def _run(docs: DataFrame, last, schema: str) -> DataFrame:
    n_parts = max(docs.rdd.getNumPartitions(), 1)
    n_blocks, n_shards, n_tasks = 4 * n_parts, 4 * n_parts, 2 * n_parts
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # this exchange is the same in all three places, and made once
    blocks = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))
    blocks = blocks.repartition(n_tasks, "block")
    answers = (
        blocks.groupBy("block")
        .applyInArrow(_asks(n_shards), "bucket int, block int, keys binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(_answer, "block int, keys binary, kinds binary")
    )
    units = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_units(n_shards), _UNITS)
    found = units.groupBy("bucket").applyInArrow(_search, "block int, runs binary")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(last, schema)


def repeated_words(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): n_words, n_removed, and the digest of the kept words.

    A word goes if it lies in a window whose words also start earlier: in a document of smaller id, or earlier in the
    same. A null text has no words. A null id counts as smaller than all others. Rows of the same id are not before one
    another except by place in the text, so that repeated rows keep or lose the same words. Other columns are ignored.
    Words are compared by 32 bits of their hash at each of the WINDOW places, and by a 64-bit hash of the minimizer.
    """
    return _run(docs, _digests, _RESULT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and the kept words joined by one space, of each row; as `repeated_words`."""
    return _run(docs, _texts, "doc_id long, text string")
