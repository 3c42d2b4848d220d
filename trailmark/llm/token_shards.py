"""Training-order materialisation: token ids in fixed-stride shards, in the order of a keyed permutation.

Texts are encoded once, slice by slice, and their ids stored. Each slice is one stream: its documents' ids one after the
other, an end id after each, cut into sequences of LENGTH ids (the last one padded). Sequences are numbered inside each
input partition as they are made, and over all partitions by one sum for each. A Feistel network over the next even number
of bits, walked until it falls below their number, permutes the numbers to slots: no list of slots is stored, and a slot
leads back to its sequence. Slots are dealt out in ranges; each range is written as one file of records of equal size, so
that a reader can start at any slot by seeking.

A record is the id of the document its first token belongs to (8 bytes; -1: null), the token's place in that document and
the number of tokens used (4 bytes each), LENGTH ids of 2 bytes, all little-endian, and a line feed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.bpe import WordBpe
from trailmark.llm.text import LOWER, span_digests, text_bytes, text_slices, word_spans
from trailmark.scratch import shared_folder, written
from trailmark.streaming.files import listed

LENGTH = 1024
HEADER = np.dtype([("doc_id", "<i8"), ("place", "<u4"), ("used", "<u4")])
SHARD_RECORDS = 4096
ROUNDS = 6
SLICE_BYTES = 3_000_000  # texts encoded at once; a longer text is a slice of its own
KEY = 20240607
END_TOKEN = "<|endoftext|>"


def stride(length: int = LENGTH) -> int:
    return HEADER.itemsize + 2 * length + 1


class Permutation:
    """A keyed bijection of 0 .. n - 1."""

    def __init__(self, n: int, key: int = KEY):
        self.n = n
        self.half = max((max(n - 1, 1).bit_length() + 1) // 2, 1)
        self.keys = np.random.default_rng(key).integers(1, 1 << 63, ROUNDS, dtype=np.uint64)

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        h = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(32)) & np.uint64((1 << self.half) - 1)

    def _walk(self, x: np.ndarray, keys: np.ndarray, forward: bool) -> np.ndarray:
        out = np.asarray(x, np.uint64).copy()
        todo = np.arange(len(out))
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        while len(todo):
            left, right = out[todo] >> half, out[todo] & mask
            for k in keys:
                if forward:
                    left, right = right, left ^ self._round(right, k)
                else:
                    left, right = right ^ self._round(left, k), left
            out[todo] = (left << half) | right
            todo = todo[out[todo] >= self.n]
        return out.astype(np.int64)

    def slot(self, number: np.ndarray) -> np.ndarray:
        return self._walk(number, self.keys, True)

    def number(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1], False)


_LETTER, _DIGIT, _OTHER = 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("a") : ord("z") + 1] = _LETTER


class Encoder:
    """Ids of texts; each distinct word of a slice is encoded once.

    Words of ASCII characters without an apostrophe fall into runs of letters, single digits, and runs of other
    characters, and are cut as bytes; the others go through the vocabulary's own pattern.
    """

    def __init__(self, vocabulary: str):
        self.bpe = WordBpe.load(vocabulary)
        self.end = self.bpe.special[END_TOKEN]

    def _plain(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Some words cut into pieces: the bytes of the distinct pieces and where each ends, the pieces of all words in a
        row, and the number of pieces up to each word's end."""
        size = ends - starts
        stop = np.cumsum(size)
        text = LOWER[data[np.repeat(starts - (stop - size), size) + np.arange(stop[-1])]]
        kind = _CLASS[text]
        new = np.ones(len(text), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        new[stop[:-1]] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(text))
        _, first, piece = np.unique(span_digests(text, begin, end), return_index=True, return_inverse=True)
        size = (end - begin)[first]
        last = np.cumsum(size)
        raw = text[np.repeat(begin[first] - (last - size), size) + np.arange(last[-1])]
        return raw, last, piece, np.searchsorted(begin, stop)

    def _odd(self, raw: bytes, starts: np.ndarray, ends: np.ndarray):
        """The same by the vocabulary's own pattern."""
        pieces, stop = self.bpe.pretokens([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())])
        distinct = {x: k for k, x in enumerate(dict.fromkeys(pieces))}
        parts = [x.encode() for x in distinct]
        last = np.cumsum([len(x) for x in parts], dtype=np.int64)
        piece = np.array([distinct[x] for x in pieces], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), last, piece, np.asarray(stop, np.int64)

    def _distinct(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Ids of distinct words, and where those of each begin and how many they are. All go through one index."""
        odd = np.zeros(len(data) + 1, np.int32)
        np.cumsum((data > 127) | (data == ord("'")), out=odd[1:])
        is_odd = odd[ends] > odd[starts]
        plain, odd = np.flatnonzero(~is_odd), np.flatnonzero(is_odd)
        cut = []
        if len(plain):
            cut.append(self._plain(data, starts[plain], ends[plain]))
        if len(odd):
            cut.append(self._odd(data.tobytes(), starts[odd], ends[odd]))
        raw, last, piece, stop = [np.zeros(0, np.uint8)], [], [], [np.zeros(1, np.int64)]
        n_bytes = n_distinct = n_pieces = 0
        for some, ends_of, pieces, stops in cut:
            raw.append(some)
            last.append(ends_of + n_bytes)
            piece.append(pieces + n_distinct)
            stop.append(stops + n_pieces)
            n_bytes, n_distinct, n_pieces = n_bytes + len(some), n_distinct + len(ends_of), n_pieces + len(pieces)
        if not n_pieces:
            return np.zeros(0, np.uint16), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        ids, at = self.bpe.encode_bytes(np.concatenate(raw), np.concatenate(last))
        piece = np.concatenate(piece)
        size = np.diff(at)[piece]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = ids[np.repeat(at[piece] - total[:-1], size) + np.arange(total[-1])].astype(np.uint16)
        offsets = total[np.concatenate(stop)]
        begin, length = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        which = np.concatenate([plain, odd])
        begin[which], length[which] = offsets[:-1], np.diff(offsets)
        return ids, begin, length

    def _prepared(self, column: pa.Array):
        data, offsets = text_bytes(column)
        starts, ends, rows = word_spans(data, offsets)
        _, first, word = np.unique(span_digests(data, starts, ends), return_index=True, return_inverse=True)
        starts, ends, word = starts[first], ends[first], word.astype(np.int32)
        del first
        ids, begin, length = self._distinct(data, starts, ends)
        length = length.astype(np.int32)
        sizes = np.bincount(rows, weights=length[word], minlength=len(column)).astype(np.int64) + 1
        return word, ids, begin, length, sizes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, an end after each, and the number of ids of each text."""
        word, ids, begin, length, sizes = self._prepared(column)
        length = length[word]
        stop = np.cumsum(length, dtype=np.int64)
        total = int(stop[-1]) if len(stop) else 0
        kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
        place = np.repeat((begin[word] - (stop - length)).astype(kind), length)
        del word, length, stop
        place += np.arange(total, dtype=kind)
        found = ids[place]
        del place
        out = np.full(total + len(column), self.end, np.uint16)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(sizes) - 1] = False
        out[inner] = found
        return out, sizes


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from text_slices(batch, limit=SLICE_BYTES)


def encoded_slices(docs: DataFrame, vocabulary: str, length: int) -> DataFrame:
    """One row per slice of an input partition: part, first (sequences of the part before it), sequences, and compressed
    the ids and the numbers of ids and ids of its documents (-1: null)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = Encoder(vocabulary), 0
        compressor = zstandard.ZstdCompressor(level=1)
        for piece in _slices(batches):
            ids, sizes = encoder.encode(piece.column("text"))
            owners = pc.fill_null(piece.column("doc_id"), -1).to_numpy()
            n = -(-len(ids) // length)
            packed = [compressor.compress(x.tobytes()) for x in (ids, sizes, owners)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([n], pa.int64()),
                    *[pa.array([x], pa.binary()) for x in packed],
                ],
                names=["part", "first", "sequences", "ids", "sizes", "owners"],
            )
            first += n

    schema = "part int, first long, sequences long, ids binary, sizes binary, owners binary"
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def _records(ids: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, used: int, length: int) -> np.ndarray:
    """Whole records of a run of tokens that starts a record; `doc_ids` and `sizes` cover the run, from its first token on."""
    n = -(-used // length)
    out = np.zeros((n, stride(length)), np.uint8)
    body = np.zeros(n * length, "<u2")
    body[:used] = ids[:used]
    starts = np.cumsum(sizes) - sizes
    first = np.arange(n) * length
    owner = np.searchsorted(starts, first, side="right") - 1
    head = np.zeros(n, HEADER)
    head["doc_id"], head["place"] = doc_ids[owner], first - starts[owner]
    head["used"] = np.minimum(used - first, length)
    out[:, : HEADER.itemsize] = head.view(np.uint8).reshape(n, -1)
    out[:, HEADER.itemsize : -1] = body.view(np.uint8).reshape(n, -1)
    out[:, -1] = 10
    return out


def shuffled_records(slices: DataFrame, begins: dict[int, int], n: int, length: int, per_shard: int) -> DataFrame:
    """shard, slots, records (compressed): the sequences of each slice, by the shard of their slots."""
    permutation = Permutation(n)
    shared = slices.sparkSession.sparkContext.broadcast(begins)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor, decompressor = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

        def whole(batch: pa.RecordBatch, column: str, k: int, kind: type) -> np.ndarray:
            return np.frombuffer(decompressor.decompress(batch.column(column)[k].as_py()), kind)

        for batch in batches:
            for k in range(batch.num_rows):
                ids, sizes = whole(batch, "ids", k, np.uint16), whole(batch, "sizes", k, np.int64)
                records = _records(ids, sizes, whole(batch, "owners", k, np.int64), len(ids), length)
                number = shared.value[batch.column("part")[k].as_py()] + batch.column("first")[k].as_py()
                slots = permutation.slot(np.arange(number, number + len(records)))
                order = np.argsort(slots)
                shard = slots[order] // per_shard
                edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
                groups = np.split(order, edges[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[edges], pa.int32()),
                        pa.array([slots[g].tobytes() for g in groups], pa.binary()),
                        pa.array([compressor.compress(records[g].tobytes()) for g in groups], pa.binary()),
                    ],
                    names=["shard", "slots", "records"],
                )

    columns = slices.select("part", "first", "ids", "sizes", "owners")
    return columns.mapInArrow(deal, "shard int, slots binary, records binary")


def write_shards(
    docs: DataFrame,
    vocabulary: str,
    path: str,
    length: int = LENGTH,
    per_shard: int = SHARD_RECORDS,
    folder: str | None = None,
) -> int:
    """Writes the ids of `docs` (doc_id, text) below `path` and returns the number of sequences.

    `docs` is read once; its ids are stored in `folder`. A null text has an end only; repeated rows are written each;
    other columns are ignored. Special tokens written out in a text are encoded as ordinary text. File k of the folder, in
    order of names, holds the slots from k * per_shard on.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    folder = folder or shared_folder(docs.sparkSession)
    slices = written(encoded_slices(docs, vocabulary, length), folder, "encoded")
    # one row for each input partition
    counts = dict(slices.groupBy("part").agg(F.sum("sequences")).collect())
    n = sum(counts.values())
    if not n:
        return 0
    begins = dict(zip(sorted(counts), accumulate((counts[p] for p in sorted(counts)), initial=0)))
    n_shards = -(-n // per_shard)
    dealt = shuffled_records(slices, begins, n, length, per_shard).repartitionById(n_shards, F.col("shard"))
    width = stride(length)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        size = min(per_shard, n - shard * per_shard)
        out = np.zeros((size, width), np.uint8)
        filled = 0
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for slots, records in zip(batch.column("slots"), batch.column("records")):
                at = np.frombuffer(slots.as_py(), np.int64) - shard * per_shard
                out[at] = np.frombuffer(decompressor.decompress(records.as_py()), np.uint8).reshape(len(at), width)
                filled += len(at)
        if filled != size:
            raise RuntimeError(f"shard {shard} has {filled} of {size} records")
        # the writer adds the line feed
        for a in range(0, size, 512):
            rows = out[a : a + 512, :-1].copy()
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * (width - 1)
            column = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])
            yield pa.RecordBatch.from_arrays([column], names=["record"])

    records = dealt.mapInArrow(fill, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.mode("overwrite").option("lineSep", "\n").text(path)
    return n


def read_shards(spark: SparkSession, path: str, start: int = 0, length: int = LENGTH, per_shard: int = SHARD_RECORDS):
    """One row per record from slot `start` on, with its ids: slot, shard, byte_offset, doc_id, place, ids.

    Files before the one that holds `start` are left out by their names and not opened, so that training can resume at
    any slot. Of that one file, of per_shard records, the records before `start` are read and passed over.
    """

    def whole(shard: int, slots: np.ndarray, head: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        return [pa.array([x[:u].tolist() for x, u in zip(ids, head["used"].tolist())], pa.list_(pa.int32()))]

    return _read(spark, path, start, length, per_shard, whole, "ids array<int>")


def _read(spark: SparkSession, path: str, start: int, length: int, per_shard: int, columns_of, schema: str) -> DataFrame:
    named = re.findall(r"/(part-(\d+)[^/]*?)(?=, |\])", listed(spark, f"{path}/part-*"))
    wanted = [f"{path}/{name}" for name, shard in named if int(shard) >= start // per_shard]
    number = F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("int")
    if wanted:
        files = spark.read.format("binaryFile").load(wanted).select(number.alias("shard"), "content")
    else:
        files = spark.createDataFrame([], "shard int, content binary")
    schema = "slot long, shard int, byte_offset long, doc_id long, place long, " + schema
    names = [x.split()[0] for x in schema.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = stride(length)
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = np.frombuffer(content.as_py(), np.uint8).reshape(-1, width)
                for a in range(max(start - shard * per_shard, 0), len(data), 512):
                    rows = data[a : a + 512]
                    head = np.ascontiguousarray(rows[:, : HEADER.itemsize]).view(HEADER).ravel()
                    ids = np.ascontiguousarray(rows[:, HEADER.itemsize : -1]).view("<u2")
                    at = np.arange(a, a + len(rows))
                    slots = at + shard * per_shard
                    columns = [
                        pa.array(slots, pa.int64()),
                        pa.array(np.full(len(rows), shard), pa.int32()),
                        pa.array(at * width, pa.int64()),
                        pa.array(head["doc_id"], mask=head["doc_id"] == -1),
                        pa.array(head["place"].astype(np.int64)),
                        *columns_of(shard, slots, head, ids),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return files.mapInArrow(parse, schema)


def shard_digests(spark: SparkSession, path: str, vocabulary: str, length: int = LENGTH, per_shard: int = SHARD_RECORDS):
    """The records as read back, with their numbers of tokens and of text ends, and the digest of their ids' bytes."""
    end = WordBpe.load(vocabulary).special[END_TOKEN]

    def digest(shard: int, slots: np.ndarray, head: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        used = np.arange(ids.shape[1]) < head["used"][:, None]
        hashes = [hashlib.sha256(x[:u].tobytes()).hexdigest() for x, u in zip(ids, head["used"].tolist())]
        return [
            pa.array(head["used"].astype(np.int64)),
            pa.array(((ids == end) & used).sum(1)),
            pa.array(hashes, pa.string()),
        ]

    return _read(spark, path, 0, length, per_shard, digest, "n_tokens long, n_ends long, ids_sha256 string")
