"""Ranked lexical search: an inverted index in shards, searched term-at-a-time over short lists and document-at-a-time
over long ones.

The index is a stored table with one row per shard: some documents of one input partition, their numbers of terms, and
for each term its documents and frequencies. Statistics of the corpus come from it, so texts are cut into terms once.

A shard answers a query in two steps. The short lists are summed up term at a time; what they give, one score for each
of their documents, is from then on one more list with an upper bound, as each long list has one. Documents are then
visited in ascending blocks. Lists whose bounds add up to less than the tenth best score so far cannot bring in a new
document: candidates come from the others only, and the rest are searched for the candidates that can still reach that
score. The ten best of a task go on from shard to shard, and so does the score to beat.

Queries are a stated set and are taken in blocks of bounded size, each of which is run against all shards.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmark.llm.text import LOWER, span_digests, spans_of, text_bytes, text_slices
from trailmark.scratch import shared_folder, written

TOP = 10
SHARD_BYTES = 4_000_000  # text of a shard, or one longer text
BLOCK_BYTES = 4_000_000  # text of a block of queries, or one longer query
SHORT = 64  # lists of at most one document in so many of the shard's are short
DOC_BLOCK = 2048  # documents visited at once

# the characters that end a term: ASCII other than letters and digits
IS_TERM = np.ones(256, bool)
IS_TERM[:128] = [chr(b).isalnum() for b in range(128)]
_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = {i: i + 32 for i in range(65, 91)}

_INDEX = (
    "n_used long, n_terms long, ids array<long>, sizes binary, digests binary, terms binary, counts binary,"
    " docs binary, freqs binary"
)


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


def _narrow(x: np.ndarray) -> bytes:
    """In 16 bits each if all fit, else in 32."""
    return x.astype(np.uint16 if not len(x) or x.max() < 1 << 16 else np.uint32).tobytes()


def _wide(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(x, np.uint16 if len(x) == 2 * n else np.uint32).astype(np.int64)


def _shard(part: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = text_bytes(part.column("text"))
    data = LOWER[data]
    starts, ends, rows = spans_of(IS_TERM[data], offsets)
    digests = span_digests(data, starts, ends)
    order = np.argsort(digests, kind="stable")  # rows stay in order inside a term
    digest, row = digests[order], rows[order]
    new_term = np.concatenate([[True], digest[1:] != digest[:-1]])[: len(digest)]
    posting = new_term.copy()
    posting[1:] |= row[1:] != row[:-1]
    at = np.flatnonzero(posting)
    first = np.flatnonzero(new_term)
    freqs = np.diff(np.append(at, len(digest)))
    counts = np.diff(np.append(np.searchsorted(at, first), len(at)))
    raw = data.tobytes()
    words = b" ".join([raw[a:b] for a, b in zip(starts[order[first]].tolist(), ends[order[first]].tolist())])
    sizes = np.bincount(rows, minlength=part.num_rows)
    values = [
        pa.array([int((sizes > 0).sum())], pa.int64()),
        pa.array([len(rows)], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("doc_id")),
        *[
            pa.array([x], pa.binary())
            for x in (
                sizes.astype(np.uint32).tobytes(), digest[first].tobytes(), words, _narrow(counts),
                _narrow(row[at]), _narrow(freqs),
            )
        ],
    ]
    names = ["n_used", "n_terms", "ids", "sizes", "digests", "terms", "counts", "docs", "freqs"]
    return pa.RecordBatch.from_arrays(values, names=names)


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard, from `docs` (doc_id, text); null texts have no terms. Nothing is shuffled."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SHARD_BYTES):
                yield _shard(part)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, _INDEX)


class Queries(NamedTuple):
    """A block of queries. Terms are numbered in the order of their digests."""

    items: list  # ids as given
    words: list[bytes]
    digests: np.ndarray
    asked: list[np.ndarray]  # terms of each query


def query_block(rows: list[tuple]) -> Queries:
    """From (item_id, text) rows; equal ids are queries of their own."""
    sets = [sorted(set(terms_of(text))) for _, text in rows]
    words = [w.encode() for w in sorted(set().union(*sets))]
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = ends - np.array([len(w) for w in words], np.int64)
    digests = span_digests(np.frombuffer(b"".join(words), np.uint8), starts, ends)
    order = np.argsort(digests)
    number = {words[k].decode(): n for n, k in enumerate(order.tolist())}
    asked = [np.array([number[w] for w in s], np.int64) for s in sets]
    return Queries([i for i, _ in rows], [words[k] for k in order], digests[order], asked)


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """The queries in blocks of `limit` bytes of text; the driver holds one block at a time."""
    rows, size = [], 0
    for row in items.select(F.col("item_id"), F.col("text").cast("string")).toLocalIterator():
        rows.append((row[0], row[1]))
        size += len(row[1] or "") + 64
        if size >= limit:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _found(row: dict, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """Query terms that a shard holds, and their numbers in the shard; the digest finds them, the bytes decide."""
    digests = np.frombuffer(row["digests"], np.uint64)
    if not len(digests) or not len(queries.digests):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(digests, queries.digests), len(digests) - 1)
    mine = np.flatnonzero(digests[at] == queries.digests)
    words = row["terms"].split(b" ")
    same = [words[at[k]] == queries.words[k] for k in mine.tolist()]
    mine = mine[same] if len(mine) else mine
    return mine, at[mine]


def document_counts(index: DataFrame, queries: Queries) -> np.ndarray:
    """How many documents hold each term of the block; every task sends one row for each term it has."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        total = np.zeros(len(q.words), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                mine, at = _found(row, q)
                total[mine] += _wide(row["counts"], len(row["digests"]) // 8)[at]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    counted = index.select("digests", "terms", "counts").mapInArrow(count, "term long, df long")
    out = np.zeros(len(queries.words), np.int64)
    for term, df in counted.groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    shared.unpersist()
    return out


class Top:
    """The best documents of one query so far, best first."""

    def __init__(self) -> None:
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    @property
    def bar(self) -> int:
        """The score that a further document has to reach."""
        return int(self.scores[-1]) if len(self.scores) == TOP else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        best = np.lexsort((ids, nulls, -scores))[:TOP]
        self.scores, self.ids, self.nulls = scores[best], ids[best], nulls[best]


class Posting(NamedTuple):
    docs: np.ndarray
    impacts: np.ndarray
    bound: int
    edges: np.ndarray  # where each block of documents starts


def _posting(docs: np.ndarray, impacts: np.ndarray, blocks: np.ndarray) -> Posting:
    return Posting(docs, impacts, int(impacts.max(initial=0)), np.searchsorted(docs, blocks))


def summed(lists: list[Posting]) -> tuple[np.ndarray, np.ndarray]:
    """Documents of any of the lists in ascending order, and their summed impacts: term at a time."""
    docs, impacts = np.concatenate([x.docs for x in lists]), np.concatenate([x.impacts for x in lists])
    order = np.argsort(docs, kind="stable")
    docs, impacts = docs[order], impacts[order]
    cuts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[cuts], np.add.reduceat(impacts, cuts)


def search_shard(lists: list[Posting], n_docs: int, ids: np.ndarray, nulls: np.ndarray, top: Top) -> None:
    """Brings `top` up to date with the documents of a shard."""
    blocks = np.arange(0, n_docs + DOC_BLOCK, DOC_BLOCK)
    short = [x for x in lists if len(x.docs) * SHORT <= n_docs]
    long = [x for x in lists if len(x.docs) * SHORT > n_docs]
    bar = top.bar
    if short:
        docs, sums = summed(short)
        long.append(_posting(docs, sums, blocks))
        if len(sums) >= TOP:  # whole scores are no smaller than these
            bar = max(bar, int(np.partition(sums, len(sums) - TOP)[len(sums) - TOP]))
    long.sort(key=lambda x: x.bound)
    reach = np.cumsum([x.bound for x in long])  # what a document can have from a list and those before it
    if not len(reach) or reach[-1] < bar:
        return
    for b in range(len(blocks) - 1):
        at = blocks[b]
        needed = int(np.searchsorted(reach, bar))  # lists before this one bring in no document
        if needed == len(long):
            return
        score = np.zeros(DOC_BLOCK, np.int64)
        for x in long[needed:]:
            part = slice(x.edges[b], x.edges[b + 1])
            score[x.docs[part] - at] += x.impacts[part]
        candidates = np.flatnonzero(score)
        for k in range(needed - 1, -1, -1):
            candidates = candidates[score[candidates] + reach[k] >= bar]
            if not len(candidates):
                break
            x = long[k]
            low, high = x.edges[b], x.edges[b + 1]
            if low == high:
                continue
            found = np.minimum(np.searchsorted(x.docs[low:high], candidates + at), high - low - 1) + low
            hit = x.docs[found] == candidates + at
            score[candidates[hit]] += x.impacts[found[hit]]
        candidates = candidates[score[candidates] >= bar]
        if len(candidates):
            top.add(score[candidates], ids[candidates + at], nulls[candidates + at])
            bar = max(bar, top.bar)


def _shard_lists(row: dict, queries: Queries, weights: np.ndarray, n: int, length: int) -> tuple[dict, int]:
    """The lists of the query terms that a shard holds, with scores in place of frequencies."""
    sizes = np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
    mine, at = _found(row, queries)
    counts = _wide(row["counts"], len(row["digests"]) // 8)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    docs, freqs = _wide(row["docs"], total), _wide(row["freqs"], total)
    m = 100 - 90 + (90 * sizes * n) // max(length, 1)
    blocks = np.arange(0, len(sizes) + DOC_BLOCK, DOC_BLOCK)
    lists = {}
    for term, k in zip(mine.tolist(), at.tolist()):
        part = slice(ends[k] - counts[k], ends[k])
        tf, held = freqs[part], docs[part]
        impacts = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[held]))
        if weights[term] > 0:
            lists[term] = _posting(held, impacts, blocks)
    return lists, len(sizes)


def _ranked(index: DataFrame, queries: Queries, weights: np.ndarray, n: int, length: int, first: int) -> DataFrame:
    """The ten best documents of each query and task."""
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, w = shared.value
        tops = [Top() for _ in q.items]
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                ids = part.column("ids").flatten()
                nulls = pc.is_null(ids).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(ids, 0).to_numpy()
                lists, n_docs = _shard_lists(part.drop_columns(["ids"]).to_pylist()[0], q, w, n, length)
                for top, asked in zip(tops, q.asked):
                    held = [lists[t] for t in asked.tolist() if t in lists]
                    if held:
                        search_shard(held, n_docs, ids, nulls, top)
        number = np.repeat(np.arange(len(tops)), [len(x.scores) for x in tops])
        if len(number):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + first),
                    pa.array(np.concatenate([x.ids for x in tops]), mask=np.concatenate([x.nulls for x in tops])),
                    pa.array(np.concatenate([x.scores for x in tops])),
                ],
                names=["query", "doc_id", "score"],
            )

    columns = index.select("ids", "sizes", "digests", "terms", "counts", "docs", "freqs")
    return columns.mapInArrow(rank, "query long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, folder: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ten best rows of `docs` (doc_id, text) for each row of `items` (item_id, text).

    Scores are those of the saturated frequencies of an item's terms weighted by rarity, in whole numbers. Equal scores
    are ranked by ascending doc_id, rows without an id last. Null texts have no terms. Rows that repeat an id are
    documents, or queries, of their own. Items without a matching document have no row; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    index = written(build_index(docs), folder, "index")
    n, length = index.agg(F.coalesce(F.sum("n_used"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    item_type = items.schema["item_id"].dataType
    first = 0
    schema = f"query long, item_id {item_type.simpleString()}, rank int, doc_id long, score long"
    for k, rows in enumerate(_blocks(items, block_bytes)):
        queries = query_block(rows)
        held = document_counts(index, queries).tolist()
        weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) if df else 0 for df in held]
        tops = _ranked(index, queries, np.array(weights, np.int64), n, length, first)
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        tops = tops.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
        ids = spark.createDataFrame([(first + i, x) for i, x in enumerate(queries.items)], schema.split(", rank")[0])
        tops = tops.join(F.broadcast(ids), "query").select("query", "item_id", "rank", "doc_id", "score")
        tops.write.mode("append" if k else "overwrite").parquet(f"{folder}/tops")
        first += len(rows)
    if not first:
        return spark.createDataFrame([], schema).drop("query")
    return spark.read.schema(schema).parquet(f"{folder}/tops").drop("query")
