"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams per language are gathered from all training rows. The matrix of log probabilities has a fixed
number of buckets and is broadcast in blocks of LANGUAGES; texts are scored in numpy, one lookup per n-gram. Most tables
have one block. With more, the texts pass one block after the other, and carry the best language so far with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.text import text_slices
from trailmark.scratch import shared_folder, written

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
LANGUAGES = 64  # of a block: its matrix takes 16 MB
SMOOTHING = 0.5
UNKNOWN = "und"
SLICE_BYTES = 1_000_000
CARRIED = "doc_id long, text string, best string, best_total double, log_sum double"


def features(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: bucket of every n-gram of the lower-cased texts, and the text it belongs to.

    Each text stands between two line feeds of its own, so that its edges count as n-grams too, and no n-gram reaches into
    another text.
    """
    texts = [x.lower() for x in texts]
    points = np.frombuffer("".join([f"\n{x}\n" for x in texts]).encode("utf-32-le"), np.uint32)
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), np.array([len(x) + 2 for x in texts], np.int64))
    mask = np.uint32(buckets - 1)
    h = np.zeros(len(points), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        keep = max(len(points) - n + 1, 0)
        h = h[:keep] * np.uint32(0x9E3779B1) + points[n - 1 :]
        if n in ORDERS:
            x = h * np.uint32(0x85EBCA6B) + np.uint32(n)
            x = (x ^ (x >> np.uint32(15))) * np.uint32(0xC2B2AE35)
            inside = rows[:keep] == rows[n - 1 :]
            yield ((x >> np.uint32(13)) & mask)[inside], rows[:keep][inside]


def _texts(part: pa.RecordBatch) -> list[str]:
    return ["" if x is None else x for x in part.column("text").to_pylist()]


def ngram_counts(labelled: DataFrame, buckets: int) -> DataFrame:
    """lang, bucket, n over all rows of `labelled` (text, lang)."""

    def rows_of(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                names, langs = np.unique(part.column("lang").to_pylist(), return_inverse=True)
                for bucket, rows in features(_texts(part), buckets):
                    cells = langs[rows] * buckets + bucket
                    if len(names) <= LANGUAGES:
                        found = np.bincount(cells, minlength=len(names) * buckets)
                        cells = np.flatnonzero(found)
                        found = found[cells]
                    else:
                        cells, found = np.unique(cells, return_counts=True)
                    edges = np.searchsorted(cells, np.arange(len(names) + 1) * buckets)
                    for k, name in enumerate(names.tolist()):
                        if name not in totals and len(totals) >= LANGUAGES:
                            yield from rows_of(totals)
                            totals.clear()
                        mine = totals.setdefault(name, np.zeros(buckets, np.int64))
                        mine[cells[edges[k] : edges[k + 1]] - k * buckets] += found[edges[k] : edges[k + 1]]
        yield from rows_of(totals)

    counts = labelled.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
    return counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Block:
    """Some languages in order, and log probabilities as a matrix of buckets x languages."""

    def __init__(self, langs: list[str], weights: np.ndarray, priors: np.ndarray):
        self.langs, self.weights, self.priors = langs, weights, priors

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Most probable language of each text (the first in order of names on a tie), the log of its probability, and the
        log of the sum of all languages'; neither is normalised."""
        total = np.tile(self.priors, (len(texts), 1))
        for bucket, rows in features(texts, len(self.weights)):
            if not len(bucket):
                continue
            starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            total[rows[starts]] += np.add.reduceat(self.weights[bucket], starts, axis=0, dtype=np.float64)
        best, top = total.argmax(1), total.max(1)
        return [self.langs[k] for k in best.tolist()], top, top + np.log(np.exp(total - top[:, None]).sum(1))


class Model:
    """Counts of n-grams by language (lang, bucket, n), and the number of training rows of each language in order."""

    def __init__(self, counts: DataFrame, docs: list[tuple[str, int]]):
        self.counts, self.docs = counts, docs

    def blocks(self) -> Iterator[Block]:
        """The driver holds one block, and one language's counts beside it."""
        total = sum(n for _, n in self.docs)
        for k in range(0, len(self.docs), LANGUAGES):
            langs = [x for x, _ in self.docs[k : k + LANGUAGES]]
            place = {x: k for k, x in enumerate(langs)}
            mine = self.counts.filter(F.col("lang").isin(langs)).groupBy("lang")
            cells = mine.agg(F.collect_list(F.struct("bucket", "n")).alias("cells")).select(
                "lang", F.col("cells.bucket").alias("bucket"), F.col("cells.n").alias("n")
            )
            # without a single n-gram all buckets are alike
            weights = np.full((BUCKETS, len(langs)), -np.log(BUCKETS), np.float32)
            for row in cells.toLocalIterator():
                counts = np.zeros(BUCKETS)
                counts[row["bucket"]] = row["n"]
                weights[:, place[row["lang"]]] = np.log(counts + SMOOTHING) - np.log(counts.sum() + SMOOTHING * BUCKETS)
            yield Block(langs, weights, np.log(np.array([n for _, n in self.docs[k : k + LANGUAGES]]) / total))


def train(labelled: DataFrame, folder: str | None = None) -> Model | None:
    """Learns from every row of `labelled` (text, lang) with a language; None if there is none.

    The prior of each is its share of documents. The features are the same for any number of languages.
    """
    labelled = labelled.filter(F.col("lang").isNotNull()).select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang")
    )
    docs = sorted((r["lang"], r["n"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect())
    if not docs:
        return None
    counts = ngram_counts(labelled, BUCKETS)
    if len(docs) > LANGUAGES:  # read once for each block
        counts = written(counts, folder or shared_folder(labelled.sparkSession), "ngram_counts")
    return Model(counts, docs)


def identify(docs: DataFrame, model: Model | None, folder: str | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text): the predicted language and its posterior probability.

    `und` with score 0 where the text is null, has no letter, or nothing was learned; on a tie the first in order of names.
    Only the text is looked at. With more than LANGUAGES languages the texts are stored in `folder` between two blocks.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = model.blocks() if model else iter(())
    n_blocks = -(-len(model.docs) // LANGUAGES) if model else 0
    carried = texts.select(
        "*",
        F.lit(UNKNOWN).alias("best"),
        F.lit(float("-inf")).alias("best_total"),
        F.lit(float("-inf")).alias("log_sum"),
    )
    for k, block in enumerate(blocks):
        carried = carried.mapInArrow(_after(docs.sparkSession.sparkContext.broadcast(block), k == n_blocks - 1), CARRIED)
        if k < n_blocks - 1:
            folder = folder or shared_folder(docs.sparkSession)
            carried = written(carried, folder, f"languages{k}")
    return carried.select(
        "doc_id",
        F.col("best").alias("lang_pred"),
        F.when(F.col("best") == UNKNOWN, 0.0).otherwise(F.exp(F.col("best_total") - F.col("log_sum"))).alias("score"),
    )


def _after(shared: Broadcast, is_last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What is carried on after one more block; the last one drops the texts and answers those without letters."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                texts = _texts(part)
                best, top, log_sum = block.score(texts)
                before = part.column("best_total").to_numpy()
                better = top > before
                best = np.where(better, best, part.column("best").to_pylist()).tolist()
                top = np.where(better, top, before)
                log_sum = np.logaddexp(log_sum, part.column("log_sum").to_numpy())
                text = part.column("text")
                if is_last:
                    best = [x if any(map(str.isalpha, t)) else UNKNOWN for x, t in zip(best, texts)]
                    text = pa.nulls(len(texts), pa.string())
                columns = [part.column("doc_id"), text, pa.array(best, pa.string()), pa.array(top), pa.array(log_sum)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "best", "best_total", "log_sum"])

    return update
