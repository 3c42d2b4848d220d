"""A corpus pipeline in stages, each applying one operator to all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trailmark.llm import bpe, decontaminate, ngram_join, quality, queries, secrets
from trailmark.scratch import shared_folder, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by similar texts: the one with the smallest id."""
    return ngram_join.one_per_component(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; no document is dropped."""
    return secrets.mask_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids of each document and of what they decode to."""
    return bpe.bpe_digests(docs, queries.tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", masked_secrets),
    ("BPE encoding", encoded),
]

#: None: compression ratios, components of links and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written as Parquet and reread as the next one's documents."""
    docs = queries.documents(spark, sf_dir)
    folder = shared_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage{k}")
    return docs
