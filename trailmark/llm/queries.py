"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import alignment, bpe, decontaminate, html, labelled_pages, langid, lexical_search, lm_score
from trailmark.llm import ngram_join, quality, secrets, simhash_join, substring_dedup, token_shards
from trailmark.llm.oracles import ORACLES
from trailmark.scratch import shared_folder


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers; TOKENIZER_DIR names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(doc_id, n: int):
    """crc32 of the id as decimal text, modulo n; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n, F.lit(0))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(
        documents(spark, sf_dir), remainder("doc_id", 10) == 0, tokenizer_path("word_bpe_49k.json")
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_components(documents(spark, sf_dir))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, vocabulary = f"{shared_folder(spark)}/shards", tokenizer_path("word_bpe_49k.json")
    if not token_shards.write_shards(documents(spark, sf_dir), vocabulary, path):
        spark.createDataFrame([], "value string").write.text(path)
    return token_shards.shard_digests(spark, path, vocabulary)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(documents(spark, sf_dir))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.filter(remainder("doc_id", 4) != 2))
    return langid.identify(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = html.fit(labelled_pages.labelled_pages())
    return html.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"), model)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(
        documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_join.simhash_components(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_bpe": op2_bpe,
    "op3_ngram_join": op3_ngram_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_shards": op5_token_shards,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_langid": op7_langid,
    "op8_quality": op8_quality,
    "op9_html": op9_html,
    "op10_secrets": op10_secrets,
    "op11_search": op11_search,
    "op12_alignment": op12_alignment,
    "op13_simhash": op13_simhash,
}

__all__ = ["ORACLES", "QUERIES"]
