"""Every operator on nulls, empty and very long texts, repeated rows, clashing columns, and no rows at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trailmark.llm import bpe, decontaminate, html, labelled_pages, langid, lm_score, ngram_join, quality, secrets
from trailmark.llm import alignment, lexical_search, simhash_join, substring_dedup, token_shards
from trailmark.llm.queries import tokenizer_path

VOCABULARY = tokenizer_path("word_bpe_49k.json")


def bench(spark, rows=((0, "one two three four five six seven eight nine ten eleven twelve"), (1, None), (None, "short"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def decontaminated(docs):
    return decontaminate.leaks(docs, bench(docs.sparkSession))


def identified(docs):
    return langid.identify(docs, langid.train(docs))


def lm(docs):
    return lm_score.lm_scores(docs, F.col("doc_id") % 3 == 0, VOCABULARY)


PER_ROW = {
    "lm": lm,
    "bpe": lambda d: bpe.bpe_digests(d, VOCABULARY),
    "ngram_join": ngram_join.similarity_components,
    "substring": substring_dedup.repeated_words,
    "langid": identified,
    "quality": quality.quality_rules,
    "secrets": secrets.secret_spans,
    "simhash": simhash_join.simhash_components,
    "alignment": lambda d: alignment.align_tokenizers(d, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")),
}
SAME_COLUMNS = {
    "keep_good": quality.keep_good,
    "one_per_component": ngram_join.one_per_component,
    "without_leaks": lambda d: decontaminate.without_leaks(d, bench(d.sparkSession)),
    "mask_secrets": secrets.mask_secrets,
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_per_row(name, edge_docs):
    got = PER_ROW[name](edge_docs)
    want = sorted(r["doc_id"] is None or r["doc_id"] for r in edge_docs.select("doc_id").collect())
    assert sorted(r["doc_id"] is None or r["doc_id"] for r in got.collect()) == want
    repeated = {tuple(round(v, 3) if isinstance(v, float) else v for v in r) for r in got.filter("doc_id = 3").collect()}
    assert len(repeated) == 1


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_no_rows(name, edge_docs):
    assert PER_ROW[name](edge_docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(SAME_COLUMNS))
def test_columns_are_kept(name, edge_docs):
    got = SAME_COLUMNS[name](edge_docs)
    assert got.dtypes == edge_docs.dtypes
    rows = got.collect()
    assert {r["block"] for r in rows} <= {"x", None}
    assert SAME_COLUMNS[name](edge_docs.limit(0)).collect() == []


def test_leaks_edges(edge_docs, docs_of, spark):
    assert decontaminated(edge_docs).collect() == []
    text = "x one two three four five six seven eight nine ten eleven twelve y"
    docs = docs_of([(None, text), (7, text), (7, text)])
    assert sorted((r["doc_id"] or -1, r["item_id"]) for r in decontaminated(docs).collect()) == [(-1, 0), (7, 0)]
    assert decontaminate.leaks(docs, bench(spark, [(None, None)])).collect() == []
    assert [r["doc_id"] for r in decontaminate.without_leaks(docs_of([(None, text), (1, "y")]), bench(spark)).collect()] == [1]


def test_search_edges(edge_docs, spark):
    items = spark.createDataFrame([(1, "word"), (None, "WORD x"), (2, None), (3, "")], "item_id long, text string")
    got = sorted((r["item_id"] or 0, r["rank"], r["doc_id"]) for r in lexical_search.search(edge_docs, items).collect())
    assert [x for x in got if x[0] == 1] == [(1, k + 1, 3) for k in range(3)]
    assert {x[0] for x in got} == {0, 1}


def test_pages_edges(spark):
    model = html.fit(labelled_pages.labelled_pages(60), rounds=20)
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, None, "<p>a", None), (4, "u", "<" * 10_000, "x"), (5, "u", "<div>" * 3000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html.main_text(pages, model).collect()}
    assert len(got) == 5 and got[1]["text"] == got[2]["text"] == "" and got[2]["url"] is None
    assert html.main_text(pages.limit(0), model).collect() == []


def test_shards_edges(edge_docs, tmp_path, spark):
    path = f"file://{tmp_path}/shards"
    n = token_shards.write_shards(edge_docs.coalesce(2), VOCABULARY, path, length=64, per_shard=50)
    rows = token_shards.read_shards(spark, path, 0, 64, 50).collect()
    assert sorted(r["slot"] for r in rows) == list(range(n))
    ends = sum(r["ids"].count(49407) for r in rows)
    assert ends == edge_docs.count()
    assert token_shards.write_shards(edge_docs.limit(0), VOCABULARY, path) == 0
