"""The pipeline against its stages done in plain Python."""

from __future__ import annotations

import hashlib
import re

from tokenizers import Tokenizer

import corpus_pipeline
from trailmark.llm import quality, queries, secrets
from llm_plain import linked, passages_of


def test_pipeline(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in quality.quality_rules(docs).collect() if r["kept"]}
    root = linked({i: texts[i] for i in sorted(good)})
    left = [i for i in sorted(good) if root[i] == i]
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = passages_of({i: texts[i] for i in left}, items)
    left = [i for i in left if i not in leaked]
    masked = {r["doc_id"]: r["text"] for r in secrets.mask_secrets(docs).collect()}
    tokenizer = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    want = set()
    for i in left:
        ids = tokenizer.encode(masked[i], add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in got} == want
    assert len(got) == len(want) > 100


def test_stages_keep_the_columns(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(30), sf_dir).dtypes == docs.dtypes


def test_stages_on_no_rows(spark, sf_dir):
    docs = queries.documents(spark, sf_dir).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []


def test_masked_texts_hold_no_base_secret(spark, sf_dir):
    docs = secrets.mask_secrets(queries.documents(spark, sf_dir))
    for r in docs.collect():
        assert not re.search("AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r["text"])
