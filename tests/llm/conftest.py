from __future__ import annotations

import tempfile

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shared_dir(spark):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="corpus-tests-"))


@pytest.fixture
def docs_of(spark):
    """A table of documents from texts or (id, text) pairs; more columns have names that operators use themselves."""

    def make(rows, **extra):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        table = [(i, t, "en", "src0", len(t or ""), *[v for v in extra.values()]) for i, t in rows]
        schema = DOCS + "".join(f", {k} string" for k in extra)
        return spark.createDataFrame(table, schema)

    return make


#: names that operators use for their own columns
CLASHES = {
    k: "x"
    for k in (
        "node", "n", "block", "bucket", "kind", "found", "merged", "masked", "words", "leaked", "root", "shard", "kept",
        "ids", "component_id", "n_words", "spans", "held_out", "score", "item_id",
    )
}

EDGE_TEXTS = ["", None, " \n\t ", "word", "ünïcödé 漢字   x", "a b c d e f g h i j " * 400, "x" * 50_000]


@pytest.fixture
def edge_docs(docs_of):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = list(enumerate(EDGE_TEXTS)) + [(3, "word"), (3, "word"), (None, "no id here"), (None, None)]
    docs = docs_of(rows, **CLASHES)
    nulls = docs.limit(1).select(*[_null(docs, c) for c in docs.columns])
    return docs.unionByName(nulls)


def _null(docs, name):
    from pyspark.sql import functions as F

    return F.lit(None).cast(docs.schema[name].dataType).alias(name)


