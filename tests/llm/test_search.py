"""Ranked search against a plain ranking of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trailmark.llm import lexical_search as S

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items):
    """(item, rank, id, score) by scoring every document."""
    counts = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n, length = sum(1 for *_, k in counts if k), sum(k for *_, k in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, k in counts:
            score = 0
            for w in set(terms(text)) & c.keys():
                m = 100 - 90 + (90 * k * n) // length
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scored)[:10])]
    return out


def make(seed, n=400):
    r = random.Random(seed)
    common, rare = [f"c{i}" for i in range(12)], [f"Rare{i}-é{i}" for i in range(300)]
    docs = [" ".join(r.choice(common if r.random() < 0.8 else rare) for _ in range(r.choice([0, 1, 5, 30, 200]))) for _ in range(n)]
    docs += r.choices(docs, k=80)  # copies tie
    items = [" ".join(r.choice(common if r.random() < 0.5 else rare) for _ in range(r.randint(0, 12))) for _ in range(30)]
    return docs, items


@pytest.mark.parametrize(("short", "block", "shard"), [(64, 2048, 4_000_000), (1, 16, 4_000_000), (10**6, 16, 5000), (20, 32, 20_000)])
def test_ranking(spark, docs_of, monkeypatch, short, block, shard):
    monkeypatch.setattr(S, "SHORT", short)
    monkeypatch.setattr(S, "DOC_BLOCK", block)
    docs, items = make(short + block)
    rows = [(7 * i % 1009, t) for i, t in enumerate(docs)] + [(5000, None), (5001, "..."), (None, docs[0]), (None, None)]
    asked = list(enumerate(items)) + [(900, None), (901, "nothing_like_it"), (901, "c1 c1 C2"), (None, "c3")]
    index = S.build_index(docs_of(rows).coalesce(3))
    queries = S.query_block(asked)
    df = S.document_counts(index, queries)
    held = Counter(w for _, t in rows for w in set(terms(t)))
    assert {w.decode(): int(k) for w, k in zip(queries.words, df)} == {w.decode(): held[w.decode()] for w in queries.words}
    # equal item ids are queries of their own, so rows are compared as lists
    found = S.search(docs_of(rows).coalesce(3), spark.createDataFrame(asked, "item_id long, text string"), block_bytes=700)
    assert found.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(ranked(rows, asked), key=key)


def test_lists_are_skipped(monkeypatch):
    """Documents that hold only terms of small bounds are not visited once ten better ones are known."""
    monkeypatch.setattr(S, "DOC_BLOCK", 64)
    n = 6400
    blocks = np.arange(0, n + 64, 64)
    weak = S._posting(np.arange(n), np.full(n, 5), blocks)
    strong = S._posting(np.arange(0, n, 50), np.full(n // 50, 100), blocks)
    looked = []
    real = np.searchsorted
    monkeypatch.setattr(S.np, "searchsorted", lambda a, v, *k: (looked.append(np.size(v)), real(a, v, *k))[1])
    top = S.Top()
    S.search_shard([weak, strong], n, np.arange(n), np.zeros(n, bool), top)
    assert top.scores.tolist() == [105] * 10 and top.ids.tolist() == list(range(0, 500, 50))
    assert sum(looked) < n / 20


def test_no_rows(spark, docs_of):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert S.search(docs_of([]), items).collect() == []
    assert S.search(docs_of(["a b"]), items.limit(0)).collect() == []
    assert [tuple(r) for r in S.search(docs_of(["a b", None, "c", "d"], score="x", rank="y"), items).select("item_id", "rank", "doc_id").collect()] == [(1, 1, 0)]


def test_digests_tell_texts_apart():
    from trailmark.llm.text import span_digests

    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), "", "\0", "\0\0", "a" * 8, "a" * 9, "x" * 255, "x" * 256, "x" * 257]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(x) for x in texts])
    digests = span_digests(data, ends - [len(x) for x in texts], ends)
    assert len(set(digests.tolist())) == len(texts)
    again = span_digests(np.frombuffer(b"--" + texts[6].encode(), np.uint8), np.array([2]), np.array([11]))
    assert again[0] == digests[6]
