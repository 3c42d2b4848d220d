"""SimHash components against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from test_brute import make_texts
from trailmark.llm import simhash_join as S

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def print_of(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    prints = [print_of(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids[root[k]] = min(i, ids.get(root[k], i))
    return sorted((i, f"{p:016x}", ids[root[k]]) for k, ((i, _), p) in enumerate(zip(rows, prints)))


@pytest.mark.parametrize("leaf", [S.LEAF, 5])
def test_components(docs_of, leaf):
    texts = make_texts(3) + ["", None, " \n", "a", "A b", "a b c", "x y z " * 30, "Ünï ÄB äb"]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    got = sorted(tuple(r) for r in S.simhash_components(docs_of(rows), leaf=leaf).collect())
    assert got == expected(rows)
    assert len({c for *_, c in got}) < len(rows) - 10


def brute(a, b=None):
    other = a if b is None else b
    near = np.bitwise_count(a[:, None] ^ other[None, :]) <= S.BUDGET
    if b is None:
        near &= np.triu(np.ones(near.shape, bool), 1)
    return set(zip(*[x.tolist() for x in np.nonzero(near)]))


def found(*args):
    out = [p for i, j in S.trie_pairs(*args) for p in zip(i.tolist(), j.tolist())]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("frontier", [S.FRONTIER, 7])
def test_trie_finds_all_pairs_that_agree_in_the_first_block(monkeypatch, frontier):
    monkeypatch.setattr(S, "FRONTIER", frontier)
    r = np.random.default_rng(5)
    for _ in range(8):
        keys = r.integers(0, 1 << 43, size=12, dtype=np.uint64) | np.uint64(5 << 43)
        for _ in range(4):
            flipped = keys ^ (np.uint64(1) << r.integers(0, 43, size=len(keys), dtype=np.uint64))
            keys = np.unique(np.concatenate([keys, flipped]))
        assert found(keys, None, S.FREE, 0) == found(keys, None, 0, 0) == brute(keys)
        cut = np.searchsorted(keys, np.uint64((5 << 43) | (1 << 42)))
        if 0 < cut < len(keys):
            assert found(keys[:cut], keys[cut:], S.FREE + 1, 1) == brute(keys[:cut], keys[cut:])


def test_every_order_has_each_block_first():
    r = np.random.default_rng(6)
    for _ in range(200):
        x = int(r.integers(0, 1 << 63)) * 2 + 1
        y = x ^ (1 << int(r.integers(64))) ^ (1 << int(r.integers(64)))
        turned = [tuple(((v << s) | (v >> (64 - s))) & (1 << 64) - 1 for v in (x, y)) for s in S.ORDERS]
        assert any(a >> (64 - S.FREE) == b >> (64 - S.FREE) for a, b in turned)


def test_a_hot_node_is_opened_and_stays_whole(spark, tmp_path):
    """A third of all fingerprints lie close to one: its node exceeds what a task takes."""
    r = np.random.default_rng(8)
    centre = np.uint64(0x123456789ABCDEF0)
    near = {centre}
    while len(near) < 700:
        p = centre
        for b in r.integers(0, 64, size=int(r.integers(1, 4))):
            p ^= np.uint64(1) << np.uint64(b)
        near.add(p)
    far = r.integers(0, 1 << 63, size=1400, dtype=np.uint64)
    every = np.unique(np.concatenate([np.array(list(near), np.uint64), far]))
    df = spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "fp long")
    label = S.smallest_linked(len(every), *np.array(sorted(brute(every))).T)
    for leaf in (32_768, 60):
        edges = S.linked_prints(df, len(every), f"{tmp_path}/{leaf}", leaf=leaf).collect()
        at = {int(x): k for k, x in enumerate(every.view(np.int64))}
        a, b = np.array([(at[e.a], at[e.b]) for e in edges]).T
        assert (S.smallest_linked(len(every), a, b) == label).all()
        assert len(edges) < 6 * len(every)


def test_fingerprints_of_long_texts(monkeypatch):
    monkeypatch.setattr(S, "_PIECE", 11)
    texts = ["w%d " % k * 40 + "end" for k in range(3)] + ["", "one two"]
    part = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    assert S.majority(*S.shingle_hashes(part), len(texts)).tolist() == [print_of(t) for t in texts]
