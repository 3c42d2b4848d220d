"""Alignment of two tokenizers against a plain version that compares all byte ranges."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from test_brute import make_texts
from trailmark.llm import alignment as S
from trailmark.llm.bpe import byte_symbols
from trailmark.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["", None, "<|endoftext|> a <s> b</s>", "a▁b", "  two  spaces\n\n\tx", "漢字\U0001f600 é é", "x", "x", "<0x41>", "\x00\x1f", " " * 300, "y" * 3000]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def plain(text, library):
    a, b = library
    byte = {s: i for i, s in enumerate(byte_symbols())}
    encoded = a.encode(" " + text, add_special_tokens=False)
    bytes_a = [bytes(byte[c] for c in t) for t in encoded.tokens]
    ids_b = b.encode(text)
    pieces = [(b.id_to_piece(i), b.is_byte(i)) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces]
    raw = (" " + text).encode()
    if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    span_a, span_b = spans(bytes_a), spans(bytes_b)
    groups, start = [], 0
    for end in sorted({e for _, e in span_a} & {e for _, e in span_b}):
        parts = [",".join(str(i) for i, (s, e) in zip(ids, sp) if s >= start and e <= end) for ids, sp in ((encoded.ids, span_a), (ids_b, span_b))]
        groups.append("|".join(parts))
        start = end
    links = [(i, j) for i, (s, e) in zip(encoded.ids, span_a) for j, (t, f) in zip(ids_b, span_b) if s < f and t < e]
    return len(encoded.ids), len(ids_b), groups, links


def test_measures(docs_of, library, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(S, "SLICE_BYTES", 1000)
    texts = make_texts(11, n=60, names=80) + ODD
    texts += texts[:20] * 3
    found = [plain(t or "", library) for t in texts]
    counts = Counter(p for f in found if f for p in set(f[3]))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    want = []
    for i, f in enumerate(found):
        if not f:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        n_best = sum(counts[p] == best[p[0]] for p in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        want.append((i, n_a, n_b, len(groups), len(links), n_best, sum(counts[p] for p in links), digest))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = S.align_tokenizers(docs_of(texts), A, B)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == want
    assert want[texts.index("a▁b")][1:] == (0, 0, 0, 0, 0, 0, "")


def test_fast_ids_are_the_librarys(library):
    pair = S.TokenizerPair.load(A, B)
    assert pair.fast is not None
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + list(range(0x1F600, 0x1F700))
    texts = [f" a{chr(c)}b {chr(c)}1{chr(c)}  {chr(c)}{chr(c)} ." for c in points]
    texts += [" it's we'll I'M 12ab  \n\n x", " " * 20_000 + "a", "\n" * 20_000]
    for text, e in zip(texts, library[0].encode_batch(texts, add_special_tokens=False)):
        assert pair._ids_a(text) == e.ids


def test_equal_texts_are_aligned_once(docs_of):
    aligned = S.aligned_texts(docs_of(["a b"] * 50 + ["c", None, ""]), A, B).collect()
    assert sorted(r["copies"] for r in aligned) == [1, 50]
