"""Operators against plain Python on small texts."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trailmark.llm import attention, bpe, decontaminate, html, labelled_pages, langid, lm_score, ngram_join, quality
from trailmark.llm import queries, secrets, substring_dedup, token_shards
from trailmark.llm.fm_index import FmIndex, repeated
from trailmark.llm.queries import tokenizer_path

VOCABULARY = tokenizer_path("word_bpe_49k.json")
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def make_texts(seed, n=120, names=400):
    """Texts with passages in common, near copies, copies and repetition."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(names)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(15, 70))] for _ in range(5)]
    out = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.3:
            base = words(r.choice(out))
            for _ in range(r.randint(0, 4)):
                if base:
                    base[r.randrange(len(base))] = r.choice(vocabulary)
            out.append(" ".join(base))
            continue
        text = [r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 5, 20, 60, 150, 400]))]
        if kind < 0.7:
            at = r.randint(0, len(text))
            text[at:at] = r.choice(passages)
        if kind > 0.95:
            text = text[:3] * 30
        out.append(r.choice([" ", "\n", " \t"]).join(text))
    return out


# --- n-gram join


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root[a], root[b]))
            root = [x if v == y else v for v in root]
    return [(i, len(s), r) for i, (s, r) in enumerate(zip(sets, root))]


@pytest.mark.parametrize("frequent", [24, 1])
def test_join_finds_every_link(docs_of, monkeypatch, frequent):
    # with a low limit most signatures are pairs of tokens
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    texts = make_texts(frequent)
    got = sorted(tuple(r) for r in ngram_join.similarity_components(docs_of(texts).repartition(3)).collect())
    assert got == linked(texts)
    kept = {r["doc_id"] for r in ngram_join.one_per_component(docs_of(texts)).collect()}
    assert kept == {c for _, _, c in got}


def test_signatures_of_similar_sets_meet():
    r = np.random.default_rng(5)
    for n in (3, 9, 40, 63, 64, 70, 79, 80, 200, 900):
        for hot in (0.0, 0.5, 1.0):
            base = r.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            is_hot = {int(x): r.random() < hot for x in base}
            size = r.integers(int(np.ceil(0.8 * n)), n + 1)
            a, b = np.sort(base[:n]), np.sort(base[n - size : n])  # b within a
            if len(b) and len(b) >= 0.8 * n:
                sa, sb = (ngram_join.signatures(x, np.array([is_hot[int(v)] for v in x])) for x in (a, b))
                assert set(sa[0].tolist()) & set(sb[0].tolist()) or set(sa[1].tolist()) & set(sb[1].tolist()), (n, hot)


# --- substring removal


def without_repeats(texts):
    seen, out = set(), []
    for i, t in enumerate(texts):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("frequent", [1000, 2])
def test_repeats(docs_of, monkeypatch, frequent):
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    texts = make_texts(7, n=150)
    docs = docs_of(texts).repartition(3)
    got = sorted(tuple(r) for r in substring_dedup.repeated_words(docs).collect())
    assert got == without_repeats(texts)
    texts = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(docs).collect()}
    assert all(hashlib.sha256(texts[i].encode()).hexdigest() == h for i, _, _, h in got)


def test_index_counts_patterns():
    r = np.random.default_rng(1)
    text = np.append(r.integers(1, 4, 500), 0)
    index = FmIndex(text, 6)
    starts = np.arange(490)
    which, low, high = repeated(index, text, starts, 6)
    counts = Counter(tuple(text[s : s + 6]) for s in range(496))
    want = {s: counts[tuple(text[s : s + 6])] for s in starts if counts[tuple(text[s : s + 6])] > 1}
    assert {int(s): int(h - l) for s, l, h in zip(which, low, high)} == want


# --- BPE and shards


def odd_texts():
    r = random.Random(3)
    plain = ["It's 'tis DON'T we'll", "aaaa aaaaaaa zzzz", "a<|endoftext|>b <|startoftext|>", "x\x1cy \x1f", "ΑΣ İI ß", "é ́"]
    return plain + ["".join(r.choice("ab éS'1 9.!ñß\n\x85　") for _ in range(40)) for _ in range(300)]


def test_ids_and_decoding_equal_the_library(docs_of):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = odd_texts()
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    docs = docs_of(texts)
    encoded = bpe.bpe_encode(docs, VOCABULARY)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == dict(enumerate(ids))
    decoded = [tokenizer.decode(x, skip_special_tokens=False) for x in ids]
    assert {r["doc_id"]: r["text"] for r in bpe.bpe_decode(encoded, VOCABULARY).collect()} == dict(enumerate(decoded))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in decoded]
    got = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in bpe.bpe_digests(docs, VOCABULARY).collect()}
    assert got == {i: (len(ids[i]), sha[i]) for i in range(len(ids))}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation(n):
    p = token_shards.Permutation(n)
    slots = p.slot(np.arange(n))
    assert sorted(slots) == list(range(n)) and (p.number(slots) == np.arange(n)).all()
    assert n < 100 or (slots != token_shards.Permutation(n, key=1).slot(np.arange(n))).any()


def test_shards_hold_all_tokens_in_permuted_order(docs_of, spark, tmp_path):
    docs = docs_of(odd_texts()).coalesce(2)
    path = f"file://{tmp_path}/shards"
    n = token_shards.write_shards(docs, VOCABULARY, path, length=32, per_shard=20)
    rows = {r["slot"]: r for r in token_shards.read_shards(spark, path, 0, 32, 20).collect()}
    order = token_shards.Permutation(n).slot(np.arange(n)).tolist()
    got = [t for s in order for t in rows[s]["ids"]]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    want, places = [], []
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 49407]
        want += ids
        places += [(r["doc_id"], k) for k in range(len(ids))]
    assert got == want
    at = np.cumsum([0] + [len(rows[s]["ids"]) for s in order])
    assert all((rows[s]["doc_id"], rows[s]["place"]) == places[a] for s, a in zip(order, at))
    later = token_shards.read_shards(spark, path, 27, 32, 20)
    assert sorted(r["slot"] for r in later.collect()) == list(range(27, n))
    # only the files that hold these slots are opened
    opened = {int(re.search(r"/part-(\d+)", f)[1]) for f in later.inputFiles()}
    assert opened == set(range(1, -(-n // 20)))
    assert token_shards.read_shards(spark, path, n + 40, 32, 20).collect() == []


def test_words_of_equal_polynomials_get_their_own_ids(docs_of, spark, tmp_path):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    path = f"file://{tmp_path}/shards"
    token_shards.write_shards(docs_of([f"{word} {other}"]).coalesce(1), VOCABULARY, path, length=4096, per_shard=20)
    ids = token_shards.read_shards(spark, path, 0, 4096, 20).first()["ids"]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert ids[:-1] == tokenizer.encode(f"{word} {other}", add_special_tokens=False).ids


# --- secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
BASE = [("assign", ASSIGN, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)]
    return ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_secrets(docs_of):
    r = random.Random(9)
    parts = ["password", " token", "=", ":", '"', " ", "API_KEY", "apikey", "secret", "AKIA", "ABCDEF1234567890", "0123456789abcdef",
             "deadbeef" * 5, "é𝒳", "\n", "x9Kd02LmQ", ".", "Passwd", "aa"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(300)]
    texts.append("token=abcdefgh1 " * 700)  # more matches than a block
    for row in secrets.secret_spans(docs_of(texts)).collect():
        want = base_spans(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        spans = [x for x in row["spans"].split(",") if x and not x.startswith("entropy")]
        assert ",".join(spans) == want
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(x.startswith(k) for x in spans) for k, _, _ in BASE]


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def test_entropy_windows(docs_of, spark):
    r = random.Random(4)
    chars = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"
    keys = ["".join(r.choice(chars) for _ in range(r.randint(20, 60))) for _ in range(40)]
    keys += ["a1" * 15 + k for k in keys[:20]]
    table = spark.createDataFrame([(k,) for k in keys], "key string")
    got = table.select("key", secrets.window_limits(F.col("key"), F.lit(3.7)).alias("w")).collect()
    for row in got:
        key = row["key"]
        hits = [i for i in range(len(key) - 19) if entropy(key[i : i + 20]) >= 3.7 - 1e-9]
        assert tuple(row["w"]) == ((hits[0], hits[-1] + 20) if hits else (None, None))
    allowed = ["123e4567-e89b-12d3-a456-426614174000", "some_long-path/of_words/only", "EXAMPLEkey0aB1cD2eF3gH4", "9" * 30]
    rows = secrets.secret_spans(docs_of([f"x {k} y" for k in allowed + keys[:5]])).collect()
    assert [r["n_entropy"] for r in sorted(rows)] == [0] * len(allowed) + [1] * 5


@pytest.mark.parametrize("size", [20, 255, 256, 257, 275, 276, 513, 2000])
def test_entropy_over_blocks(docs_of, size):
    """A long candidate against one window after the other; low stretches lie across the blocks' edges."""
    r = random.Random(size)
    chars = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"
    texts = []
    for _ in range(6):
        key = [r.choice(chars) for _ in range(size)]
        low = r.randrange(size)
        key[:low] = "a1" * (low // 2) + "a" * (low % 2)
        texts.append("x " + "".join(key) + " y")
    for row in secrets.secret_spans(docs_of(texts)).collect():
        key = texts[row["doc_id"]][2:-2]
        limit = 3.0 if re.fullmatch("[0-9a-fA-F]+", key) else 3.7
        hits = [i for i in range(size - 19) if entropy(key[i : i + 20]) >= limit - 1e-9]
        letters, digits = re.search("[A-Za-z]", key), re.search("[0-9]", key)
        want = [f"entropy:{hits[0] + 2}:{hits[-1] + 22}"] if hits and letters and digits else []
        assert [x for x in row["spans"].split(",") if x.startswith("entropy")] == want


def test_sample_words_silence_themselves_only(docs_of, spark):
    key = "q7Rt2Xz9Lm4Vb8Nc1Kd6q7Rt2Xz9Lm4Vb8Nc1Kd6"
    docs = docs_of([f"EXAMPLE_SERVICE_KEY={key}", f"samples/{key}", f"{key}xXxX{key}", "example" + key[:19] + "sample"])
    rows = {r["doc_id"]: r["spans"] for r in secrets.secret_spans(docs).collect()}
    assert [rows[i].count("entropy") for i in range(4)] == [1, 1, 2, 0]


def test_long_candidates_take_linear_time(docs_of):
    r = random.Random(2)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["".join(r.choices(chars, k=500_000)), "a-b_" * 100_000 + "9a", "token=" + "deadbeef" * 20_000]
    start = time.time()
    rows = {x["doc_id"]: x for x in secrets.secret_spans(docs_of(texts)).collect()}
    assert time.time() - start < 60  # seconds for what took hours
    assert rows[0]["n_entropy"] >= 1 and rows[1]["n_entropy"] == 0 and rows[2]["n_hex"] == 1


def test_masking(docs_of):
    key = "q7Rt2Xz9Lm4Vb8Nc1Kd6"
    docs = docs_of([f"a token={key} b {key}", "nothing here", None])
    got = {r["doc_id"]: r for r in secrets.mask_secrets(docs).collect()}
    assert got[0]["text"] == "a [SECRET] b [SECRET]" and got[0]["n_chars"] == 21
    assert got[1]["text"] == "nothing here" and got[1]["n_chars"] == 12 and got[2]["text"] is None


# --- decontamination


def test_leaks_with_replaced_words(docs_of, spark):
    r = random.Random(2)
    items = [[f"b{i}x{k}" for k in range(n)] for i, n in enumerate((14, 20, 45, 60))]
    texts, want = [], set()
    for k in range(60):
        i = k % 4
        passage = list(items[i])
        for at in range(r.randrange(9), len(passage), 10):  # one word in ten
            passage[at] = "other"
        text = [f"d{r.randrange(999)}" for _ in range(r.randint(0, 120))]
        at = r.randint(0, len(text))
        if k % 3:
            text[at:at] = passage
            want.add((k, i))
        elif k % 2:
            text[at:at] = items[i][:9]  # too little of a long item
        texts.append(" ".join(text).upper())
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x for x in decontaminate.leaks(docs_of(texts), bench).collect()}
    assert set(got) == want
    for (d, i), row in got.items():
        doc, item = texts[d].lower().split(), items[i]
        a, b, n = row["doc_word"], row["item_word"], row["n_window"]
        assert sum(x == y for x, y in zip(doc[a : a + n], item[b : b + n])) == row["n_equal"] >= 0.8 * n
    kept = {x["doc_id"] for x in decontaminate.without_leaks(docs_of(texts), bench).collect()}
    assert kept == set(range(60)) - {d for d, _ in want}


def test_every_allowed_replacement_leaves_a_seed():
    span = decontaminate.SPAN
    masks = [{k for k, on in enumerate(m) if on == "1"} for m in decontaminate.MASKS]
    assert all(len(m) == span for m in decontaminate.MASKS)
    for n in range(span, decontaminate.WINDOW + 1):
        placed = [{at + k for k in m} for m in masks for at in range(n - span + 1)]
        for gone in itertools.combinations(range(n), n - math.ceil(decontaminate.AGREE * n)):
            assert any(p.isdisjoint(gone) for p in placed), (n, gone)


def test_leaks_with_neighbours_replaced(docs_of, spark):
    items = {n: [f"n{n}x{k}" for k in range(n)] for n in (10, 15, 16, 20, 33)}
    gone = {10: (4, 6), 15: (6, 7), 16: (7, 8), 20: (3, 8, 9, 14), 33: (2, 7, 12, 13, 18, 23, 29)}
    texts, kept = [], ["nothing of the kind " * 9]
    for n, item in items.items():
        texts.append("before " + " ".join("other" if k in gone[n] else w for k, w in enumerate(item)) + " after")
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in items.items()], "item_id long, text string")
    docs = docs_of(texts + kept)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == set(enumerate(items))
    assert [r["text"] for r in decontaminate.without_leaks(docs, bench).collect()] == kept


def test_short_items_are_found_word_for_word(docs_of, spark):
    items = {n: " ".join(f"s{n}x{k}" for k in range(n)) for n in range(1, 11)}
    texts = [("x " * n + items[n].upper() + " y" * (n % 3)) for n in items] + list(items.values())
    texts += [items[n].replace("x2", "z2") for n in items] + [None, "", "x", items[8] + " " + items[5]]
    bench = spark.createDataFrame(
        [(n, x, "c", 1) for n, x in items.items()], "item_id long, text string, words string, doc_id int"
    )
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs_of(texts), bench).collect()}
    want = {(i, n) for i, t in enumerate(texts) for n, x in items.items() if n >= 5 and t and x in t.lower()}
    want |= {(20 + n - 1, n) for n in (9, 10)}  # one word replaced
    assert got == want


def test_seeds_hold_no_more_than_a_window_around_them(spark):
    bench = spark.createDataFrame([(1, " ".join(map(str, range(500))))], "item_id long, text string")
    rows = decontaminate._item_seeds(bench).collect()
    assert len(rows) == (500 - 8) * 4 and max(len(r["part"]) for r in rows) == 31


# --- quality and languages


def test_quality_counts(docs_of):
    texts = make_texts(11, n=60, names=30) + ["# a\n# a\n b|c\nb|c\n\n\n", "<x>\n" * 60]
    for row in quality.quality_rules(docs_of(texts)).collect():
        text = texts[row["doc_id"]]
        w = words(text)
        grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want = [len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed]
        assert [row[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")] == want
        assert not (failed and row["kept"])


def test_compression_bands(docs_of):
    r = random.Random(1)
    prose = " ".join("".join(r.choice("etaoinsh") for _ in range(r.randint(2, 8))) for _ in range(900))
    noise = " ".join("".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(6)) for _ in range(2500))
    periodic = " ".join(f"{k}" for k in range(40)) + " "
    half = prose + ("z" * 9 + " ") * 5000
    got = {x["doc_id"]: x for x in quality.quality_rules(docs_of([prose, noise, periodic * 200, half])).collect()}
    assert got[0]["kept"] and not got[1]["kept"] and not got[2]["kept"] and not got[3]["kept"]
    assert [x["doc_id"] for x in quality.keep_good(docs_of([prose, noise])).collect()] == [0]


@pytest.mark.parametrize("width", [2, 3])
def test_short_texts_have_a_band(docs_of, width):
    r = random.Random(width)
    common = [["it", "is", "of", "to", "at", "no", "on"], ["the", "and", "for", "not", "was", "his"]]
    signs = "".join(map(chr, range(33, 127)))
    prose = " ".join(r.choice(common[width - 2]) for _ in range(55))
    noise = " ".join("".join(r.choice(signs) for _ in range(width)) for _ in range(55))
    rows = {x["doc_id"]: x for x in quality.quality_rules(docs_of([prose, noise])).collect()}
    assert len(prose) < 256 and rows[0]["ratio"] > 1.3 and rows[0]["kept"] == (not rows[0]["base_failed"])
    assert not rows[1]["base_failed"] and rows[1]["ratio"] < 1.2 and not rows[1]["kept"]


@pytest.mark.parametrize("size", [4100, 6000, 8191, 8192, 12_000, 40_000])
def test_part_of_a_text_is_encoded_or_repeated(docs_of, size):
    r = random.Random(size)
    vocabulary = ["".join(r.choice("etaoinshrdlucmfw") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    prose = " ".join(r.choice(vocabulary) for _ in range(size))[:size]
    encoded = base64.b64encode(r.randbytes(size)).decode()
    encoded = " ".join(encoded[k : k + 12] for k in range(0, size, 12))
    texts = [prose]
    for percent in (30, 45, 60, 70):
        n = size * percent // 100
        for part in (encoded[:n], ("all the same words again " * size)[:n]):
            texts += [prose[: size - n - 1] + "\n" + part, part + "\n" + prose[: size - n - 1]]
    assert [x["doc_id"] for x in quality.keep_good(docs_of(texts)).collect()] == [0]


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    got = queries.op7_langid(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) > 0.97 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)


def test_no_letters_no_language(docs_of):
    docs = docs_of(["some words of text", "1234 !!", None, ""])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()}
    assert got == {0: "en", 1: "und", 2: "und", 3: "und"}


def plain_languages(rows, texts):
    """Naive Bayes with the operator's features, one n-gram at a time."""
    counts, docs = {}, Counter(lang for _, lang in rows)
    for text, lang in rows:
        mine = counts.setdefault(lang, Counter())
        for bucket, _ in langid.features([text or ""], langid.BUCKETS):
            mine.update(bucket.tolist())
    out = []
    for text in texts:
        grams = [b for bucket, _ in langid.features([text], langid.BUCKETS) for b in bucket.tolist()]
        total = {}
        for lang in sorted(docs):
            size = math.log(counts[lang].total() + langid.SMOOTHING * langid.BUCKETS)
            total[lang] = math.log(docs[lang] / len(rows))
            total[lang] += sum(math.log(counts[lang][g] + langid.SMOOTHING) - size for g in grams)
        best = max(sorted(total), key=total.get)
        out.append((best, 1 / sum(math.exp(x - total[best]) for x in total.values())))
    return out


@pytest.mark.parametrize("languages", [64, 3, 1])
def test_languages_equal_plain_bayes_in_any_blocks(spark, docs_of, monkeypatch, languages):
    monkeypatch.setattr(langid, "LANGUAGES", languages)
    r = random.Random(8)
    rows = []
    for k in range(7):
        letters = [chr(97 + (5 * k + j) % 26) for j in range(9)]
        rows += [("".join(r.choice(letters + [" "]) for _ in range(r.randint(0, 60))), f"l{k}") for _ in range(6)]
    rows += [(t, "l6copy") for t, lang in rows if lang == "l6"]  # ties
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(r.randint(1, 12))) + "x" for _ in range(40)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"))
    got = {x["doc_id"]: x for x in langid.identify(docs_of(texts), model).collect()}
    for i, (lang, score) in enumerate(plain_languages(rows, texts)):
        assert got[i]["lang_pred"] == lang and got[i]["score"] == pytest.approx(score, rel=1e-3)


# --- pages


@pytest.mark.parametrize("part", ['<div class="', "<a<a", "<!", "<a '\"", "<p x='", "<script ", "</b", "<i x=\"'", "<", "a<b \"c"])
def test_broken_markup_takes_linear_time(part):
    start = time.process_time()
    html.leaf_blocks(part * (1_000_000 // len(part)))
    assert time.process_time() - start < 4


def test_tags_end_at_the_first_bracket_outside_quotes():
    r = random.Random(5)

    def plain(page, at):
        quote = ""
        for k in range(at, len(page)):
            if quote:
                quote = "" if page[k] == quote else quote
            elif page[k] == ">":
                return k + 1
            elif page[k] in "\"'":
                quote = page[k]
        return -1

    for _ in range(400):
        page = "".join(r.choice("ab<>\"' ") for _ in range(r.randint(0, 40)))
        ends = html._TagEnds(page)
        for at in range(len(page) + 1):
            assert ends.after(at) == plain(page, at)


def test_formulas_and_hidden_elements_do_not_split_a_block():
    for page, want in [
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>5</mn><annotation>x=5</annotation></math> be five</p>", "Let x=5 be five"),
        ("<p>Press <button>Share</button> here</p>", "Press here"),
        ("<p>One <svg/>two <svg><text>no</text></svg>three</p>", "One two three"),
        ("<p>a <select><option>x<option>y</select>b <script>c < d</script>e</p>", "a b e"),
    ]:
        assert [(b.text, b.path) for b in html.leaf_blocks(page)] == [(want, ("p",))]


def test_decoding_equals_the_best_of_all_labellings():
    r = np.random.default_rng(3)
    for n in (1, 2, 5, 8):
        blocks = [html.Block((f"t{k}",), "x", 0) for k in range(n)]
        weights = {f"in:t{k}": r.normal(size=2) for k in range(n)}
        model = html.Crf(weights, r.normal(size=(2, 2)), r.normal(size=2))
        scores = model.scores(blocks)

        def total(labels):
            inner = sum(scores[k, y] for k, y in enumerate(labels)) + model.start[labels[0]]
            return inner + sum(model.chain[a, b] for a, b in zip(labels, labels[1:]))

        assert model.decode(blocks) == list(max(itertools.product((0, 1), repeat=n), key=total))



def test_pages_of_other_layouts():
    model = html.fit(labelled_pages.labelled_pages())
    pages = labelled_pages.labelled_pages(150, seed=1234)
    hits = [model.decode(b) == labels for b, labels in pages]
    assert sum(hits) > 0.9 * len(hits)


@pytest.mark.parametrize("start", ["<article><h1>A</h1>", "<b>A</b>", "A<p>", "</head>A<p>", "<body>A<p>"])
def test_head_without_end_tag(start):
    page = f"<html><head><meta charset=x><title>T <b>t</title><style>p {{}}</style>\n{start}<p>One <i>two</i>.<p>Three."
    assert [b.text for b in html.leaf_blocks(page)] == ["A", "One two.", "Three."]


def test_articles_of_the_table(spark, sf_dir):
    import html as entities

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in queries.op9_html(spark, sf_dir).collect()}
    for i, page in pages.items():
        body = re.search("<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(entities.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body))
        assert got[i] == "\n".join(filter(None, blocks))


# --- language model


def test_lm_base_and_held_out_score(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in queries.documents(spark, sf_dir).collect()}
    tokens = {i: words(t.translate(LOWER)) + [None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = queries.op1_lm_score(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = tokens[r["doc_id"]]
        want = [held[r["doc_id"]], len(ws), sum(counts[w] > 0 for w in ws), n]
        assert [r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]] == want
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel_tol=1e-9)
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_windows_score_every_token_once():
    sizes = np.array([1, 5, 16, 17, 32, 33, 100])
    ids = np.arange(sizes.sum()) % attention.START
    inputs, targets, first = attention.windows(ids, sizes)
    at = (first[:, None] + np.arange(attention.STRIDE))[targets >= 0]
    assert sorted(at) == list(range(len(ids))) and (ids[at] == targets[targets >= 0]).all()
    before = inputs[:, attention.STRIDE - 1 :][targets >= 0]
    starts = set((np.cumsum(sizes) - sizes).tolist())
    assert all(b == (attention.START if a in starts else ids[a - 1]) for a, b in zip(at, before))


def test_model_sums_to_one_and_ignores_the_future():
    model = attention.initial()
    scorer = attention.Scorer(model)
    r = np.random.default_rng(0)
    inputs = r.integers(0, 1000, (1, attention.SPAN))
    targets = np.full((attention.VOCABULARY, attention.STRIDE), -1)
    targets[:, 3] = np.arange(attention.VOCABULARY)
    found = scorer.score(np.repeat(inputs, attention.VOCABULARY, 0), targets)[:, 3]
    assert abs(np.exp(found.astype(float)).sum() - 1) < 1e-4
    later = inputs.copy()
    later[0, attention.STRIDE - 1 + 4 :] = 7
    assert np.allclose(scorer.hidden(inputs)[:4], scorer.hidden(later)[:4])


def test_gradients():
    model = {k: x.astype(float) for k, x in attention.initial().items()}
    r = np.random.default_rng(0)
    inputs, targets = r.integers(0, 1000, (2, attention.SPAN)), r.integers(-1, 1000, (2, attention.STRIDE))
    _, g = attention.gradients(model, inputs, targets)
    for k, x in g.items():
        at = np.unravel_index(abs(x).argmax(), x.shape)
        step = []
        for d in (1e-5, -2e-5):
            model[k][at] += d
            step.append(attention.gradients(model, inputs, targets)[0])
        model[k][at] += 1e-5
        assert math.isclose((step[0] - step[1]) / 2e-5, x[at], rel_tol=1e-3), k


def test_block_trains_on_every_window(docs_of, monkeypatch):
    r = random.Random(5)
    texts = [" ".join(r.choice(("alpha", "beta", "gamma", "delta")) + str(r.randrange(99)) for _ in range(n)) for n in (9000, 10, 0, 700, 3000)]
    held = np.array([False, False, False, True, False])
    monkeypatch.setattr(lm_score, "GROUP_WORDS", 2500, raising=False)
    block = lm_score.Texts(pa.array(texts))
    _, _, ids, sizes = block.subwords(lm_score._bpe(VOCABULARY), np.flatnonzero(~held))
    want = Counter(x.tobytes() for x in attention.windows(ids, sizes)[1])
    got, plain = Counter(), attention.gradients

    def noted(p, inputs, targets):
        got.update(x.tobytes() for x in targets)
        return plain(p, inputs, targets)

    monkeypatch.setattr(attention, "gradients", noted)
    start = attention.initial()
    found = lm_score._local_model(block, ~held, VOCABULARY, start)
    assert not want - got
    passes = sum(got.values()) // sum(want.values())
    assert got == Counter({k: n * passes for k, n in want.items()})
    assert found[1] == len(ids) and found[0] != attention.packed(start)


def test_block_encodes_its_words_once(monkeypatch):
    r = random.Random(6)
    texts = [" ".join("word" + str(r.randrange(500)) for _ in range(n)) for n in (900, 10, 0, 700, 300)]
    monkeypatch.setattr(lm_score, "GROUP_WORDS", 250)
    block = lm_score.Texts(pa.array(texts))
    calls, plain = [], bpe.WordBpe.encode_bytes

    def noted(self, *args):
        calls.append(1)
        return plain(self, *args)

    monkeypatch.setattr(bpe.WordBpe, "encode_bytes", noted)
    lm_score._local_model(block, np.ones(5, bool), VOCABULARY, attention.initial())
    assert len(calls) == 1


def test_every_block_of_texts_is_one_task(docs_of):
    docs = docs_of([f"text {i} of many" for i in range(80)])
    n = 4 * docs.rdd.getNumPartitions()
    number = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "text"), F.lit(n))
    block = {r["doc_id"]: r["block"] for r in docs.select("doc_id", number.alias("block")).collect()}
    scored = lm_score.lm_scores(docs, F.col("doc_id") % 3 == 0, VOCABULARY)
    found = {(block[r["doc_id"]], r["task"]) for r in scored.select("doc_id", F.spark_partition_id().alias("task")).collect()}
    assert len(found) == len({b for b, _ in found}) == len({t for _, t in found}) > 1


def test_lm_without_training_rows(docs_of):
    rows = lm_score.lm_scores(docs_of(["a b", ""]), F.lit(True), VOCABULARY).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in sorted(rows)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
