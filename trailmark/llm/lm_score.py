"""Language-model scores of whole texts: a causal self-attention model over subwords, backed by corpus word counts.

Words are cut into subwords by the first merges of a public vocabulary, with the word's end marked. The attention model
gives P(word | context) as the product over its subwords. The score mixes it with the counts of all training words,

    P(w | context) = SHARE * P_attention(w | context) + (1 - SHARE) * count(w) / N

with N training tokens, which sums to at most one.

1. Documents are put into blocks. Each block reports its distinct words with their training counts to the words' shards,
   and trains the model on every window of all its training texts, starting from a common model.
2. Shards add up the counts and answer each block. The blocks' models are averaged by the tokens they were trained on.
3. Blocks score their texts.

The common model is fitted on the beginnings of START_TEXTS training texts; everything else covers all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm import attention
from trailmark.llm.bpe import WordBpe
from trailmark.llm.text import IS_SPACE, LOWER, keep_memory, mixed, text_bytes, text_slices, words_of
from trailmark.scratch import shared_folder, written

START_TEXTS = 400  # training texts of the smallest hashed ids
START_CHARS = 20_000  # of each of these texts, so that one task holds them all
START_STEPS, START_RATE = 500, 0.015
BLOCK_STEPS, BLOCK_RATE = 40, 0.004  # a small block is passed over several times, up to so many steps
BLOCK_BATCH = (64, 512)  # windows of a step: the least, and the most, which blocks of many windows use
GROUP_WORDS = 200_000  # words that are cut into windows at a time; a long text is one group of its own
SHARE = 0.75
MODEL_GROUPS = 16  # the blocks' models are added up in so many groups
END_KEY = np.uint64(0x7465786520656E64)  # stands for the end token among the hashes of words

SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


class Texts:
    """Words of some texts, and their distinct words."""

    def __init__(self, column: pa.Array):
        hashes, rows, sizes, pieces = [], [], [], []
        base = 0
        for part in text_slices(pa.RecordBatch.from_arrays([column], ["text"])):
            data, offsets = text_bytes(part.column("text"))
            data = LOWER[data]
            words = words_of(data, offsets)
            hashes.append(words.hashes)
            rows.append(words.rows + base)
            sizes.append(words.ends - words.starts)
            pieces.append(data[~IS_SPACE[data]])
            base += part.num_rows
        self.n = base
        self.rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.data = np.concatenate(pieces) if pieces else np.zeros(0, np.uint8)
        # distinct words in the order of their hashes, whatever the order of the texts
        coded = pa.array(hashes).dictionary_encode()
        number = coded.indices.to_numpy()
        first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))
        order = np.argsort(hashes[first], kind="stable")
        self.first, self.keys = first[order], hashes[first[order]]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.word = place[number]
        self.counts = np.bincount(self.rows, minlength=self.n)
        self._encoded = None

    def encoded(self, bpe: WordBpe) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of the distinct words in a row, and their n + 1 offsets."""
        if self._encoded is None:
            ends = np.cumsum(self.sizes)
            size = self.sizes[self.first]
            stop = np.cumsum(size)
            place = np.repeat(ends[self.first] - stop, size) + np.arange(int(size.sum()))
            ids, offsets = bpe.encode_bytes(self.data[place], stop) if len(stop) else (np.zeros(0), np.zeros(1, np.int64))
            self._encoded = ids.astype(np.int16), offsets
        return self._encoded

    def lengths(self, bpe: WordBpe) -> np.ndarray:
        """Tokens of each text, with its end."""
        _, offsets = self.encoded(bpe)
        return np.bincount(self.rows, weights=np.diff(offsets)[self.word], minlength=self.n).astype(np.int64) + 1

    def groups(self, rows: np.ndarray) -> list[np.ndarray]:
        """Some texts, cut into groups of about GROUP_WORDS words."""
        group = np.cumsum(self.counts[rows] + 1) // GROUP_WORDS
        return np.split(rows, np.flatnonzero(np.diff(group)) + 1) if len(rows) else []

    def subwords(self, bpe: WordBpe, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts: words (numbers of tokens), token ids with an end after each text, sizes of the texts."""
        all_ids, offsets = self.encoded(bpe)
        count = self.counts[rows]
        before = np.cumsum(self.counts) - self.counts
        mine = np.repeat(before[rows] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        words = self.word[mine]
        lengths = np.diff(offsets)[words]
        ends = np.cumsum(lengths)
        total = int(lengths.sum())
        flat = all_ids[np.repeat(offsets[words] - (ends - lengths), lengths) + np.arange(total)]
        inner = np.diff(np.append(0, ends)[np.append(0, np.cumsum(count))])
        sizes = inner + 1
        out = np.full(int(sizes.sum()), attention.END, np.int16)
        shift = np.cumsum(sizes) - sizes - (np.cumsum(inner) - inner)
        out[np.repeat(shift, inner) + np.arange(total)] = flat
        return mine, lengths, out, sizes


def _bpe(vocabulary: str) -> WordBpe:
    # bytes and bytes at a word's end, merges, start and end of a text
    return WordBpe.load(vocabulary, attention.START - 512)


def _split(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    shard = (mixed(keys) % np.uint64(n)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(n + 1))


def _column(table: pa.Table) -> pa.Array:
    return table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())


_COUNTS = "shard int, block int, keys binary, counts binary, model binary"


def _start_model(texts: Texts, vocabulary: str) -> bytes:
    _, _, ids, sizes = texts.subwords(_bpe(vocabulary), np.arange(texts.n))
    inputs, targets, _ = attention.windows(ids, sizes)
    model, _ = attention.train(attention.initial(), inputs, targets, START_STEPS, START_RATE, 96)
    return attention.packed(model)


def _local_model(texts: Texts, train: np.ndarray, vocabulary: str, start: dict) -> tuple[bytes, int]:
    """The common model after steps on all windows of a block's training texts, and the number of their tokens.

    The texts come in random order, and the windows of each group of them.
    """
    r = np.random.default_rng(3)
    rows = r.permutation(np.flatnonzero(train))
    if not len(rows):
        return b"", 0
    bpe = _bpe(vocabulary)
    sizes = texts.lengths(bpe)
    groups = texts.groups(rows)
    count = np.array([int((-(-sizes[g] // attention.STRIDE)).sum()) for g in groups])
    batch = int(np.clip(count.sum() // BLOCK_STEPS, *BLOCK_BATCH))
    steps = -(-count // batch)
    passes = -(-BLOCK_STEPS // int(steps.sum()))
    trainer = attention.Trainer(start, passes * int(steps.sum()), BLOCK_RATE)
    for _ in range(passes):
        for g, n in zip(groups, steps):
            # texts of a group are cut in their own order
            _, _, ids, found = texts.subwords(bpe, np.sort(g))
            inputs, targets, _ = attention.windows(ids, found)
            for at in np.array_split(r.permutation(len(inputs)), n):
                trainer.step(inputs[at], targets[at])
    return attention.packed(trainer.p), int(sizes[rows].sum())


def _report(n_shards: int, vocabulary: str, start: bytes):
    def report(table: pa.Table) -> pa.Table:
        keep_memory()
        number = table.column("block")[0].as_py()
        texts = Texts(_column(table))
        train = ~table.column("held_out").to_numpy()
        keys = np.append(texts.keys, END_KEY)
        seen = np.bincount(texts.word[train[texts.rows]], minlength=len(texts.keys))
        counts = np.append(seen, train.sum()).astype(np.uint32)
        order, edges = _split(keys, n_shards)
        rows = []
        for s in range(n_shards):
            at = order[edges[s] : edges[s + 1]]
            if len(at):
                rows.append((s, number, keys[at].tobytes(), counts[at].tobytes(), b""))
        model, tokens = _local_model(texts, train, vocabulary, attention.unpacked(np.frombuffer(start, np.float32)))
        if model:
            rows.append((n_shards + number % MODEL_GROUPS, number, b"", np.int64(tokens).tobytes(), model))
        return _table(rows, _COUNTS)

    return report


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


_ANSWERS = "block int, shard int, counts binary, tokens long, types long, model binary, weight long"


def _add_up(table: pa.Table) -> pa.Table:
    """Total counts in each block's own order, and the shard's share of N and V; or the sum of some models by weight."""
    shard = table.column("shard")[0].as_py()
    if len(table.column("model")[0].as_py()):
        weights = [int(np.frombuffer(x.as_py(), np.int64)[0]) for x in table.column("counts")]
        total = sum(w * np.frombuffer(x.as_py(), np.float32).astype(np.float64) for w, x in zip(weights, table.column("model")))
        return _table([(None, shard, b"", 0, 0, total.tobytes(), sum(weights))], _ANSWERS)
    keys = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("keys")]
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table.column("counts")])
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(back, weights=counts, minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(x) for x in keys])
    rows = [(None, shard, b"", int(totals.sum()), int((totals > 0).sum()), b"", 0)]
    for block, mine in zip(table.column("block").to_pylist(), np.split(totals[back], ends[:-1])):
        rows.append((block, shard, mine.tobytes(), 0, 0, b"", 0))
    return _table(rows, _ANSWERS)


def _scores(n_shards: int, vocabulary: str, model: bytes, n_tokens: int, n_types: int):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keep_memory()
        texts = Texts(_column(docs))
        keys = np.append(texts.keys, END_KEY)
        order, edges = _split(keys, n_shards)
        known = np.zeros(len(keys), np.int64)
        for shard, x in zip(answers.column("shard").to_pylist(), answers.column("counts").to_pylist()):
            known[order[edges[shard] : edges[shard + 1]]] = np.frombuffer(x, np.int64)
        scorer = attention.Scorer(attention.unpacked(np.frombuffer(model, np.float32)))
        counts, rows = known[texts.word], texts.rows
        base = np.log10((known + 0.1) / (n_tokens + 0.1 * (n_types + 1)))
        base_score = np.bincount(rows, weights=base[texts.word], minlength=texts.n) + base[-1]
        n_known = np.bincount(rows, weights=counts > 0, minlength=texts.n) + (known[-1] > 0)
        total = np.zeros(texts.n)
        bpe = _bpe(vocabulary)
        for mine in texts.groups(np.arange(texts.n)):
            words, lengths, ids, sizes = texts.subwords(bpe, mine)
            inputs, targets, first = attention.windows(ids, sizes)
            per_token = np.empty(len(ids))
            found = scorer.score(inputs, targets)
            real = targets >= 0
            per_token[(first[:, None] + np.arange(attention.STRIDE))[real]] = found[real]
            # tokens of each word, and the end of each text
            inner = texts.counts[mine]
            spans = np.ones(len(words) + len(mine), np.int64)
            end_at = np.cumsum(inner + 1) - 1
            is_word = np.ones(len(spans), bool)
            is_word[end_at] = False
            spans[is_word] = lengths
            logs = np.add.reduceat(per_token, np.cumsum(spans) - spans)
            seen = np.full(len(spans), known[-1], np.int64)
            seen[is_word] = counts[words]
            owner = np.repeat(mine, inner + 1)
            share = SHARE if n_tokens else 1.0
            mass = np.log10(share * np.exp(logs) + (1 - share) * seen / max(n_tokens, 1) + 1e-300)
            total += np.bincount(owner, weights=mass, minlength=texts.n)
        values = [
            docs.column("doc_id").combine_chunks(),
            docs.column("held_out").combine_chunks(),
            pa.array(texts.counts + 1, pa.int64()),
            pa.array(n_known.astype(np.int64)),
            pa.array(np.full(texts.n, n_tokens, np.int64)),
            pa.array(base_score),
            pa.array(total),
        ]
        return pa.table(values, names=[x.split()[0] for x in SCHEMA.split(", ")])

    return score


def _common_model(training: DataFrame, vocabulary: str) -> bytes:
    """The model each block starts from, fitted by one task.

    It sees the first START_CHARS characters of the START_TEXTS training texts of the smallest hashes.
    """

    def fit(batches):
        keep_memory()
        texts = Texts(pa.chunked_array([b.column(0) for b in batches], pa.string()).combine_chunks())
        if texts.n:
            yield pa.RecordBatch.from_pydict({"model": pa.array([_start_model(texts, vocabulary)], pa.binary())})

    first = training.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("hash"), F.substring("text", 1, START_CHARS).alias("text")
    )
    first = first.orderBy("hash", "doc_id").limit(START_TEXTS).select("text").coalesce(1)
    model = first.mapInArrow(fit, "model binary").collect()
    return bytes(model[0]["model"]) if model else attention.packed(attention.initial())


def lm_scores(docs: DataFrame, held_out, vocabulary: str, folder: str | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text), scored by what the rows without `held_out` (a condition) teach.

    Tokens are the words and one end per text; A-Z are lower-cased. A null text has the end only. Repeated rows count and
    are scored each. If nothing is held in, counts are 0 and the model is untrained. Words are told
    apart by 64 bits of their hash. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    n_parts = max(docs.rdd.getNumPartitions(), 1)
    n_blocks = n_shards = 4 * n_parts
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    start = _common_model(docs.filter(~F.col("held_out")), vocabulary)
    blocks = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))
    blocks = blocks.repartitionById(n_blocks, "block")  # one task for each; hashed numbers leave tasks uneven
    counts = blocks.groupBy("block").applyInArrow(_report(n_shards, vocabulary, start), _COUNTS)
    answers = written(counts.groupBy("shard").applyInArrow(_add_up, _ANSWERS), folder, "answers")
    # one row of sums, and as many models as there are groups
    n_tokens, n_types = (int(x or 0) for x in answers.agg(F.sum("tokens"), F.sum("types")).first())
    models = answers.filter("weight > 0").select("model", "weight").collect()
    model = start
    if models:
        total = sum(np.frombuffer(x["model"], np.float64) for x in models) / sum(x["weight"] for x in models)
        model = total.astype(np.float32).tobytes()
    replies = answers.filter("block is not null").select("block", "shard", "counts").repartitionById(n_blocks, "block")
    score = _scores(n_shards, vocabulary, model, n_tokens, n_types)
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, SCHEMA)
