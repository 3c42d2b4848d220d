"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A seed is a fixed mask over SPAN consecutive words: the words under a 1 are hashed, those under a 0 are ignored. Every
position of the test items is hashed under every mask into a table of seeds; every position of the documents is hashed
the same way and joined with it. A hit fixes how document and item are aligned. It is verified on the aligned words:
some window of WINDOW words (or the whole item, if shorter) must agree in at least AGREE of its words, so that words may
be replaced. Words are compared without regard to case. Items of MIN_ITEM to SPAN - 1 words have one seed each, the hash
of all their words, and are found word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 9
# however the words are chosen that AGREE allows to be replaced in a window of SPAN to WINDOW words, a seed is left
MASKS = ("100111001", "111000101", "001001111", "100110110")
WINDOW = 20
AGREE = 0.8
MIN_ITEM = 5  # words; shorter items occur in texts that have nothing to do with them
MAX_BROADCAST_BYTES = 192 << 20  # of the seeds; beyond it the join with them shuffles both sides

# documents are cut into segments of so many seed positions; a hit carries its segment, not the document
SEGMENT = 64
_MARGIN = WINDOW - SPAN  # words on both sides that a window around a seed may reach into

_SPACE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Lower-cased words; a text without words gives one empty word, which is shorter than any seed."""
    trimmed = F.trim(F.coalesce(text.cast("string"), F.lit("")), F.lit(_SPACE))
    return F.split(F.lower(trimmed), r"[\x20\x09-\x0D]+", -1)


def _whole(words: Column, n: int, position: Column) -> Column:
    """The seed of an item of n words: all of them, hashed."""
    return F.xxhash64(F.lit(f"whole {n}"), *[F.get(words, position + k) for k in range(n)])


def _masked(words: Column, position: Column) -> list[Column]:
    """The seeds under every mask at a position."""
    return [
        F.xxhash64(F.lit(m), *[F.get(words, position + k) for k, on in enumerate(mask) if on == "1"])
        for m, mask in enumerate(MASKS)
    ]


def _item_seeds(benchmark: DataFrame) -> DataFrame:
    """seed, item_id, n_item, part (the item's words that a window around the seed can hold), part_at (the place of the
    first of them), item_at (place of the seed in the part)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("item"))
    items = items.withColumn("n_item", F.size("item")).filter(F.col("n_item") >= MIN_ITEM)
    last = F.col("n_item") - SPAN
    short = F.lit(None).cast("long")
    for n in range(MIN_ITEM, SPAN):
        short = F.when(F.col("n_item") == n, _whole(F.col("item"), n, F.lit(0))).otherwise(short)
    placed = items.select("*", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).alias("at"))
    first = F.greatest(F.col("at") - _MARGIN, F.lit(0))
    seeds = F.when(last < 0, F.array(short)).otherwise(F.array(*_masked(F.col("item"), F.col("at"))))
    return placed.select(
        F.explode(seeds).alias("seed"),
        "item_id",
        "n_item",
        F.slice("item", first + 1, F.col("at") - first + SPAN + _MARGIN).alias("part"),
        first.alias("part_at"),
        (F.col("at") - first).alias("item_at"),
    )


def _segments(texts: DataFrame, shortest: int) -> DataFrame:
    """doc_id, first (place of the segment's first word), segment (words), at (each seed position in the segment).

    `shortest` is the number of words that a seed needs, SPAN at most.
    """
    last = F.size("words") - shortest
    cut = texts.filter(last >= 0).select(
        "doc_id", "words", last.alias("last"), F.explode(F.sequence(F.lit(0), last, F.lit(SEGMENT))).alias("start")
    )
    first = F.greatest(F.col("start") - _MARGIN, F.lit(0))
    stop = F.least(F.col("start") + SEGMENT - 1, F.col("last"))
    cut = cut.select(
        "doc_id",
        first.alias("first"),
        (F.col("start") - first).alias("low"),
        (stop - first).alias("high"),
        F.slice("words", first + 1, stop + SPAN + _MARGIN - first).alias("segment"),
    )
    return cut.select("doc_id", "first", "segment", F.explode(F.sequence("low", "high")).alias("at"))


def _bounds(agree: Column, width: Column) -> Column:
    """Number of equal words in the best window of `width`, and the first such window's start."""
    starts = F.sequence(F.lit(0), F.size(agree) - width)
    scored = F.transform(
        starts,
        lambda s: F.struct(
            F.aggregate(F.slice(agree, s + 1, width), F.lit(0), lambda a, x: a + x).alias("n"), (-s).alias("at")
        ),
    )
    return F.array_max(scored)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and test item found in it, at the best alignment:

    doc_id, item_id, n_equal (equal words of the best window), n_window (its words), doc_word (its first word in the
    document, from 0), item_word, n_item (words of the item).

    Items of fewer than MIN_ITEM words carry too little evidence and are not looked for, those below SPAN words are found
    word for word; texts that are null or shorter than the items match nothing. Rows of the same doc_id count as one
    document, items of the same item_id as one item; null ids form a document or item of their own. Other columns, whatever
    their names, are ignored in both tables.
    """
    seeds = _item_seeds(benchmark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    # the number of items does not follow that of the documents, but their bytes are counted all the same
    size = F.aggregate("part", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 16) + 64
    short = [F.max(F.when(F.col("n_item") == n, n)) for n in range(MIN_ITEM, SPAN)]
    size_of, *lengths = seeds.agg(F.sum(size), *short).first()
    lengths = [n for n in lengths if n]  # short items there are; without them their seeds are not computed
    known = seeds.select("seed").distinct()
    if (size_of or 0) <= MAX_BROADCAST_BYTES:
        seeds, known = F.broadcast(seeds), F.broadcast(known)
    placed = _segments(texts, min(lengths, default=SPAN))
    segment, at = F.col("segment"), F.col("at")
    found_at = F.array(*_masked(segment, at), *[_whole(segment, n, at) for n in lengths])
    # the semi join has no condition but the key, so it stays in one compiled stage with the hashing; only hits leave it
    hits = placed.select("*", F.explode(found_at).alias("seed")).join(known, "seed", "left_semi").join(seeds, "seed")
    diagonal = F.col("at") - F.col("item_at")
    first = F.greatest(F.lit(0), -diagonal)
    length = F.least(F.size("part"), F.size("segment") - diagonal) - first
    width = F.least("n_item", F.lit(WINDOW))
    agree = F.zip_with(
        F.slice("part", first + 1, length),
        F.slice("segment", diagonal + first + 1, length),
        lambda a, b: (a == b).cast("int"),
    )
    found = (
        hits.filter(length >= width)
        .select(
            "doc_id",
            "item_id",
            (F.col("first") + diagonal - F.col("part_at")).alias("diagonal"),
            (F.col("part_at") + first).alias("item_first"),
            "n_item",
            width.alias("n_window"),
            _bounds(agree, width).alias("best"),
        )
        .filter(F.col("best.n") >= F.ceil(F.lit(AGREE) * F.col("n_window")))
    )
    item_word = F.col("item_first") - F.col("best.at")
    ranked = found.select(
        "doc_id",
        "item_id",
        F.struct(
            F.col("best.n").alias("n_equal"),
            F.col("n_window"),
            (-(item_word + F.col("diagonal"))).alias("doc_word"),
            (-item_word).alias("item_word"),
            F.col("n_item"),
        ).alias("best"),
    )
    # repeated alignments are combined before the shuffle
    return ranked.groupBy("doc_id", "item_id").agg(F.max("best").alias("best")).select(
        "doc_id",
        "item_id",
        F.col("best.n_equal").alias("n_equal"),
        F.col("best.n_window").alias("n_window"),
        (-F.col("best.doc_word")).alias("doc_word"),
        (-F.col("best.item_word")).alias("item_word"),
        F.col("best.n_item").alias("n_item"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id has no leak, with all their columns. Null ids count as one document."""
    found = leaks(docs, benchmark).select("doc_id").distinct().withColumnRenamed("doc_id", "leaked")
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["leaked"]), "left_anti")
