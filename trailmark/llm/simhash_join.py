"""SimHash near-duplicates: fingerprints of weighted word shingles, linked by a self-join of binary tries.

The 64 bits of a fingerprint are cut into three blocks. Two fingerprints that differ in two bits at most agree in one
block, so there are three tries, each with another block first, and the traversal of a trie spends nothing of its error
budget inside its first block. The subtrees below that block's leading bits are therefore traversed each by itself, in
one task each; a subtree with more than LEAF fingerprints is opened in Spark level by level, as pairs of nodes whose
prefixes stay within the budget, until every node of a pair is small.

A task traverses pairs of nodes together, one bit a level: children on the same side keep the number of differing bits,
those on different sides have one more, and a pair beyond the budget is dropped with all below it. Nodes are ranges of
the sorted keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.components import components
from trailmark.llm.hot_join import with_measures
from trailmark.llm.text import LOWER, text_bytes, text_slices, word_spans
from trailmark.scratch import shared_folder, written

SHINGLE = 3
SEED = 42
BITS = 64
BUDGET = 2  # differing bits allowed
ORDERS = (0, 21, 42)  # rotations that bring each block to the front
FREE = 21  # leading bits in which the two sides of a pair agree
LEAF = 32_768  # fingerprints of a node that a task takes whole
STEP = 4  # levels opened at once
FEW = 32  # pairs of keys below two nodes that are compared directly
FRONTIER = 1 << 18  # pairs of nodes traversed at once
_PIECE = 1 << 16  # shingles whose bits are counted at once


def shingle_hashes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of each text, and the row of each."""
    data, offsets = text_bytes(part.column("text"))
    starts, ends, rows = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # all words in a row, each followed by one space
    sizes = ends - starts
    stops = np.cumsum(sizes + 1) - 1
    joined = np.full(stops[-1] + 1, 32, np.uint8)
    place = np.ones(len(joined), bool)
    place[stops] = False
    inside = np.repeat(starts - (stops - sizes), sizes) + np.flatnonzero(place)
    joined[place] = LOWER[data[inside]]
    begins = stops - sizes
    n_words = np.bincount(rows, minlength=part.num_rows)
    count = max(len(rows) - SHINGLE + 1, 0)
    first = np.flatnonzero(rows[:count] == rows[SHINGLE - 1 : SHINGLE - 1 + count])
    a, b, row = begins[first], stops[first + SHINGLE - 1], rows[first]
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        at = np.searchsorted(rows, short)
        a = np.concatenate([a, begins[at]])
        b = np.concatenate([b, stops[at + n_words[short] - 1]])
        row = np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        a, b, row = a[order], b[order], row[order]
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    return np.array([digest(text[x:y], SEED) for x, y in zip(a.tolist(), b.tolist())], np.uint64), row


def majority(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """One fingerprint per row: the bits set in more than half of its hashes; 0 without any."""
    ones = np.zeros((n_rows, BITS), np.int64)
    for at in range(0, len(hashes), _PIECE):
        mine = rows[at : at + _PIECE]
        bits = np.unpackbits(hashes[at : at + _PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cuts = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        ones[mine[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    total = np.bincount(rows, minlength=n_rows)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (64 bits as a long) of each row's text; null texts count as empty. Nothing is shuffled."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                prints = majority(*shingle_hashes(part), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
                )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(build, "doc_id long, fp long")


def trie_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, spent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of keys within BUDGET, from the node of all keys `a` and that of all keys `b`, or of `a` with itself.

    Keys are distinct, ascending, and equal in their first `depth` bits inside each array; `spent` of these bits differ
    between the two.
    """
    same = b is None
    b = a if same else b
    ones: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def ones_before(level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in ones:
            bit = np.uint64(BITS - 1 - level)
            of_a = np.concatenate([[0], np.cumsum((a >> bit) & np.uint64(1), dtype=np.int64)])
            of_b = of_a if same else np.concatenate([[0], np.cumsum((b >> bit) & np.uint64(1), dtype=np.int64)])
            ones[level] = of_a, of_b
        return ones[level]

    stack = [(depth, np.array([[0], [len(a)], [0], [len(b)], [spent]], np.int64))]
    while stack:
        level, nodes = stack.pop()
        if nodes.shape[1] > FRONTIER:
            half = nodes.shape[1] // 2
            stack += [(level, nodes[:, :half]), (level, nodes[:, half:])]
            continue
        size_a, size_b = nodes[1] - nodes[0], nodes[3] - nodes[2]
        few = size_a * size_b <= FEW
        if few.any():
            size = (size_a * size_b)[few]
            pair = np.repeat(np.arange(len(size)), size)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            width = size_b[few][pair]
            i, j = nodes[0][few][pair] + nth // width, nodes[2][few][pair] + nth % width
            if same:
                i, j = i[i < j], j[i < j]
            ok = np.bitwise_count(a[i] ^ b[j]) <= BUDGET
            if ok.any():
                yield i[ok], j[ok]
        a0, a1, b0, b1, differ = nodes[:, ~few]
        if not len(a0):
            continue
        ones_a, ones_b = ones_before(level)
        mid_a, mid_b = a1 - (ones_a[a1] - ones_a[a0]), b1 - (ones_b[b1] - ones_b[b0])
        itself = (a0 == b0) if same else np.zeros(len(a0), bool)
        children = [(a0, mid_a, b0, mid_b, differ), (mid_a, a1, mid_b, b1, differ)]
        if level >= FREE:
            ok = differ < BUDGET
            children.append(tuple(x[ok] for x in (a0, mid_a, mid_b, b1, differ + 1)))
            ok &= ~itself  # the mirror image of the pair before
            children.append(tuple(x[ok] for x in (mid_a, a1, b0, mid_b, differ + 1)))
        below = np.concatenate([np.stack(x) for x in children], axis=1)
        size_a, size_b = below[1] - below[0], below[3] - below[2]
        alive = (size_a > 0) & (size_b > 0)
        if same:
            alive &= (below[0] != below[2]) | (size_a > 1)
        if alive.any():
            stack.append((level + 1, below[:, alive]))


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest index each of n items is linked with, over the links (i, j) and those behind `label`."""
    label = np.arange(n) if label is None else label
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def _edges(a: np.ndarray, b: np.ndarray | None, depth: int, spent: int, order: int) -> pa.Table:
    """Each linked fingerprint with the first of its component inside the task."""
    every = a if b is None else np.concatenate([a, b])
    shift = 0 if b is None else len(a)
    label = np.arange(len(every))
    gathered: list[tuple[np.ndarray, np.ndarray]] = []
    for i, j in trie_pairs(a, b, depth, spent):
        gathered.append((i, j + shift))
        if sum(len(x) for x, _ in gathered) > 4 * FRONTIER:
            label = smallest_linked(len(every), *map(np.concatenate, zip(*gathered)), label)
            gathered = []
    if gathered:
        label = smallest_linked(len(every), *map(np.concatenate, zip(*gathered)), label)
    moved = np.flatnonzero(label != np.arange(len(every)))
    left, right = np.uint64((BITS - order) % BITS), np.uint64(order)
    turned = (every << left) | (every >> right) if order else every
    return pa.table(
        {"a": pa.array(turned[label[moved]].view(np.int64)), "b": pa.array(turned[moved].view(np.int64))}
    )


def _key(fp: Column, order: int) -> Column:
    return F.shiftleft(fp, order).bitwiseOR(F.shiftrightunsigned(fp, BITS - order)) if order else fp


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("key", BITS - depth)


def _traverse_node(depth: int):
    def run(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("key").to_numpy().view(np.uint64))
        return _edges(keys, None, depth, 0, table.column("turn")[0].as_py())

    return run


def _traverse_pair(depth: int):
    def run(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        a, b = (np.sort(np.array(row[x], np.int64).view(np.uint64)) for x in ("keys_a", "keys_b"))
        return _edges(a, None if row["a"] == row["b"] else b, depth, row["spent"], row["turn"])

    return run


def _opened(tree: DataFrame, big: DataFrame, depth: int, leaf: int, folder: str) -> list[DataFrame]:
    """Edges below nodes that are too large for a task: `big` (turn, node) at `depth` is opened in pairs of nodes.

    The rows here are nodes and pairs of nodes. A pair has at most as many pairs below it as prefixes of STEP bits lie
    within the budget of one another.
    """
    pairs = big.select("turn", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("spent"))
    edges = []
    while depth < BITS:
        below = FREE if depth < FREE < depth + STEP else min(depth + STEP, BITS)
        parents = pairs.select("turn", F.col("a").alias("parent")).union(pairs.select("turn", "b")).distinct()
        inside = tree.withColumn("parent", _prefix(depth)).join(parents, ["turn", "parent"], "left_semi")
        children = inside.groupBy("turn", "parent", _prefix(below).alias("node")).agg(F.count("*").alias("n"))
        children = written(children, folder, f"nodes_{below}")
        left = children.select("turn", F.col("parent").alias("a"), F.col("node").alias("x"), F.col("n").alias("n_x"))
        right = children.select("turn", F.col("parent").alias("b"), F.col("node").alias("y"), F.col("n").alias("n_y"))
        spent = F.col("spent") + F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
        once = ((F.col("a") != F.col("b")) | (F.col("x") <= F.col("y"))) & ((F.col("x") != F.col("y")) | (F.col("n_x") > 1))
        found = pairs.join(left, ["turn", "a"]).join(right, ["turn", "b"]).where(once).select(
            "turn", F.col("x").alias("a"), F.col("y").alias("b"), spent.alias("spent"),
            (F.greatest("n_x", "n_y") > leaf).alias("large"),
        )
        found = written(found.where(F.col("spent") <= (BUDGET if below > FREE else 0)), folder, f"pairs_{below}")
        ready, pairs, depth = found.where("not large").drop("large"), found.where("large").drop("large"), below
        wanted = ready.select("turn", F.col("a").alias("node")).union(ready.select("turn", "b")).distinct()
        # at most `leaf` keys in a list
        packed = tree.withColumn("node", _prefix(depth)).join(wanted, ["turn", "node"], "left_semi")
        packed = packed.groupBy("turn", "node").agg(F.collect_list("key").alias("keys"))
        packed = written(packed, folder, f"keys_{depth}")
        tasks = ready.join(packed.withColumnsRenamed({"node": "a", "keys": "keys_a"}), ["turn", "a"])
        tasks = tasks.join(packed.withColumnsRenamed({"node": "b", "keys": "keys_b"}), ["turn", "b"])
        edges.append(tasks.groupBy("turn", "a", "b").applyInArrow(_traverse_pair(depth), "a long, b long"))
        if pairs.isEmpty():
            break
    return edges


def linked_prints(prints: DataFrame, n: int, folder: str, leaf: int = LEAF) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within BUDGET bits of one another, from distinct ones (fp), n of them.

    Edges join what is connected, not each linked pair, and are fewer than three for each fingerprint and node pair.
    """
    turned = F.array(*[F.struct(F.lit(s).alias("turn"), _key(F.col("fp"), s).alias("key")) for s in ORDERS])
    tree = prints.select(F.inline(turned))
    depth = min(max(int(4 * n / leaf).bit_length(), 1), FREE)  # a quarter of a leaf in a node, if bits were random
    noded = tree.withColumn("node", _prefix(depth))
    sizes = noded.groupBy("turn", "node").agg(F.count("*").alias("n")).where("n > 1")
    big = written(sizes.where(F.col("n") > leaf).select("turn", "node"), folder, "big")
    edges = []
    if not big.isEmpty():
        edges = _opened(tree, big, depth, leaf, folder)
        noded = noded.join(big, ["turn", "node"], "left_anti")
    edges.append(noded.groupBy("turn", "node").applyInArrow(_traverse_node(depth), "a long, b long"))
    return reduce(DataFrame.unionByName, edges).distinct()


def simhash_components(docs: DataFrame, folder: str | None = None, leaf: int = LEAF) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link when they differ in at most BUDGET bits; component_id is the smallest doc_id reachable by links.
    Texts without words, null ones included, have fingerprint zero and link like others. Null ids are passed on and count
    as no id: a component without any id has a null component_id. Rows that repeat an id are documents of their own.
    Other columns are ignored, and no rows give no rows.

    Equal fingerprints are one from the start. What is shuffled by a key that may be frequent is combined before.
    """
    folder = folder or shared_folder(docs.sparkSession)
    rows = written(fingerprints(docs), folder, "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("smallest"), F.count("*").alias("copies"))
    prints = written(prints, folder, "prints")
    edges = linked_prints(prints.select("fp"), prints.count(), folder, leaf)
    roots = components(edges, folder, "links").withColumnRenamed("node", "fp")
    labelled = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    labelled = written(labelled, folder, "labelled")
    ids = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"), F.count("*").alias("members"))
    ids = written(ids, folder, "ids")
    members = with_measures(labelled.select("fp", "copies", "root"), ids, "root", "members")
    members = written(members.select("fp", "copies", "component_id"), folder, "members")
    return with_measures(rows, members, "fp", "copies").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
