"""Exact similarity join on word shingles with token-combination prefixes.

Tokens are hashed shingles. A fixed-size table of counts over all documents, addressed by the leading bits of the hash,
tells frequent tokens from rare ones; any such rule gives exact results, as long as all documents use the same. Tokens
are ordered rare ones first, then by hash. Two sets with Jaccard similarity s have at least ceil(s * n) tokens in
common, so that among the first n - ceil(s * n) + 1 tokens of one at least one is shared:

* a rare token in this prefix is a signature by itself;
* frequent tokens fall into CLASSES by their hash, and pairs of tokens of one class are signatures. If no pair of a class
  is shared, at most one of its tokens is, so the prefix is extended until the tokens beyond the first of each class
  (and the rare ones) reach the number that must not all differ. Sets smaller than SMALL use single tokens instead, and
  sets up to SMALL / s use both.

Texts that share a signature are candidates. Sizes and parity bitmaps (each token flips one bit, so the bits that differ
never exceed the tokens that differ) discard most. The texts of a connected component of what is left are then verified
against one another on the sets themselves, a large component in pairs of chunks. So of the candidates that share a
frequent signature only a forest is passed on, which connects the same texts. Equal texts are one node throughout.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.components import components
from trailmark.llm.text import LOWER, mixed, text_bytes, text_slices, windows_of, words_of
from trailmark.scratch import shared_folder, written

WORDS = 5
PERCENT = 80
TABLE_BITS = 24  # counters of the table of frequencies; what is broadcast is one bit for each
SEGMENT_BITS = 15
FREQUENT = 24  # a token is frequent if its counter is above this, and six deviations above the mean counter
CLASSES = 16
SMALL = 64
BITS = 512
LONG_BITS = 4096
LONG_FROM = 512  # sets of this size or more have a long bitmap too
CHUNK = 128


def shingle_sets(part: pa.RecordBatch, n: int = WORDS) -> list[np.ndarray]:
    """Of each text the ascending hashes of its distinct shingles; of fewer than n words the whole is one."""
    data, offsets = text_bytes(part.column("text"))
    words = words_of(LOWER[data], offsets)
    first, hashes = windows_of(words, n)
    rows = np.arange(part.num_rows + 1)
    cuts = np.searchsorted(words.rows[first], rows)
    out = [np.unique(hashes[a:b]) for a, b in zip(cuts, cuts[1:])]
    cuts = np.searchsorted(words.rows, rows)
    for i in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(cuts) < n)):
        whole = words.hashes[cuts[i] : cuts[i + 1]]
        factors = np.cumprod(np.full(len(whole), 0xC2B2AE3D27D4EB4F, np.uint64))
        out[i] = mixed(np.array([(whole * factors).sum() + np.uint64(len(whole))], np.uint64))
    return out


def frequent_tokens(texts: DataFrame) -> bytes:
    """One bit for each counter of the table: whether its count over all rows of `texts` (text) is high.

    Each task adds up its own table; tables are added segment by segment. The result has a fixed size.
    """
    n_segments = 1 << (TABLE_BITS - SEGMENT_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << TABLE_BITS, np.uint8)
        for batch in batches:
            for part in text_slices(batch):
                sets = shingle_sets(part)
                at, n = np.unique(np.concatenate(sets) >> np.uint64(64 - TABLE_BITS), return_counts=True)
                table[at] = np.minimum(table[at] + n.astype(np.int64), 255)
        rows = [zlib.compress(x.tobytes(), 1) for x in table.reshape(n_segments, -1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n_segments), pa.int32()), pa.array(rows, pa.binary())], names=["segment", "counts"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << SEGMENT_BITS, np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(zlib.decompress(x.as_py()), np.uint8)
        high = total > max(FREQUENT, total.mean() + 6 * total.mean() ** 0.5)
        return pa.table(
            {"segment": table.column("segment").slice(0, 1), "bits": pa.array([np.packbits(high).tobytes()], pa.binary())}
        )

    counts = texts.select("text").mapInArrow(count, "segment int, counts binary")
    found = counts.groupBy("segment").applyInArrow(add, "segment int, bits binary").collect()
    empty = bytes(1 << (SEGMENT_BITS - 3))
    bits = dict(found)
    return b"".join(bytes(bits.get(k, empty)) for k in range(n_segments))


def is_frequent(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = tokens >> np.uint64(64 - TABLE_BITS)
    return (bits[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the number of tokens that fall on each bit, as 64-bit words."""
    at = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures by rare tokens, and those by frequent ones."""
    n = len(tokens)
    need = n - -(-PERCENT * n // 100) + 1
    rare, hot = tokens[~frequent], tokens[frequent]
    if len(rare) >= need:
        return rare[:need], hot[:0]
    out = []
    if n * PERCENT < SMALL * 100:
        out.append(hot[: need - len(rare)])
    if n >= SMALL:
        classes = (hot >> np.uint64(8)) % np.uint64(CLASSES)
        order = np.argsort(classes, kind="stable")
        first = np.zeros(len(hot), bool)
        first[order] = np.concatenate([[True], np.diff(classes[order]) != 0])
        reached = len(rare) + np.cumsum(~first)
        end = int(np.searchsorted(reached, need)) + 1
        for c in range(CLASSES):
            mine = hot[:end][classes[:end] == c]
            a, b = np.triu_indices(len(mine), 1)
            out.append(mixed(mine[a] * np.uint64(0x9E3779B97F4A7C15) + mine[b]))
    return rare, np.concatenate(out) if out else hot[:0]


_PROFILE = "doc_id long, node long, n int, small binary, large binary"


def profiles(docs: DataFrame, hot_bits: bytes, n_buckets: int) -> tuple[DataFrame, DataFrame]:
    """One row per document with its size and bitmaps, and its signatures dealt out to buckets."""
    shared = docs.sparkSession.sparkContext.broadcast(hot_bits)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                sets = shingle_sets(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("node"),
                        pa.array([len(x) for x in sets], pa.int32()),
                        pa.array([bitmap(x, BITS).tobytes() for x in sets], pa.binary()),
                        pa.array(
                            [bitmap(x, LONG_BITS).tobytes() if len(x) >= LONG_FROM else None for x in sets], pa.binary()
                        ),
                    ],
                    names=["doc_id", "node", "n", "small", "large"],
                )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.frombuffer(shared.value, np.uint8)
        seen: set[int] = set()
        for batch in batches:
            for part in text_slices(batch, limit=4_000_000):
                found: dict[int, list] = {0: [], 1: []}
                for node, tokens in zip(part.column("node").to_pylist(), shingle_sets(part)):
                    if len(tokens) and node not in seen:
                        if len(seen) < 100_000:
                            seen.add(node)
                        rare, combined = signatures(tokens, is_frequent(hot, tokens))
                        size = np.array([len(tokens)], np.uint64)
                        if len(rare):
                            found[0].append((rare, node, size))
                        if len(combined):
                            found[1].append((combined, node, np.append(size, bitmap(tokens, BITS))))
                for kind, rows in found.items():
                    if rows:
                        yield _dealt(kind, rows, n_buckets)

    texts = docs.select("doc_id", "node", "text")
    return texts.mapInArrow(profile, _PROFILE), texts.mapInArrow(
        sign, "bucket int, kind int, signs binary, nodes binary, owners binary, extras binary"
    )


def _dealt(kind: int, rows: list, n_buckets: int) -> pa.RecordBatch:
    """Signatures of some texts by bucket; their sizes go along, and bitmaps with frequent signatures, once a bucket."""
    signs = np.concatenate([x for x, _, _ in rows])
    owner = np.repeat(np.arange(len(rows)), [len(x) for x, _, _ in rows])
    nodes = np.array([x for _, x, _ in rows], np.int64)
    extras = np.array([x for _, _, x in rows], np.uint64)
    # not by the leading bits, which order the prefixes
    buckets = mixed(signs) % np.uint64(n_buckets)
    order = np.argsort(buckets, kind="stable")
    edges = np.searchsorted(buckets[order], np.arange(n_buckets + 1, dtype=np.uint64))
    out = []
    for b in range(n_buckets):
        at = order[edges[b] : edges[b + 1]]
        if len(at):
            mine, local = np.unique(owner[at], return_inverse=True)
            out.append(
                (
                    b,
                    kind,
                    (signs[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                    nodes[mine].tobytes(),
                    local.astype(np.uint32 if len(mine) > 65535 else np.uint16).tobytes(),
                    extras[mine].tobytes(),
                )
            )
    names = ["bucket", "kind", "signs", "nodes", "owners", "extras"]
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)


def _possible(n_a: np.ndarray, n_b: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes that differ in at least so many tokens can be similar enough."""
    return (100 + PERCENT) * (n_a + n_b - differ) >= 2 * PERCENT * (n_a + n_b)


def _lists(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures in order and the owner of each, of those that several texts have; the owners' nodes and extras."""
    signs, nodes, owners, extras, base = [], [], [], [], 0
    for row in rows:
        mine = np.frombuffer(row["nodes"], np.int64)
        signs.append(np.frombuffer(row["signs"], np.uint32))
        owners.append(np.frombuffer(row["owners"], np.uint32 if len(mine) > 65535 else np.uint16).astype(np.int64) + base)
        nodes.append(mine)
        extras.append(np.frombuffer(row["extras"], np.uint64).reshape(len(mine), -1))
        base += len(mine)
    sign, owner, node, extra = (np.concatenate(x) for x in (signs, owners, nodes, extras))
    # copies of a text in other tasks are the same node
    node, first, back = np.unique(node, return_index=True, return_inverse=True)
    owner, extra = back[owner], extra[first]
    for _ in range(2):  # signatures that occur once are most of them; so are, then, those of copies only
        order = np.lexsort((owner, sign))
        sign, owner = sign[order], owner[order]
        same = sign[1:] == sign[:-1]
        new = np.concatenate([[True], ~same | (owner[1:] != owner[:-1])])[: len(sign)]
        sign, owner = sign[new], owner[new]
        same = sign[1:] == sign[:-1]
        several = np.zeros(len(sign), bool)
        several[1:] = same
        several[:-1] |= same
        sign, owner = sign[several], owner[several]
    return sign, owner, node, extra


def _all_pairs(rows: list[dict]) -> np.ndarray:
    """Distinct pairs of nodes of similar size that share a signature, smaller node first."""
    sign, owner, node, extra = _lists(rows)
    size = extra[:, 0].astype(np.int64)
    ends = np.searchsorted(sign, sign, side="right")
    found = np.zeros(0, np.int64)
    gathered: list[np.ndarray] = []
    at = np.arange(len(sign))
    for d in range(1, int((ends - at).max(initial=1))):
        at = at[at + d < ends[at]]
        a, b = owner[at], owner[at + d]
        ok = _possible(size[a], size[b], abs(size[a] - size[b]))
        gathered.append(a[ok] * len(node) + b[ok])
        if sum(map(len, gathered)) > 2_000_000:
            found, gathered = np.unique(np.concatenate([found, *gathered])), []
    found = np.unique(np.concatenate([found, *gathered]))
    return np.stack([node[found // len(node)], node[found % len(node)]], 1)


def _forest_of_lists(rows: list[dict]) -> np.ndarray:
    """Edges that connect all nodes that share a signature and that sizes and bitmaps allow to be similar.

    Each node is compared with the nodes not reached yet; what one list has connected is not compared in the next.
    """
    sign, owner, node, extra = _lists(rows)
    maps, size = extra[:, 1:], extra[:, 0].astype(np.int64)
    tree = np.arange(len(node))
    edges = []
    starts = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]])[: len(sign)])
    for members in np.split(owner, starts[1:]) if len(owner) else []:
        left = members
        while len(left) and (tree[left] != tree[left[0]]).any():
            now = tree[left] == tree[left[0]]
            queue, left = list(left[now]), left[~now]
            while queue and len(left):
                x = queue.pop()
                differ = np.bitwise_count(maps[left] ^ maps[x]).sum(1, dtype=np.int64)
                ok = _possible(size[left], size[x], np.maximum(differ, abs(size[left] - size[x])))
                if ok.any():
                    joined = np.unique(tree[left[ok]])
                    first = left[ok][np.unique(tree[left[ok]], return_index=True)[1]]
                    edges += [(x, int(y)) for y in first]
                    reached = np.isin(tree[left], joined)
                    tree[np.isin(tree, joined)] = tree[x]
                    queue += list(left[reached])
                    left = left[~reached]
    pairs = np.array(edges, np.int64).reshape(-1, 2)
    pairs = node[pairs]
    return np.stack([pairs.min(1), pairs.max(1)], 1)


def _pairs_of_bucket(table: pa.Table) -> pa.Table:
    """Pairs (a < b) by rare signatures, and a forest of the candidates by frequent ones."""
    rows = table.to_pylist()
    out = []
    for kind, pairs_of in ((0, _all_pairs), (1, _forest_of_lists)):
        mine = [x for x in rows if x["kind"] == kind]
        pairs = pairs_of(mine) if mine else np.zeros((0, 2), np.int64)
        out.append((np.full(len(pairs), kind), pairs))
    kinds, pairs = np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])
    return pa.table(
        {"kind": pa.array(kinds, pa.int32()), "a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())}
    )


def _surviving(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Drops the pairs whose sizes and bitmaps exclude that they are similar."""
    for column in ("small", "large"):
        left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col(column).alias("map_a"))
        right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col(column).alias("map_b"))
        joined = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "map_a", "map_b")

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n_a, n_b = (batch.column(x).to_numpy().astype(np.int64) for x in ("n_a", "n_b"))
                maps = zip(batch.column("map_a").to_pylist(), batch.column("map_b").to_pylist())
                differ = np.array(
                    [
                        0 if x is None or y is None
                        else (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()
                        for x, y in maps
                    ],
                    np.int64,
                )
                yield batch.select(["a", "b"]).filter(pa.array(_possible(n_a, n_b, np.maximum(differ, abs(n_a - n_b)))))

        pairs = joined.mapInArrow(keep, "a long, b long")
    return pairs


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Indices of the edges that join two trees, taken in order."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[y] = x
            kept.append(k)
    return kept


def similar_pairs(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets whose similarity reaches the limit, from the counts of common tokens."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    common = np.zeros((len(sets), len(sets)), np.float64)
    width = 1 << 14
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        block = np.zeros((len(sets), width), np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        common += block @ block.T
    size = np.array([len(x) for x in sets], np.float64)
    either = size[:, None] + size[None, :] - common
    return np.nonzero(np.triu(100 * common >= PERCENT * either, 1))


def _links(table: pa.Table) -> pa.Table:
    """A forest over the similar texts of one chunk or pair of chunks."""
    nodes = table.column("node").to_numpy()
    sets = shingle_sets(table.select(["text"]).combine_chunks().to_batches()[0]) if len(nodes) else []
    a, b = similar_pairs(sets) if len(sets) > 1 else (np.zeros(0, int), np.zeros(0, int))
    kept = forest(a, b, len(nodes))
    return pa.table({"a": pa.array(nodes[a[kept]], pa.int64()), "b": pa.array(nodes[b[kept]], pa.int64())})


def _labelled(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, node (of the text), n, root (a node of the component) and component_id of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("node"))
    n_parts = max(docs.rdd.getNumPartitions(), 1)
    profile, signed = profiles(docs, frequent_tokens(docs), n_buckets=2 * n_parts)
    profile = written(profile, folder, "profile")
    nodes = profile.dropDuplicates(["node"]).select("node", "n", "small", "large")
    pairs = signed.groupBy("bucket").applyInArrow(_pairs_of_bucket, "kind int, a long, b long").distinct()
    pairs = written(pairs, folder, "pairs")
    near = _surviving(pairs.filter("kind = 0").select("a", "b"), nodes)
    near = written(near.unionByName(pairs.filter("kind = 1").select("a", "b")), folder, "near")
    clusters = components(near, folder, "near")
    # sets are verified by component of candidates; a large one is cut into chunks, every two of which meet
    sized = clusters.join(clusters.groupBy("root").agg(F.count("*").alias("size")), "root")
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("node"), chunks).cast("int")
    dealt = sized.select(
        "node",
        "root",
        F.explode(F.transform(F.sequence(F.lit(0), chunks - 1), lambda k: F.struct(
            F.least(k, mine).alias("first"), F.greatest(k, mine).alias("second")))).alias("chunk"),
    )
    members = docs.join(clusters.select("node"), "node", "left_semi").dropDuplicates(["node"]).select("node", "text")
    members = written(members, folder, "members")
    links = (
        dealt.join(members, "node")
        .select("root", "chunk.first", "chunk.second", "node", "text")
        .groupBy("root", "first", "second")
        .applyInArrow(_links, "a long, b long")
    )
    roots = components(written(links, folder, "links"), folder, "links")
    smallest = profile.groupBy("node").agg(F.min("doc_id").alias("smallest"))
    labelled = smallest.join(roots, "node", "left").select(
        "node", "smallest", F.coalesce("root", "node").alias("root")
    )
    ids = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    labels = written(labelled.select("node", "root").join(ids, "root"), folder, "labels")
    return profile.select("doc_id", "node", "n").join(labels, "node", "left")


def similarity_components(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id.

    Texts link when 100 * intersection >= 80 * union of their shingle sets; component_id is the smallest doc_id that is
    reachable by links. Texts without words, null ones included, link with nothing. Null ids are passed on and count as
    no id: a component without any id has a null component_id. Rows that repeat an id are documents of their own.
    Tokens are 64-bit hashes. Other columns are ignored.
    """
    return _labelled(docs, folder or shared_folder(docs.sparkSession)).select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_per_component(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of `docs` (doc_id, text, any others) that stand for their component: those whose doc_id is the smallest.

    Of rows that repeat that id, one with the text that links stays. Rows without an id stand for a component only if it
    has no id at all, one row for each such component. Texts without words stay. Columns keep names and order.
    """
    folder = folder or shared_folder(docs.sparkSession)
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id = F.col(f"c{names.index('doc_id')}").cast("long")
    text = F.coalesce(F.col(f"c{names.index('text')}").cast("string"), F.lit(""))
    keyed = plain.withColumns({"doc_id": doc_id, "text": text, "node": F.xxhash64(text)})
    labels = _labelled(docs, folder)
    # a component's label is one id, so it is kept where the row's own id is that label
    kept = labels.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("n") > 0))
    first = kept.groupBy("root", "doc_id").agg(F.min("node").alias("node")).select("doc_id", "node")
    first = first.withColumnsRenamed({"doc_id": "kept_id", "node": "kept_node"})
    same = keyed["doc_id"].eqNullSafe(first["kept_id"]) & (keyed["node"] == first["kept_node"])
    empty = labels.filter("n = 0").select(F.col("node").alias("kept_node")).distinct()
    columns = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    linked = keyed.join(first, same, "left_semi")
    if not kept.groupBy("doc_id", "node").count().filter("count > 1").isEmpty():
        # whole rows are shuffled once more only where some repeat
        linked = linked.dropDuplicates(["doc_id", "node"])
    return linked.select(*columns).unionByName(
        keyed.join(empty, keyed["node"] == empty["kept_node"], "left_semi").select(*columns)
    )
