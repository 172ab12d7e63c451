"""N-gram Jaccard self-join with a count-vector R-tree.

A text's set is its distinct k-word shingles (64-bit hashes). Shingles are
hashed into groups; a set's group counts are a point, and for two points the
sum of the coordinate minima is an upper bound of the overlap. Points are
packed into an R-tree (children hold coordinate maxima, so the same sum bounds
the overlap with everything below a node); surviving pairs are verified on the
sets.

One tree over a whole corpus would not be selective: balanced group counts of
unrelated texts lie close together. So the points are first divided into
*blocks*, a superset of the link graph's components, with a partition argument
that loses no link: two sets of Jaccard similarity >= t differ in at most
(1-t)/(1+t) * (|x|+|y|) = d shingles, so of any d+1 hash groups, at least one
has the same content in both sets. Sets of one size class (and the next one) use
the same number of groups, more than d+1 of them. Groups are ranked by what they
hold, those of many shingles first, and the d+1 highest make the set's keys: of
two linked sets, take the one whose last key ranks higher; one of its groups is
the other's too, and ranks high enough to be a key there. Texts that share a key
get into one block. Texts that merely share a common passage stay apart: nearly
all keys are groups of two and more shingles, most hold others as well, and
shingles that a sample of SAMPLE_SHINGLES shingles shows in three or more texts
of different kind (by their smallest shingle) are left out of the groups, in all
sets alike, which takes nothing from the argument: without them sets differ no
more.

Within a block, trees are searched in tasks of bounded size. The result is the
components of the link graph, so a pair whose texts are already connected is
not verified again; no link between different components is left out.

Stages: sets -> their keys' first KEY_BITS bits, as sorted lists of small
differences, to find those that occur again (a bit filter) -> (key, set) rows of
these alone, merged in the map tasks (a key has at most one row per task) -> star
edges of equal keys -> blocks -> R-tree joins inside blocks, in chunks of about
CHUNK_SHINGLES -> components -> documents. Shuffle files and tables of texts go
when they have been read, so disk holds one step's at a time.

A set is identified by a 64-bit hash of its shingles: texts of equal sets share
one point (expected false merges: N^2 / 2^65). Its text comes from one row, which
a 64-bit hash of id and text names, so null and repeated ids lose nothing.

Edge cases: texts without words (null, empty, only spaces) have no shingles
and are linked with nothing; texts of fewer than k words have their whole
sequence as one shingle; repeated rows are one set; a null doc_id is ignored
as a component id unless all of a component's are null; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.session import Scratch, cut_lineage, scratch

from .common import (bit_filter, byte_views, components, contracted, filter_bits, frees, join_counted, may_hold, mix,
                     rows_with, shingle_set, signed, unused, word_hashes, worker_cache)

DIMENSIONS = 64            # hash groups of a point
LEAF, NODE = 16, 8         # points of a leaf, children of an inner node
CHUNK_SHINGLES = 1 << 20   # shingles that one R-tree join task holds
SAMPLE_SHINGLES = 1 << 22  # in which common passages are looked for
FLUSH_ROWS = 1 << 20       # key rows that a map task merges at a time
KEY_BITS = 40              # of a key, in the search for keys that occur again
PART_SHINGLES = 1 << 21    # shingles whose keys are searched at a time
BATCH_ROWS = 1 << 16


def set_id(s: np.ndarray) -> np.uint64:
    return mix(np.add.reduce(mix(s), keepdims=True) + np.uint64(len(s)))[0]


# --------------------------------------------------------------- group keys
@functools.lru_cache(None)
def _classes(percent: int, most: int) -> tuple[np.ndarray, tuple[int, ...]]:
    """Lower bounds of the size classes, and groups per class. Sizes of linked
    sets lie in one class or in two neighbouring ones."""
    low = [1]
    while low[-1] <= most:
        low.append(low[-1] * 100 // percent + 1)
    groups = [1]
    for k in range(1, len(low)):
        differ = _differ(low[k] - 1, low[k] - 1, percent)  # largest of class k - 1
        groups.append(differ + 1 + (3 * differ + 6) // 7 if differ else 1)
    return np.array(low), tuple(groups)


def _differ(one: int, two: int, percent: int) -> int:
    """In how many shingles linked sets of these sizes differ at most."""
    return (100 - percent) * (one + two) // (100 + percent)


@functools.lru_cache(4096)
def _bounds(groups: int) -> np.ndarray:
    return (np.arange(1, groups, dtype=object) * (1 << 64) // groups).astype(np.uint64)


def group_keys(n: int, s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set of n shingles; ``s``: those of them, sorted, that are
    grouped. Two sets of Jaccard similarity >= percent / 100 share one key at
    least."""
    low, groups = _classes(percent, max(1 << 20, 1 << (4 * n).bit_length()))
    own = int(np.searchsorted(low, n, side="right"))  # class own - 1, 1-based as in ``groups``
    sums = np.empty(len(s) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(mix(s ^ np.uint64(0xA0761D6478BD642F)), out=sums[1:])
    keys = []
    for k in (own, own + 1):
        m = groups[k]
        cuts = np.empty(m + 1, np.int64)
        cuts[0], cuts[m] = 0, len(s)
        cuts[1:m] = np.searchsorted(s, _bounds(m))
        content = sums[cuts[1:]] - sums[cuts[:-1]]
        named = mix(content ^ mix(np.arange(m, dtype=np.uint64) + np.uint64(k << 32)))
        held = np.minimum(cuts[1:] - cuts[:-1], 15).astype(np.uint64)
        rank = held << np.uint64(60) | named >> np.uint64(4)   # by what a group holds alone, so alike in all sets
        last = m - 1 - _differ(n, min(int(low[k]) - 1, 100 * n // percent), percent)
        keys.append(named[rank >= np.partition(rank, last)[last]])
    return np.concatenate(keys)


def _sample_rows(k: int):
    """mapInArrow: text -> (shingle, smallest shingle of the text)."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in byte_views(batch.column(0)):
                s = shingle_set(word_hashes(text), k)
                if len(s):
                    lead = mix(s).min()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(s)), pa.array(signed(np.full(len(s), lead)))], names=["shingle", "lead"])

    return run


def common_shingles(texts: DataFrame, shingles: int, k: int) -> np.ndarray:
    """Bit filter of shingles that texts of different kind share, from a sample
    (by hash of the text) of about SAMPLE_SHINGLES of them. It decides how well
    blocks come apart, never what is linked."""
    parts = 1 << 20
    share = min(parts, parts * SAMPLE_SHINGLES // max(shingles, 1))
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) < share)
    kinds = sample.mapInArrow(_sample_rows(k), "shingle long, lead long").groupBy("shingle", "lead").count()
    shared = kinds.groupBy("shingle").agg(F.count("*").alias("kinds"), F.sum("count").alias("n"))
    return bit_filter(shared.filter("kinds >= 3 and 2 * kinds >= n").select("shingle"))


def _heads(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - KEY_BITS)


def _texts_keys(batches: Iterator[pa.RecordBatch], k: int, percent: int, common):
    """(set id, keys) of each text with words."""
    for batch in batches:
        for text in byte_views(batch.column(0)):
            s = shingle_set(word_hashes(text), k)
            if len(s):
                yield set_id(s), group_keys(len(s), s[~may_hold(common.value, signed(s))], percent)


def packed(heads: np.ndarray, start: int) -> bytes:
    """Sorted numbers from ``start`` on as compressed bytes of their differences."""
    steps = np.diff(heads, prepend=np.uint64(start)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8)[:, :KEY_BITS // 8]
    return pa.compress(np.ascontiguousarray(planes.T), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, start: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * KEY_BITS // 8, codec="zstd", asbytes=True), np.uint8)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :KEY_BITS // 8] = planes.reshape(KEY_BITS // 8, n).T
    return np.cumsum(steps.view("<u8").ravel()).astype(np.uint64) + np.uint64(start)


def _start(part: int, parts: int) -> int:
    return -(-(part << KEY_BITS) // parts)


def _head_rows(k: int, percent: int, common, parts: int):
    """mapInArrow: text -> (part, n, heads): first bits of keys, at most two
    equal ones of a flush, dealt in ``parts`` ranges."""

    def flush(keys):
        heads = np.sort(_heads(np.concatenate(keys)))
        heads = heads[np.r_[True, True, heads[2:] != heads[:-2]][:len(heads)]]
        starts = [_start(p, parts) for p in range(parts)]
        cuts = np.r_[np.searchsorted(heads, np.array(starts, np.uint64)), len(heads)]
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        for at in range(0, len(full), 64):
            some = full[at:at + 64]
            data = [packed(heads[cuts[p]:cuts[p + 1]], starts[p]) for p in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(cuts[some + 1] - cuts[some], pa.int32()), pa.array(data, pa.binary())],
                names=["part", "n", "heads"])

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("ngram_join")
        keys, held = [], 0
        for _, own in _texts_keys(batches, k, percent, common):
            keys.append(own)
            held += len(own)
            if held > 2 * FLUSH_ROWS:
                yield from flush(keys)
                keys, held = [], 0
        if held:
            yield from flush(keys)

    return run


def _again(parts: int):
    """mapInArrow: (part, n, heads), sorted by part -> heads that occur twice."""

    def twice(lists):
        heads = np.sort(np.concatenate(lists))
        heads = np.unique(heads[1:][heads[1:] == heads[:-1]])
        for at in range(0, len(heads), BATCH_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(signed(heads[at:at + BATCH_ROWS].copy()))], names=["head"])

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lists = None, []
        for b in batches:
            for p, n, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                if p != part:
                    if lists:
                        yield from twice(lists)
                    part, lists = p, []
                lists.append(unpacked(data, n, _start(p, parts)))
        if lists:
            yield from twice(lists)

    return run


def keys_again(texts: DataFrame, shingles: int, k: int, percent: int, common, tables: Scratch) -> np.ndarray:
    """Bit filter of the first bits of keys that occur more than once."""
    parts = 1 + shingles // PART_SHINGLES
    heads = texts.mapInArrow(_head_rows(k, percent, common, parts), "part int, n int, heads binary")
    spread = heads.repartition("part").sortWithinPartitions("part")
    found = tables.put(spread.mapInArrow(_again(parts), "head long"), "again")
    bits = bit_filter(found, filter_bits(found.count()))
    tables.drop("again")
    return bits


def _key_rows(k: int, percent: int, common, again):
    """mapInArrow: text -> (key, node, other) for keys whose first bits occur
    again. other null: set ``node`` has this key. Else an edge node-other: both
    have one key, seen in this task."""

    def flush(keys, nodes):
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        first = np.r_[True, keys[1:] != keys[:-1]]
        yield from _batches(keys[first], nodes[first], None)
        head = nodes[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
        pairs = np.unique(np.stack([head, nodes], 1)[~first & (head != nodes)], axis=0)
        yield from _batches(mix(pairs[:, 0] ^ mix(pairs[:, 1])), pairs[:, 0], pairs[:, 1])

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("ngram_join")
        keys, nodes, held = [], [], 0
        for node, own in _texts_keys(batches, k, percent, common):
            own = own[may_hold(again.value, signed(_heads(own)))]
            if len(own):
                keys.append(own)
                nodes.append(np.full(len(own), node))
                held += len(own)
            if held > FLUSH_ROWS:
                yield from flush(keys, nodes)
                keys, nodes, held = [], [], 0
        if held:
            yield from flush(keys, nodes)

    return run


def _batches(*columns: np.ndarray | None, names=("key", "node", "other")) -> Iterator[pa.RecordBatch]:
    n = len(columns[0])
    for at in range(0, n, BATCH_ROWS):
        size = min(BATCH_ROWS, n - at)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(size, pa.int64()) if c is None else pa.array(signed(np.ascontiguousarray(c[at:at + size])))
             for c in columns], names=list(names))


@frees
def _star_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a hash partition of the keys -> edges that connect the sets of
    each key, as few as do."""
    keys, nodes, pairs = [], [], []
    for b in batches:
        key, node, other = (b.column(i) for i in range(3))
        edge = other.is_valid().to_numpy(zero_copy_only=False)
        node = node.to_numpy()
        keys.append(key.to_numpy()[~edge])
        nodes.append(node[~edge])
        if edge.any():
            pairs.append(np.stack([node[edge], other.drop_null().to_numpy()], 1))
    if keys:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        if len(same):
            first = np.r_[True, key[1:] != key[:-1]]
            head = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            pairs.append(np.stack([head[same], node[same]], 1))
    if pairs:
        yield from _batches(*contracted(np.concatenate(pairs)), names=["a", "b"])


# -------------------------------------------------------------------- R-tree
def point(s: np.ndarray) -> np.ndarray:
    """Group counts of a sorted set; the group is the hash's top bits."""
    return np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=DIMENSIONS).astype(np.int32)


class CountTree:
    """Packed R-tree over group counts. Each level holds, per node, the
    coordinate maxima and the smallest set size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # sort-tile packing: size first, then two coordinates inside tiles
        order = np.argsort(sizes, kind="stable")
        tile = LEAF * NODE * NODE
        for start in range(0, len(order), tile):
            part = order[start:start + tile]
            part = part[np.argsort(points[part, 0], kind="stable")]
            for at in range(0, len(part), LEAF * NODE):
                piece = part[at:at + LEAF * NODE]
                part[at:at + LEAF * NODE] = piece[np.argsort(points[piece, 1], kind="stable")]
            order[start:start + tile] = part
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.levels = []
        high, least, fan = self.points, self.sizes, LEAF
        while len(high) > 1:
            cuts = np.arange(0, len(high), fan)
            high, least = np.maximum.reduceat(high, cuts), np.minimum.reduceat(least, cuts)
            self.levels.append((high, least, fan))
            fan = NODE

    def search(self, q: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Points whose overlap bound with ``q`` allows a link, the largest
        bound first."""

        def allowed(high, least):
            bound = np.minimum(high, q).sum(1)
            return (100 + percent) * bound >= percent * (least + size), bound

        if not self.levels:
            at = np.arange(len(self.order))
        else:
            nodes = np.arange(len(self.levels[-1][0]))
            for depth in range(len(self.levels) - 1, -1, -1):
                high, least, fan = self.levels[depth]
                nodes = nodes[allowed(high[nodes], least[nodes])[0]]
                below = len(self.levels[depth - 1][0]) if depth else len(self.order)
                nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
                nodes = nodes[nodes < below]
            at = nodes
        ok, bound = allowed(self.points[at], self.sizes[at])
        at, bound = at[ok], bound[ok]
        return self.order[at[np.argsort(-bound, kind="stable")]]


def tree_join(sets: list[np.ndarray], queries: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected in the link graph between
    ``queries`` and all ``sets``: each query is searched in the tree; a
    candidate is verified unless it is already connected with the query."""
    sizes = np.array([len(s) for s in sets], np.int64)
    points = np.stack([point(s) for s in sets])
    tree = CountTree(points, sizes)
    label = np.arange(len(sets))
    members = {i: [i] for i in range(len(sets))}
    links = []
    for q in queries:
        found = tree.search(points[q], int(sizes[q]), percent)
        found = found[label[found] != label[q]]
        at = 0
        while at < len(found):
            c = found[at]
            at += 1
            if label[c] == label[q]:
                continue
            both = len(sets[c]) + len(sets[q])
            common = both - len(np.union1d(sets[c], sets[q]))
            if 100 * common >= percent * (both - common):
                links.append((int(q), int(c)))
                one, two = label[q], label[c]
                if len(members[one]) < len(members[two]):
                    one, two = two, one
                moved = members.pop(two)
                label[moved] = one
                members[one] += moved
                found, at = found[at:], 0
                found = found[label[found] != label[q]]
    return links


def _join_tasks(k: int, percent: int):
    """mapInArrow over rows (task, node, asks, text), sorted by task -> links
    (a, b). Holds one task's sets at a time."""

    def links(nodes, sets, asks):
        asks = np.flatnonzero(asks)
        for a, b in tree_join(sets, asks, percent):
            yield nodes[a], nodes[b]

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nodes, sets, asks, out = None, [], [], [], []

        def pack():
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for b in batches:
            for t, node, ask, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                          b.column(2).to_pylist(), byte_views(b.column(3))):
                if t != task:
                    if len(sets) > 1:
                        out += links(nodes, sets, asks)
                    task, nodes, sets, asks = t, [], [], []
                s = shingle_set(word_hashes(text), k)
                if len(s) and signed(set_id(s).reshape(1))[0] == node:
                    nodes.append(node)
                    sets.append(s)
                    asks.append(ask)
            if len(out) > BATCH_ROWS:
                yield pack()
                out = []
        if len(sets) > 1:
            out += links(nodes, sets, asks)
        if out:
            yield pack()

    return run


def _set_rows(k: int):
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("ngram_join")
        for b in batches:
            sizes, ids = np.zeros(len(b), np.int64), np.zeros(len(b), np.uint64)
            for i, text in enumerate(byte_views(b.column(1))):
                s = shingle_set(word_hashes(text), k)
                if len(s):
                    sizes[i], ids[i] = len(s), set_id(s)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(signed(ids), mask=sizes == 0), pa.array(sizes)],
                names=["doc_id", "row_key", "node", "n_shingles"])

    return run


# ------------------------------------------------------------------ operator
def _row_key(id_col: str, text_col: str):
    """64-bit key of a row's id and text (null id, null text: values of their own)."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def document_sets(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, row_key, node (set id, null without words), n_shingles."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       _row_key(id_col, text_col).alias("row_key"))
    return rows.mapInArrow(_set_rows(k), "doc_id long, row_key long, node long, n_shingles long")


def _classes_of(rows: DataFrame) -> DataFrame:
    """Per set: smallest doc_id, rows, size, and the first row (by id, null
    last, then key) with the number of rows that equal it."""
    texts = rows.filter("node is not null").groupBy("node", "row_key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first("n_shingles").alias("size"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    return texts.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.sum("n").alias("copies"), F.first("size").alias("size"),
        F.min_by(F.struct("row_key", "n"), order).alias("head")).select(
        "node", "least", "copies", "size", F.col("head.row_key").alias("key"), F.col("head.n").alias("equal"))


def _components_of(docs, rows, k, percent, id_col, text_col, chunk_shingles) -> DataFrame:
    """Per set: node, copies, least, key, root (one of its component's sets)."""
    with scratch(docs.sparkSession, "ngram_join") as tables:
        classes = cut_lineage(_classes_of(rows))
        roots = components(_links(docs, classes, k, percent, id_col, text_col, chunk_shingles, tables))
        facts = classes.join(roots, "node", "left").withColumn("linked", F.col("root").isNotNull())
        return cut_lineage(facts.withColumn("root", F.coalesce("root", "node")))


def near_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id
    that links of similarity >= percent / 100 reach, itself included)."""
    rows = cut_lineage(document_sets(docs, k, id_col, text_col))
    facts = _components_of(docs, rows, k, percent, id_col, text_col, chunk_shingles)
    # sets without a link need no join: their own class has the smallest doc_id
    alone = facts.filter("not linked").select("node", "copies", F.col("least").alias("component_id"))
    linked = facts.filter("linked")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    known = cut_lineage(alone.union(linked.join(smallest, "root").select("node", "copies", "component_id")))
    out = join_counted(rows.filter("node is not null").drop("row_key"), known, "node", "copies", rows.count())
    bare = rows.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id").union(bare)


def _links(docs, classes, k, percent, id_col, text_col, chunk_shingles, tables) -> DataFrame:
    texts, sc = docs.select(F.col(text_col).alias("text")), docs.sparkSession.sparkContext
    shingles = classes.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 0
    common = sc.broadcast(common_shingles(texts, shingles, k))
    again = sc.broadcast(keys_again(texts, shingles, k, percent, common, tables))
    keyed = texts.mapInArrow(_key_rows(k, percent, common, again), "key long, node long, other long")
    stars = tables.put(keyed.repartition("key").mapInArrow(_star_edges, "a long, b long"), "stars")
    blocks = components(stars).withColumnRenamed("root", "block").join(classes, "node")
    blocks = cut_lineage(blocks.select("node", "block", "size", "key", "equal"))
    tables.drop("stars")
    weight = F.ceil(F.sum("size") / F.lit(chunk_shingles))
    chunks = blocks.groupBy("block").agg(weight.alias("chunks"))
    blocks = blocks.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks"))
    blocks = cut_lineage(blocks)
    source = docs.select(_row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    wanted = rows_with(source, "key", blocks.filter("equal = 1").select("key"))
    repeated = blocks.filter("equal > 1").select("key")
    if not repeated.isEmpty():   # equal rows count once
        wanted = wanted.union(rows_with(source, "key", repeated).groupBy("key").agg(F.first("text").alias("text")))
    places = blocks.select("block", "chunks", "chunk", "node", "size", "key")
    blocks = tables.put(places.join(wanted, "key").drop("key"), "blocks")

    def join(tasks: DataFrame) -> DataFrame:
        rows = tasks.select(F.xxhash64("task").alias("task"), "node", "asks", "text")
        spread = rows.repartition("task").sortWithinPartitions("task")
        return spread.mapInArrow(_join_tasks(k, percent), "a long, b long")

    # each chunk with itself and with its block's first chunk
    own = blocks.select(F.struct("block", "chunk").alias("task"), "node", F.lit(True).alias("asks"), "text")
    others = F.explode(F.sequence(F.lit(1).cast("long"), F.col("chunks") - 1))
    hub = blocks.filter("chunks > 1 and chunk = 0").withColumn("other", others).select(
        F.struct("block", F.col("other").alias("chunk")).alias("task"), "node", F.lit(False).alias("asks"), "text")
    found = cut_lineage(join(own.union(hub)))
    large = blocks.filter("chunks > 1")
    if large.isEmpty():
        return found
    # what is not in its block's largest component yet: against every chunk
    roots = components(found)
    narrow = cut_lineage(large.drop("text").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    sizes = narrow.groupBy("block", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("block").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    rest = cut_lineage(narrow.join(main, "block").filter("root <> main").select("node", F.col("chunk").alias("part")))
    parts = large.join(rest.select("node"), "node").select("block", F.col("chunk").alias("part")).distinct()
    parts, asking = cut_lineage(parts), large.join(rest, "node")
    most, weight = large.agg(F.max("chunks"), F.sum("size")).first()
    # a chunk meets the rest of those before it, at as many distances in a turn as keep its copies below the corpus
    step = max(1, shingles // (2 * weight))
    for at in range(1, most, step):
        away = F.explode(F.sequence(F.lit(at).cast("long"), F.least(F.lit(at + step - 1).cast("long"), F.col("chunks") - 1)))
        far = F.pmod(F.col("part") + F.col("away"), F.col("chunks"))
        asks = asking.filter(F.col("chunks") > at).withColumn("away", away).select(
            F.struct("block", "part", far.alias("chunk")).alias("task"), "node", F.lit(True).alias("asks"), "text")
        asked = large.filter(F.col("chunks") > at).withColumn("away", away).withColumn(
            "part", F.pmod(F.col("chunk") - F.col("away"), "chunks")).join(parts, ["block", "part"]).select(
            F.struct("block", "part", "chunk").alias("task"), "node", F.lit(False).alias("asks"), "text")
        found = cut_lineage(found.union(join(asks.union(asked))))
    return found


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``:
    the row with the smallest doc_id (null last), of rows that share it the one
    with the smallest hash of id and text, of rows that equal in both the one
    with the largest hash of all columns. Rows without words all stay."""
    rows = cut_lineage(document_sets(docs, k, id_col, text_col))
    facts = _components_of(docs, rows, k, percent, id_col, text_col, CHUNK_SHINGLES)
    order = F.struct(F.col("least").isNull(), "least", "key")
    stays = cut_lineage(facts.groupBy("root").agg(F.min_by(F.struct("key", "equal"), order).alias("head")).select(
        F.col("head.key").alias("key"), F.col("head.equal").alias("equal")))
    key = unused(docs, "row_key")
    marked = docs.withColumn(key, _row_key(id_col, text_col))
    others = rows.filter("node is not null").select(F.col("row_key").alias(key)).distinct().join(
        stays.select(F.col("key").alias(key)), key, "left_anti")
    kept = rows_with(marked, key, cut_lineage(others), "left_anti")
    repeated = stays.filter("equal > 1").select(F.col("key").alias(key))
    if not repeated.isEmpty():
        one = F.max_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
        single = rows_with(kept, key, repeated).groupBy(key).agg(one).select("row.*")
        return rows_with(kept, key, repeated, "left_anti").drop(key).union(single)
    return kept.drop(key)
