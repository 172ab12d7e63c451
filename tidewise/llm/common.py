"""Helpers shared by the corpus operators: table access, vectorised word
hashing, joins that stand hot keys, connected components."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.session import cut_lineage, ship_package

# Word separators everywhere in this subpackage: space and U+0009..U+000D.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Rows a key may have before a join treats it as hot: at least this many ...
HOT_ROWS = 64
# ... and more than 1/HOT_SHARE of all rows, so there are at most HOT_SHARE hot
# keys at any input size; that is the bound of the only broadcast here.
HOT_SHARE = 10_000


# Arrow batches of whole texts: small enough that a batch, its copy in the
# worker and what is made of it stay far below an executor's memory.
BATCH_BYTES = 8 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def prepare(spark: SparkSession) -> SparkSession:
    """Send the package to the workers, and bound the bytes of an Arrow batch
    unless the session has its own bound."""
    if spark.conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def frees(run):
    """A mapInArrow function that gives the memory its task has freed back to
    the system: workers are reused, and idle ones count against the executor."""

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task


_CACHES: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What tasks of one operator share in a reused Python worker. Another
    operator's cache is dropped, so workers hold one at most."""
    for other in [k for k in _CACHES if k != owner]:
        del _CACHES[other]
    return _CACHES.setdefault(owner, {})


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_counted(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``facts`` (one row per ``key``; ``count``
    tells how many of ``rows`` carry it). Keys of more than
    max(HOT_ROWS, total / HOT_SHARE) rows, at most HOT_SHARE of them, are
    broadcast, so no task gathers the rows of a hot key; the others shuffle.
    Both inputs are read twice: hand over checkpointed frames."""
    limit = max(HOT_ROWS, total // HOT_SHARE)
    hot = facts.filter(F.col(count) > limit)
    cold = facts.filter(F.col(count) <= limit)
    by_broadcast = rows.join(F.broadcast(hot), key)
    by_shuffle = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return by_broadcast.unionByName(by_shuffle)


FILTER_BITS = 1 << 23


def filter_bits(keys: int) -> int:
    """Bits for a filter of so many keys: 16 each, within 8 MB in all."""
    return 1 << min(26, max(16, (16 * keys).bit_length()))


def bit_filter(hashes: DataFrame, size: int = FILTER_BITS) -> np.ndarray:
    """Bits of a column of 64-bit hashes: ``size`` (a power of two) of them
    whatever the number of hashes (at most size / 64 rows come to the driver). A
    value may be absent although its bit is set, so an exact join has to
    follow; a crowded filter costs rows, never a result."""
    place = F.pmod(F.col(hashes.columns[0]), F.lit(size))
    word = F.expr("bit_or(shiftleft(1L, cast(bit as int)))")
    rows = hashes.select(F.floor(place / 64).alias("word"), (place % 64).alias("bit")).groupBy("word").agg(
        word.alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return bits


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the (signed) hashes have their bit set."""
    place = hashes & (64 * len(bits) - 1)
    return (bits[place >> 6] >> (place & 63)) & 1 == 1


def _by_bit(bits, want: bool, schema: pa.Schema):
    """mapInArrow: the rows whose last column, a hash, may (may not) be held;
    that column goes."""

    @frees
    def run(batches):
        worker_cache("none")
        for b in batches:
            mask = may_hold(bits.value, b.column(b.num_columns - 1).to_numpy()) == want
            part = b.filter(pa.array(mask))
            if len(part):
                yield pa.RecordBatch.from_arrays(part.columns[:-1], schema=schema)

    return run


def rows_with(df: DataFrame, key: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Semi or anti join of wide rows with a narrow column of keys (named as
    ``key``) of any number: a bit filter settles most rows in place, so only
    those that may have a partner are shuffled, for the exact join."""
    from pyspark.sql.pandas.types import to_arrow_schema

    bits = df.sparkSession.sparkContext.broadcast(bit_filter(keys.select(F.xxhash64(key))))
    schema = to_arrow_schema(df.schema)
    hashed = df.withColumn(unused(df, "hash"), F.xxhash64(key))
    likely = hashed.mapInArrow(_by_bit(bits, True, schema), df.schema)
    joined = likely.join(keys.hint("merge"), key, how).select(*[F.col(f"`{c}`") for c in df.columns])
    if how == "left_semi":
        return joined
    return joined.union(hashed.mapInArrow(_by_bit(bits, False, schema), df.schema))


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """0-based global rank by ``order`` without one task for all rows: range
    partitions, numbered inside, shifted by the counts of those before."""
    from pyspark.sql import Window as W

    cut = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = cut.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return (cut.withColumn("_own", own).join(starts, "_part")
            .withColumn(name, F.col("_own") + F.col("_start")).drop("_part", "_own", "_start"))


# ---------------------------------------------------------------- components
TASK_EDGES = 1 << 20    # edges that one task contracts (about 100 bytes each while it does)


def contracted(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (rows of two nodes) -> one edge (node, smallest node) for every
    other node of the components that they make."""
    nodes, at = np.unique(edges, return_inverse=True)
    u, v = at.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        if np.array_equal(root[u], root[v]):
            break
        for end in (u, v):
            np.minimum.at(root, root[end], low)      # roots hang below smaller ones
        while not np.array_equal(root, root[root]):
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


@frees
def _forest(batches):
    """mapInArrow over edges (u, v): those of the task, contracted."""
    pairs = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1) for b in batches if len(b)]
    if pairs:
        u, v = contracted(np.concatenate(pairs))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, root) for every node
    that has an edge; root is the component's smallest node.

    Each round, tasks of about TASK_EDGES edges contract theirs to stars, and
    alternating large-star and small-star steps merge the stars of different
    tasks. Every step keeps at most as many edges as before, and the edges are
    checkpointed after it; the round in which one task holds them all is the
    last. A hub's edges are reduced map-side and its join is split by AQE.
    """
    e = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    e = cut_lineage(e.filter("u <> v").distinct())
    state = None
    while True:
        tasks = -(-e.count() // TASK_EDGES)
        if tasks == 0:
            break
        e = cut_lineage(e.coalesce(tasks).mapInArrow(_forest, "u long, v long"))
        if tasks == 1:
            break
        # large star: every larger neighbour of u points to u's smallest neighbour
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: u and its smaller neighbours point to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = cut_lineage(moved.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select("v", F.col("v").alias("root")).distinct())


# ------------------------------------------------------------- word hashing
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(1)
def _tables():
    letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    lower = np.arange(256)
    lower[ord("A"):ord("Z") + 1] += 32
    space = np.zeros(256, bool)
    space[list(SPACE_BYTES)] = True
    power = np.full(_SLICE + 1, _BASE, np.uint64)
    power[0] = 1
    inverse = np.full(_SLICE + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    return letters, letters[lower], space, np.cumprod(power), np.cumprod(inverse)


def word_hashes(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the words of one text (its UTF-8 bytes), in order; with
    ``lower``, A-Z count as a-z. Works in slices that end at a space, so memory
    stays a small multiple of the slice and of the result."""
    return words_at(data, lower)[0]


def words_at(data: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes`` with each word's first byte and the byte after its last."""
    plain, lowered, space, power, inverse = _tables()
    letters = lowered if lower else plain
    out, first, after, at, n = [], [], [], 0, len(data)
    while at < n:
        end = min(n, at + _SLICE)
        if end < n:
            gaps = np.flatnonzero(space[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # one word longer than a slice
                rest = np.flatnonzero(space[data[end:]])
                end = end + int(rest[0]) if len(rest) else n
        part, offset = data[at:end], at
        at = end
        if len(part) > _SLICE:
            out.append(_long_word(part[~space[part]], letters))
            whole = np.flatnonzero(~space[part])[[0, -1]] + offset
            first.append(whole[:1])
            after.append(whole[1:] + 1)
            continue
        inside = np.empty(len(part) + 2, np.int8)
        inside[0] = inside[-1] = 0
        np.logical_not(space[part], out=inside[1:-1].view(bool))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        if not len(edge):
            continue
        starts, ends = edge[0::2], edge[1::2]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(letters[part] * power[:len(part)], out=sums[1:])
        out.append((sums[ends] - sums[starts]) * inverse[starts])
        first.append(starts + offset)
        after.append(ends + offset)
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return mix(np.concatenate(out)), np.concatenate(first), np.concatenate(after)


def range_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the word ranges [start, end) of a text."""
    power, inverse = _tables()[3:]
    if len(words) >= len(power):
        power, inverse = (np.cumprod(np.r_[np.uint64(1), np.full(len(words), b, np.uint64)]) for b in (power[1], inverse[1]))
    sums = np.empty(len(words) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(words * power[:len(words)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def _long_word(word: np.ndarray, letters: np.ndarray) -> np.ndarray:
    power = _tables()[3]
    total, shift = 0, 1
    for at in range(0, len(word), _SLICE):
        part = word[at:at + _SLICE]
        total += int(np.sum(letters[part] * power[:len(part)])) * shift
        shift = shift * pow(_BASE, _SLICE, 1 << 64) % (1 << 64)
    return np.array([total % (1 << 64)], np.uint64)


_ODD = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; a text of fewer
    than k words, but one at least, has its whole sequence as the only one."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    acc = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        acc = mix(acc * _ODD[0] + words[i:n - width + 1 + i] + _ODD[1])
    if width < k:
        acc = mix(acc + _ODD[2] * np.uint64(width))
    return np.unique(acc)


def byte_views(column: pa.Array):
    """The UTF-8 bytes of each value of a string column, without copies; null: empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    for i in range(len(column)):
        yield data[offsets[i]:offsets[i + 1]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
