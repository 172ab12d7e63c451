"""Periodic runs of words: maximal repetitions of at least four periods.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(6, 4 q) that no neighbouring word extends keeping the period.
Runs are found with an enhanced suffix array and the branching-tandem test.

Several documents are handled at once: their words get codes of their own
document, so no common prefix reaches over a document's end.

1. A word of a run occurs four times in it at least, and each pair of
   neighbours three times. Words that fail this in their document belong to no
   run; stretches of the others, with a separator of its own after each, form
   the indexed sequence. (Nothing else is left out.)
2. Suffix array by prefix doubling; only suffixes that still tie are sorted
   again. The ranks of every doubling are kept: equal rank at level k means 2^k
   equal words, which gives common extensions to either side in a descent over
   the levels. The last ranks are the inverse suffix array ISA.
3. The LCP intervals come from one walk over the LCP array with a stack of open
   boundaries; no tree is stored. Each boundary of depth d splits its interval
   in two; the suffixes i of the smaller side check whether ISA[i + d] or
   ISA[i - d] lies in the other side. If so, the square of period d there is a
   branching one: the word after it breaks the period, so it ends its run.
4. Rotating the square to the left as long as the word before equals the word
   one period on gives the run's start. Squares with the same stretch merge
   into one run with the smallest period.

All work on one document's words stays in one task's memory (about 100 bytes per
indexed word); documents share nothing, so there is no shuffle.

Edge cases: a null, empty or blank text has no words and no run; repeated rows
and ids are handled each on its own; null ids stay; other columns are not read;
an empty table gives an empty result. A null id is never rewritten by
``looped``, the fixture rule of the query.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frees, worker_cache

LEAST_WORDS = 6
LEAST_PERIODS = 4
CHUNK_BYTES = 2 << 20     # text bytes of documents that are handled at once
_PAIRS = 1 << 21          # suffix checks at once


# --------------------------------------------------------------- suffix array
def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(suffix array, its inverse, rank levels) of a sequence whose last symbol
    occurs once. Level k ranks the suffixes by their first 2^k symbols."""
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable").astype(np.int64)
    ordered = symbols[sa]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, np.int64)
    levels, h = [], 1
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while not first.all():
        levels.append(rank.astype(np.int32) if n < 1 << 31 else rank.copy())
        slots = np.flatnonzero(~(first & np.r_[first[1:], True]))    # places of suffixes that tie
        tied = sa[slots]
        key = rank[tied] * n + rank[tied + h]
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        sa[slots] = tied
        first[slots] = np.r_[True, key[1:] != key[:-1]]
        start = np.maximum.accumulate(np.where(first[slots], slots, 0))
        rank[tied] = start
        h *= 2
    return sa, rank, levels


def common_prefix(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Equal symbols from places i and j on (i <> j)."""
    size = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size += (levels[k][i + size] == levels[k][j + size]).astype(np.int64) << k
    return size


def common_suffix(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Equal symbols before places i < j."""
    size = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i - size - (1 << k), j - size - (1 << k)
        inside = a >= 0
        a[~inside] = b[~inside] = 0
        size += (inside & (levels[k][a] == levels[k][b])).astype(np.int64) << k
    return size


def _boundaries(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per boundary k of positive depth (ranks k - 1 and k share lcp[k] > 0
    symbols): k, the first rank of its left side and the rank after its right
    side. Among equal depths of one interval the last boundary splits last."""
    depths, stack, at, left, right = lcp.tolist(), [], [], [], []
    begin = [0] * len(depths)
    for k, d in enumerate(depths[1:], 1):
        before = k - 1
        while stack and depths[stack[-1]] >= d:
            top = stack.pop()
            before = begin[top]
            at.append(top)
            left.append(before)
            right.append(k)
        if d:
            begin[k] = before
            stack.append(k)
    n = len(depths)
    while stack:
        top = stack.pop()
        at.append(top)
        left.append(begin[top])
        right.append(n)
    return tuple(np.array(x, np.int64) for x in (at, left, right))


def runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs of a sequence whose last
    symbol occurs once, by start and period."""
    n = len(symbols)
    none = np.empty(0, np.int64)
    if n < LEAST_WORDS:
        return none, none, none
    sa, isa, levels = suffix_ranks(symbols)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = common_prefix(levels, sa[:-1], sa[1:])
    at, left, right = _boundaries(lcp)
    small = np.minimum(at - left, right - at)
    # the square that ends a run has a side with two more of the run's suffixes
    keep = np.maximum(at - left, right - at) >= LEAST_PERIODS - 1
    at, left, right, small = at[keep], left[keep], right[keep], small[keep]
    is_left = at - left <= right - at
    begin, other, stop = np.where(is_left, left, at), np.where(is_left, at, left), np.where(is_left, right, at)
    depth = lcp[at]
    starts, periods = [], []
    ends, lo = np.cumsum(small), 0
    while lo < len(small):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _PAIRS, side="right")))
        who = np.repeat(np.arange(lo, hi), small[lo:hi])
        base = ends[lo:hi] - small[lo:hi]
        place = np.arange(base[0], ends[hi - 1]) - np.repeat(base, small[lo:hi])
        i, d = sa[begin[who] + place], depth[who]
        for near in (i + d, i - d):
            inside = np.flatnonzero((near >= 0) & (near < n))
            rank = isa[near[inside]]
            hit = inside[(rank >= other[who[inside]]) & (rank < stop[who[inside]])]
            starts.append(np.minimum(i[hit], near[hit]))
            periods.append(d[hit])
        lo = hi
    i, d = (np.concatenate(x) if x else none for x in (starts, periods))
    start, end = i - common_suffix(levels, i, i + d), i + 2 * d
    keep = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d)
    start, end, d = start[keep], end[keep], d[keep]
    order = np.lexsort((d, end, start))
    start, end, d = start[order], end[order], d[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][:len(start)]
    start, end, d = start[new], end[new], d[new]
    order = np.lexsort((d, start))
    return start[order], end[order], d[order]


# ------------------------------------------------------------------ documents
def _indexed(doc: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, places): the sequence to index and where its symbols stand;
    a separator's place is -1."""
    none = np.empty(0, np.int64)
    if not len(word):
        return none, none
    _, code, count = np.unique(doc * (int(word.max()) + 1) + word, return_inverse=True, return_counts=True)
    often = count[code] >= LEAST_PERIODS
    at = np.flatnonzero(often[:-1] & often[1:] & (doc[:-1] == doc[1:]))
    if not len(at):
        return none, none
    _, pair, pairs = np.unique(code[at] * len(count) + code[at + 1], return_inverse=True, return_counts=True)
    at = at[pairs[pair] >= LEAST_PERIODS - 1]
    live = np.zeros(len(word), bool)
    live[at] = live[at + 1] = True
    places = np.flatnonzero(live)
    if not len(places):
        return none, none
    # a stretch ends where the next place is not the neighbour or of another document
    last = np.r_[(np.diff(places) > 1) | (doc[places[1:]] != doc[places[:-1]]), True]
    group = np.r_[0, np.cumsum(last)[:-1]]
    long = np.bincount(group)[group] >= LEAST_WORDS
    places, last = places[long], last[long]
    slot = np.arange(len(places)) + np.r_[0, np.cumsum(last)[:-1]]
    size = len(places) + int(last.sum())
    symbols, where = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    symbols[slot], where[slot] = code[places], places
    gaps = np.flatnonzero(where < 0)
    symbols[gaps] = len(count) + np.arange(len(gaps))
    return symbols, where


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """Fixture rule of the query: every tenth document (by crc32 of its id)
    repeats a stretch of itself to its end. Places of the original words that
    the document's words become, or None for a document left alone."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def _document_runs(ids: list, texts: pa.Array, rewrite) -> Iterator[tuple]:
    """Per document: number of runs, the run of greatest exponent (start, length,
    period) or None, all runs as text, the words kept as text."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    values, doc = split.flatten(), pc.list_parent_indices(split).to_numpy()
    full = pc.not_equal(pc.binary_length(values), 0)          # leading or trailing space leaves empty parts
    values, doc = values.filter(full), doc[full.to_numpy(zero_copy_only=False)].astype(np.int64)
    sizes = np.bincount(doc, minlength=len(ids))
    first = np.cumsum(sizes) - sizes
    word = values.dictionary_encode().indices.to_numpy().astype(np.int64)
    source = np.arange(len(word))
    if rewrite is not None:
        for k, doc_id in enumerate(ids):
            places = rewrite(doc_id, int(sizes[k]))
            if places is not None:
                source[first[k]:first[k] + sizes[k]] = first[k] + places
        word = word[source]
    symbols, where = _indexed(doc, word)
    start, end, period = runs(symbols)
    start, length = where[start], end - start
    dropped = np.zeros(len(word) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    bounds = np.r_[0, np.cumsum(np.bincount(doc[kept], minlength=len(ids)))]
    words = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values.take(pa.array(source[kept])))
    collapsed = pc.binary_join(words, pa.scalar(" ", pa.large_string()))
    found: list[list] = [[] for _ in ids]
    for s, n, q, k in zip(start.tolist(), length.tolist(), period.tolist(), doc[start].tolist()):
        found[k].append((s - int(first[k]), n, q))
    for own, text in zip(found, byte_strings(collapsed)):
        best = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        yield len(own), best, "".join(f"{s},{n},{q}\n" for s, n, q in own), text


def byte_strings(column: pa.Array) -> Iterator[bytes]:
    return (v.as_buffer().to_pybytes() if v.is_valid else b"" for v in column)


def _rows(rewrite):
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("none")
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(batch):
                limit = (sizes[at - 1] if at else 0) + CHUNK_BYTES
                stop = max(at + 1, int(np.searchsorted(sizes, limit, side="right")))
                part = batch.slice(at, stop - at)
                ids = part.column(0).to_pylist()
                out = [(n, *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), listed, text)
                       for n, best, listed, text in _document_runs(ids, part.column(1), rewrite)]
                columns = list(zip(*out))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds)),
                     pa.array(columns[7], pa.string()), pa.array(columns[8], pa.binary()).cast(pa.string())],
                    names=["doc_id", *names, "runs", "collapsed"])
                at = stop

    return run


SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs string, collapsed string")


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """Per document: its number of runs; start, length, period and floor(1000 *
    exponent) of the run with the greatest length / period (ties: smallest
    start, then period); all runs as ``start,length,period`` lines; the text
    without what repeats a run's first period, words joined by one space; and
    both texts' sha256. ``rewrite(doc_id, n)`` may give the places of the words
    to take instead of a document's own."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_rows(rewrite), SCHEMA)
