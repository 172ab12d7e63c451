"""Ranked lexical search: the best documents of each item, by reversed search.

The items (the query set) are small against the documents, so the index is
turned round: an inverted index over the *items'* terms is broadcast and every
document streams through it once. A term is a stretch of ASCII letters, digits
and non-ASCII characters, A-Z lower-cased. Per batch of documents the counts of
indexed terms are looked up in the postings, which adds up the scores of all
items the document touches; scores that beat an item's bound go into its heap
of at most ``top`` entries. Heaps of all tasks merge in two steps (per group of
tasks, then per item), so no task sees more than a bounded number of entries
of an item per group.

Scores are 64-bit integers. N documents have a term, L is the number of all
their terms, n that of one document, df and tf are a term's document and
in-document counts: weight w = floor(1000 ln((2N + 2) / (2 df + 1))), length
norm m = 100 - 75 + (75 n N) div L, score = sum over the item's terms, repeats
included, of w * ((10^9 tf) div (1000 tf + 8 m)).

Statistics come from a first pass that emits one row per task and indexed term.
Items are read as a stream and handled in blocks of at most BLOCK_BYTES of text
(one item at least) and BLOCK_ITEMS items: that bounds the broadcast, the
statistics the driver holds and a task's score table, whatever the number of
items; each block passes over the documents twice.

Edge cases: a null or term-free text (document or item) takes no part, so such
an item has no rows; every row of a table is a document or an item of its own,
repeated ids and texts included (ranks are per item row); ties go to the smaller
doc_id, null ids last; a long text is counted slice by slice; other columns are
not read; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewise.session import cut_lineage

from .common import byte_views, frees, worker_cache

TOP = 10
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 4096
GROUPS = 64               # groups of tasks whose heaps merge first
_CELLS = 1 << 21          # cells of a score table (documents x items)
_SLICE = 1 << 20          # bytes of a text handled at once

# ASCII bytes that are no letter or digit become spaces, A-Z become a-z.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, slice by slice (slices end at a space)."""
    text = text.translate(_TERMS)
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > _SLICE:
            end = text.find(b" ", at + _SLICE)
            end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class ItemIndex:
    """Inverted index of one block of items: per term the items that hold it
    and how often."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        postings: list[list[tuple[int, int]]] = []
        for at, (_, text) in enumerate(items):
            counts = Counter()
            for part in terms(text):
                counts.update(part)
            for term, n in counts.items():
                place = self.vocabulary.setdefault(term, len(postings))
                if place == len(postings):
                    postings.append([])
                postings[place].append((at, n))
        self.sizes = np.array([len(p) for p in postings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.items = np.array([i for p in postings for i, _ in p], np.int64)
        self.counts = np.array([n for p in postings for _, n in p], np.int64)

    def matched(self, column: pa.Array):
        """Per document its number of terms; and as (document, term, count)
        its indexed terms."""
        find, size = self.vocabulary.get, len(self.vocabulary)
        total = np.zeros(len(column), np.int64)
        found = []
        for d, view in enumerate(byte_views(column)):
            for part in terms(view.tobytes()):
                total[d] += len(part)
                places = np.fromiter(map(find, part, repeat(-1)), np.int64, len(part))
                found.append(places[places >= 0] + d * size)
        key, count = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
        return total, key // max(size, 1), key % max(size, 1), count


def _statistics(index):
    """mapInArrow: per task, documents with an indexed term by term; term -1
    counts documents with a term at all, -2 all terms."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("none")
        own, documents, length = np.zeros(len(index.value.vocabulary), np.int64), 0, 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                total, _, term, _ = index.value.matched(batch.column(0).slice(at, 256))
                own += np.bincount(term, minlength=len(own))
                documents += int(np.count_nonzero(total))
                length += int(total.sum())
        held = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[held, -1, -2], pa.int64()), pa.array(np.r_[own[held], documents, length], pa.int64())],
            names=["term", "n"])

    return run


def _heaps(index, weights, documents: int, length: int, top: int):
    """mapInArrow: streams documents through the item index and yields the
    task's heaps: item, task, doc_id, score."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("none")
        idx, weight = index.value, weights.value
        heaps: list[list] = [[] for _ in idx.ids]
        least = np.ones(len(idx.ids), np.int64)          # scores below are no candidates
        rows = max(1, min(256, _CELLS // max(1, len(idx.ids))))
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.slice(at, rows)
                total, doc, term, tf = idx.matched(part.column(1))
                norm = 100 - 75 + (75 * total * documents) // length
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * norm[doc]))
                sizes = idx.sizes[term]
                ends = np.cumsum(sizes)
                posting = np.arange(ends[-1] if len(ends) else 0) + np.repeat(idx.starts[term] - ends + sizes, sizes)
                scores = np.zeros((len(part), len(idx.ids)), np.int64)
                np.add.at(scores, (np.repeat(doc, sizes), idx.items[posting]), np.repeat(gain, sizes) * idx.counts[posting])
                ids = part.column(0).to_pylist()
                who, item = np.nonzero(scores >= least)
                for d, i, s in zip(who.tolist(), item.tolist(), scores[who, item].tolist()):
                    entry = (s, ids[d] is not None, -(ids[d] or 0))   # ordered worst to best
                    heap = heaps[i]
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == top:
                        least[i] = max(1, heap[0][0])
        out = [(i, -e[2] if e[1] else None, e[0]) for i, heap in enumerate(heaps) for e in heap]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([task] * len(out), pa.int64()),
             pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64())],
            names=["item", "task", "doc_id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items as a stream of bounded blocks."""
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        text = (text or "").encode()
        if block and (size + len(text) > BLOCK_BYTES or len(block) >= BLOCK_ITEMS):
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def _search_block(docs: DataFrame, index: ItemIndex, top: int, first: int) -> DataFrame | None:
    """Ranked documents of one block's items, or None if no document has a term."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(index)
    counts = docs.select("text").mapInArrow(_statistics(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = dict(counts.collect())                          # the block's terms and two totals
    documents, length = df.pop(-1, 0), df.pop(-2, 0)
    if not length:
        return None
    weights = np.zeros(len(index.vocabulary), np.int64)
    for term, n in df.items():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    heaps = docs.mapInArrow(_heaps(shared, sc.broadcast(weights), documents, length, top),
                            "item long, task long, doc_id long, score long")
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = Window.partitionBy("item", F.col("task") % GROUPS).orderBy(*best)
    final = Window.partitionBy("item").orderBy(*best)
    merged = heaps.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= top)
    merged = merged.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= top)
    schema = "item long, item_id long"
    names = docs.sparkSession.createDataFrame(list(enumerate(index.ids)), schema)
    return merged.join(F.broadcast(names), "item").select(
        (F.col("item") + first).alias("item"), "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per item row its ``top`` best documents of positive score: item (the
    row's number in the query stream), item_id, rank from 1, doc_id, score."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wanted = items.select(F.col(item_col).cast("long"), F.col(item_text_col))
    out, first = [], 0
    for block in _blocks(wanted):
        found = _search_block(rows, ItemIndex(block), top, first)
        first += len(block)
        if found is not None:
            out.append(cut_lineage(found))               # one plan per block, not one for all
    if not out:
        return docs.sparkSession.createDataFrame([], "item long, item_id long, rank int, doc_id long, score long")
    merged = out[0]
    for f in out[1:]:
        merged = merged.union(f)
    return merged
