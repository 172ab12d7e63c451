"""Substring deduplication by sliding sentence spans.

A text is cut into sentences: at stops before white space, closing quotes and
brackets between them allowed, at line ends, and after the word of the smallest
hash of every CUT_EVERY consecutive words. A cut so depends on fewer than
CUT_EVERY words on each side of it. Every run of consecutive sentences of at
least RUN_WORDS words, as short as possible from each first and up to each last
sentence, is hashed. A passage has the same cuts in all places but for its first
and last CUT_EVERY - 1 words, and no gap above CUT_EVERY words between them, so
4 * CUT_EVERY + RUN_WORDS - 3 (44) shared words hold a common run for certain. Of equal runs
in the whole corpus the first one, by (doc_id, place), stays; the sentences
that any other one covers are removed.

Almost all runs occur once, so only their 8-byte hashes are shuffled first, at
most two of a kind per map task, sorted and streamed: that finds the hashes that
occur again. A second scan emits (hash, document, first sentence, last sentence)
for runs whose hash may be one of them, by a bit filter. These are compared in
the map tasks first: a later occurrence of the same task is known as a repeat and
only the first one is looked up, so a passage that a third of all documents
share reaches the task of its hash as one row per map task. Tasks on the other
side stream sorted rows and hold one batch. Texts with repeats meet them in a
join; all others, told by a bit filter again, are not shuffled.

Edge cases: null and empty texts have no sentences and come back as they are;
texts of fewer words have no runs and are unchanged; runs that
repeat inside one text count as well; rows that repeat both doc_id and text
are one document; a null doc_id comes after all others; other columns of any
name pass through ``remove_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.session import cut_lineage

from .common import bit_filter, byte_views, filter_bits, frees, may_hold, range_hashes, signed, words_at

RUN_WORDS = 15
CUT_EVERY = 8
FLUSH_ROWS = 1 << 20
BATCH_ROWS = 1 << 16
_STOPS = [c.encode() for c in ".!?\u2026\u3002\uff0e\uff01\uff1f\u061f\u06d4\u0964\u0965"]
_CLOSERS = [c.encode() for c in "\"')]}\u2019\u201d\u201c\u00bb\u00ab\u203a\u2039\u300d\u300f\uff09"]
_LAST = (1 << 63) - 1


class _Marks:
    """Single-byte marks by table; others only where their last byte occurs."""

    def __init__(self, marks: list[bytes]):
        self.single, self.several = np.zeros(256, bool), np.zeros(256, bool)
        self.single[[m[0] for m in marks if len(m) == 1]] = True
        self.long = [m for m in marks if len(m) > 1]
        self.several[[m[-1] for m in self.long]] = True

    def ending(self, data: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Bytes of the mark that ends before each of the places; 0: none."""
        last = data[np.maximum(after, 1) - 1]
        size = (self.single[last] & (after > 0)).astype(np.int64)
        some = np.flatnonzero(self.several[last])
        for mark in self.long if len(some) else ():
            at = some[after[some] >= len(mark)]
            for k in range(1, len(mark) + 1):
                at = at[data[after[at] - k] == mark[-k]]
            size[at] = len(mark)
        return size


_STOP, _CLOSE = _Marks(_STOPS), _Marks(_CLOSERS)


def _stops(data: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which words end in a stop, before closing quotes and brackets."""
    end, active = after.copy(), np.arange(len(after))
    while len(active):
        size = _CLOSE.ending(data, end[active])
        active, size = active[size > 0], size[size > 0]
        end[active] -= size
        active = active[end[active] > first[active]]
    return (end > first) & (_STOP.ending(data, end) > 0)


def sentences(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, first word of each sentence and one after the last, byte
    where each sentence's first word starts)."""
    words, first, after = words_at(data)
    n = len(words)
    if not n:
        return words, np.zeros(1, np.int64), first
    lines = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=lines[1:])
    ends = _stops(data, first, after)
    ends[:-1] |= lines[first[1:]] > lines[after[:-1]]
    if n >= CUT_EVERY:
        windows = np.lib.stride_tricks.sliding_window_view(words, CUT_EVERY)
        ends[np.arange(len(windows)) + CUT_EVERY - 1 - windows[:, ::-1].argmin(axis=1)] = True
    ends[-1] = True
    starts = np.r_[0, np.flatnonzero(ends) + 1]
    return words, starts, first[starts[:-1]]


def runs(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, sentence after the last) of every run."""
    n = len(starts) - 1
    if len(words) < RUN_WORDS:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    i = np.arange(n)
    to = np.searchsorted(starts, starts[:-1] + RUN_WORDS)
    since = np.searchsorted(starts, starts[1:] - RUN_WORDS, side="right") - 1
    pairs = np.unique(np.r_[(i * (n + 1) + to)[to <= n], (since * (n + 1) + i + 1)[since >= 0]])
    a, b = pairs // (n + 1), pairs % (n + 1)
    return range_hashes(words, starts[a], starts[b]), a, b


_NAMES = ["hash", "doc", "row", "start", "stop", "repeat"]
_RUNS = "hash long, doc long, row long, start int, stop int, repeat boolean"


@frees
def _run_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> hashes of its runs; one that occurs again before a flush comes
    twice, and no more often."""

    def flush():
        hashes, count = np.unique(np.concatenate(held), return_counts=True)
        out = np.r_[hashes, hashes[count > 1]].view(np.int64)
        for at in range(0, len(out), BATCH_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(out[at:at + BATCH_ROWS])], names=["hash"])

    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for text in byte_views(batch.column(0)):
            words, starts, _ = sentences(text)
            h = runs(words, starts)[0]
            held.append(h)
            size += len(h)
            if size > FLUSH_ROWS:
                yield from flush()
                held, size = [], 0
    if size:
        yield from flush()


@frees
def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted hashes -> each that occurs again, once."""
    last = np.empty(0, np.int64)         # the hash before, and whether it was told
    told = False
    for b in batches:
        h = np.r_[last, b.column(0).to_numpy()]
        if not len(h):
            continue
        same = np.r_[False, h[1:] == h[:-1]]
        second = same & ~np.r_[False, same[:-1]]       # one row per hash that repeats
        if told and len(same) > 1 and same[1]:
            second[1] = False
        if second.any():
            yield pa.RecordBatch.from_arrays([pa.array(h[second])], names=["hash"])
        told = bool(same[-1]) or (told and len(h) == 1)
        last = h[-1:]


def _run_rows(bits):
    """mapInArrow: (doc, row, text) -> runs that may occur again; repeat tells
    that an earlier run of this task is equal. Repeats are spread by another
    hash, as they need no lookup."""

    def flush(held):
        h, doc, row, start, stop = (np.concatenate([x[i] for x in held]) for i in range(5))
        order = np.lexsort((start, row, doc, h))
        h, doc, row, start, stop = h[order], doc[order], row[order], start[order], stop[order]
        later = np.r_[False, h[1:] == h[:-1]]
        same = np.r_[False, (doc[1:] == doc[:-1]) & (row[1:] == row[:-1]) & (start[1:] == start[:-1])] & later
        # a copied row's runs are those of one document; keep them once
        h, doc, row, start, stop, later = (x[~same] for x in (h, doc, row, start, stop, later))
        h = np.where(later, h ^ (row.view(np.uint64) | np.uint64(1)), h)
        for at in range(0, len(h), BATCH_ROWS):
            cut = slice(at, at + BATCH_ROWS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[cut].view(np.int64)), pa.array(doc[cut]), pa.array(row[cut]),
                 pa.array(start[cut].astype(np.int32)), pa.array(stop[cut].astype(np.int32)), pa.array(later[cut])],
                names=_NAMES)

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            docs, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, text in enumerate(byte_views(batch.column(2))):
                words, starts, _ = sentences(text)
                h, a, b = runs(words, starts)
                some = np.flatnonzero(may_hold(bits.value, signed(h)))
                if len(some):
                    held.append([h[some], np.full(len(some), docs[i]), np.full(len(some), rows[i]), a[some], b[some]])
                    size += len(some)
                if size > FLUSH_ROWS:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


@frees
def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by (known repeat, hash, doc, row, start) -> all that are not
    the first run of their hash. A row at the first one's place is the same run
    of the same document, read by another task."""
    head = None                          # hash, doc, row, start of the first run of the hash before
    for b in batches:
        if not len(b):
            continue
        h, doc, row, start, stop, known = (b.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        first = np.r_[True, h[1:] != h[:-1]]
        at = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
        place = [x[at] for x in (doc, row, start)]
        if head is not None and head[0] == h[0]:
            for p, value in zip(place, head[1:]):
                p[h == h[0]] = value
        head = (h[-1], *(p[-1] for p in place))
        moved = (doc != place[0]) | (row != place[1]) | (start != place[2])
        found = np.flatnonzero(known | moved)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(x[found]) for x in (doc, row, start, stop)],
                                             names=["doc", "row", "start", "stop"])


def _covered(spans: list[dict] | None, n: int) -> np.ndarray:
    mark = np.zeros(n + 1, np.int64)
    if spans is not None and len(spans):
        np.add.at(mark, [s["start"] for s in spans], 1)
        np.add.at(mark, [s["stop"] for s in spans], -1)
    return np.cumsum(mark)[:-1] > 0


def _clean(text_at: int, spans_at: int, schema: pa.Schema, bits=None):
    """mapInArrow: rows with their spans -> rows with the text without covered
    sentences, n_sentences, n_removed. With ``bits`` the column is the hash of
    the row's key instead: rows whose bit is not set, which have no spans."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if bits is not None:
                whole = whole.filter(pa.array(~may_hold(bits.value, whole.column(spans_at).to_numpy())))
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                spans = batch.column(spans_at).to_pylist() if bits is None else [None] * len(batch)
                texts, total, removed = [], [], []
                for i, data in enumerate(byte_views(batch.column(text_at))):
                    _, starts, place = sentences(data)
                    gone = _covered(spans[i], len(starts) - 1)
                    total.append(len(gone))
                    removed.append(int(gone.sum()))
                    if gone.any():
                        edge = np.r_[0, place[1:], len(data)]  # leading space belongs to the first sentence
                        raw = data.tobytes()
                        texts.append(b"".join(raw[edge[k]:edge[k + 1]] for k in np.flatnonzero(~gone)).decode())
                    else:
                        texts.append(batch.column(text_at)[i].as_py())
                columns = [pa.array(texts, pa.string()) if k == text_at else batch.column(k)
                           for k in range(batch.num_columns) if k != spans_at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(total, pa.int64()), pa.array(removed, pa.int64())], schema=schema)

    return run


def _key(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row")]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per run that is not the first of its hash: doc, row (hash of the text),
    start and stop (sentence numbers, stop exclusive)."""
    rows = docs.select(*_key(id_col, text_col), F.col(text_col).alias("text"))
    hashes = rows.select("text").mapInArrow(_run_hashes, "hash long")
    again = cut_lineage(hashes.repartition("hash").sortWithinPartitions("hash").mapInArrow(_again, "hash long"))
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(again, filter_bits(again.count())))
    found = rows.mapInArrow(_run_rows(bits), _RUNS)
    dealt = found.repartition("hash").sortWithinPartitions("repeat", "hash", "doc", "row", "start")
    return dealt.mapInArrow(_repeats, "doc long, row long, start int, stop int")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without repeated spans in the text, and n_sentences, n_removed
    (columns of ``docs`` that have these names are replaced)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop("n_sentences", "n_removed")
    spans = cut_lineage(repeated_spans(docs, id_col, text_col).groupBy("doc", "row").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")))
    key = F.xxhash64("doc", "row")
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(spans.select(key), filter_bits(spans.count())))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_sentences", T.LongType()),
                           T.StructField("n_removed", T.LongType())])
    at, last, arrow = docs.columns.index(text_col), len(docs.columns), to_arrow_schema(schema)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    packed = docs.select(own, *_key(id_col, text_col)).withColumn("key", key)
    rest = packed.select("whole.*", F.col("key").alias("_key")).mapInArrow(_clean(at, last, arrow, bits), schema)
    likely = packed.mapInArrow(_held(bits), packed.schema).drop("key")
    joined = likely.join(spans.hint("merge"), ["doc", "row"], "left").select("whole.*", F.col("spans").alias("_spans"))
    return joined.mapInArrow(_clean(at, last, arrow), schema).union(rest)


def _held(bits):
    """mapInArrow: rows whose last column, a hash, may be held."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = b.filter(pa.array(may_hold(bits.value, b.column(b.num_columns - 1).to_numpy())))
            if len(part):
                yield part

    return run
