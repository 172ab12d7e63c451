"""Best-fit packing of tokenised documents into sequences.

Tokens come from a public word-level BPE vocabulary (a path parameter); a
document is its ids and an end id. Documents longer than a sequence are cut;
nothing else is.

Packing is bounded-space online best-fit: a fixed number of open bins, kept in
a bitset whose bit f says that a bin with f free tokens is open. A piece goes
to the fullest bin that still holds it (the lowest set bit at or above its
length); if none does, a bin is opened, and when all are in use the fullest
one closes first. Pieces are dealt by hash into groups of about GROUP_PIECES;
each group is a stream in descending length, packed on its own with memory for
the open bins only, so any number of groups runs in parallel and a group costs
at most one badly filled sequence.

Tokenising splits a text at spaces and newlines, which this vocabulary's
normaliser and pre-tokeniser never join across, and encodes each distinct word
once per cache life; the cache is bounded in bytes.

Edge cases: a null or empty text is the end id alone; repeated rows and
doc_ids are packed like others; null doc_ids are kept; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.session import cut_lineage

from .common import frees, worker_cache

SEQUENCE = 4096
END_ID = 1
OPEN_BINS = 16384
GROUP_PIECES = 50_000
SLICE_BYTES = 2 << 20      # text that is encoded at once
CACHE_BYTES = 48 << 20     # of a worker's cache
_ENTRY_BYTES = 180         # of a cache entry beside its letters and ids (measured)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ragged(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches pool[start : start + size] one after the other, and their ends."""
    end = np.cumsum(size)
    place = np.arange(end[-1] if len(end) else 0) + np.repeat(start - end + size, size)
    return pool[place], end


class WordEncoder:
    """Ids of texts, equal to the vocabulary's own encoding of the whole text.

    The chunks between spaces are made distinct by Arrow; a chunk of letters
    and closing marks is its lower-case word and the marks, which the
    pre-tokeniser keeps apart; any other chunk is encoded as it stands. Words
    and other chunks are encoded once per cache life."""

    # Latin letters that the vocabulary's normaliser only lower-cases, one by one
    _letters = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
    _marks = ".,!?;:%$&*#"

    def __init__(self, path: str, small: bool = False):
        # a sixth of the memory for half as much time again, where executors are shared with other stages
        self.cache_bytes, self.slice_bytes = (CACHE_BYTES // 6, SLICE_BYTES // 4) if small else (CACHE_BYTES, SLICE_BYTES)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.word_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.word_end[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_words(self, words: list[str]) -> list[bytes]:
        """Words of letters only: one pre-token each, so each ends at a word-end id."""
        out = []
        for at in range(0, len(words), 256):
            part = words[at:at + 256]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(part) or (len(ids) and ends[-1] != len(ids)):
                out += map(self._encode, part)
                continue
            raw, start = ids.tobytes(), 0
            for end in (4 * ends).tolist():
                out.append(raw[start:end])
                start = end
        return out

    def _lookup(self, parts: pa.Array, learn) -> list[bytes]:
        """Ids of each of the distinct ``parts``; ``learn`` encodes a list of new ones."""
        parts = parts.to_pylist()
        if self.known_bytes > self.cache_bytes:
            self.known.clear()
            self.known_bytes = 0
        found = list(map(self.known.get, parts))
        new = [i for i, f in enumerate(found) if f is None]
        for i, ids in zip(new, learn([parts[i] for i in new])):
            self.known[parts[i]] = found[i] = ids
            self.known_bytes += _ENTRY_BYTES + len(parts[i]) + len(ids)
        return found

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, size) of the ids of each chunk."""
        stem = pc.utf8_rtrim(chunks, characters=self._marks)
        plain = pc.match_substring_regex(stem, self._letters).to_numpy(zero_copy_only=False)
        tail = (pc.binary_length(chunks).to_numpy() - pc.binary_length(stem).to_numpy()) * plain
        words = pc.utf8_lower(stem.filter(pa.array(plain))).dictionary_encode()
        raw = self._lookup(words.dictionary, self._learn_words)
        # segments: the words, the other chunks, the marks
        first = np.zeros(len(chunks), np.int64)
        first[plain] = words.indices.to_numpy()
        other = chunks.filter(pa.array(~plain))
        first[~plain] = len(raw) + np.arange(len(other))
        raw += self._lookup(other, lambda new: map(self._encode, new))
        second = np.zeros(len(chunks), np.int64)
        for n in np.unique(tail[tail > 0]).tolist():
            at = np.flatnonzero(tail == n)
            marks = pc.utf8_slice_codeunits(chunks.take(pa.array(at)), -n).dictionary_encode()
            second[at] = len(raw) + marks.indices.to_numpy()
            raw += self._lookup(marks.dictionary, lambda new: map(self._encode, new))
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        start = np.cumsum(size) - size
        both = np.stack([first, second], 1).ravel()
        own = size[both]
        own[1::2] *= tail > 0
        pool, end = _ragged(np.frombuffer(b"".join(raw), "<u4"), start[both], own)
        end = end[1::2]
        return pool, np.r_[0, end[:-1]][:len(end)], own[0::2] + own[1::2]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end): the ids of all texts of a string column (null: empty)
        one after the other, and where each text's end."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        pool, start, size = self._chunk_ids(coded.dictionary)
        code = coded.indices.to_numpy()
        ids, end = _ragged(pool, start[code], size[code])
        last = np.cumsum(pc.list_value_length(split).to_numpy()) - 1     # a text has one chunk at least
        return ids, end[last]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in groups of about slice_bytes of text; a
        longer text is encoded in slices that end at a space."""
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            before = size[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(size, before + self.slice_bytes, side="right")))
            if stop == at + 1 and size[at] - before > self.slice_bytes:
                parts = pa.array(_slices(texts[at].as_py(), self.slice_bytes), pa.large_string())
                yield np.concatenate([self.encode_column(parts.slice(i, 1))[0] for i in range(len(parts))])
            else:
                ids, end = self.encode_column(texts.slice(at, stop - at))
                yield from np.split(ids, end[:-1])
            at = stop


def _slices(text: str, size: int) -> list[str]:
    """A long text cut at spaces and newlines (which belong to no token)."""
    out, at = [], 0
    while at < len(text):
        cut = re.compile("[ \n]").search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        out.append(text[at:end])
        at = end + 1
    return out


def _pieces(path: str, with_ids: bool, small: bool = False):
    end = np.array([END_ID], "<u4").tobytes()

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("packing")
        if (path, small) not in cache:
            cache[path, small] = WordEncoder(path, small)
        encoder = cache[path, small]
        for batch in batches:
            encoded = zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)))
            for _ in range(0, len(batch), 512):
                ids, piece, start, length, crc, raw = [], [], [], [], [], []
                for doc, own in islice(encoded, 512):
                    own = own.astype("<u4", copy=False).tobytes() + end
                    for k, a in enumerate(range(0, len(own), 4 * SEQUENCE)):
                        cut = own[a:a + 4 * SEQUENCE]
                        ids.append(doc)
                        piece.append(k)
                        start.append(a // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        if with_ids:
                            raw.append(cut)
                columns = [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def token_pieces(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False, small: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, on request, ids
    (little-endian unsigned 32-bit). ``small``: encoders that take less memory
    and more time."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(_pieces(path or default_vocabulary(), with_ids, small), schema)


class OpenBins:
    """Bounded-space best-fit over bins of ``capacity``."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits = 0                                     # bit f: a bin with f free is open
        self.bins = [[] for _ in range(capacity + 1)]     # bin numbers by free space
        self.open = self.numbers = 0

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1..capacity tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.numbers
            self.numbers += 1
        left = free - length
        if left:
            if not self.bins[left]:
                self.bits |= 1 << left
            self.bins[left].append(number)
            self.open += 1
        return number, self.capacity - free


def _pack(capacity: int, open_bins: int):
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins = None, None
        for batch in batches:
            sequence, offset = [], []
            for g, length in zip(batch.column("group").to_pylist(), batch.column("length").to_pylist()):
                if g != group:
                    group, bins = g, OpenBins(capacity, open_bins)
                number, at = bins.place(length)
                sequence.append((g << 32) + number)
                offset.append(at)
            columns = [batch.column(n) for n in batch.schema.names if n != "group"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*(n for n in batch.schema.names if n != "group"), "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = SEQUENCE, open_bins: int = OPEN_BINS,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length in
    1..capacity, any other columns)."""
    pieces = cut_lineage(pieces)
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(groups)))
    ordered = dealt.repartition("group").sortWithinPartitions("group", F.desc("length"), "doc_id", "piece", "ids_crc32")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ordered.mapInArrow(_pack(capacity, open_bins), schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   small: bool = False) -> DataFrame:
    return pack(token_pieces(docs, path, id_col, text_col, small=small))
