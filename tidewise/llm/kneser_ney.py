"""Quality by an interpolated modified Kneser-Ney n-gram model.

The model is trained on trusted text: documents that ``labels`` marks good
(quality = 1), all of them but a tenth that is held back for the thresholds.
Its tokens are words as they are written (ORDER of them; a character of a
script without spaces is a word). N-gram counts are sharded. With them

    p_n(w | ctx) = max(c - D(c), 0) / c(ctx) + (D1 N1 + D2 N2 + D3 N3) / c(ctx) * p_(n-1)(w | ctx')

with the modified discounts D1, D2, D3+ of each order, is known for every
trusted n-gram. An n-gram that is not trusted has only the factor of its
context (1 if that is not trusted either) and p_(n-1). So the log probability
of a text is the sum over its tokens of log p_1(w), and of the gain of p_3 over
p_1, which the trigram u v w decides.

Gains are made where trigrams meet: all occurrences with one middle word v are
one shard's, so counts of u v w, different left neighbours of v w and the
totals of the contexts u v and v are numbers of that shard alone. Trigrams of a
frequent v (more than WORD_SHARDS shards of them) are dealt by u v instead; what
their shards count of v w is summed in one table. A first sweep over the
trusted text counts: it yields the discounts, and per shard the words it needs
p_1 of, joined with the one-word table. Texts are read once, into blocks of
coded words. A second sweep deals out the trigrams
of all documents, counts the trusted ones again (cheaper than storing them),
and sums gains per document. Each sweep goes in PASSES turns over the blocks, for
a part of the shards each, so shuffles hold that part of the trigrams at a time.

log p_1 is a count join by word hash: the map tasks look up at most SHARD_GRAMS
of the most frequent words, which are broadcast, and emit (word, document,
count), merged per document, for the others that pass a bit filter; these are
shuffled once, joined with the values and summed. Nothing is pruned: more text
gives more n-grams and more shards. Tables between the steps are compressed
files below the checkpoint folder, dropped after their last read.

A document's perplexity is per word. It is kept if that is at most the
LANGUAGE_QUANTILE of the held-back trusted documents of its language; texts of
at most LEAST_WORDS tokens, and languages without such documents, are not
judged (kept).

Edge cases: white space of any length is one space; a null, empty or blank
text has one token, its end; a null language is a language of its own; without
trusted text every probability is uniform and everything is kept; a null
doc_id is never trusted; rows that repeat a document are scored and train each; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewise.session import Scratch, cut_lineage, scratch

from .common import frees, signed, words_at

ORDER = 3
LANGUAGE_QUANTILE = 0.995
LEAST_WORDS = 40          # about 200 characters
LEAST_CHARS = LEAST_WORDS  # the bound in tokens, by its name of when these were characters
SHARD_GRAMS = 4 << 20     # values that are broadcast
SHARD_TOKENS = 1 << 19    # whose trigrams are one shard
WORD_SHARDS = 6           # shards' worth of one middle word that are not dealt out
BLOCK_CHARS = 6 << 20     # text that a task counts or scores at a time
FILTER_BITS = 1 << 26
PASSES = 6                # turns over the text, for a part of the shards each
QUANTILE_STEPS = 2000     # per unit of log perplexity
START, END = ("\x02",), ("\x03",)

_WORD, _PAIR, _GRAMS = 1, 2, 3   # kinds of a shard's rows
_MARKS = str.maketrans(START[0] + END[0], "  ")
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff])")


def line(text: str | None) -> str:
    """The text as the model reads it: ORDER - 1 starts, words, an end, with
    single spaces."""
    text = text or ""
    if START[0] in text or END[0] in text:
        text = text.translate(_MARKS)
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", text)
    return " ".join([*START * (ORDER - 1), *text.split(), *END])


def flat(text: str | None) -> tuple[str, ...]:
    return tuple(line(text).split(" "))


def _tokens(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of the lines, number of words of each line)."""
    sizes = np.array([t.count(" ") + 1 for t in lines])
    return words_at(np.frombuffer(" ".join(lines).encode(), np.uint8), lower=False)[0], sizes


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _keys(words: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of n-grams, from the hashes of their words: the public
    XXH64 of each, seeded with that of those before, as F.xxhash64 has it."""
    h = np.full(len(words[0]), 42, np.uint64)
    for w in words:
        h = (h + _P5 + np.uint64(8)) ^ (_turned(w * _P2, 31) * _P1)
        h = _turned(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h = h ^ (h >> np.uint64(32))
    return h


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays in one value, each after its length, word codes as short as may be."""
    return b"".join(x for a in arrays for x in (np.array([len(a), a.itemsize], np.int64).tobytes(), a.tobytes()))


def _unpacked(value: bytes, kinds: str) -> list[np.ndarray]:
    found, at = [], 0
    for kind in kinds:
        n, size = np.frombuffer(value, np.int64, 2, at)
        found.append(np.frombuffer(value, f"{kind}{size}", n, at + 16))
        at += 16 + int(n * size)
    return found


def _short(codes: np.ndarray, size: int) -> np.ndarray:
    return codes.astype(np.uint16 if size <= 1 << 16 else np.uint32)


@frees
def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, trusted, text) -> blocks of about BLOCK_CHARS characters: docs,
    which are trusted, tokens of each, different words, code of every token."""

    def block():
        words, sizes = _tokens(lines)
        codes, different = pd.factorize(words)
        order = np.argsort(-np.bincount(codes), kind="stable")  # frequent words get small codes, which compress
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        planes = np.ascontiguousarray(rank[codes].view(np.uint8).reshape(-1, 4).T).ravel()
        value = _packed([np.array(docs), np.array(trusted), sizes, different[order], planes])
        return pa.RecordBatch.from_arrays([pa.array([len(words)]), pa.array([value], pa.binary())], names=["tokens", "block"])

    docs, trusted, lines, size = [], [], [], 0
    for b in batches:
        for doc, good, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            docs.append(doc)
            trusted.append(good)
            lines.append(line(text))
            size += len(lines[-1])
            if size > BLOCK_CHARS:
                yield block()
                docs, trusted, lines, size = [], [], [], 0
    if lines:
        yield block()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for b in batches:
        for value in b.column(1):
            *facts, planes = _unpacked(value.as_buffer(), "ibiuu")
            yield [*facts, np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()]


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, place in the line) of every word."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _found(keys: np.ndarray, of: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """What ``of`` has for the wanted ones of the sorted keys, 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted), of.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, of[at], 0)


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return _found(keys, np.ones(len(keys), np.int8), wanted) == 1


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key among the different ones, first place of these)."""
    of, different = pd.factorize(keys)
    first = np.empty(len(different), np.int64)
    first[of[::-1]] = np.arange(len(of) - 1, -1, -1)
    return of, first


# --------------------------------------------------------------------- shards
@frees
def _common_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> (word, n), at most 4096 words of a block."""
    for *_, words, codes in _blocks(batches):
        n = np.bincount(codes, minlength=len(words))
        some = n * 4096 > len(codes)
        yield pa.RecordBatch.from_arrays([pa.array(signed(words[some])), pa.array(n[some])], names=["word", "n"])


def _gram_rows(often, shards: int, passes: int, turn: int, scored: bool):
    """Blocks -> (shard, _GRAMS, trigrams) for the shards of one turn. Trigrams
    of documents that are not trusted count for nothing: unless they are to be
    scored, they are left out except where v is frequent."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, trusted, sizes, words, codes in _blocks(batches):
            of, place = _places(sizes)
            shard = (words % np.uint64(shards)).astype(np.int32)[codes[:-1]]
            shared = np.flatnonzero(_among(often.value, words)[codes[1:-1]]) + 1
            shard[shared] = _keys([words[codes[shared - 1]], words[codes[shared]]]) % np.uint64(shards)
            take = (shard % passes == turn) & (place[1:] >= ORDER - 1)
            if not scored:
                needed = trusted[of[1:]]
                needed[shared] = True
                take &= needed
            at = np.flatnonzero(take)
            at = at[np.argsort(shard[at], kind="stable")]
            shard = shard[at]
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else np.zeros(1, np.int64)
            packed = []
            for i, j in zip(cuts[:-1], cuts[1:]):
                own = at[i:j]
                gram, different = pd.factorize(np.concatenate([codes[own - 1], codes[own], codes[own + 1]]))
                line_of = of[own + 1]
                packed.append(_packed([words[different], _short(gram, len(different)), trusted[line_of],
                                       *([docs[line_of]] if scored else [])]))
            n = len(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[cuts[:-1]]), pa.array(np.full(n, _GRAMS, np.int32)), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.array(packed, pa.binary())], names=["shard", "kind", "key", "n", "grams"])

    return run


def _by_shard(batches: Iterator[pa.RecordBatch]):
    """Rows sorted by shard and kind -> (shard, (keys, n) of its words, (keys,
    n) of its pairs, packed trigrams), the keys sorted."""

    def told(rows):
        keys, n = (np.concatenate([r[i] for r in rows]) if rows else np.empty(0, np.int64) for i in (0, 1))
        order = np.argsort(keys.view(np.uint64))
        return keys.view(np.uint64)[order], n[order]

    now, held = None, {}
    for b in batches:
        shard, kind = (b.column(i).to_numpy() for i in (0, 1))
        cuts = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]), True]) if len(b) else [0]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if shard[i] != now:
                if now is not None:
                    yield now, told(held[_WORD]), told(held[_PAIR]), held[_GRAMS]
                now, held = shard[i], {_WORD: [], _PAIR: [], _GRAMS: []}
            rows = b.slice(i, j - i)
            held[kind[i]] += rows.column(4).to_pylist() if kind[i] == _GRAMS else [
                tuple(rows.column(c).to_numpy() for c in (2, 3))]
    if now is not None:
        yield now, told(held[_WORD]), told(held[_PAIR]), held[_GRAMS]


def _trigrams(packed: list[bytes], scored: bool) -> list[np.ndarray]:
    """u, v, w, whether trusted, and docs if to be scored, of packed trigrams."""
    rows = []
    for x in packed:
        words, codes, *facts = _unpacked(x, "uubi" if scored else "uub")
        rows.append([*words[codes].reshape(ORDER, -1), *facts])
    kinds = [np.uint64] * ORDER + [bool] + [np.int64] * scored
    return [np.concatenate(c) for c in zip(*rows)] if rows else [np.empty(0, k) for k in kinds]


def _shard_counts(often):
    """Trigrams -> (kind, shard, v, w, n). Kind 0: n n-grams of order ``shard``
    are counted v times; _WORD: n cold v stand before w; _PAIR: n different u
    stand before v w, v being frequent."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, _, _, packed in _by_shard(batches):
            u, v, w, trusted = _trigrams(packed, False)
            of, first = _distinct(_keys([u, v, w]))
            c3 = np.bincount(of, trusted, len(first)).astype(np.int64)
            v, w = v[first], w[first]
            of, first = _distinct(_keys([v, w]))
            c2 = np.bincount(of, c3 > 0, len(first)).astype(np.int64)
            v, w = v[first], w[first]
            shared = _among(often.value, v)
            of, first = _distinct(w)
            before = np.bincount(of, (c2 > 0) & ~shared, len(first)).astype(np.int64)
            times = np.arange(1, 5)
            seen = [np.bincount(np.minimum(c, 5), minlength=6)[1:5] for c in (c3, c2[~shared])]
            columns = [(np.zeros(8, np.int32), np.repeat([3, 2], 4).astype(np.int32), np.tile(times, 2), np.zeros(8, np.int64),
                        np.concatenate(seen)),
                       (np.full(len(first), _WORD, np.int32), np.full(len(first), shard, np.int32), np.zeros(len(first), np.int64),
                        w[first].view(np.int64), before),
                       (np.full(shared.sum(), _PAIR, np.int32), np.full(shared.sum(), shard, np.int32), v[shared].view(np.int64),
                        w[shared].view(np.int64), c2[shared])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*columns)], names=["kind", "shard", "v", "w", "n"])

    return run


# ---------------------------------------------------------------------- model
def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen 1..4 times."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.0)
    return tuple(min(max(d, 0.05), k) for d, k in zip(found, (0.95, 1.95, 2.95)))


def _seen(table: DataFrame) -> list[int]:
    """Numbers of n-grams seen 1..4 times."""
    return list(table.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first())


def _sums():
    """What a context's total and rest are made of."""
    once, twice, more = F.col("n") == 1, F.col("n") == 2, F.col("n") >= 3
    return [F.sum("n").alias("total"), *[F.count_if(x).alias(name) for x, name in ((once, "n1"), (twice, "n2"), (more, "n3"))]]


def _rest(total, n1, n2, n3, cut: tuple[float, float, float]):
    """Share of a context that its discounts free (0 if it is not trusted)."""
    return (n1 * cut[0] + n2 * cut[1] + n3 * cut[2]) / np.maximum(total, 1)


def _contexts(of: np.ndarray, c: np.ndarray, size: int, cut) -> tuple[np.ndarray, np.ndarray]:
    """(total, rest) of contexts, from the counts of the n-grams ``of`` each."""
    total, *seen = (np.bincount(of, x, size) for x in (c, c == 1, c == 2, c >= 3))
    return total, _rest(total, *seen, cut)


def _used(c: np.ndarray, cut: tuple[float, float, float]) -> np.ndarray:
    """Counts without their discounts."""
    return np.maximum(c - np.array([0.0, *cut])[np.minimum(c, 3)], 0.0)


def _shard_gains(often, model):
    """Trigrams and what is told of their words -> (doc, gain)."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = model.value
        cut, base, total1 = facts["cut"], facts["base"], facts["total"]
        for _, words, pairs, packed in _by_shard(batches):
            u, v, w, trusted, docs = _trigrams(packed, True)
            of, first = _distinct(_keys([u, v, w]))
            c3 = np.bincount(of, trusted, len(first)).astype(np.int64)
            u, v, w = u[first], v[first], w[first]
            context, starts = _distinct(_keys([u, v]))
            total3, rest3 = (x[context] for x in _contexts(context, c3, len(starts), cut[3]))
            key = _keys([v, w])
            pair, first = _distinct(key)
            c2 = np.bincount(pair, c3 > 0, len(first)).astype(np.int64)
            v, w = v[first], w[first]
            shared = _among(often.value, v)
            c2[shared] = _found(*pairs, key[first][shared])
            context, starts = _distinct(v)
            total2, rest2 = _contexts(context, c2, len(starts), cut[2])
            shared = _among(often.value, v[starts])
            for own, told in ((total2, facts["totals"]), (rest2, facts["rests"])):
                own[shared] = _found(facts["often"], told, v[starts][shared])
            total2, rest2 = total2[context], rest2[context]
            with np.errstate(divide="ignore", invalid="ignore"):  # of what is not trusted
                p1 = _used(_found(*words, w), cut[1]) / total1 + base
                p2 = _used(c2, cut[2]) / total2 + rest2 * p1
                lower = np.where(c2 > 0, np.log(p2 / p1), np.where(total2 > 0, np.log(rest2), 0.0))
                p3 = _used(c3, cut[3]) / total3 + rest3 * p2[pair]
                gain = np.where(c3 > 0, np.log(p3 / p1[pair]), lower[pair] + np.where(total3 > 0, np.log(rest3), 0.0))
            which, different = pd.factorize(docs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(different), pa.array(np.bincount(which, gain[of], len(different)))], names=["doc", "gain"])

    return run


def gains(blocks: DataFrame, tables: Scratch) -> tuple[DataFrame, DataFrame, float]:
    """((doc, gain) of the blocks, parts to be summed; (key, value, n) of the
    trusted words; log probability of an unknown word)."""
    share = lambda df: df.sparkSession.sparkContext.broadcast
    total = blocks.agg(F.sum("tokens")).first()[0] or 0
    passes = min(PASSES, -(-total // SHARD_TOKENS) or 1)
    shards = passes * (-(-total // (passes * SHARD_TOKENS)) or 1)
    common = blocks.mapInArrow(_common_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    often = [r[0] for r in common.filter(F.col("n") > WORD_SHARDS * SHARD_TOKENS).select("word").collect()] if shards > 1 else []
    often = share(blocks)(np.sort(np.array(often, np.int64).view(np.uint64)))
    rows = "shard int, kind int, key long, n long, grams binary"

    def dealt(turn: int, scored: bool) -> DataFrame:
        return blocks.mapInArrow(_gram_rows(often, shards, passes, turn, scored), rows)

    def met(df: DataFrame) -> DataFrame:
        return df.repartition("shard").sortWithinPartitions("shard", "kind")

    for turn in range(passes):
        counted = tables.put(met(dealt(turn, False)).mapInArrow(
            _shard_counts(often), "kind int, shard int, v long, w long, n long"), "counted")
    words, pairs = counted.filter(F.col("kind") == _WORD), counted.filter(F.col("kind") == _PAIR)
    pairs2 = tables.put(pairs.groupBy("v", "w").agg(F.sum("n").alias("n")).filter("n > 0"), "pairs")
    words1 = words.select("w", "n").union(pairs2.select("w", F.lit(1).cast("long")))
    words1 = tables.put(words1.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 0"), "words")
    seen = {(r["order"], r["k"]): r["n"] for r in counted.filter("kind = 0").groupBy(
        F.col("shard").alias("order"), F.col("v").alias("k")).agg(F.sum("n").alias("n")).collect()}
    cut = {1: discounts(*_seen(words1)),
           2: discounts(*[a + seen.get((2, k), 0) for k, a in enumerate(_seen(pairs2), 1)]),
           3: discounts(*[seen.get((3, k), 0) for k in (1, 2, 3, 4)])}
    letters = words1.count() + 1  # and the unknown one
    total1, *once = (x or 0 for x in words1.agg(*_sums()).first())
    rest = _rest(total1, *once, cut[1])
    base = rest / letters
    unknown = math.log(base) if base else -math.log(letters)
    stats = pairs2.groupBy("v").agg(*_sums()).toPandas()
    stats = stats.assign(v=stats["v"].to_numpy(np.int64).view(np.uint64)).sort_values("v")
    totals = stats["total"].to_numpy(np.float64)
    rests = _rest(totals, *(stats[c].to_numpy(np.float64) for c in ("n1", "n2", "n3")), cut[2])
    model = share(blocks)({"cut": cut, "base": base, "total": max(total1, 1), "often": stats["v"].to_numpy(), "totals": totals, "rests": rests})
    told = tables.put(words.select("shard", "w").join(words1, "w").select(
        "shard", F.lit(_WORD).alias("kind"), F.col("w").alias("key"), "n"), "told")
    told = tables.put(pairs.select("shard", "v", "w").join(pairs2, ["v", "w"]).select(
        "shard", F.lit(_PAIR).alias("kind"), F.xxhash64("v", "w").alias("key"), "n"), "told")
    tables.drop("counted")
    tables.drop("pairs")
    for turn in range(passes):
        own = told.filter(F.col("shard") % passes == turn).withColumn("grams", F.lit(None).cast("binary"))
        parts = met(dealt(turn, True).union(own)).mapInArrow(_shard_gains(often, model), "doc long, gain double")
        found = tables.put(parts.groupBy("doc").agg(F.sum("gain").alias("gain")), "gains")
    tables.drop("told")
    value = F.log(F.greatest(F.col("n") - F.when(F.col("n") == 1, cut[1][0]).when(F.col("n") == 2, cut[1][1]).otherwise(cut[1][2]),
                             F.lit(0.0)) / max(total1, 1) / (base or 1.0) + 1)
    return found, words1.select(F.xxhash64("w").alias("key"), value.alias("value"), "n"), unknown


# -------------------------------------------------------------------- scoring
def _step():
    """Step of an n-gram's count: eight per doubling."""
    return F.floor(8 * F.log2("n"))


def _frequent(table: DataFrame) -> int:
    """The least step of counts so that at most SHARD_GRAMS n-grams reach it."""
    steps = table.groupBy(_step().alias("step")).agg(F.count("*").alias("grams")).orderBy(F.desc("step")).collect()
    total, least = 0, 8 * 64
    for step, grams in steps:
        total += grams
        if total > SHARD_GRAMS:
            break
        least = step
    return least


def _filter(keys: DataFrame) -> np.ndarray:
    """Bits of the keys, FILTER_BITS of them whatever the number of keys."""
    place = F.pmod(F.col("key"), F.lit(FILTER_BITS))
    rows = keys.select(F.floor(place / 64).alias("word"), (place % 64).alias("bit")).groupBy("word").agg(
        F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return bits


def _lookups(model, unknown: float):
    """Blocks -> (key, doc, n, logp): per row of the input one with its tokens
    as n and the log probability without the values still to be joined, and
    (word, doc, count, null) for these."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs, bits = model.value
        for docs, _, sizes, words, codes in _blocks(batches):
            of, place = _places(sizes)
            tokens = sizes - (ORDER - 1)
            at = np.flatnonzero(place >= ORDER - 1)
            which, found = codes[at], _keys([words])
            logp = tokens * unknown + np.bincount(of[at], _found(keys, logs, found)[which], len(docs))
            own = found.view(np.int64)
            spot = own % FILTER_BITS
            some = (~_among(keys, found) & ((bits[spot >> 6] >> (spot & 63)) & 1 == 1))[which]
            pair, n = np.unique(of[at][some] * len(found) + which[some], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[docs, own[pair % len(found)]]), pa.array(np.r_[docs, docs[pair // len(found)]]),
                 pa.array(np.r_[tokens, n.astype(np.int64)]),
                 pa.concat_arrays([pa.array(logp), pa.nulls(len(pair), pa.float64())])], names=["key", "doc", "n", "logp"])

    return run


def entropies(blocks: DataFrame, parts: DataFrame, table: DataFrame, unknown: float) -> DataFrame:
    """(doc, tokens, entropy) of the blocks, from their gains and the values of
    the words; rows of the same doc count as copies of one."""
    least = _frequent(table)
    hot = table.filter(_step() >= least).select("key", "value").toArrow()
    keys = hot.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    cold = table.filter(_step() < least).select("key", "value")
    model = blocks.sparkSession.sparkContext.broadcast((keys[order], hot.column(1).to_numpy()[order], _filter(cold)))
    found = blocks.mapInArrow(_lookups(model, unknown), "key long, doc long, n long, logp double")
    joined = found.join(cold.hint("shuffle_hash"), "key", "left")
    first = F.col("logp").isNotNull()
    rows = joined.select("doc", F.when(first, F.col("n")).alias("tokens"), F.when(first, F.col("logp")).otherwise(
        F.coalesce(F.col("value"), F.lit(0.0)) * F.col("n")).alias("logp"))
    sums = rows.union(parts.select("doc", F.lit(None).cast("long"), "gain")).groupBy("doc").agg(
        F.sum("tokens").alias("tokens"), F.count("tokens").alias("copies"), F.sum("logp").alias("logp"))
    return sums.select("doc", (F.col("tokens") / F.col("copies")).cast("long").alias("tokens"),
                       (-F.col("logp") / F.col("tokens")).alias("entropy"))


def perplexities(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, perplexity, threshold, kept."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()
    held_back = F.pmod(F.xxhash64("trusted_id"), F.lit(10)) == 0
    taught = good.filter(~held_back)
    doc = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")), F.col(lang_col)).alias("doc")
    with scratch(docs.sparkSession, "kneser_ney") as tables:
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), doc, F.col(text_col).alias("text"))
        for turn in range(PASSES):  # so that the shuffle holds a part of the texts at a time
            part = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(PASSES)) == turn)
            marked = part.join(taught.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left")
            marked = marked.select("doc", F.col("trusted_id").isNotNull().alias("trusted"), "text")
            blocks = tables.put(marked.mapInArrow(_coded, "tokens long, block binary"), "blocks")
        sums = cut_lineage(entropies(blocks, *gains(blocks, tables)))
    facts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), doc)
    scored = facts.join(sums, "doc").select("doc_id", "lang", "tokens", "entropy")
    step = F.ceil(F.col("entropy") * QUANTILE_STEPS)
    judged = scored.join(good.filter(held_back), F.col("doc_id") == F.col("trusted_id")).filter(
        F.col("tokens") > LEAST_WORDS)
    steps = judged.groupBy("lang", step.alias("step")).agg(F.count("*").alias("n"))
    by_lang = W.partitionBy("lang")
    share = F.sum("n").over(by_lang.orderBy("step")) / F.sum("n").over(by_lang)
    limits = steps.withColumn("share", share).filter(F.col("share") >= LANGUAGE_QUANTILE).groupBy("lang").agg(
        (F.min("step") / QUANTILE_STEPS).alias("limit")).withColumnRenamed("lang", "of")
    joined = scored.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left")
    kept = F.coalesce((F.col("tokens") <= LEAST_WORDS) | (F.col("entropy") <= F.col("limit")), F.lit(True))
    return joined.select("doc_id", F.col("tokens").alias("n_tokens"), F.exp("entropy").alias("perplexity"),
                         F.exp("limit").alias("threshold"), kept.alias("kept"))
