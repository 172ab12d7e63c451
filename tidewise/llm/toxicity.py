"""Toxicity by compression distance.

Two zstandard dictionaries are learned from labelled text: the ordinary one holds
a sample of ordinary windows, the toxic one the same windows and before them
the vocabulary that marks toxic text (words whose letter n-grams occur in far
more toxic than ordinary documents). Their content is chosen here, not by
zstandard's trainer, whose dictionaries tell the two apart less well (figures in
the README). Since both share the ordinary content and
it comes last, a window without toxic vocabulary compresses to the same length
with either; the gain of a window is the ordinary length minus the toxic one.
Windows are runs of WINDOW_WORDS words over the whole text, each between two
fixed pieces of ordinary text, so that a match at its edges is found and pays.
A logistic model over a document's gains, fitted on the same labelled
documents, calibrates the score.

Only training uses the driver, on a bounded sample of labelled documents:
at most SAMPLE_TOXIC toxic and SAMPLE_ORDINARY ordinary ones, chosen by hash of
doc_id, of at most SAMPLE_CHARS characters each, without near copies of each
other. Scoring covers every document and all of its text; the model (about
35 kB) travels with the tasks.

Edge cases: null, empty and wordless texts have no windows and get the model's
score for none; without labels of both kinds every score is the share of toxic
ones among all usable labels (0 without any) and ``reject_toxic`` keeps every
row; a null doc_id is not held out and never labelled;
repeated rows get equal scores; columns of any name pass through
``with_score``; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frees, unused, worker_cache

SAMPLE_TOXIC, SAMPLE_ORDINARY, SAMPLE_CHARS = 1500, 3500, 20_000
WINDOW_WORDS = 3
ORDINARY_BYTES = 16 << 10
EDGE_BYTES = 64
START_LETTERS = 3
GRAM_LETTERS = (4, 5, 6, 7)
GRAM_RATIO = 5.0      # toxic over ordinary document frequency
GRAM_SHARE = 0.02      # of the toxic documents, at least (and LEAST_DOCUMENTS)
LEAST_DOCUMENTS = 3
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")


def held_out(id_col: str = "doc_id") -> Column:
    """Documents whose labels are never learned."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def marked_words(text: str) -> list[str]:
    """Words in lower case with their first START_LETTERS in capitals, so that
    a word's start matches word starts only, not the same letters inside one."""
    return [w[:START_LETTERS].upper() + w[START_LETTERS:] for w in _WORD.findall(text.lower())]


def windows(text: str, words: int = WINDOW_WORDS) -> list[bytes]:
    w = marked_words(text)
    return [" ".join(w[i:i + words]).encode() for i in range(0, len(w), words)]


def gain_features(g: np.ndarray) -> list[float]:
    """Largest gain, mean of the three largest, shares and logs of the numbers
    of windows by gain."""
    n = len(g)
    if not n:
        return [0.0] * 10
    top = np.sort(g)[-3:]
    least = [int((g >= c).sum()) for c in (2, 3, 4, 5, 6)]
    return [float(top[-1]), float(top.mean()), least[1] / n, least[2] / n, float(np.log(n)),
            *(float(np.log1p(c)) for c in least)]


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    before: bytes = b""
    after: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    share: float = 0.0

    def compressors(self):
        import zstandard as z

        params = z.ZstdCompressionParameters(
            strategy=z.STRATEGY_GREEDY, min_match=5, window_log=18, hash_log=16, chain_log=16, search_log=6,
            write_content_size=0, write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
        return [z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT),
                                 compression_params=params) for d in (self.ordinary, self.toxic)]

    def gains(self, compressors, parts: list[bytes]) -> np.ndarray:
        if not parts:
            return np.zeros(0, np.int64)
        padded = [self.before + p + self.after for p in parts]
        lengths = []
        for c in compressors:
            found = c.multi_compress_to_buffer(padded, threads=0)
            lengths.append(np.fromiter((len(found[i]) for i in range(len(parts))), np.int64, len(parts)))
        return lengths[0] - lengths[1]

    def calibrated(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.centre) / self.scale, -50, 50)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + z @ self.weights[1:], -30, 30)))

    def scores(self, texts: list[str | None], compressors) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), self.share)
        return self.calibrated(np.array([gain_features(self.gains(compressors, windows(t or ""))) for t in texts]))


# ------------------------------------------------------------------- training
def _without_near_copies(texts: list[str]) -> list[str]:
    """Keeps a text unless it shares 30 % of its 3-word runs (long texts: of a
    quarter of them, by a hash that every process computes alike) with kept ones."""
    seen: set[int] = set()
    out = []
    for t in texts:
        w = _WORD.findall(t.lower())
        runs = {crc32(" ".join(w[i:i + 3]).encode()) for i in range(max(1, len(w) - 2))}
        if len(w) > 40:
            runs = {h for h in runs if not h & 3}
        if len(runs & seen) <= 0.3 * len(runs):
            out.append(t)
            seen |= runs
    return out


def _grams(words: set[str]) -> set[str]:
    return {w[i:i + n] for w in words for n in GRAM_LETTERS for i in range(len(w) - n + 1)}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept is free."""
    x = np.c_[np.ones(len(x)), x]
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty),
                               x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[str], ordinary: list[str], share: float | None = None) -> Model:
    """A model from labelled texts; ``share`` of toxic labels (default: of the
    texts) is the score where they teach nothing."""
    both = len(toxic) + len(ordinary)
    model = Model(share=share if share is not None else len(toxic) / both if both else 0.0)
    toxic, ordinary = _without_near_copies(toxic), _without_near_copies(ordinary)
    if not toxic or not ordinary:
        return model
    in_toxic, in_ordinary, ordinary_words = Counter(), Counter(), set()
    for t in toxic:
        in_toxic.update(_grams(set(marked_words(t))))
    for t in ordinary:
        own = set(marked_words(t))
        in_ordinary.update(g for g in _grams(own) if g in in_toxic)
        ordinary_words |= own
    least = max(LEAST_DOCUMENTS, round(GRAM_SHARE * len(toxic)))
    marks = {g for g, n in in_toxic.items() if n >= least
             and n / len(toxic) >= GRAM_RATIO * (in_ordinary[g] + 0.5) / len(ordinary)}
    words = Counter(w for t in toxic for w in marked_words(t) if not marks.isdisjoint(_grams({w})))
    least = max(2, round(0.6 * least))
    telling = [w for w, n in words.most_common() if n >= least and w not in ordinary_words]
    common = [p for t in ordinary for p in windows(t, 8)]
    random.Random(1).shuffle(common)
    base = b" ".join(common)[:ORDINARY_BYTES]
    content = b" " + b" ".join(w.encode() for w in reversed(telling)) + b" "
    model.toxic, model.ordinary = content + base, base[:len(content)] + base
    model.before, model.after = base[-EDGE_BYTES:] + b" ", b" " + base[EDGE_BYTES:2 * EDGE_BYTES]
    if len(model.ordinary) < 8 or not telling:
        return model
    compressors = model.compressors()
    x = np.array([gain_features(model.gains(compressors, windows(t))) for t in toxic + ordinary])
    model.centre, model.scale = x.mean(0), x.std(0) + 1e-9
    model.weights = _logistic((x - model.centre) / model.scale, np.r_[np.ones(len(toxic)), np.zeros(len(ordinary))])
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on labelled rows of ``docs`` that are not held out."""
    usable = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out()).select("doc_id", "toxic")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = usable.filter("toxic = 1").orderBy(order).limit(SAMPLE_TOXIC).union(
        usable.filter("toxic = 0").orderBy(order).limit(SAMPLE_ORDINARY))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.filter(F.length("text") <= SAMPLE_CHARS)
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "toxic", "text").collect()
    rows.sort(key=lambda r: r[0])
    share = usable.agg(F.avg("toxic")).first()[0] or 0.0
    return train([r[2] for r in rows if r[1] == 1], [r[2] for r in rows if r[1] == 0], share)


# -------------------------------------------------------------------- scoring
def _score(model: Model, at: int, schema: pa.Schema):
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity")
        compressors = model.compressors() if len(model.weights) else None
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                score = model.scores(part.column(at).to_pylist(), compressors)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], schema=schema)

    return run


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score as a last column."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if name in docs.columns:
        raise ValueError(f"docs already has a column {name}")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(_score(model, docs.columns.index(text_col), to_arrow_schema(schema)), schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit(docs, labels)
    out = with_score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold; all rows where
    the labels teach no difference (a model without weights)."""
    model = fit(docs, labels, text_col=text_col)
    if not len(model.weights):
        return docs
    name = unused(docs, "score")
    return with_score(docs, model, text_col, name).filter(F.col(name) < THRESHOLD).drop(name)
