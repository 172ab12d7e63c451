"""Information-theoretic sanitisation of personal data.

Base spans (email, ip, card, phone) are found by pattern and checked. Beyond
them, words around such entities may reveal them: the corpus tells how
strongly. For an entity e (a value of one kind) and a term t,

    PMI(e; t) = log2(n(e, t) * N / (n(e) * n(t)))     IC(e) = log2(N / n(e))

where n(e) counts the distinct contexts of the entity, n(e, t) those that hold
the term, n(t) the distinct texts with the term and N all distinct texts. All
places of an entity in one text (CONTEXT_WORDS words on each side of each) make
one context, so a word between two mentions meets the entity once, and copies of
a document count once everywhere. A term whose PMI is at least DISCLOSURE of
IC(e), the share of the entity's information that the term gives away, is a
disclosing term if they are not together by chance: of all pairs of an entity
and a term at most CHANCE_PAIRS may be expected to meet so often. The bound is
that of Hoeffding for n(e, t) of n(e) draws at a rate of n(t) / N; it asks for
no number of contexts, so an entity seen twice has disclosing terms in all but
small corpora, and one seen once where the corpus has few entities. The term is
marked wherever it occurs outside base spans, also in documents without the
entity, and ``sanitise`` generalises it.

Jobs: (1) contexts of entities, counted by (entity, term); (2) counts of all
terms over distinct texts, merged in the map tasks before the shuffle, joined to
(1); only texts with copies are shuffled, once per map task; (3) a scan that finds base spans and, through a bit filter whose size does not depend
on the data, possible occurrences of disclosing terms, which an exact join confirms.

Edge cases: a null text counts as empty and has no spans; positions are code
points of the whole text; a term that overlaps a base span is not marked there;
null and repeated doc_ids are separate rows; other columns of any name pass
through ``sanitise``; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.session import cut_lineage

from .common import SPACE_BYTES, bit_filter, byte_views, may_hold, rows_with, signed, unused, words_at

CONTEXT_WORDS = 5
CHANCE_PAIRS = 0.05
DISCLOSURE = 0.75
FLUSH_TERMS = 1 << 21
LEAST_BYTES = 3          # of a term

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in order."""
    found = []
    if "@" in text:
        found += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k] if k < len(KINDS) else 'term'}:{a}:{b}" for a, k, b in spans)


# ---------------------------------------------------------------------- terms
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = SPACE_BYTES[0]
_LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


def terms_at(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after the last) of the terms of a text: runs of
    letters and digits, ASCII lower-cased, of LEAST_BYTES bytes, that start
    with a letter."""
    folded = _FOLD[data]
    h, a, b = words_at(folded, lower=False)
    good = (b - a >= LEAST_BYTES) & _LETTER[folded[np.minimum(a, max(len(folded) - 1, 0))]] if len(h) else np.zeros(0, bool)
    return h[good], a[good], b[good]


def _hash_text(kind: int, value: str) -> int:
    raw = hashlib.blake2b(f"{kind}:{value.lower()}".encode(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


_AROUND = re.compile(r"\S+")


def contexts(text: str, spans: list[tuple[int, int, int]]) -> Iterator[str]:
    """The CONTEXT_WORDS words before and after each span, however long."""
    words = [m.span() for m in _AROUND.finditer(text)] if spans else []
    starts, ends = [a for a, _ in words], [b for _, b in words]
    for a, _, b in spans:
        i, j = bisect.bisect_left(starts, a), bisect.bisect_right(ends, b)
        before = [text[x:min(y, a)] for x, y in words[max(0, i - CONTEXT_WORDS):i]]
        after = [text[max(x, b):y] for x, y in words[j:j + CONTEXT_WORDS]]
        yield " ".join(before + after)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> (entity, term, context); a null term is the entity itself. A text
    gives one context per entity."""
    for batch in batches:
        entity, term, context = [], [], []
        for text in batch.column(0):
            text = text.as_py() or ""
            spans = base_spans(text)
            places: dict[int, list[str]] = {}
            for (a, kind, b), around in zip(spans, contexts(text, spans)):
                places.setdefault(_hash_text(kind, text[a:b]), []).append(around)
            for e, parts in places.items():
                around = "\n".join(parts)
                h = np.unique(terms_at(np.frombuffer(around.encode(), np.uint8))[0])
                terms = [None, *signed(h).tolist()]
                entity += [e] * len(terms)
                context += [_hash_text(9, around)] * len(terms)
                term += terms
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (entity, term, context)],
                                         names=["entity", "term", "context"])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> (term, texts with it), merged within the task."""
    held, size = [], 0

    def flush():
        terms, counts = np.unique(np.concatenate(held), return_counts=True)
        for at in range(0, len(terms), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(terms[at:at + (1 << 16)])), pa.array(counts[at:at + (1 << 16)].astype(np.int64))],
                names=["term", "documents"])

    for batch in batches:
        for data in byte_views(batch.column(0)):
            h = np.unique(terms_at(data)[0])
            if len(h):
                held.append(h)
                size += len(h)
            if size > FLUSH_TERMS:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, text) -> the first row of each hash in this task."""
    seen: set[int] = set()
    for batch in batches:
        new = []
        for h in batch.column(0).to_pylist():
            new.append(h not in seen)
            seen.add(h)
        yield batch.filter(pa.array(new, pa.bool_()))


def distinct_texts(texts: DataFrame) -> tuple[DataFrame, int]:
    """(each different value of the column text once, their number). Texts are
    told apart by 64-bit hashes; those without copies are not shuffled."""
    hashed = texts.select(F.xxhash64("text").alias("hash"), "text")
    groups = cut_lineage(hashed.groupBy("hash").agg(F.count("*").alias("copies")))
    copied = groups.filter("copies > 1").select("hash")
    firsts = hashed.mapInArrow(_first_of_task, hashed.schema)
    single = rows_with(firsts, "hash", copied, "left_anti").select("text")
    merged = rows_with(firsts, "hash", copied).dropDuplicates(["hash"]).select("text")
    return single.union(merged), groups.count()


def disclosing_terms(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, entity, disclosure): terms that give away an entity, each with
    the one it gives away most of."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    seen = cut_lineage(texts.mapInArrow(_contexts, "entity long, term long, context long").distinct())
    different, total = distinct_texts(texts)
    entities = seen.filter("term is null").groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = cut_lineage(seen.filter("term is not null").groupBy("entity", "term").agg(F.count("*").alias("n_et")))
    tests = pairs.count()
    pairs = pairs.join(entities, "entity")
    counts = different.mapInArrow(_term_counts, "term long, documents long").groupBy("term").agg(
        F.sum("documents").alias("n_t"))
    n = F.lit(float(max(total, 1)))
    pmi = F.log2(F.col("n_et") * n / (F.col("n_e") * F.col("n_t")))
    known = F.greatest(F.log2(n / F.col("n_e")), F.lit(1e-9))
    # bits by which the meetings are improbable: n_e times the divergence of their rate from the term's
    rate, chance = F.col("n_et") / F.col("n_e"), F.col("n_t") / n
    without = F.when(F.col("n_e") > F.col("n_et"), (F.col("n_e") - F.col("n_et")) * F.log2(
        (1 - rate) / F.greatest(1 - chance, F.lit(1e-12)))).otherwise(0.0)
    bits = F.col("n_et") * F.log2(rate / chance) + without
    strong = pairs.join(counts, "term").withColumn("disclosure", pmi / known).filter(
        (F.col("disclosure") >= DISCLOSURE) & (bits >= F.log2(F.lit(max(tests, 1) / CHANCE_PAIRS))))
    return cut_lineage(strong.groupBy("term").agg(
        F.max_by("entity", F.struct("disclosure", "entity")).alias("entity"), F.max("disclosure").alias("disclosure")))


def _scan(bits):
    """(id, text) -> id, counts by kind, base spans, possible terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                counts, spans, hits = np.zeros((4, len(batch)), np.int64), [], []
                for i, data in enumerate(byte_views(batch.column(1))):
                    text = data.tobytes().decode()
                    found = base_spans(text)
                    for _, kind, _ in found:
                        counts[kind, i] += 1
                    spans.append(spans_text(found))
                    h, a, b = terms_at(data)
                    some = may_hold(bits.value, signed(h))
                    own = []
                    for k in np.flatnonzero(some).tolist():
                        start = len(data[:a[k]].tobytes().decode())
                        end = start + len(data[a[k]:b[k]].tobytes().decode())
                        if not any(x < end and start < y for x, _, y in found):
                            own.append({"term": int(h[k].view(np.int64)), "start": start, "stop": end})
                    hits.append(own)
                base = [hashlib.sha256(s.encode()).hexdigest() for s in spans]
                hit = pa.array(hits, pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c) for c in counts], pa.array(base), pa.array(spans), hit],
                    names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "hits"])

    return run


def _join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """base spans and confirmed terms -> all spans, in order."""
    for batch in batches:
        out = []
        for base, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            spans = [(int(a), KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
            out.append(spans_text(sorted(spans + [(t["start"], len(KINDS), t["stop"]) for t in terms])))
        yield pa.RecordBatch.from_arrays([pa.array(out), *batch.columns[2:]], names=["spans", *batch.schema.names[2:]])


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans (kind:start:end by start, comma-joined)."""
    terms = disclosing_terms(docs, text_col)
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(terms.select("term")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
              "hits array<struct<term: long, start: long, stop: long>>")
    found = rows.mapInArrow(_scan(bits), schema).withColumn("uid", F.monotonically_increasing_id())
    found = cut_lineage(found)
    hits = found.filter("size(hits) > 0").select("uid", F.explode("hits").alias("hit"))
    hits = hits.withColumn("term", F.col("hit.term")).join(terms.select("term"), "term", "left_semi")
    confirmed = hits.groupBy("uid").agg(F.collect_list("hit").alias("terms"))
    joined = found.drop("hits").join(confirmed, "uid", "left")
    plain = joined.filter("terms is null").select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
                                                  F.col("base").alias("spans"))
    out = joined.filter("terms is not null").select("base", "terms", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256")
    merged = out.mapInArrow(_join_spans, "spans string, doc_id long, n_email long, n_ip long, n_card long, "
                                         "n_phone long, base_sha256 string")
    return plain.unionByName(merged)


def sanitised(text: str | None, spans: str) -> str | None:
    """The text with every span replaced by its kind; of overlapping spans the
    one that starts first counts, and covers both."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for s in spans.split(","):
        kind, a, b = s.split(":")
        a, b = int(a), int(b)
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _sanitise(text_at: int, spans_at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [sanitised(t, s) for t, s in zip(batch.column(text_at).to_pylist(), batch.column(spans_at).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if i == text_at else batch.column(i)
                 for i in range(batch.num_columns) if i != spans_at], schema=schema)

    return run


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (unique ids) with base spans and disclosing terms generalised
    to their kind."""
    from pyspark.sql.pandas.types import to_arrow_schema

    own, name = unused(docs, "of"), unused(docs, "spans")
    spans = find_spans(docs, id_col, text_col).select(F.col("doc_id").alias(own), F.col("spans").alias(name))
    joined = docs.join(spans, F.col(id_col).cast("long").eqNullSafe(F.col(own))).drop(own)
    schema = T.StructType(docs.schema.fields)
    at = docs.columns.index(text_col)
    return joined.mapInArrow(_sanitise(at, len(docs.columns), to_arrow_schema(schema)), schema)
