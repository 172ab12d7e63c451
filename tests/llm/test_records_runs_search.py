"""Token files, periodic runs and reversed search: against brute force."""

import glob
import hashlib
import math
import os
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewise.llm import lexical_search, packing, periodic_runs, records
from tidewise.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- token files
def _crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c_equals_the_bitwise_form():
    rng = np.random.default_rng(1)
    messages = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (4, 8, 9, 511, 512, 513, 1024, 3000, 5)]
    assert records.crc32c(messages).tolist() == [_crc32c(m) for m in messages]
    assert records.crc32c([b"123456789"]).tolist() == [0xE3069283]
    assert records.crc32c([]).tolist() == []


def test_damaged_frames_raise():
    good = records.frames([b"some payload", b"another one"])
    assert records.payloads(good) == [b"some payload", b"another one"]
    for at in (0, 9, 14, len(good[0]) - 1):
        bad = bytearray(good[0])
        bad[at] ^= 4
        with pytest.raises(ValueError):
            records.payloads([bytes(bad), good[1]])


def _tokens(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    order = sorted(range(len(rows)), key=lambda j: (rows[j][0] is not None, rows[j][0] or 0))
    out, start = [], 0
    for j in order:
        ids = tokenizer.encode(rows[j][1] or "", add_special_tokens=False).ids + [records.END_ID]
        out.append((rows[j][0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_equals_the_tokenizer(spark, sf_small, docs):
    got = [tuple(r) for r in QUERIES["op11_length_delimited_records"](spark, sf_small).collect()]
    assert sorted(got) == _tokens([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_round_trip_of_edge_rows(edges, edge_rows, clashing, empty, spark, tmp_path):
    expected = _tokens(edge_rows)
    for frame in (edges, clashing):
        got = [tuple(r) for r in records.round_trip(frame).collect()]
        # rows of one id may swap places, which moves their starts: compare content and the gapless chain
        assert sorted(((g[0], g[2], g[3]) for g in got), key=str) == sorted(((e[0], e[2], e[3]) for e in expected), key=str)
        chain = sorted(got, key=lambda g: g[1])
        assert [g[1] for g in chain] == [0, *np.cumsum([g[2] for g in chain]).tolist()[:-1]]
        assert [g[0] is not None for g in chain] == sorted(g[0] is not None for g in chain)
        ids = [g[0] for g in chain if g[0] is not None]
        assert ids == sorted(ids)
    assert records.round_trip(empty).collect() == []


def test_shards_index_and_shuffled_reads(spark, docs, tmp_path):
    folder = f"file:{tmp_path}/tokens"
    records.write_records(docs, folder, shard_bytes=20_000)
    index = records.read_index(spark, folder).collect()
    shards = sorted(glob.glob(f"{tmp_path}/tokens/shards/*.rec"))
    assert len(shards) == len({r.shard for r in index}) > 5
    ordered = sorted(index, key=lambda r: r.start)
    assert [(r.shard, r.record) for r in ordered] == sorted((r.shard, r.record) for r in index)
    # a plain walk over the shards finds the same frames
    walked = 0
    for path in shards:
        data, at = open(path, "rb").read(), 0
        while at < len(data):
            size = 16 + int.from_bytes(data[at:at + 8], "little")
            records.payloads([data[at:at + size]])
            at, walked = at + size, walked + 1
        assert at == os.path.getsize(path)
    assert walked == len(index)
    plain = records.read_records(spark, folder, with_ids=True).collect()
    once = records.read_records(spark, folder, seed=7, with_ids=True).collect()
    again = records.read_records(spark, folder, seed=7, with_ids=True).collect()
    other = records.read_records(spark, folder, seed=8, with_ids=True).collect()
    assert sorted(plain) == sorted(once) == sorted(other)
    assert once == again != other
    assert [r.doc_id for r in once] != sorted(r.doc_id for r in once)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in plain)
    # a stray file of a lost attempt is never read; a damaged shard raises
    open(f"{tmp_path}/tokens/shards/shard-000000-999999.rec", "wb").write(b"junk")
    assert sorted(records.read_records(spark, folder, with_ids=True).collect()) == sorted(plain)
    with open(shards[0], "r+b") as f:
        f.seek(30)
        f.write(b"\xff\x00\xff")
    with pytest.raises(Exception, match="checksum"):
        records.read_records(spark, folder).collect()


def test_one_id_of_a_third_of_the_rows_is_split(spark, tmp_path):
    rows = [(7 if i % 3 == 0 else i, f"word {i} " * 30) for i in range(3000)]
    folder = f"file:{tmp_path}/hot"
    records.write_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), folder, shard_bytes=40_000)
    sizes = Counter(r.shard for r in records.read_index(spark, folder).collect())
    assert len(sizes) >= 10 and max(sizes.values()) < 900


# -------------------------------------------------------------- periodic runs
def _runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _expected(doc_id, text, rewrite=True):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if rewrite and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = _runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_equal_brute_force(spark, sf_small, docs):
    got = [tuple(r) for r in QUERIES["op12_branching_tandem_runs"](spark, sf_small).collect()]
    rows = [r for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 60_000]
    some = {r.doc_id for r in rows}
    assert sorted(g for g in got if g[0] in some) == sorted(_expected(*r) for r in rows)
    assert sum(g[1] for g in got) > 10


def test_runs_of_edge_rows(edges, edge_rows, clashing, empty):
    small = [r for r in edge_rows if r[0] != 7]
    for frame in (edges, clashing):
        out = periodic_runs.find_runs(frame, rewrite=periodic_runs.looped).drop("runs", "collapsed")
        got = [tuple(r) for r in out.collect()]
        assert len(got) == len(edge_rows)
        assert sorted((g for g in got if g[0] != 7), key=str) == sorted((_expected(r[0], r[1]) for r in small), key=str)
    assert periodic_runs.find_runs(empty).collect() == []


def test_kept_text_and_listed_runs(spark):
    rows = [(1, "a b a b a b a b c"), (2, "x x x x x"), (3, "x\n x x  x x x"), (4, "p q r " * 4 + "p z")]
    got = {r.doc_id: (r.runs, r.collapsed, r.exponent_milli) for r in
           periodic_runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("0,8,2\n", "a b c", 4000), 2: ("", "x x x x x", None), 3: ("0,6,1\n", "x", 6000),
                   4: ("0,13,3\n", "p q r z", 4333)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4), st.integers(1, 6))
def test_runs_of_random_words(texts, loop):
    texts = [t + t[:loop] * 5 for t in texts]
    column = pa.array([" ".join(f"w{x}" for x in t) for t in texts])
    got = [r[2] for r in periodic_runs._document_runs(list(range(len(texts))), column, None)]
    assert got == ["".join(f"{s},{n},{q}\n" for s, n, q in _runs(t)) for t in texts]


def test_a_long_periodic_text_takes_near_linear_time():
    import time

    def seconds(n):
        column = pa.array([" ".join(["a", "b", "a", "c"] * n)])
        at = time.process_time()
        assert [r[0] for r in periodic_runs._document_runs([0], column, None)] == [1]
        return time.process_time() - at

    seconds(1000)
    assert seconds(80_000) < 30 * max(seconds(8_000), 0.02)


# ------------------------------------------------------------ reversed search
def _ranked(rows, items, top=10):
    found = [TERM.findall((r[1] or "").translate(LOWER)) for r in rows]
    n_docs, length = sum(1 for f in found if f), sum(map(len, found))
    df = Counter(t for f in found for t in set(f))
    out = []
    for item_id, text in items:
        wanted = Counter(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for r, f in zip(rows, found):
            tf = Counter(f)
            m = 100 - 75 + (75 * len(f) * n_docs) // max(length, 1)
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                        for t, k in wanted.items() if tf[t])
            if score > 0:
                scored.append((-score, r[0] is None, r[0] or 0))
        out += [(item_id, i + 1, None if s[1] else s[2], -s[0]) for i, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def _search(docs, items, **kw):
    return sorted((tuple(r) for r in lexical_search.search(docs, items, **kw).drop("item").collect()), key=str)


ITEMS = [(1, "One TWO word text"), (2, None), (3, "..."), (4, "漢字 é x"), (None, "w5x5 w5x5 a b"), (1, "seven"), (5, "unknown")]


def test_search_equals_brute_force(spark, sf_small, docs):
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    got = sorted((tuple(r) for r in QUERIES["op13_reversed_search"](spark, sf_small).collect()), key=str)
    assert got == _ranked([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])


def test_search_on_edge_rows(spark, edges, edge_rows, clashing, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = _ranked(edge_rows, ITEMS)
    assert _search(edges, items) == expected
    assert _search(clashing, items.withColumn("doc_id", items.item_id)) == expected
    assert _search(empty, items) == [] == _search(edges, items.limit(0))
    assert _search(edges, items, top=1) == _ranked(edge_rows, ITEMS, 1)


def test_search_in_blocks_and_slices(spark, edges, edge_rows, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 2)
    assert _search(edges, items) == _ranked(edge_rows, ITEMS)
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 4)
    assert _search(edges, items) == _ranked(edge_rows, ITEMS)
    monkeypatch.setattr(lexical_search, "_SLICE", 3)
    text = "ab, Cd efgéh ij"
    assert [t.decode() for part in lexical_search.terms(text.encode()) for t in part] == TERM.findall(text.translate(LOWER))


def test_equal_scores_go_to_the_smaller_ids(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (99, "other")],
                                 "doc_id long, text string").repartition(6)
    got = _search(docs, spark.createDataFrame([(1, "words")], "item_id long, text string"))
    assert sorted(r[2] for r in got) == list(range(1, 11)) and sorted(r[1] for r in got) == list(range(1, 11))
