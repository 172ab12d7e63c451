"""Source mixing and sequence packing: against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidewise.llm import mixing, packing
from tidewise.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(words, weights=(5, 2, 1), repeats=3):
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(words.values()), set()
    while True:
        rest, free = total - sum(repeats * words[s] for s in capped), sum(w[s] for s in order if s not in capped)
        above = {s for s in order if s in capped or w[s] * rest > repeats * words[s] * free}
        if above == capped:
            break
        capped = above
    return {s: float(repeats * words[s]) if s in capped else w[s] * rest / (free or 1) for s in order}


def _mix(rows):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    words = defaultdict(int)
    for r, n in zip(rows, size):
        words[r[3]] += n
    target = _targets(words)
    out, served = [], defaultdict(int)
    key = lambda j: (hashlib.md5(("" if rows[j][0] is None else str(rows[j][0])).encode()).hexdigest(),
                     rows[j][0] is not None, rows[j][0] or 0, size[j])
    for j in sorted(range(len(rows)), key=key):
        s = rows[j][3]
        served[s] += size[j]
        copies = sum(2 * (served[s] + c * words[s]) - size[j] <= 2 * target[s] for c in range(3)) if size[j] and target[s] else 0
        out.append((rows[j][0], size[j], words[s], round(target[s], 6), size[j] * copies))
    return sorted(out, key=str)


def _got(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


def test_plan_equals_brute_force(docs):
    assert _got(mixing.plan(docs)) == _mix([tuple(r) for r in docs.collect()])


def test_plan_on_edge_rows(edges, edge_rows, empty):
    assert _got(mixing.plan(edges)) == _mix(edge_rows)
    assert mixing.plan(empty).collect() == []


def test_targets_are_met_capped_and_shared(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "big" if i % 3 else ("tiny" if i % 60 else None), 0) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = mixing.plan(df).collect()
    by = defaultdict(list)
    for r, src in ((r, rows[r.doc_id][3]) for r in got):
        by[src].append(r)
    assert abs(sum(v[0].target for v in by.values()) - sum(r["size"] for r in got)) < 1e-6
    for v in by.values():
        assert v[0].target <= 3 * v[0].source_size
        assert abs(sum(r.taken for r in v) - v[0].target) <= 9
        assert all(r.taken <= 3 * r["size"] for r in v)
    again = mixing.plan(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_repeats_rows_and_keeps_columns(clashing, edge_rows):
    out = mixing.mix(clashing)
    assert out.columns == clashing.columns
    taken = defaultdict(int)
    for r in _mix(edge_rows):
        if r[1]:
            taken[r[0], r[1]] += r[4] // r[1]
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, len(WORD.findall(r.text))] += 1
    assert {k: v for k, v in taken.items() if v} == dict(got)


# ------------------------------------------------------------------------ packing
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary())


ODD = ["", " ", "İstanbul İ. ΣΑΣ. ΑΣ ΣΑΣ,", "a<|endoftext|>b <|startoftext|>", "don't I'll 've's x's", "é é́ ́a Å",
       "a b\x1cc\x85d e", "１２ ² ½ x2y3 __a_b", "ﬁ ǅ ß ẞ ª ʰ", "日本語 テキスト。 한국어", "😀👍🏽 a😀b", "word.&amp; $$$ ###",
       "\t\ttabs\r\nnew", "x" * 5000, "naïve,naïve NAÏVE…", "K Å Ω"]


def test_ids_equal_the_vocabularys_own(docs, tokenizer):
    texts = ODD + [r.text for r in docs.select("text").collect()]
    encoder = packing.WordEncoder(packing.default_vocabulary())
    for text, ids in zip(texts, encoder.encode(pa.array(texts))):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_small_caches_change_nothing(docs, monkeypatch):
    texts = pa.array([r.text for r in docs.select("text").limit(40).collect()] + ["", None, " \n"])

    def encoded(small=False):
        return [ids.tolist() for ids in packing.WordEncoder(packing.default_vocabulary(), small).encode(texts)]

    want = encoded()
    assert encoded(small=True) == want
    monkeypatch.setattr(packing, "CACHE_BYTES", 1000)
    assert encoded() == want
    monkeypatch.setattr(packing, "SLICE_BYTES", 100)   # long texts in slices
    assert encoded() == want


def _check_packing(rows, texts, tokenizer, spare):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for seq in bins.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at and 1 <= r.length <= 4096
            at += r.length
        assert at <= 4096
    for doc, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted(pieces[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 4096)))
        for r in own:
            cut = ids[r.start:r.start + r.length]
            assert r.start == 4096 * r.piece and len(cut) == r.length and zlib.crc32(cut.tobytes()) == r.ids_crc32
        assert sum(r.length for r in own) == len(ids)
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) + spare


def test_packing_is_whole_gapless_and_tight(spark, sf_small, docs, tokenizer):
    rows = QUERIES["op4_best_fit_packing"](spark, sf_small).collect()
    _check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer, 2)


def test_packing_of_edge_rows(edges, edge_rows, empty, tokenizer):
    unique = {i: t for i, t, *_ in edge_rows if i not in (None, 1, 9)}
    rows = packing.pack_documents(edges).collect()
    _check_packing([r for r in rows], {}, tokenizer, 2)
    only = packing.pack_documents(edges.filter("doc_id not in (1, 9)")).collect()
    _check_packing(only, unique, tokenizer, 2)
    assert packing.pack_documents(empty).collect() == []


def test_bounded_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(5) == (1, 0)
    assert bins.place(7) == (2, 0)            # opens a third: bin 0 (4 free), the fullest, closes
    assert bins.place(4) == (1, 5) and bins.place(3) == (2, 7)
    assert bins.place(2) == (3, 0)            # bin 2 is full and gone


def test_groups_are_packed_on_their_own(spark):
    r = np.random.default_rng(1)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(r.integers(1, 4097, 2000))]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(5)
    for group, open_bins, spare in ((200, 64, 0.2), (5000, 16384, 0.01)):
        out = packing.pack(df, open_bins=open_bins, group_pieces=group).collect()
        used = defaultdict(int)
        for x in out:
            used[x.sequence_id] += x.length
        assert max(used.values()) <= 4096 and len(out) == 2000
        big = sum(n > 2048 for *_, n, _ in rows)
        assert len(used) <= max(big, -(-sum(x.length for x in out) // 4096)) * (1 + spare) + 3
    again = {(x.doc_id, x.sequence_id, x.offset) for x in packing.pack(df.repartition(3)).collect()}
    assert again == {(x.doc_id, x.sequence_id, x.offset) for x in packing.pack(df).collect()}
