"""Exact dedup, near dedup, sentence spans: against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from tidewise.llm import common, exact_dedup, ngram_join, sentence_spans
from tidewise.llm.queries import QUERIES
from tidewise.session import scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ----------------------------------------------------------------- exact dedup
def _copies(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            out.append((i, keep, len(ids), kept, digest))
    return sorted(out, key=str)


def test_duplicate_map_equals_brute_force(edges, edge_rows):
    got = [tuple(r) for r in exact_dedup.duplicate_map(edges).collect()]
    assert sorted(got, key=str) == _copies(edge_rows)


@pytest.mark.parametrize("bucket_bytes", [200, 5000, 1 << 25])
def test_grace_recursion_gives_the_same_groups(edges, edge_rows, bucket_bytes):
    got = exact_dedup.merge_copies(edges.select("doc_id", "text"), bucket_bytes=bucket_bytes)
    want = {(t, k, n) for t, k, n in {(r[1] or "", None, None) for r in edge_rows}}
    rows = got.collect()
    assert {r.content for r in rows} == {w[0] for w in want} and len(rows) == len(want)
    assert sum(r.n for r in rows) == len(edge_rows)


def test_deduplicate_keeps_columns_and_one_row_of_each_text(clashing, edge_rows):
    got = exact_dedup.deduplicate(clashing)
    assert got.columns == clashing.columns
    rows = got.collect()
    assert sorted(r.text or "" for r in rows) == sorted({t or "" for _, t, *_ in edge_rows})
    assert {r.doc_id for r in rows if r.text == edge_rows[0][1]} == {2}


def test_hot_copies_are_one_record_per_map_task(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 > 0, 'hot text', concat('t', id)) as text").repartition(4)
    rows = exact_dedup.duplicate_map(df).collect()
    assert len(rows) == 3000 and sum(r.kept for r in rows) == 1001
    assert {r.group_size for r in rows} == {1, 2000} and {r.keep_id for r in rows if r.group_size > 1} == {2999}


# ------------------------------------------------------------------- near dedup
def _components(rows, k, percent):
    lower = {c: c + 32 for c in range(65, 91)}
    sets = []
    for i, t, *_ in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted((j for j in range(len(rows)) if sets[j]), key=lambda j: len(sets[j]))
    for n, a in enumerate(order):
        for b in order[n + 1:]:
            if percent * len(sets[b]) > 100 * len(sets[a]):
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for j, r in enumerate(rows):
        least[find(j)].append(r[0])
    return sorted(((r[0], len(sets[j]), min((i for i in least[find(j)] if i is not None), default=None) if sets[j] else r[0])
                   for j, r in enumerate(rows)), key=str)


def _edited(rows, copies, seed=3):
    r, out, new = random.Random(seed), list(rows), 10**6
    for _, t, *_ in rows[:8]:
        w = t.split(" ")
        for _ in range(copies):
            v = list(w)
            for _ in range(r.randint(0, max(1, len(v) // 50))):
                v[r.randrange(len(v))] = f"zz{r.randint(0, 5)}"
            out.append((new, " ".join(v)))
            new += 1
    return out


@pytest.mark.parametrize("k, percent, chunk", [(3, 90, 1 << 20), (5, 80, 2000)])
def test_components_equal_brute_force(spark, docs, k, percent, chunk):
    rows = _edited([tuple(r) for r in docs.select("doc_id", "text").limit(120).collect()], 30)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.near_components(df, k, percent, chunk_shingles=chunk).collect()
    assert sorted(map(tuple, got), key=str) == _components(rows, k, percent)


def test_components_on_edge_rows(edges, edge_rows, empty, clashing):
    got = ngram_join.near_components(edges, 3, 90).collect()
    assert sorted(map(tuple, got), key=str) == _components(edge_rows, 3, 90)
    assert ngram_join.near_components(empty, 3, 90).collect() == []
    kept = ngram_join.keep_one(clashing)
    assert kept.columns == clashing.columns and 2 not in {r.doc_id for r in kept.collect()}


def test_links_through_null_and_repeated_ids(spark):
    base = [f"w{i}" for i in range(40)]
    a, b, c = base, [*base[:37], "x1", "x2", "x3"], [*base[:34], "y1", "y2", "y3", "x1", "x2", "x3"]
    unlike = " ".join(f"u{i}" for i in range(30))
    text = lambda w: " ".join(w)
    rows = [(1, text(a)), (None, text(b)), (None, text(b)), (2, text(c)), (7, unlike), (7, text(a) + " tail"), (None, None)]
    assert {r for r in _components(rows, 3, 70)} >= {(2, 38, 1), (None, 38, 1)}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.near_components(df, 3, 70).collect()
    assert sorted(map(tuple, got), key=str) == _components(rows, 3, 70)


def test_one_row_of_each_group_stays(spark):
    words = lambda p, n=60: " ".join(f"{p}{i}" for i in range(n))
    a, u, v = words("a"), words("u"), words("v")
    near = lambda t: t + " end"
    rows = [(1, a, 0), (2, near(a), 1), (2, u, 2), (3, near(u), 3),        # one id, two texts
            (None, v, 4), (None, near(v), 5), (None, v, 4), (None, v, 6),   # no id at all, equal rows
            (5, words("z"), 7), (5, words("z"), 7), (5, near(words("z")), 8),
            (6, "", 9), (6, "", 9), (None, None, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_key int").repartition(3)
    kept = ngram_join.keep_one(df, 5, 80)
    assert kept.columns == df.columns
    got = sorted((tuple(r) for r in kept.collect()), key=str)
    of = lambda p: [r for r in got if r[1] and r[1].startswith(p)]
    assert of("a") == [(1, a, 0)] and of("u") == [(2, u, 2)]
    assert len(of("v")) == 1 and len(of("z")) == 1 and of("z")[0][0] == 5
    assert sorted((r for r in got if not r[1]), key=str) == [(6, "", 9), (6, "", 9), (None, None, 10)]
    assert sorted((tuple(r) for r in ngram_join.keep_one(df.repartition(5), 5, 80).collect()), key=str) == got


def test_linked_sets_share_a_group_key():
    rng = np.random.default_rng(5)
    for percent in (60, 80, 90):
        for n in [*range(1, 60), 100, 333, 1000]:
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            # the farthest set that still links: drop d shingles, add a
            for a in range(0, n + 1):
                d = 0
                while 100 * (n - d - 1) >= percent * (n + a) and d + 1 < n:
                    d += 1
                if 100 * (n - d) < percent * (n + a):
                    break
                y = np.unique(np.r_[rng.permutation(x)[d:], rng.integers(0, 1 << 63, a, dtype=np.uint64)])
                for share in (0, 3):  # none, and a third of all shingles left out
                    a_keys, b_keys = (ngram_join.group_keys(len(z), z[z % np.uint64(3) > 0] if share else z, percent) for z in (x, y))
                    assert np.intersect1d(a_keys, b_keys).size


def test_texts_that_share_a_few_shingles_share_no_key():
    rng = np.random.default_rng(11)
    phrases = rng.integers(0, 1 << 64, 1500, dtype=np.uint64)   # a text has 45 of them: two texts share one or two
    sets = [np.unique(np.r_[rng.choice(phrases, 45, False), rng.integers(0, 1 << 64, n, dtype=np.uint64)])
            for n in rng.integers(60, 140, 250)]
    seen = Counter(k for s in sets for k in set(ngram_join.group_keys(len(s), s, 80).tolist()))
    assert sum(n > 1 for n in seen.values()) <= 5


def test_only_keys_that_occur_again_are_dealt_out(spark):
    r = random.Random(3)
    texts = [" ".join(f"w{r.randint(0, 10**6)}" for _ in range(120)) for _ in range(60)]
    texts += [texts[0] + " more", texts[1] + " more"]
    none = type("Bits", (), {"value": np.zeros(1024, np.int64)})
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    keys = [k for _, k in ngram_join._texts_keys([batch], 5, 80, none)]
    parts = 7
    heads = pa.Table.from_batches(ngram_join._head_rows(5, 80, none, parts)([batch])).combine_chunks().to_batches()[0]
    assert heads.column("n").to_numpy().sum() == sum(map(len, keys))
    assert pa.compute.binary_length(heads.column("heads")).to_numpy().sum() < 8 * sum(map(len, keys))
    order = pa.compute.sort_indices(heads.column("part"))
    again = [x for b in ngram_join._again(parts)([heads.take(order)]) for x in b.column(0).to_pylist()]
    count = Counter(np.concatenate(keys).tolist())
    assert set(again) == {k >> 24 for k, n in count.items() if n > 1} and len(again) == len(set(again))
    with scratch(spark, "test") as tables:
        frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
        bits = type("Bits", (), {"value": ngram_join.keys_again(frame, 62 * 116, 5, 80, none, tables)})
    rows = pa.Table.from_batches(ngram_join._key_rows(5, 80, none, bits)([batch]))
    dealt = {k % (1 << 64) for k, other in zip(rows["key"].to_pylist(), rows["other"].to_pylist()) if other is None}
    assert dealt >= {k for k, n in count.items() if n > 1} and len(dealt) < len(count) / 5


@pytest.mark.parametrize("parts", [1, 3, 1000])
def test_packed_heads_come_back(parts):
    rng = np.random.default_rng(parts)
    starts = [ngram_join._start(p, parts) for p in range(parts + 1)]
    assert starts[0] == 0 and starts[-1] == 1 << ngram_join.KEY_BITS
    for low, high in zip(starts[:3], starts[1:4]):
        for n in (1, 2, 5000):
            heads = np.sort(np.r_[rng.integers(low, high, n, dtype=np.uint64), np.uint64(high - 1)])
            assert np.array_equal(ngram_join.unpacked(ngram_join.packed(heads, low), len(heads), low), heads)


def test_texts_of_a_block_in_many_chunks_meet(spark):
    r = random.Random(9)
    words = lambda n: [f"v{r.randint(0, 10**6)}" for _ in range(n)]
    passage, rows = words(70), []
    for i in range(24):   # half of each is the same passage: one block, and pairs of near copies in it
        own = words(60)
        rows += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + own[:-2] + words(2)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.near_components(df, 5, 80, chunk_shingles=1000).collect()
    want = _components(rows, 5, 80)
    assert len({c for _, _, c in want}) == 24
    assert sorted(map(tuple, got), key=str) == want


def test_components_leave_no_shuffle_files(spark, docs):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = lambda: {f for f in env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    rows = ngram_join.cut_lineage(ngram_join.document_sets(docs, 5))
    before = files()
    facts = ngram_join._components_of(docs, rows, 5, 80, "doc_id", "text", 1 << 20)
    assert not files() - before
    assert facts.count()


def test_tree_search_misses_no_candidate():
    rng = np.random.default_rng(7)
    base = [np.unique(rng.integers(0, 1 << 63, 150, dtype=np.uint64)) for _ in range(40)]
    sets = [np.unique(np.r_[b[rng.random(len(b)) > .06], rng.integers(0, 1 << 63, 4, dtype=np.uint64)]) for b in base for _ in range(6)]
    points, sizes = np.stack([ngram_join.point(s) for s in sets]), np.array([len(s) for s in sets])
    tree = ngram_join.CountTree(points, sizes)
    for q in range(0, len(sets), 7):
        found = set(tree.search(points[q], int(sizes[q]), 80).tolist())
        for c, s in enumerate(sets):
            both = len(np.intersect1d(s, sets[q]))
            if 100 * both >= 80 * (len(s) + len(sets[q]) - both):
                assert c in found


@pytest.mark.parametrize("task_edges", [1 << 20, 50])
def test_connected_components(spark, monkeypatch, task_edges):
    monkeypatch.setattr(common, "TASK_EDGES", task_edges)
    r = random.Random(2)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {n: c for n, c in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {a for a, b in edges if a == b and all(a not in e or e[0] == e[1] for e in edges)}
    assert got == {x: find(x) for x in root if x not in loops}


# --------------------------------------------------------------- sentence spans
def _spans(rows):
    """Brute force over the module's own sentences and runs."""
    parsed, first = [], {}
    for i, t in {(r[0], r[1] or "") for r in rows}:
        words, starts, place = sentence_spans.sentences(np.frombuffer(t.encode(), np.uint8))
        h, a, b = sentence_spans.runs(words, starts)
        parsed.append((i, t, starts, place, h, a, b))
        for x, s in zip(h.tolist(), a.tolist()):
            at = ((1 << 63) - 1 if i is None else i, s, t)
            first[x] = min(first.get(x, at), at)
    out = {}
    for i, t, starts, place, h, a, b in parsed:
        gone = [False] * (len(starts) - 1)
        for x, s, e in zip(h.tolist(), a.tolist(), b.tolist()):
            if first[x] != ((1 << 63) - 1 if i is None else i, s, t):
                gone[s:e] = [True] * (e - s)
        raw, edge = t.encode(), [0, *place[1:].tolist(), len(t.encode())]
        text = b"".join(raw[edge[k]:edge[k + 1]] for k in range(len(gone)) if not gone[k]).decode() if any(gone) else t
        out[i, t] = (text, len(gone), sum(gone))
    return out


def test_repeated_passages_are_removed_once_first_stays(spark, docs):
    passage = " ".join(f"pw{i}{'.' if i % 11 == 10 else ''}" for i in range(60)) + "."
    rows = [tuple(r) for r in docs.select("doc_id", "text").limit(100).collect()]
    rows += [(10**6 + n, t[:200] + "\n" + passage + "\n" + t[200:]) for n, (_, t) in enumerate(rows[:15])]
    rows += [(2 * 10**6, passage), (None, passage + " Tail one here.")]
    got = sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = _spans(rows)
    assert len(got) == len(rows)
    left = 0
    for r, src in zip(sorted(got, key=lambda r: str(r.doc_id)), sorted(rows, key=lambda r: str(r[0]))):
        assert (r.text, r.n_sentences, r.n_removed) == want[src[0], src[1]]
        left += "pw5 pw6" in r.text
    assert left == 1 and "Tail one here." in {r.text for r in got if r.doc_id is None}


def _bytes(t):
    return np.frombuffer(t.encode(), np.uint8)


def _plain_spans(rows):
    """The rules of the docstring, written with lists of words; of the module
    only the word hash is used."""
    stop = re.compile("[.!?\u2026\u3002\uff0e\uff01\uff1f\u061f\u06d4\u0964\u0965][\"')\\]}\u2019\u201d\u201c\u00bb\u00ab\u203a\u2039\u300d\u300f\uff09]*$")
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    parsed, first = {}, {}
    for i, t in sorted({(r[0], r[1] or "") for r in rows}, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        found = list(WORD.finditer(t))
        words = [m[0].translate(lower) for m in found]
        hashes = [int(common.word_hashes(_bytes(w))[0]) for w in words]
        ends = {k for k, m in enumerate(found) if stop.search(m[0]) or k + 1 == len(found) or "\n" in t[m.end():found[k + 1].start()]}
        for k in range(len(words) - 7):
            ends.add(max(range(k, k + 8), key=lambda j: (-hashes[j], j)))
        bounds = [0, *(e + 1 for e in sorted(ends))] if words else [0]
        n, runs = len(bounds) - 1, set()
        for k in range(n):
            runs |= {(k, min((e for e in range(k + 1, n + 1) if bounds[e] - bounds[k] >= 15), default=None))}
            runs |= {(max((b for b in range(k + 1) if bounds[k + 1] - bounds[b] >= 15), default=None), k + 1)}
        parsed[i, t] = found, bounds, sorted(r for r in runs if None not in r)
        for a, b in parsed[i, t][2]:
            first.setdefault(tuple(words[bounds[a]:bounds[b]]), []).append((i is None, i or 0, i, t, a))
    out = {}
    for key, (found, bounds, runs) in parsed.items():
        gone = set()
        for a, b in runs:
            words = tuple(m[0].translate(lower) for m in found[bounds[a]:bounds[b]])
            if min(first[words], key=lambda x: (x[0], x[1], x[4] if x[3] == key[1] else -1))[2:] != (*key, a):
                gone |= set(range(a, b))
        edge = [0, *(found[b].start() for b in bounds[1:-1]), len(key[1])]
        out[key] = "".join(key[1][edge[k]:edge[k + 1]] for k in range(len(bounds) - 1) if k not in gone) if gone else key[1]
    return out


def test_spans_equal_the_rules_written_plainly(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").limit(60).collect() if len(r.text) < 8000]
    quoted = " ".join(f"Q{i}{'.”' if i % 9 == 8 else ''}" for i in range(55))
    rows += [(10**6 + n, f"{t[:150]} {quoted}\n{t[150:400]}") for n, (_, t) in enumerate(rows[:12])]
    rows += [(2 * 10**6, "Same words again. " * 30), (2 * 10**6 + 1, "Same words again. " * 9), (None, quoted)]
    got = sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = _plain_spans(rows)
    assert {(r.doc_id, r.text) for r in got} == {(k[0], v) for k, v in want.items()}
    assert sum("Q3 Q4" in r.text for r in got) == 1


def test_sorted_streams_cross_batches():
    def batches(columns, names, size):
        table = pa.table(dict(zip(names, columns)))
        return table.to_batches(max_chunksize=size)

    rng = random.Random(4)
    for size in (1, 2, 3, 100):
        h = sorted(rng.randint(0, 12) for _ in range(40))
        told = [x for b in sentence_spans._again(batches([pa.array(h, pa.int64())], ["hash"], size)) for x in b.column(0).to_pylist()]
        assert told == sorted(x for x in set(h) if h.count(x) > 1)
        rows = sorted((rng.random() < .2, rng.randint(0, 6), rng.randint(0, 3), rng.randint(0, 1), rng.randint(0, 2)) for _ in range(60))
        cols = [pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3, 4)]
        found = [x for b in sentence_spans._repeats(batches([*cols, cols[3], pa.array([r[0] for r in rows])], sentence_spans._NAMES, size))
                 for x in zip(*(b.column(k).to_pylist() for k in range(3)))]
        want = []
        for r in rows:
            head = min(x for x in rows if x[:2] == r[:2])
            if r[0] or r[2:] != head[2:]:
                want.append(r[2:])
        assert sorted(found) == sorted(want)


def test_every_shared_passage_of_50_words_holds_a_common_run():
    r = random.Random(5)
    words = lambda n: [f"v{r.randint(0, 3000)}" for _ in range(n)]
    for case in range(600):
        passage = words(50)
        if case % 3:
            for k in range(r.randint(5, 14), 50, r.randint(9, 20)):
                passage[k] += '.\u201d' if case % 3 == 1 else '.")'
        found = []
        for _ in range(2):
            before, after = words(r.randint(0, 40)), words(r.randint(0, 40))
            text = " ".join(before + passage + after)
            h, a, b = sentence_spans.runs(*sentence_spans.sentences(_bytes(text))[:2])
            found.append(set(h.tolist()))
        assert found[0] & found[1]


def test_stops_before_closing_marks_and_of_other_scripts():
    text = 'He said "one two." Then (three four!) five\u2026 \u4e03\u3002 and\u201cso?\u201d \u00abq.\u00bb "" end'
    starts = sentence_spans.sentences(_bytes(text))[1].tolist()
    assert {4, 7, 8, 9, 10, 11} <= set(starts)


def test_clean_documents_are_left_alone(spark):
    r = random.Random(4)
    rows = [(i, " ".join(f"v{r.randint(0, 10**6)}" + ("." if r.random() < .2 else "") for _ in range(200))) for i in range(50)]
    got = sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x.doc_id, x.text) for x in got} == set(rows) and not any(x.n_removed for x in got)


def test_spans_on_edge_rows(edges, edge_rows, empty, clashing):
    got = sentence_spans.remove_repeats(edges.select("doc_id", "text")).collect()
    want = _spans(edge_rows)
    assert len(got) == len(edge_rows)
    for r in got:
        src = [t for i, t, *_ in edge_rows if i == r.doc_id]
        assert any((r.text or "", r.n_sentences, r.n_removed) == want[r.doc_id, t or ""] for t in src)
    assert sentence_spans.remove_repeats(empty).collect() == []
    assert set(sentence_spans.remove_repeats(clashing).columns) == {*clashing.columns, "n_removed"}


def test_queries_return_every_document(spark, sf_small, docs):
    n = docs.count()
    for q in ("op3_sentence_spans", "op7_exact_dedup", "op9_ngram_jaccard_join"):
        assert QUERIES[q](spark, sf_small).count() == n
