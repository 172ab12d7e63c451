"""The pipeline against brute-force versions of its stages, and the queries'
SQL twins."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from tidewise.llm import toxicity
from tidewise.llm.queries import ORACLE, QUERIES

from test_filters import _components
from test_mix_and_pack import _mix


def _brute(rows, labelled):
    train = {i: y for i, y in labelled.items() if zlib.crc32(str(i).encode()) % 4 != 2}
    known = sorted((i, t) for i, t, *_ in rows if i in train and len(t) <= toxicity.SAMPLE_CHARS)
    model = toxicity.train([t for i, t in known if train[i] == 1], [t for i, t in known if train[i] == 0])
    score = model.scores([r[1] for r in rows], model.compressors() if len(model.weights) else None)
    rows = [r for r, s in zip(rows, score) if s < toxicity.THRESHOLD]
    yield rows
    last = {}
    for r in rows:
        if r[1] not in last or last[r[1]][0] < r[0]:
            last[r[1]] = r
    rows = list(last.values())
    yield rows
    least = {i: c for i, _, c in _components(rows, 5, 80)}
    rows = [r for r in rows if least[r[0]] == r[0]]
    yield rows
    by_id = {r[0]: r for r in rows}
    mixed = []
    for i, size, _, _, taken in _mix(rows):
        mixed += [by_id[i]] * (taken // size if size else 0)
    yield mixed


def test_every_stage_equals_brute_force(spark, sf_small, docs, labels):
    rows = [tuple(r) for r in docs.collect()]
    labelled = {r.doc_id: r.toxic for r in labels.collect()}
    frame, want = docs, _brute(rows, labelled)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf_small)
        assert frame.columns == docs.columns, name
        got = [tuple(r) for r in frame.collect()]
        assert sorted(got) == sorted(next(want)), name
        frame = spark.createDataFrame(got, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, sf_small).collect()
    assert Counter((r.doc_id) for r in packed if r.piece == 0) == Counter(r[0] for r in got)


def test_run_is_the_stages_in_turn(spark, sf_small):
    out = QUERIES["pipeline"](spark, sf_small)
    rows = out.collect()
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
    assert rows and max(fill.values()) <= 4096
    assert len(fill) <= -(-sum(fill.values()) // 4096) + 1


def test_stages_on_edge_rows(spark, sf_small, edges, empty):
    for frame in (edges, empty):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, sf_small)
            frame = spark.createDataFrame(frame.collect(), frame.schema)
    assert frame.count() == 0


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if n in QUERIES))
def test_sql_twins(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    rel = con.execute(ORACLE[name])
    cols = [d[0] for d in rel.description]
    df = QUERIES[name](spark, sf_small)
    assert sorted(df.columns) == sorted(cols)

    def canon(rows):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)

    assert canon(tuple(r) for r in df.select(*cols).collect()) == canon(rel.fetchall())


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_ids_of_reruns_agree(spark, sf_small):
    def digest(name):
        rows = sorted(map(str, QUERIES[name](spark, sf_small).collect()))
        return hashlib.md5("".join(rows).encode()).hexdigest()

    for name in ("op1_fair_queue_mix", "op4_best_fit_packing", "op10_compression_toxicity", "op11_length_delimited_records",
                 "op13_reversed_search"):
        assert digest(name) == digest(name)
