"""Bands of earlier folds, against a loop."""

import numpy as np

from tidewise.operators import extensions as ex
from tidewise.plans.bands import kth_of_prefix, running_bands
from tidewise.plans.ordered import running_total


def test_kth_of_every_prefix():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 300):
        codes = rng.integers(0, max(1, size // 2), size)
        asks = [(n, r) for n in range(1, size + 1) for r in {0, n // 2, n - 1}]
        got = kth_of_prefix(codes, np.array([a[0] for a in asks]), np.array([a[1] for a in asks]))
        assert got.tolist() == [int(np.sort(codes[:n])[r]) for n, r in asks]


def _rows():
    rng = np.random.default_rng(2)
    rows = []
    for model in ("a", "b", None):
        for fold in range(12):
            for i in range(int(rng.integers(1, 9))):
                e = None if rng.random() < 0.1 or (model == "b" and fold < 2) else float(np.round(rng.normal(), 1))
                rows.append((model, fold, i, e, 0.0))
    return rows


def test_running_bands_equal_a_loop_whatever_the_parts(spark):
    rows = _rows()
    pred = spark.createDataFrame(rows, "model string, fold long, idx long, actual double, prediction double").repartition(3)
    for part_values in (100_000, 7):
        got = {(r.model, r.fold): (r.residual_q10, r.residual_q50, r.residual_q90) for r in running_bands(pred, part_values=part_values).collect()}
        assert len(got) == len({r[:2] for r in rows})
        for (model, fold), bands in got.items():
            seen = [r[3] for r in rows if r[0] == model and r[1] < fold and r[3] is not None]
            want = tuple(np.quantile(seen, [0.1, 0.5, 0.9])) if seen else (None,) * 3
            assert bands == want if not seen else np.allclose(bands, want), (model, fold)
    assert running_bands(pred.limit(0)).collect() == []


def test_later_folds_change_no_earlier_band(spark):
    rows = _rows()
    schema = "model string, fold long, idx long, actual double, prediction double"
    whole = {(r.model, r.fold): tuple(r) for r in running_bands(spark.createDataFrame(rows, schema)).collect()}
    cut = running_bands(spark.createDataFrame([r for r in rows if r[1] < 7], schema)).collect()
    assert all(whole[r.model, r.fold] == tuple(r) for r in cut)


def test_prediction_rows_keep_entity_keys(spark):
    import datetime as dt

    pred = spark.createDataFrame([(g, "m", k, 10 * k + i, dt.date(2024, 1, 1) + dt.timedelta(10 * k + i), float(i), 1.0)
                                  for g in ("x", None) for k in range(3) for i in range(4)],
                                 "hub string, model string, fold long, idx long, date date, actual double, prediction double")
    by = ["hub", "model"]
    out = ex.prediction_rows(pred, running_bands(pred, by), by=[*by, "fold"]).collect()
    assert len(out) == 24 and {r.hub for r in out} == {"x", None}
    assert all((r.confidence_lower is None) == (r.date < dt.date(2024, 1, 11)) for r in out)
    whole = ex.prediction_rows(pred, ex.residual_bands(pred, by), by=by).collect()
    assert len(whole) == 24 and all(r.confidence_lower is not None for r in whole)


def test_running_total_across_ranges(spark):
    rng = np.random.default_rng(3)
    rows = [(k, int(o), int(rng.integers(0, 9))) for k in ("a", None) for o in rng.permutation(200)[:120]]
    df = spark.createDataFrame(rows, "k string, o long, c long")
    got = {(r.k, r.o): r.t for r in running_total(df, "c", "o", ["k"], "t", width=16).collect()}
    assert got == {(k, o): sum(r[2] for r in rows if r[0] == k and r[1] < o) for k, o, _ in rows}
