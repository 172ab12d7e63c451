"""Walk-forward invariants against a brute-force numpy loop."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.plans import backtest as bt


def _frame(spark, n, p=2, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(5, 2, (n, p)) + 1.0
    y = X @ np.arange(1, p + 1) * 0.1 + rng.normal(0, 0.2, n)
    d0 = dt.date(2020, 1, 1)
    rows = [(d0 + dt.timedelta(days=i), float(y[i]), *[float(v) for v in X[i]]) for i in range(n)]
    cols = ", ".join(f"f{j} double" for j in range(p))
    return spark.createDataFrame(rows, f"date date, y double, {cols}"), X, y


def _brute(X, y, W, s):
    """The loop of the definition: for i in range(W, n - s, s) (strict bound)."""
    out = {}
    n = len(y)
    for k, i in enumerate(range(W, n - s, s)):
        coef = np.linalg.lstsq(X[i - W:i], y[i - W:i], rcond=None)[0]
        pred = X[i:i + s] @ coef
        yt = y[i:i + s]
        da, dp = np.sign(np.diff(yt)), np.sign(np.diff(pred))
        out[k] = dict(mae=np.mean(np.abs(yt - pred)), rmse=np.sqrt(np.mean((yt - pred) ** 2)),
                      mape=np.mean(np.abs((yt - pred) / yt)) * 100,
                      direction_accuracy=np.mean(da == dp) * 100 if len(yt) > 1 else float("nan"),
                      pred=pred, start=i)
    return out


@pytest.mark.parametrize("n,W,s,p", [(300, 60, 20, 1), (250, 50, 15, 2), (200, 40, 40, 3), (120, 100, 21, 1)])
def test_gram_fit_equals_per_fold_lstsq(spark, n, W, s, p):
    df, X, y = _frame(spark, n, p)
    feats = [f"f{j}" for j in range(p)]
    pred = bt.walk_forward_lstsq(df, feats, "y", W, s)
    met = {r.fold: r for r in bt.fold_metrics(pred, W, s).collect()}
    exp = _brute(X, y, W, s)
    assert len(met) == len(exp) == bt.fold_count(n, W, s)
    for k, e in exp.items():
        m = met[k]
        assert m.test_start == e["start"] and m.train_start == e["start"] - W
        for name in ("mae", "rmse", "mape", "direction_accuracy"):
            assert math.isclose(getattr(m, name), e[name], rel_tol=1e-7, abs_tol=1e-9), name
    rows = {r.idx: r.prediction for r in pred.collect()}
    for e in exp.values():
        for j, v in enumerate(e["pred"]):
            assert math.isclose(rows[e["start"] + j], v, rel_tol=1e-7, abs_tol=1e-9)


def test_no_folds_when_series_too_short(spark):
    df, _, _ = _frame(spark, 50, 1)
    pred = bt.walk_forward_lstsq(df, ["f0"], "y", 40, 10)
    assert pred.count() == 0
    assert bt.summary(bt.fold_metrics(pred, 40, 10)).count() == 0


def test_last_block_ending_at_n_is_omitted(spark):
    # n = W + 2s: folds at i = W only (range(W, n - s, s) stops before n - s)
    df, _, _ = _frame(spark, 100, 1)
    pred = bt.walk_forward_lstsq(df, ["f0"], "y", 60, 20)
    assert sorted(r.fold for r in pred.select("fold").distinct().collect()) == [0]


def test_grouped_model_path_equals_gram_path(spark):
    df, X, y = _frame(spark, 220, 2, seed=3)
    a = {(r.fold, r.idx): r.prediction for r in bt.walk_forward_lstsq(df, ["f0", "f1"], "y", 50, 25).collect()}
    b = {(r.fold, r.idx): r.prediction for r in bt.walk_forward_grouped(
        df, bt.NumpyLeastSquares, ["f0", "f1"], "y", 50, 25).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert math.isclose(a[k], b[k], rel_tol=1e-8, abs_tol=1e-10)


def test_summary_population_std(spark):
    df, X, y = _frame(spark, 300, 1, seed=5)
    s = bt.summary(bt.fold_metrics(bt.walk_forward_lstsq(df, ["f0"], "y", 60, 20), 60, 20)).collect()[0]
    exp = _brute(X, y, 60, 20)
    maes = [e["mae"] for e in exp.values()]
    assert math.isclose(s.mae_mean, np.mean(maes), rel_tol=1e-9)
    assert math.isclose(s.mae_std, np.std(maes), rel_tol=1e-7)
    assert s.n_folds == len(exp)


def test_fold_count_formula():
    for n in range(0, 400, 7):
        for W, s in ((252, 21), (200, 50), (10, 3)):
            assert bt.fold_count(n, W, s) == len(range(W, n - s, s))


def test_fold_scoped_imputation_matches_loop(spark):
    rng = np.random.default_rng(11)
    n, W, s = 180, 60, 20
    x1 = rng.normal(4, 1, n)
    x2 = rng.normal(2, 1, n)
    y = 0.3 * x1 + 0.7 * x2 + rng.normal(0, 0.1, n)
    x1[rng.random(n) < 0.2] = np.nan
    x2[rng.random(n) < 0.5] = np.nan
    y[rng.random(n) < 0.1] = np.nan
    d0 = dt.date(2022, 1, 1)
    nn = lambda v: None if np.isnan(v) else float(v)
    rows = [(d0 + dt.timedelta(days=i), nn(y[i]), nn(x1[i]), nn(x2[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "date date, y double, a double, b double")
    got = {(r.fold, r.idx): r.prediction for r in
           bt.walk_forward_lstsq_fold_imputed(df, ["a", "b"], "y", W, s).collect()}
    exp = {}
    X = np.column_stack([x1, x2])
    for k, i in enumerate(range(W, n - s, s)):
        tr = slice(i - W, i)
        med = [np.nanmedian(X[tr, 0]), np.nanmedian(X[tr, 1]), np.nanmedian(y[tr])]
        fill = lambda a, m: np.where(np.isnan(a), m, a)
        Xtr = np.column_stack([fill(X[tr, 0], med[0]), fill(X[tr, 1], med[1])])
        ytr = fill(y[tr], med[2])
        coef = np.linalg.lstsq(Xtr, ytr, rcond=None)[0]
        te = slice(i, i + s)
        Xte = np.column_stack([fill(X[te, 0], med[0]), fill(X[te, 1], med[1])])
        for j, v in enumerate(Xte @ coef):
            exp[(k, i + j)] = v
    assert got.keys() == exp.keys()
    for key in exp:
        assert math.isclose(got[key], exp[key], rel_tol=1e-8, abs_tol=1e-10)


def test_walk_forward_per_entity(spark):
    # folds are per key: each key's rows are indexed and cut on their own
    rng = np.random.default_rng(5)
    rows, data = [], {}
    for key, n in (("hub_a", 150), ("hub_b", 95)):
        x = rng.normal(3, 1, n) + 1
        y = 0.8 * x + rng.normal(0, 0.1, n)
        data[key] = (x, y)
        d0 = dt.date(2021, 3, 1)
        rows += [(key, d0 + dt.timedelta(days=i), float(y[i]), float(x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "hub string, date date, y double, f0 double")
    pred = bt.walk_forward_lstsq(df, ["f0"], "y", 40, 15, partition_cols=["hub"])
    got = {(r.hub, r.fold, r.idx): r.prediction for r in pred.collect()}
    for key, (x, y) in data.items():
        exp = _brute(x.reshape(-1, 1), y, 40, 15)
        keys = {k for k in got if k[0] == key}
        assert len(keys) == sum(len(e["pred"]) for e in exp.values())
        for k, e in exp.items():
            for j, v in enumerate(e["pred"]):
                assert math.isclose(got[(key, k, e["start"] + j)], v, rel_tol=1e-8)
    m = bt.fold_metrics(pred, 40, 15, partition_cols=["hub"])
    assert {r.hub for r in m.collect()} == {"hub_a", "hub_b"}


def test_tied_dates_fail_unless_a_tiebreak_is_named(spark):
    from tidewise.plans.ordered import IDX, add_row_index

    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(d, "a", 1.0), (d, "b", 2.0), (d + dt.timedelta(1), "a", 3.0)],
                               "date date, hub string, v double")
    with pytest.raises(Exception, match="rows tie"):
        add_row_index(df, "date").collect()
    assert sorted(r[IDX] for r in add_row_index(df, ["date", "hub"]).collect()) == [0, 1, 2]
    assert sorted((r.hub, r[IDX]) for r in add_row_index(df, "date", ["hub"]).collect()) == [("a", 0), ("a", 1), ("b", 0)]


def _series(spark, n, offset=0.0, seed=0):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n) + offset, rng.normal(size=n) * 3 + offset
    y = 2 * (x1 - offset) - (x2 - offset) + rng.normal(size=n) * .1 + 5
    rows = [(dt.date(2000, 1, 1) + dt.timedelta(int(i)), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "date date, x1 double, x2 double, spot_price double"), x1, x2, y


@pytest.mark.parametrize("offset", [0.0, 1e4, 1e6, 1e8])
@pytest.mark.parametrize("kind", ["lstsq", "ols"])
def test_linear_fits_keep_their_digits_at_any_offset(spark, offset, kind):
    df, x1, x2, y = _series(spark, 170, offset)
    got = {r.idx: r.prediction for r in bt.walk_forward_linear(
        df, {"m": bt.Linear(("x1", "x2"), kind)}, window=60, step=20).collect()}
    x = np.c_[x1, x2]
    for k in range(bt.fold_count(170, 60, 20)):
        a, b = slice(k * 20, k * 20 + 60), slice(k * 20 + 60, k * 20 + 80)
        if kind == "ols":
            m = x[a].mean(0)
            coef = np.linalg.lstsq(x[a] - m, y[a] - y[a].mean(), rcond=None)[0]
            want = y[a].mean() + (x[b] - m) @ coef
        else:
            want = x[b] @ np.linalg.lstsq(x[a], y[a], rcond=None)[0]
        tol = 1e-7 if offset < 1e7 else 1e-4
        assert np.allclose([got[i] for i in range(b.start, b.stop)], want, atol=tol, rtol=0)


def test_elastic_net_minimises_its_objective(spark):
    m = bt.Linear(("x1", "x2"), "elastic_net", alpha=0.3, l1_ratio=0.6)
    _, x1, x2, y = _series(spark, 80, 2.0)
    x = np.c_[x1, x2, y]
    d = x - x.mean(0)
    a, *b = m.solve(80, x.mean(0), d.T @ d)

    def objective(a, b):
        return (np.sum((y - a - x[:, :2] @ b) ** 2) / 160 + .3 * (.6 * np.abs(b).sum() + .2 * np.sum(np.square(b))))

    best, rng = objective(a, np.array(b)), np.random.default_rng(1)
    for _ in range(200):
        assert objective(a + rng.normal() * .01, np.array(b) + rng.normal(size=2) * .01) >= best - 1e-12


def test_null_rows_raise_or_are_dropped(spark):
    df, *_ = _series(spark, 130)
    holes = df.withColumn("x1", F.when(F.dayofmonth("date") != 7, F.col("x1")))
    with pytest.raises(Exception, match="model column is NULL"):
        bt.walk_forward_lstsq(holes, ["x1"], window=60, step=20).collect()
    n = holes.dropna().count()
    pred = bt.walk_forward_lstsq(holes, ["x1"], window=60, step=20, nulls="drop")
    assert pred.count() == 20 * bt.fold_count(n, 60, 20) and pred.filter("prediction is null").count() == 0


def test_null_actual_makes_fold_metrics_null(spark):
    rows = [("m", 0, i, float(i), float(i) + 1) for i in range(4)] + [("m", 1, i, None if i == 5 else 0.0, 1.0) for i in range(4, 8)]
    pred = spark.createDataFrame(rows, "model string, fold long, idx long, actual double, prediction double")
    got = {r.fold: r for r in bt.fold_metrics(pred, 4, 4).collect()}
    assert got[0].mae == 1.0 and got[0].n_null == 0 and got[0].mape_skipped == 1
    assert got[1].mae is None and got[1].rmse is None and got[1].mape is None and got[1].n_null == 1


def test_no_training_target_lies_in_the_test_block(spark):
    df, *_ = _series(spark, 200)
    # a feature that is the target of the row: any overlap would show as a perfect fit of leaked rows
    for h in (7, 14):
        w, s = 70, 21
        folds = bt.fold_moments(bt._indexed(df, "date", []), ["x1", "spot_price"], [], w - h, s).collect()
        for r in folds:
            last_train = r.fold * s + (w - h) - 1
            assert r._rows == w - h and last_train + h < r.fold * s + w
    pred = bt.horizon_walk_forward(df, {"m": bt.Linear(("x1",))}, (7, 14), window=70, step=21).collect()
    y = {r.date: r.spot_price for r in df.collect()}
    for r in pred:
        assert r.actual == y[r.date + dt.timedelta(r.horizon_days)]


def test_compare_any_models_by_key(spark):
    from tidewise.registry_models import Mean

    df, *_ = _series(spark, 130)
    both = df.withColumn("hub", F.lit("a")).unionByName(df.filter("x1 > -10").withColumn("hub", F.lit("b")))
    pred = bt.compare(both, {"ols": bt.Linear(("x1", "x2"), "ols"), "mean": bt.Fitted(Mean, ("x1",))},
                      window=60, step=20, partition_cols=["hub"])
    s = {(r.hub, r.model): r for r in bt.summary(bt.fold_metrics(pred, 60, 20, ["hub"]), ("hub", "model")).collect()}
    assert set(s) == {(h, m) for h in "ab" for m in ("ols", "mean")}
    assert all(s[h, "ols"].mae_mean < s[h, "mean"].mae_mean for h in "ab")


def test_importance_of_any_model(spark):
    from tidewise.plans.models import feature_importance

    class Own:
        def get_feature_importance(self):
            return {"a": 2, "b": 1}

    assert sorted(map(tuple, feature_importance(Own()).collect())) == [("a", 2.0), ("b", 1.0)]
    assert feature_importance(object()).count() == 0


@pytest.mark.parametrize("window, step, horizon", [(50, 21, 0), (60, 20, 0), (25, 1, 0), (7, 10, 0), (61, 17, 5), (40, 40, 0)])
def test_fold_moments_read_two_running_sums(spark, window, step, horizon):
    """Any window and step, columns far from zero, against a loop over folds."""
    rng = np.random.default_rng(12)
    n = 230
    x = rng.normal(1e6, 1, (n, 2))
    y = x @ [0.5, -0.25] + rng.normal(0, 0.1, n)
    df = spark.createDataFrame([(dt.date(2022, 1, 1) + dt.timedelta(i), *map(float, (a, b, c))) for i, (a, b, c) in enumerate(zip(*x.T, y))],
                               "date date, a double, b double, y double")
    got = {(r.fold, r.idx): r.prediction for r in bt.walk_forward_linear(
        df, {"ols": bt.Linear(("a", "b"), "ols")}, "y", window, step, horizon=horizon).collect()}
    want = {}
    for k, i in enumerate(range(window, n - step, step)):
        tr = slice(i - window, i - horizon)
        mu, my = x[tr].mean(0), y[tr].mean()
        coef = np.linalg.lstsq(x[tr] - mu, y[tr] - my, rcond=None)[0]
        want |= {(k, j): my + (x[j] - mu) @ coef for j in range(i, i + step)}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_linear_folds_copy_no_rows(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1) + dt.timedelta(i), float(i % 7), float(i % 5)) for i in range(300)],
                               "date date, a double, y double")
    x = bt.add_row_index(df, "date")
    plans = {(w, s): bt.fold_moments(x, ["a", "y"], [], w, s)._jdf.queryExecution().executedPlan().toString()
             for w, s in ((100, 7), (100, 50), (99, 98))}
    assert all("Generate" not in p for p in plans.values())
    assert len({p.count("Exchange") for p in plans.values()}) == 1


def test_imputed_folds_are_slices_of_shared_rows(spark):
    rng = np.random.default_rng(13)
    rows = [(k, dt.date(2022, 1, 1) + dt.timedelta(i), None if rng.random() < 0.3 else float(rng.normal()),
             None if rng.random() < 0.2 or (k == "b" and i < 90) else float(rng.normal())) for k in ("a", "b", None) for i in range(170)]
    df = spark.createDataFrame(rows, "k string, date date, x double, y double")
    models = {"ols": bt.Linear(("x",), "ols"), "plain": bt.Fitted(bt.NumpyLeastSquares, ("x",))}
    runs = [sorted((tuple(r) for r in bt.walk_forward_imputed(df, models, "y", 40, 13, partition_cols=["k"], folds_per_group=g).collect()), key=str)
            for g in (1, 3, None)]
    assert runs[0] == runs[1] == runs[2]
    a, b = ([r for r in runs[0] if r[0] == k] for k in ("a", "b"))
    assert {r[2] for r in a} == set(range(bt.fold_count(170, 40, 13)))
    assert min(r[2] for r in b) > 0    # folds whose whole training target is NULL fit nothing
    assert bt.walk_forward_imputed(df.limit(0), models, "y", 40, 13).count() == 0
