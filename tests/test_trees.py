"""Tree ensembles of a fold, model tables, keyed backtests with a NULL key."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.plans import backtest as bt
from tidewise.plans import models as md
from tidewise.plans.trees import Ensemble, bin_edges


def _exhaustive(x, y, rows, depth):
    """A regression tree by trying every column and every gap between values."""
    best, sse = None, ((y[rows] - y[rows].mean()) ** 2).sum()
    for j in range(x.shape[1]) if depth else ():
        values = np.unique(x[rows, j])
        for a, b in zip(values[:-1], values[1:]):
            left, right = rows[x[rows, j] <= a], rows[x[rows, j] >= b]
            gain = sse - sum(((y[r] - y[r].mean()) ** 2).sum() for r in (left, right))
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = gain, j, a, left, right
    if best is None:
        mean = y[rows].mean()
        return lambda row: mean
    _, j, a, left, right = best
    below, above = _exhaustive(x, y, left, depth - 1), _exhaustive(x, y, right, depth - 1)
    return lambda row: (below if row[j] <= a else above)(row)


def test_a_tree_equals_the_exhaustive_search():
    rng = np.random.default_rng(3)
    for depth in (1, 2, 4):
        for _ in range(8):
            x, y = rng.integers(0, 7, (40, 3)).astype(float), rng.normal(size=40)
            tree = _exhaustive(x, y, np.arange(40), depth)
            got = Ensemble(False, 1, depth, bootstrap=False).fit(x, y).predict(x)
            assert np.allclose(got, [tree(r) for r in x])


def test_boosting_fits_what_is_left_over():
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 9, (50, 2)).astype(float), rng.normal(size=50)
    left, want = y - y.mean(), np.full(50, y.mean())
    for _ in range(6):
        tree = _exhaustive(x, left, np.arange(50), 2)
        step = 0.3 * np.array([tree(r) for r in x])
        left, want = left - step, want + step
    assert np.allclose(Ensemble(True, 6, 2, 0.3).fit(x, y).predict(x), want)


def test_samples_seeds_importances_and_edge_frames():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    y = 3 * x[:, 2] + 0.1 * rng.normal(size=300)
    for make in (lambda s: Ensemble(True, 50, 3, 0.2, 0.8, 0.8, seed=s, features=("a", "b", "c", "d")),
                 lambda s: Ensemble(False, 20, 5, column_share=1 / 3, seed=s, features=("a", "b", "c", "d"))):
        one, two, other = make(1).fit(x, y), make(1).fit(x, y), make(2).fit(x, y)
        assert np.array_equal(one.predict(x), two.predict(x)) and not np.array_equal(one.predict(x), other.predict(x))
        imp = one.get_feature_importance()
        assert max(imp, key=imp.get) == "c" and abs(sum(imp.values()) - 1) < 1e-12
        assert np.abs(one.predict(x) - y).mean() < 0.5 * np.abs(y - y.mean()).mean()
    constant = Ensemble(True, 5, 3).fit(np.ones((10, 2)), np.arange(10.0))
    assert np.allclose(constant.predict(np.zeros((3, 2))), 4.5)
    assert np.allclose(Ensemble(False, 3, 2, bootstrap=False).fit(np.zeros((4, 0)), np.arange(4.0)).predict(np.zeros((2, 0))), 1.5)


def test_bins_are_distinct_values_or_quantiles():
    assert bin_edges(np.array([3.0, 1.0, 1.0, 2.0]), 256).tolist() == [1.5, 2.5]
    x = np.random.default_rng(6).normal(size=5000)
    edges = bin_edges(x, 32)
    sizes = np.bincount(np.searchsorted(edges, x, side="left"))
    assert len(edges) == 31 and sizes.max() <= 5000 // 32 + 2


def _frame(spark, n=150, regions=(None,)):
    rng = np.random.default_rng(7)
    rows = [(r, dt.date(2020, 1, 1) + dt.timedelta(i), float(rng.normal()), float(rng.normal()), 0.0) for r in regions for i in range(n)]
    rows = [(r, d, a, b, 2 * a - b + 5) for r, d, a, b, _ in rows]
    return spark.createDataFrame(rows, "region string, date date, x1 double, x2 double, spot_price double")


def test_all_folds_of_all_kinds_equal_fits_of_each_fold(spark):
    df = _frame(spark).drop("region")
    kinds = {k: md.fold_model(k, ("x1", "x2"), **({"n_estimators": 7} if k == "xgboost" else {}))
             for k in ("random_forest", "xgboost", "linear")}
    got = bt.compare(df, kinds, "spot_price", 60, 20).toPandas()
    pdf = df.toPandas().sort_values("date").reset_index(drop=True)
    assert sorted(got.fold.unique()) == list(range(bt.fold_count(150, 60, 20)))
    for (kind, k), part in got.groupby(["model", "fold"]):
        train, test = pdf.iloc[20 * k:20 * k + 60], pdf.iloc[20 * k + 60:20 * k + 80]
        part = part.sort_values("idx")
        if kind == "linear":
            want = test.spot_price.to_numpy()
        else:
            want = kinds[kind].make().fit(train[["x1", "x2"]], train.spot_price).predict(test[["x1", "x2"]])
        assert np.allclose(part.prediction, want) and np.allclose(part.actual, test.spot_price)


def test_a_null_series_is_a_series(spark):
    df = _frame(spark, 120, ("a", None))
    named = df.withColumn("region", F.coalesce("region", F.lit("none")))

    def rows(pred, name):
        return sorted((r.model, r.fold, r.idx, round(r.actual, 9), round(r.prediction, 9)) for r in pred.collect() if r.region == name)

    runs = [lambda d: bt.walk_forward_lstsq(d, ["x1"], window=60, step=20, partition_cols=["region"]),
            lambda d: bt.walk_forward_grouped(d, bt.NumpyLeastSquares, ["x1"], window=60, step=20, partition_cols=["region"]),
            lambda d: bt.walk_forward_lstsq_fold_imputed(d, ["x1"], window=60, step=20, partition_cols=["region"]),
            lambda d: bt.compare(d, {"ols": bt.Linear(("x1",), "ols"), "f": md.fold_model("random_forest", ["x1"])},
                                 window=60, step=20, partition_cols=["region"])]
    for run in runs:
        got = run(df)
        assert rows(got, None) == rows(run(named), "none") != []
        assert len(rows(got, "a")) == len(rows(got, None))
        metrics = bt.fold_metrics(got, 60, 20, ["region"])
        assert metrics.filter("region is null").count() == metrics.filter("region = 'a'").count() > 0


def test_models_of_a_window_are_saved_loaded_and_scored(spark, tmp_path):
    df = _frame(spark).drop("region")
    kinds = {k: md.fold_model(k, ("x1", "x2"), **({"n_estimators": 30} if k in ("xgboost", "lightgbm") else {}))
             for k in ("elastic_net", "linear", "random_forest", "xgboost", "lightgbm")}
    md.save_models(md.fit_window(df, kinds), str(tmp_path / "models"))
    loaded = md.load_models(spark, str(tmp_path / "models"))
    got = md.predict_with(loaded, df).toPandas()
    pdf = df.toPandas().sort_values(["x1", "x2", "spot_price"])
    for kind, part in got.groupby("model"):
        part = part.sort_values(["x1", "x2", "spot_price"])
        if kind == "linear":
            assert np.allclose(part.prediction, part.spot_price)
        elif kind != "elastic_net":
            want = kinds[kind].make().fit(pdf[["x1", "x2"]], pdf.spot_price).predict(pdf[["x1", "x2"]])
            assert np.allclose(part.prediction, want)
        assert (part.prediction - part.spot_price).abs().mean() < (part.spot_price - part.spot_price.mean()).abs().mean()
    imp = {(r.model, r.feature): r.importance for r in md.importances(loaded).collect()}
    assert len(imp) == 10 and abs(imp["linear", "x1"] - 2) < 1e-9 and imp["xgboost", "x1"] > imp["xgboost", "x2"]


def test_a_loaded_mllib_model_keeps_its_contract(spark, tmp_path):
    df = _frame(spark, 80).drop("region")
    model = md.RegressionModel("linear", "spot_price", ["x2", "x1"])
    with pytest.raises(ValueError):
        model.save(str(tmp_path / "none"))
    model.train_final_model(df)
    model.save(str(tmp_path / "m"))
    again = md.RegressionModel.load(str(tmp_path / "m"))
    assert (again.kind, again.target, again.features, again.date_col) == ("linear", "spot_price", ["x2", "x1"], "date")
    assert again.get_feature_importance().collect() == model.get_feature_importance().collect()
    assert again.evaluate_model(df)["mae"] < 1e-6
    assert json.loads(spark.read.text(str(tmp_path / "m" / "facts")).first()[0])["features"] == ["x2", "x1"]


def test_the_report_equals_metrics_of_plain_numpy(spark, sf_small, tmp_path):
    """E4 against a loop over folds that uses none of the library's plans."""
    from tidewise.plans.training import run_training, training_data
    from tidewise.sources import landed

    tables = {k: v.cache() for k, v in landed.tables(spark, sf_small).items()}
    boosted = {k: {"n_estimators": 5} for k in ("xgboost", "lightgbm")}
    rep = {r.model: r for r in run_training(tables, str(tmp_path), model_overrides=boosted).collect()}
    data = training_data(tables, rollup_entities=True).toPandas().sort_values("date").reset_index(drop=True)
    feats = [c for c in data.columns if c not in ("date", "spot_price") and data[c].notna().any()]
    x, y, w, s = data[feats].to_numpy(float), data.spot_price.to_numpy(float), 252, 21

    def linear(a, b, c):
        mu, my = a.mean(0), b.mean()
        scale = np.sqrt(((a - mu) ** 2).sum(0))
        scale[scale == 0] = 1
        return my + (c - mu) @ (np.linalg.lstsq((a - mu) / scale, b - my, rcond=None)[0] / scale)

    fits = {"linear": linear}
    for kind in ("random_forest", "xgboost", "lightgbm"):
        fits[kind] = lambda a, b, c, k=kind: md.fold_model(k, feats, **boosted.get(k, {})).make().fit(a, b).predict(c)
    for kind, fit in fits.items():
        mae, mape = [], []
        for i in range(w, len(y) - s, s):
            error = np.abs(y[i:i + s] - fit(x[i - w:i], y[i - w:i], x[i:i + s]))
            mae.append(error.mean())
            mape.append((error / y[i:i + s]).mean() * 100)
        assert rep[kind].mae == f"{np.mean(mae):.4f} ± {np.std(mae):.4f}", kind
        assert rep[kind].mape == f"{np.mean(mape):.2f}% ± {np.std(mape):.2f}%", kind
    assert set(rep) == {*fits, "elastic_net"}


def test_permutation_importance_of_linear_and_other_models(spark):
    df = _frame(spark, 120, ("a", None))
    models = {"sums": bt.Linear(("x1", "x2")), "moved": bt.Fitted(bt.NumpyLeastSquares, ("x1", "x2")),
              "forest": md.fold_model("random_forest", ("x1", "x2"))}
    got = {(r.region, r.model, r.fold, r.feature): r.importance for r in
           bt.permutation_importance(df, models, "spot_price", 60, 20, partition_cols=["region"]).collect()}
    folds = bt.fold_count(120, 60, 20)
    assert len(got) == 2 * 3 * folds * 2
    for (region, model, fold, feature), value in got.items():
        if model == "moved":
            assert abs(value - got[region, "sums", fold, feature]) < 1e-8 * max(1, abs(value))
        if model == "forest" and feature == "x1":
            assert value > 0
    part = bt.permutation_importance(df, {"m": models["moved"]}, "spot_price", 60, 20, partition_cols=["region"], max_shifts=5)
    assert part.count() == 2 * folds * 2
