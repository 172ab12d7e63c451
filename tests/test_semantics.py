"""Hand-made inputs with pandas/numpy expected values for the null and edge
rules (SURVEY §1.3, §5 item 2)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewise.operators import storage as st
from tidewise.operators import weather as wx
from tidewise.plans import features as fe
from tidewise.plans.ordered import add_row_index, forward_fill, windowed


def _days(n, start="2024-01-01"):
    d0 = dt.date.fromisoformat(start)
    return [d0 + dt.timedelta(days=i) for i in range(n)]


def _close(a, b, tol=1e-9):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return False
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


def test_degree_days_null_stays_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 50.0), (dt.date(2024, 1, 2), None),
                                (dt.date(2024, 1, 3), 70.0)], "date date, temperature double")
    out = {r.date: r for r in wx.degree_days(df).collect()}
    assert out[dt.date(2024, 1, 1)].HDD == 15.0 and out[dt.date(2024, 1, 1)].CDD == 0.0
    assert out[dt.date(2024, 1, 2)].HDD is None and out[dt.date(2024, 1, 2)].CDD is None
    assert out[dt.date(2024, 1, 3)].CDD == 5.0


@pytest.mark.parametrize("plan", ["halo", "partition"])
def test_rolling_and_lags_match_pandas(spark, plan):
    rng = np.random.default_rng(1)
    n = 120
    vals = rng.normal(40, 10, n)
    vals[[5, 17, 60, 61]] = np.nan
    pdf = pd.DataFrame({"date": _days(n), "x": vals})
    sdf = spark.createDataFrame([(d, None if np.isnan(v) else float(v)) for d, v in zip(pdf.date, pdf.x)],
                                "date date, x double")

    def build(w):
        return wx.lag_cols(w, "x", [1, 3, 30]) + wx.rolling_cols(w, "x", [7, 30])

    out = windowed(sdf, build, "date", (), 30, plan, bucket_rows=40).toPandas().sort_values("date")
    s = pdf.x
    exp = {
        "x_lag_1": s.shift(1), "x_lag_3": s.shift(3), "x_lag_30": s.shift(30),
        "x_rolling_7": s.rolling(7).mean(), "x_rolling_7_std": s.rolling(7).std(),
        "x_rolling_7_max": s.rolling(7).max(), "x_rolling_30_min": s.rolling(30).min(),
    }
    for col, e in exp.items():
        got = out[col].tolist()
        for g, x in zip(got, e.tolist()):
            assert _close(None if g is None or (isinstance(g, float) and math.isnan(g)) else g, x, 1e-9), col


def test_halo_equals_plain_window_multibucket(spark):
    # many buckets (bucket_rows=16 < series length), look-back 10, 3 series
    rows = []
    for key in ("a", "b", "c"):
        for i, d in enumerate(_days(90 if key != "b" else 37)):
            rows.append((key, d, float((i * 7919) % 101) if i % 11 else None))
    df = spark.createDataFrame(rows, "k string, date date, v double")

    def build(w):
        return wx.lag_cols(w, "v", [1, 10]) + wx.rolling_cols(w, "v", [5, 11])

    halo = windowed(df, build, "date", ["k"], 10, "halo", bucket_rows=16).orderBy("k", "date").collect()
    plain = windowed(df, build, "date", ["k"], 10, "partition").orderBy("k", "date").collect()
    assert len(halo) == len(plain) == len(rows)
    for a, b in zip(halo, plain):
        for c in a.asDict():
            assert _close(a[c], b[c]) if isinstance(a[c], float) or a[c] is None else a[c] == b[c], c


def test_row_index_contiguous_per_key(spark):
    rows = [(k, d) for k in ("x", "y") for d in _days(400 if k == "x" else 3)]
    df = spark.createDataFrame(rows, "k string, date date")
    out = add_row_index(df, "date", ["k"], "idx").groupBy("k").agg(
        F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.count("*").alias("n"),
        F.countDistinct("idx").alias("nd")).collect()
    for r in out:
        assert r.lo == 0 and r.hi == r.n - 1 and r.nd == r.n


def test_forward_fill_crosses_buckets(spark):
    # values only in January; all later months must carry the last one
    rows = [(d, 1.0 * i if d.month == 1 and i % 3 == 0 else None) for i, d in enumerate(_days(100))]
    df = spark.createDataFrame(rows, "date date, v double")
    out = forward_fill(df, "v", "f", "date").orderBy("date").toPandas()
    exp = pd.Series([r[1] for r in rows]).ffill()
    assert [None if pd.isna(x) else x for x in out.f] == [None if pd.isna(x) else x for x in exp]


def test_pct_change_pads_and_zero_denominator(spark):
    d = _days(6)
    wg = [100.0, None, 110.0, 0.0, 5.0, None]
    df = spark.createDataFrame(list(zip(d, wg)), "date date, working_gas double")
    out = st.storage_change(df).orderBy("date").collect()
    s = pd.Series(wg)
    # pandas 2.x pads before pct_change; x/0 -> inf there, NULL here
    exp_pct = (s.ffill() / s.ffill().shift(1) - 1) * 100
    exp_diff = s.diff()
    for r, p, q in zip(out, exp_pct, exp_diff):
        if np.isinf(p):
            assert r.storage_change_pct is None
        else:
            assert _close(r.storage_change_pct, None if pd.isna(p) else p)
        assert _close(r.storage_change, None if pd.isna(q) else q)


def test_tightness_bins_edges_and_nulls(spark):
    # ratios exactly at the edges -0.1, -0.05, 0.05 and a zero average
    rows = [(dt.date(2024, 1, i + 1), wg, 100.0) for i, wg in enumerate([89.0, 90.0, 95.0, 105.0, 120.0])]
    rows += [(dt.date(2024, 2, 1), 10.0, 0.0), (dt.date(2024, 2, 2), None, 10.0)]
    df = spark.createDataFrame(rows, "date date, working_gas double, five_year_avg double")
    out = {r.date: r for r in st.tightness(df).collect()}
    bins = lambda r: (r.storage_very_tight, r.storage_tight, r.storage_normal, r.storage_loose)
    assert bins(out[dt.date(2024, 1, 1)]) == (1, 0, 0, 0)
    assert bins(out[dt.date(2024, 1, 2)]) == (0, 1, 0, 0)   # -0.1 is tight
    assert bins(out[dt.date(2024, 1, 3)]) == (0, 0, 1, 0)   # -0.05 is normal
    assert bins(out[dt.date(2024, 1, 4)]) == (0, 0, 0, 1)   # 0.05 is loose
    assert bins(out[dt.date(2024, 2, 1)]) == (0, 0, 0, 0)   # zero average -> null ratio
    assert bins(out[dt.date(2024, 2, 2)]) == (0, 0, 0, 0)
    for r in out.values():
        if r.storage_tightness is not None:
            assert sum(bins(r)) == 1


def test_calendar_day_366_and_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 31),), (dt.date(2024, 12, 30),), (dt.date(2021, 1, 3),)],
                               "date date")
    w = {r.date: r for r in wx.weather_calendar(df).collect()}
    r = w[dt.date(2024, 12, 31)]
    assert r.day_of_year == 366
    assert _close(r.day_sin, math.sin(2 * math.pi * 366 / 365))
    assert r.is_winter == 1 and r.is_fall == 0
    s = {r.date: r for r in st.storage_calendar(df).collect()}
    assert s[dt.date(2024, 12, 30)].week_of_year == 1
    assert s[dt.date(2021, 1, 3)].week_of_year == 53
    for r in s.values():
        assert r.is_injection_season + r.is_withdrawal_season == 1


def test_trend_matches_polyfit(spark):
    y = [3.0, 5.0, 4.0, 8.0, 9.0, None, 7.0, 6.0, 5.0, 1.0]
    df = spark.createDataFrame(list(zip(_days(len(y)), y)), "date date, working_gas double")
    out = st.storage_trend(df).orderBy("date").collect()
    for i, r in enumerate(out):
        win = y[max(0, i - 3): i + 1]
        if len(win) < 4 or any(v is None for v in win):
            assert r.storage_trend is None
        else:
            assert _close(r.storage_trend, float(np.polyfit(range(4), win, 1)[0]), 1e-9)
            assert _close(r.storage_projected_8w, y[i] + 8 * r.storage_trend)


def test_regional_weights_unmatched_and_null_poison(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(d1, "Northeast", 55.0), (d1, "Other", 45.0), (d1, "South", 75.0),
            (d2, "West", 60.0), (d2, "Midwest", None)]
    df = spark.createDataFrame(rows, "date date, region string, temperature double")
    out = {r.date: r for r in wx.regional_degree_days(df).collect()}
    assert _close(out[d1].HDD_weighted, 10 * 0.25 + 20 * 0.1 + 0)
    assert _close(out[d1].CDD_weighted, 10 * 0.30)
    assert out[d2].HDD_weighted is None


def test_feature_stage_column_counts(spark):
    w = spark.createDataFrame([(d, 40.0 + i % 9) for i, d in enumerate(_days(60))], "date date, temperature double")
    assert len(fe.weather_features(w).columns) == 49
    s = spark.createDataFrame([(d, 3000.0 + i, 2900.0) for i, d in enumerate(_days(40))],
                              "date date, working_gas double, five_year_avg double")
    assert len(fe.storage_features(s).columns) == 63


def test_fewer_rows_than_window(spark):
    df = spark.createDataFrame([(d, 1.0) for d in _days(5)], "date date, x double")
    out = windowed(df, lambda w: wx.rolling_cols(w, "x", [7]), "date", (), 6).collect()
    assert all(r.x_rolling_7 is None for r in out)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1974, 45000])
def test_exact_quantiles_match_numpy(spark, n):
    from tidewise.operators.impute import exact_quantiles

    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(0, 1, n), 3)  # ties included
    df = spark.createDataFrame([(float(v),) for v in vals], "r double")
    got = {r.q: r.value for r in exact_quantiles(df, ["r"], [0.1, 0.5, 0.9]).collect()}
    for q in (0.1, 0.5, 0.9):
        assert _close(got[q], float(np.quantile(vals, q)), 1e-12)


def test_lookahead_halo_equals_plain_lead(spark):
    rows = [(k, d, float(i)) for k in ("a", "b") for i, d in enumerate(_days(70 if k == "a" else 20))]
    df = spark.createDataFrame(rows, "k string, date date, v double")

    def build(w):
        return [f"lead(v, 1) {w()} as n1", f"lead(v, 9) {w()} as n9"]

    halo = windowed(df, build, "date", ["k"], 0, "halo", bucket_rows=12, lookahead=9).orderBy("k", "date").collect()
    plain = windowed(df, build, "date", ["k"], 0, "partition").orderBy("k", "date").collect()
    assert [tuple(r) for r in halo] == [tuple(r) for r in plain]


def test_keyed_forward_fill_matches_pandas(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in ("x", "y", "z"):
        for i, d in enumerate(_days(150, "2023-11-15")):
            v = float(i) if rng.random() < 0.15 else None
            rows.append((k, d, v))
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = {(r.k, r.date): r.f for r in forward_fill(df, "v", "f", "date", ["k"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "date", "v"])
    pdf["f"] = pdf.groupby("k")["v"].ffill()
    for r in pdf.itertuples():
        exp = None if pd.isna(r.f) else r.f
        assert got[(r.k, r.date)] == exp


def test_asof_join_by_key(spark):
    from tidewise.operators.joins import asof_join

    left = spark.createDataFrame([("a", dt.date(2024, 1, d)) for d in range(1, 21)]
                                 + [("b", dt.date(2024, 1, d)) for d in range(1, 21)], "k string, date date")
    right = spark.createDataFrame([("a", dt.date(2024, 1, 5), 1.0), ("a", dt.date(2024, 1, 12), 2.0),
                                   ("b", dt.date(2023, 12, 30), 9.0)], "k string, rd date, v double")
    got = {(r.k, r.date.day): r.v for r in asof_join(left, right, "date", "rd", ["v"], by=["k"]).collect()}
    assert got[("a", 4)] is None and got[("a", 5)] == 1.0 and got[("a", 11)] == 1.0 and got[("a", 20)] == 2.0
    assert all(got[("b", d)] == 9.0 for d in range(1, 21))


def test_gas_burn_branches_and_grain(spark):
    from tidewise.operators.power import gas_burn_proxy

    rows = [(dt.datetime(2024, 1, 1, 1), 100.0, 30.0), (dt.datetime(2024, 1, 1, 2), 200.0, None),
            (dt.datetime(2024, 1, 2, 1), None, None), (None, 50.0, 5.0)]
    df = spark.createDataFrame(rows, "ts timestamp, total_load double, gas_generation double")
    gen = {r.date: r.gas_burn_mwh for r in gas_burn_proxy(df).collect()}
    # generation present: used as is; nulls skipped; all-null day sums to 0; null time dropped
    assert gen == {dt.date(2024, 1, 1): 30.0, dt.date(2024, 1, 2): 0.0}
    load = {r.date: r.gas_burn_mwh for r in gas_burn_proxy(df.drop("gas_generation")).collect()}
    assert math.isclose(load[dt.date(2024, 1, 1)], 120.0) and load[dt.date(2024, 1, 2)] == 0.0
    exact = gas_burn_proxy(df.drop("gas_generation"), grain="exact").collect()
    assert len(exact) == 3
