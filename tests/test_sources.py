"""JSON parse edge cases (written by the test itself), stored-table appends,
scans and the as-of join against a brute-force check."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewise.operators.joins import asof_join
from tidewise.sources import forecast as fc
from tidewise.sources import series as se
from tidewise.sources import store as sto


def _write(tmp, name, obj):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj))
    return p


def test_series_payload_edge_cases(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "NG.RNGWHHD.D.json", {"data": [
        {"period": "2024-01-02", "value": "3.5"}, {"period": "2024-01-03", "value": "x"},
        {"period": "2024-01-04", "value": None}, {"period": "2024-01-05", "value": 2.25}]})
    _write(d, "NG.N9010US2.M.json", {"data": [{"period": "2024-01", "value": "101.5"}]})
    _write(d, "NG.N3010US2.M.json", {"note": "no data key"})
    payloads = se.read_payload_files(spark, d)
    long = se.core_series(payloads)
    got = sorted((r.series, r.frequency, r.date, r.value) for r in long.collect())
    assert got == [
        ("henry_hub_spot", "daily", dt.date(2024, 1, 2), 3.5),
        ("henry_hub_spot", "daily", dt.date(2024, 1, 5), 2.25),
        ("production", "monthly", dt.date(2024, 1, 1), 101.5),
    ]
    tables = se.series_to_tables(long)
    assert tables["prices"].filter(F.col("hub") == "HenryHub").count() == 2
    bounded = se.parse_series(payloads, start="2024-01-03", end="2024-01-31").collect()
    assert sorted(r.date for r in bounded) == [dt.date(2024, 1, 5)]


def test_storage_id_is_weekly():
    assert se.SERIES_IDS["storage"].endswith(".W")


def test_forecast_payload_edge_cases(spark):
    periods = [
        {"startTime": "2024-01-01T22:00:00-05:00", "temperature": 40.0, "windSpeed": "10 mph",
         "probabilityOfPrecipitation": {"value": 20.0}},
        {"startTime": "2024-01-02T06:00:00-05:00", "temperature": 41.0, "windSpeed": "",
         "probabilityOfPrecipitation": {"value": None}},
        {"startTime": "2024-01-02T18:00:00-05:00", "temperature": 42.0},
        {"startTime": "2024-01-03T06:00:00-05:00", "temperature": 43.0, "windSpeed": "5 to 10 mph"},
    ]
    rows = [("Boston", json.dumps({"properties": {"periods": periods}})), ("Nowhere", json.dumps({"properties": {
        "periods": periods}})), ("Chicago", json.dumps({"properties": {"periods": []}}))]
    payloads = spark.createDataFrame(rows, "station string, payload string")
    out = fc.regional_forecast(payloads, days=3).orderBy("period_no").collect()
    assert [r.station for r in out] == ["Boston"] * 3           # unknown and empty stations skipped
    assert out[0].date == dt.date(2024, 1, 1)                     # local date, not UTC
    assert out[0].wind_mph == 10.0 and out[0].precipitation == 20.0
    assert out[1].wind_speed == "" and out[1].wind_mph is None and out[1].precipitation is None
    assert out[2].wind_speed == "" and out[2].precipitation == 0.0  # missing key -> 0
    assert out[0].region == "Northeast"


def test_append_key_semantics(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 10.0), (dt.date(2024, 2, 1), 11.0)],
                               "month date, dry_gas_bcfpd double")
    assert sto.append(df, root, "production_monthly") == 2
    with pytest.raises(sto.DuplicateKeyError):
        sto.append(df, root, "production_monthly")
    more = spark.createDataFrame([(dt.date(2024, 2, 1), 99.0), (dt.date(2024, 3, 1), 12.0)],
                                 "month date, dry_gas_bcfpd double")
    assert sto.append(more, root, "production_monthly", on_conflict="skip") == 1
    assert sto.append(more, root, "production_monthly", on_conflict="replace") == 2
    stored = sto.read_stored(spark, root, "production_monthly")
    got = sorted((r.month, float(r.dry_gas_bcfpd)) for r in stored.collect())
    assert got == [(dt.date(2024, 1, 1), 10.0), (dt.date(2024, 2, 1), 99.0), (dt.date(2024, 3, 1), 12.0)]
    empty = spark.createDataFrame([], "month date, dry_gas_bcfpd double")
    assert sto.append(empty, root, "production_monthly") == 0
    dup = spark.createDataFrame([(dt.date(2025, 1, 1), 1.0), (dt.date(2025, 1, 1), 2.0)],
                                "month date, dry_gas_bcfpd double")
    with pytest.raises(sto.DuplicateKeyError):
        sto.append(dup, root, "production_monthly")
    # bounded scan prunes by the year-month partition column
    scan = sto.scan_range(stored, "production_monthly", "2024-02-01", "2024-12-31")
    assert [r.month for r in scan.collect()] == [dt.date(2024, 2, 1), dt.date(2024, 3, 1)]


def test_append_rejects_are_raised_or_returned(spark, tmp_path):
    d = dt.date(2024, 1, 1)
    rows = [(d, 1e12), (dt.date(2024, 2, 1), 1.0), (dt.date(2024, 2, 1), 2.0), (None, 3.0), (dt.date(2024, 3, 1), 4.0),
            (dt.date(2024, 3, 1), 4.0)]
    df = spark.createDataFrame(rows, "month date, dry_gas_bcfpd double")
    with pytest.raises(Exception, match="does not fit"):
        sto.conform(df, "production_monthly").collect()
    counts = {r.reason: r.n for r in sto.reject_count(df, "production_monthly").collect()}
    assert counts == {"type": 1, "duplicate": 2, "null_key": 1}
    for mode in ("error", "skip", "replace"):
        with pytest.raises(sto.DuplicateKeyError):
            sto.append(df, str(tmp_path), "production_monthly", mode)
        with pytest.raises(sto.RejectedRowsError):
            sto.append(df.filter("month is null or dry_gas_bcfpd > 10"), str(tmp_path), "production_monthly", mode)
    assert not (tmp_path / "production_monthly").exists()  # nothing was written
    n, rejected = sto.append_accepted(df, str(tmp_path), "production_monthly")
    stored = sto.read_stored(spark, str(tmp_path), "production_monthly").collect()
    assert n == 1 and [(r.month, float(r.dry_gas_bcfpd)) for r in stored] == [(dt.date(2024, 3, 1), 4.0)]
    assert sorted(r.reason for r in rejected.collect()) == ["duplicate", "duplicate", "null_key", "type"]


def test_append_leaves_session_settings_and_cache_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "month date, dry_gas_bcfpd double")
    for mode in ("error", "replace"):
        sto.append(df, str(tmp_path), "production_monthly", mode)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert not df.is_cached


def test_ingest_is_checked_before_any_write(spark, tmp_path):
    good = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "month date, dry_gas_bcfpd double")
    bad = spark.createDataFrame([(None, 1)], "date date, total_rigs int")
    with pytest.raises(sto.RejectedRowsError):
        sto.ingest_all({"production_monthly": good, "rigs_weekly": bad}, str(tmp_path))
    assert not (tmp_path / "production_monthly").exists()


def test_corrupt_payloads_raise_or_are_returned(spark):
    good = json.dumps({"data": [{"period": "2024-01-01", "value": "1.5"}, {"period": "2024-01-02", "value": "NaN"}]})
    rows = [("a", good), ("b", good[:30]), ("c", "plain text"), ("d", None), ("e", "{}")]
    pages = spark.createDataFrame(rows, "series_id string, payload string")
    with pytest.raises(Exception, match="corrupt payload"):
        se.parse_series(pages).collect()
    assert [(r.series_id, r.value) for r in se.parse_series(pages, on_corrupt="skip").collect()] == [("a", 1.5)]
    assert sorted(r.series_id for r in se.corrupt_payloads(pages).collect()) == ["b", "c", "d"]
    forecasts = spark.createDataFrame([("Boston", '{"properties": {"periods": [')], "station string, payload string")
    with pytest.raises(Exception, match="corrupt payload"):
        fc.parse_forecast(forecasts).collect()
    assert se.corrupt_payloads(forecasts, fc.FORECAST_SCHEMA).count() == 1
    assert fc.parse_forecast(forecasts, on_corrupt="skip").count() == 0


def test_nan_is_null_on_read(spark, tmp_path):
    from tidewise.operators.weather import degree_days
    from tidewise.sources.tables import read_table

    df = spark.createDataFrame([(dt.date(2024, 1, 1), float("nan")), (dt.date(2024, 1, 2), 60.0)],
                               "date date, temperature double")
    df.write.parquet(str(tmp_path / "t.parquet"))
    got = {r.date.day: r.temperature for r in read_table(spark, str(tmp_path), "t").collect()}
    assert got == {1: None, 2: 60.0}
    assert {r.date.day: r.HDD for r in degree_days(df).collect()} == {1: None, 2: 5.0}


def test_asof_join_matches_brute_force(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(150)]
    weekly = [d for d in days if d.weekday() == 2][::1]
    left = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "date date, p double")
    right = spark.createDataFrame([(d, float(i * 10)) for i, d in enumerate(weekly)], "rdate date, v double")
    got = {r.date: r.v for r in asof_join(left, right, "date", "rdate", ["v"], release_lag_days=2).collect()}
    for d in days:
        cands = [i * 10.0 for i, w in enumerate(weekly) if w + dt.timedelta(days=2) <= d]
        assert got[d] == (cands[-1] if cands else None)


def test_series_bad_period_fails_the_job(spark):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    payloads = spark.createDataFrame([("NG.RNGWHHD.D", json.dumps({"data": [{"period": "not-a-date", "value": "1"}]}))],
                                     "series_id string, payload string")
    with pytest.raises((PySparkException, Py4JJavaError, Exception)):
        se.parse_series(payloads).collect()


def test_ingest_all_window(spark, sf_small, tmp_path):
    from tidewise.sources import landed

    tabs = landed.tables(spark, sf_small)
    got = sto.ingest_all({"prices": tabs["prices"], "rigs_weekly": tabs["rigs_weekly"]}, str(tmp_path),
                         end="1997-12-31", days=365)
    p = sto.read_stored(spark, str(tmp_path), "prices").collect()
    assert got["prices"] == len(p) > 0
    assert all(dt.date(1996, 12, 31) <= r.date <= dt.date(1997, 12, 31) for r in p)


def test_matrix_rollup_one_row_per_date_and_latest_keeps_ties(spark, sf_small):
    from tidewise.operators.joins import feature_matrix
    from tidewise.sources import landed

    tabs = landed.tables(spark, sf_small)
    m = feature_matrix(tabs, rollup_entities=True)
    n_prices = tabs["prices"].count()
    assert m.count() == n_prices == m.select("date").distinct().count()
    exact = feature_matrix(tabs)
    assert exact.count() >= n_prices  # fan-out by region / balancing area
    wd = spark.createDataFrame([(dt.date(2024, 1, 1), "West", 1.0), (dt.date(2024, 1, 2), "West", 2.0),
                                (dt.date(2024, 1, 2), "South", 3.0)], "date date, region string, hdd double")
    latest = sto.latest(wd, "weather_daily").collect()
    assert sorted(r.region for r in latest) == ["South", "West"] and {r.date for r in latest} == {dt.date(2024, 1, 2)}


def test_training_window_of_one_frame(spark):
    from tidewise.operators.impute import training_window, window_bounds

    df = spark.range(20).selectExpr("date_add(date'2024-01-01', cast(id as int)) as date", "id")
    assert sorted(r.id for r in training_window(df, 5).collect()) == list(range(14, 20))
    assert sorted(r.id for r in training_window(df, 2, end="2024-01-11").collect()) == [8, 9, 10]
    assert window_bounds(df, 5) == ("2024-01-15", "2024-01-20") and window_bounds(df.limit(0)) == (None, None)
