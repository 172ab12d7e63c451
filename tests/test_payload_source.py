"""Landed payload folders as a data source."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewise.sources import payload_source as ps
from tidewise.sources import series as se


def _land(folder, key, page, document):
    os.makedirs(f"{folder}/{key}", exist_ok=True)
    with open(f"{folder}/{key}/{page}.json.part", "w") as f:
        f.write(document if isinstance(document, str) else json.dumps(document))
    os.rename(f"{folder}/{key}/{page}.json.part", f"{folder}/{key}/{page}.json")


def _page(month, days, **odd):
    return {"data": [{"period": f"{month}-{d:02d}", "value": odd.get(f"d{d}", d)} for d in days]}


@pytest.fixture
def folder(spark, tmp_path):
    folder = str(tmp_path / "land")
    for key in ("NG.A.D", "NG.B.D"):
        for month in ("2023-12", "2024-01", "2024-02"):
            _land(folder, key, month, _page(month, range(1, 29), d3="x", d4=None, d5="7.5"))
    _land(folder, "NG.C.M", "2024", {"data": [{"period": "2024-01", "value": "1"}, {"period": "2024-03", "value": 2}]})
    _land(folder, "NG.C.M", "extra", {})
    return folder


def _opened(df):
    return {r.file for r in df.select("file").distinct().collect()}


def test_rows_equal_the_parsed_payload_rows(spark, folder):
    got = {(r.key, r.date, r.value) for r in ps.payloads(spark, folder).collect()}
    payloads = spark.read.text(f"{folder}/*/*.json", wholetext=True).select(
        F.regexp_extract(F.input_file_name(), "([^/]+)/[^/]+$", 1).alias("series_id"), F.col("value").alias("payload"))
    assert got == {tuple(r) for r in se.parse_series(payloads).collect()}
    assert len(got) == 2 * 3 * 26 + 2


def test_options_choose_the_files(folder):
    def names(**options):
        if "keys" in options:
            options["keys"] = json.dumps(options["keys"])
        return sorted(n for p in ps.PayloadReader({"path": folder, **options}).partitions() for n in p.names)

    assert len(names()) == 8
    assert names(keys=["NG.A.D"], start="2024-02-01") == ["NG.A.D/2024-02.json"]
    assert names(keys=["NG.C.M", "none"]) == ["NG.C.M/2024.json", "NG.C.M/extra.json"]
    assert names(end="2023-12-31") == ["NG.A.D/2023-12.json", "NG.B.D/2023-12.json", "NG.C.M/extra.json"]
    assert names(start="2024-01-31", end="2024-01-31") == ["NG.A.D/2024-01.json", "NG.B.D/2024-01.json", "NG.C.M/2024.json", "NG.C.M/extra.json"]


def test_options_equal_filters_and_skip_unreadable_files(spark, folder):
    whole = ps.payloads(spark, folder)
    for options, condition in (({"keys": ["NG.A.D"]}, "key = 'NG.A.D'"), ({"keys": []}, "false"),
                               ({"start": "2024-02-10", "end": "2024-02-19"}, "date between date'2024-02-10' and date'2024-02-19'"),
                               ({"keys": ["NG.B.D", "NG.C.M"], "end": "2024-01-02"}, "key in ('NG.B.D', 'NG.C.M') and date <= date'2024-01-02'")):
        assert sorted(ps.payloads(spark, folder, **options).collect()) == sorted(whole.filter(condition).collect())
    assert whole.filter("key = 'NG.A.D'").count() < whole.count() == 2 * 3 * 26 + 2
    # files that cannot match are not opened: a broken one among them is no error
    _land(folder, "NG.A.D", "2022-05", "{broken")
    assert ps.payloads(spark, folder, start="2024-01-01", on_corrupt="raise").count() == 2 * 2 * 26 + 2
    assert _opened(ps.payloads(spark, folder, keys=["NG.A.D"], start="2024-02-01")) == {"NG.A.D/2024-02.json"}
    with pytest.raises(Exception, match="corrupt payload NG.A.D/2022-05.json"):
        ps.payloads(spark, folder, on_corrupt="raise").collect()


def test_corrupt_files_are_reported(spark, folder):
    _land(folder, "NG.A.D", "2024-03", '{"data": [{"period": "2024-03-01", "val')
    _land(folder, "NG.A.D", "2024-04", "")
    _land(folder, "NG.B.D", "2024-05", {"data": [{"period": "soon", "value": 1}]})
    bad = ps.payloads(spark, folder).filter("corrupt is not null").collect()
    assert {r.file for r in bad} == {"NG.A.D/2024-03.json", "NG.A.D/2024-04.json", "NG.B.D/2024-05.json"}
    assert all(r.date is None and r.value is None and "Error" in r.corrupt for r in bad)


def test_forecast_pages(spark, tmp_path):
    folder = str(tmp_path / "fc")
    periods = [{"startTime": f"2024-06-{d:02d}T23:00:00-05:00", "temperature": 60 + d, "windSpeed": "10 mph" if d % 2 else "",
                **({"probabilityOfPrecipitation": {"value": None if d == 3 else d}} if d > 1 else {})} for d in range(1, 20)]
    _land(folder, "Boston", "2024-06-01", {"properties": {"periods": periods}})
    _land(folder, "Chicago", "2024-06-01", {"properties": None})
    got = sorted(ps.payloads(spark, folder, "forecast").collect())
    assert [r.date.day for r in got] == list(range(1, 15)) and {r.key for r in got} == {"Boston"}
    assert [(r.wind_speed, r.precipitation) for r in got[:4]] == [(10.0, 0.0), (None, 2.0), (10.0, None), (None, 4.0)]


def test_empty_and_missing_folders_and_bad_options(spark, tmp_path):
    assert ps.payloads(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="kind"):
        ps.payloads(spark, str(tmp_path), on_corrupt="perhaps").collect()


def test_a_restarted_stream_reads_no_file_twice(spark, folder, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        q = (ps.payloads(spark, folder, stream=True).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start())
        q.awaitTermination(120)
        assert q.exception() is None
        return spark.read.schema(ps.SCHEMAS["series"]).parquet(out)

    assert run().count() == 2 * 3 * 26 + 2
    assert run().count() == 2 * 3 * 26 + 2        # nothing new
    _land(folder, "NG.A.D", "2024-03", _page("2024-03", range(1, 11)))
    _land(folder, "NG.A.D", "2024-04", "{broken")
    got = run()
    assert got.filter("corrupt is null").count() == 2 * 3 * 26 + 2 + 10
    assert got.groupBy("file", "date").count().filter("count > 1").count() == 0
    assert [r.file for r in got.filter("corrupt is not null").collect()] == ["NG.A.D/2024-04.json"]


def test_offsets_tell_files_of_one_moment_apart(folder):
    r = ps.PayloadStreamReader({"path": folder})
    for name, _, _ in ps.listed(folder):
        os.utime(f"{folder}/{name}", ns=(10**18, 10**18))
    first = r.latestOffset()
    assert first["time"] == 10**18 and len(first["names"]) == 8
    _land(folder, "NG.Z.D", "2024-01", _page("2024-01", [1]))
    os.utime(f"{folder}/NG.Z.D/2024-01.json", ns=(10**18, 10**18))
    second = r.latestOffset()
    assert [n for p in r.partitions(first, second) for n in p.names] == ["NG.Z.D/2024-01.json"]
    assert r.partitions(second, r.latestOffset()) == []


def test_landed_pages_come_back(spark, tmp_path):
    days = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(i), float(i) if i % 7 else None) for i in range(70)], "date date, v double")
    folder = f"file:{tmp_path}/w"
    ps.write_payloads(se.pages(days, "NG.Q.D", "v"), folder)
    got = sorted((r.date, r.value) for r in ps.payloads(spark, folder).collect())
    assert got == [(r.date, r.v) for r in sorted(days.collect()) if r.v is not None]
