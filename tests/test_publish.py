"""Ingest of several tables is all or nothing."""

import datetime as dt
import os

import pytest

from tidewise.sources import publish as pb
from tidewise.sources import store

D = dt.date(2024, 1, 5)


def _batch(spark, day, shift=0):
    rows = {"prices": [(day, "HenryHub", 2.5 + shift, None, None)], "storage_weekly": [(day, 1.0 + shift, 2.0, 3.0, None)],
            "production_monthly": [(day, 90.0 + shift)], "lng_monthly": [(day, 1.0 + shift, None, "", 2.0)],
            "power_burn": [(day, "pjm", 5.0 + shift, None, None)], "weather_daily": [(day, "West", 1.0, 0.0, None, None, 64.0 + shift, 5.0)],
            "rigs_weekly": [(day, 9 + shift, 5, 4)], "events": [(day, "outage", 1.0 + shift)],
            "features": [(day, "f", 1.0 + shift)], "predictions": [(day, "m", 7, 1.0 + shift, None, None, None, None)]}
    out = {}
    for t, r in rows.items():
        fields = store.TABLES[t].schema.fields
        kinds = {"decimal": "double"}
        schema = ", ".join(f"{f.name} {kinds.get(f.dataType.typeName(), f.dataType.simpleString())}" for f in fields)
        out[t] = spark.createDataFrame(r, schema)
    return out


def _state(spark, root):
    return {t: sorted(map(str, store.read_stored(spark, root, t).collect())) for t in store.TABLES}


@pytest.fixture
def root(spark, tmp_path):
    root = f"file:{tmp_path}/db"
    assert store.ingest_all(_batch(spark, D), root) == {t: 1 for t in store.TABLES}
    return root


@pytest.mark.parametrize("conflict, day", [("error", dt.date(2024, 2, 9)), ("replace", D)])
def test_a_failure_while_writing_leaves_all_tables(spark, root, monkeypatch, conflict, day):
    before, real, done = _state(spark, root), store._write_partitioned, []

    def failing(*a):
        if len(done) == 3:
            raise OSError("disk gone")
        done.append(a)
        return real(*a)

    monkeypatch.setattr(store, "_write_partitioned", failing)
    with pytest.raises(OSError, match="disk gone"):
        store.ingest_all(_batch(spark, day, 1), root, conflict, parallelism=1)
    assert len(done) == 3 and _state(spark, root) == before
    monkeypatch.undo()
    store.ingest_all(_batch(spark, day, 1), root, conflict)     # what was staged is discarded, not published
    after = _state(spark, root)
    assert all(len(after[t]) == (2 if conflict == "error" else 1) and after[t] != before[t] for t in after)


@pytest.mark.parametrize("conflict, day", [("error", dt.date(2024, 2, 9)), ("replace", D)])
def test_a_failure_while_publishing_is_made_good(spark, root, monkeypatch, conflict, day):
    before, real, moved = _state(spark, root), pb._Files.move, []

    def failing(self, source, target):
        if "/_staging/" in source:
            if len(moved) == 3:
                raise OSError("driver lost")
            moved.append(target)
        return real(self, source, target)

    monkeypatch.setattr(pb._Files, "move", failing)
    with pytest.raises(OSError, match="driver lost"):
        store.ingest_all(_batch(spark, day, 1), root, conflict)
    monkeypatch.undo()
    after = _state(spark, root)      # the first read finishes the commit
    assert all(len(after[t]) == (2 if conflict == "error" else 1) and after[t] != before[t] for t in after)
    path = root.removeprefix("file:")
    assert not os.listdir(f"{path}/_commits") or all(f.endswith(".crc") for f in os.listdir(f"{path}/_commits"))
    assert pb.recover(spark, root) == 0


def test_conflicts_rejects_and_empty_batches_publish_nothing(spark, root):
    before = _state(spark, root)
    with pytest.raises(store.DuplicateKeyError):
        store.ingest_all(_batch(spark, D, 1), root)
    later = _batch(spark, dt.date(2024, 3, 1))
    later["prices"] = later["prices"].selectExpr("date", "cast(null as string) as hub", "spot_price")
    with pytest.raises(store.RejectedRowsError):
        store.ingest_all(later, root)
    assert store.ingest_all({t: df.limit(0) for t, df in later.items()}, root) == {t: 0 for t in store.TABLES}
    assert store.ingest_all(_batch(spark, D, 1), root, "skip") == {t: 0 for t in store.TABLES}
    assert _state(spark, root) == before and store.ingest_all({}, root) == {}


def test_rejected_rows_come_with_the_accepted_ones(spark, tmp_path):
    df = spark.createDataFrame([(D, "a", 1.0), (D, None, 2.0), (D, "b", 1e12)], "date date, hub string, spot_price double")
    n, rejected = store.append_accepted(df, f"{tmp_path}/r", "prices")
    assert n == 1 and sorted(r.reason for r in rejected.collect()) == ["null_key", "type"]
