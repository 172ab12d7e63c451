"""Row windows on replayed streams equal the batch windows."""

import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.operators import storage
from tidewise.streaming.windows import stream_windows, window_columns

SCHEMA = "ba string, ts timestamp, v double"
T0 = dt.datetime(2024, 1, 1)


def _run(spark, folder, out, state, **kw):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    q = (stream_windows(stream, "v", "ts", ["ba"], (1, 3, 7), (4, 7), True, **kw).writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.read.parquet(out), q.recentProgress


def _land(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}-tmp")
    os.makedirs(folder, exist_ok=True)
    for f in os.listdir(f"{folder}-tmp"):
        if f.endswith(".parquet"):
            os.rename(f"{folder}-tmp/{f}", f"{folder}/{name}.parquet")


def _rows(n=160):
    rng = np.random.default_rng(4)
    return [(b, T0 + dt.timedelta(hours=i), None if rng.random() < 0.1 else (0.0 if rng.random() < 0.05 else float(rng.normal(50, 9))))
            for b in ("x", "y", None) for i in range(n)]


def _close(a, b):
    return a is None and b is None or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_replayed_files_equal_the_batch(spark, tmp_path):
    rows = _rows()
    jitter = np.random.default_rng(6).uniform(0, 5, len(rows))
    order = [r for _, r in sorted(zip(jitter, rows), key=lambda x: (x[1][1] + dt.timedelta(hours=x[0]), str(x[1][0])))]
    folder = str(tmp_path / "in")
    for k in range(8):
        _land(spark, folder, f"f{k}", order[60 * k:60 * (k + 1)])
    got, progress = _run(spark, folder, str(tmp_path / "out"), str(tmp_path / "ck"), delay_seconds=6 * 3600)
    assert [r.status for r in got.select("status").distinct().collect()] == ["ok"]
    named = {(r.ba, r.ts): r for r in got.collect()}
    held = {b: sorted(r[1] for r in rows if r[0] == b)[-6:] for b in ("x", "y", None)}
    assert len(named) == len(rows) - 18 and not set(named) & {(b, t) for b, ts in held.items() for t in ts}
    for b in ("x", "y", None):
        v = [r[2] for r in sorted((r for r in rows if r[0] == b), key=lambda r: r[1])]
        last = None
        for i, x in enumerate(v):
            r = named.get((b, T0 + dt.timedelta(hours=i)))
            filled = x if x is not None else last
            if r is not None:
                for k in (1, 3, 7):
                    assert r[f"v_lag_{k}"] == (v[i - k] if i >= k else None)
                for w in (4, 7):
                    frame = v[i - w + 1:i + 1] if i + 1 >= w else [None]
                    full = None not in frame
                    for s, f in (("", np.mean), ("_std", lambda z: np.std(z, ddof=1)), ("_max", max), ("_min", min)):
                        assert _close(r[f"v_rolling_{w}{s}"], float(f(frame)) if full else None)
                assert _close(r.v_change, x - v[i - 1] if i and x is not None and v[i - 1] is not None else None)
                assert _close(r.v_change_pct, (filled / last - 1) * 100 if last and filled is not None else None)
            last = filled
    # one state row per series, whatever the length
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]) == 3


def test_batch_change_of_the_library_is_the_same(spark, tmp_path):
    rows = [r for r in _rows(60) if r[0] == "x"]
    batch = storage.storage_change(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("v", "working_gas"), order_col="ts", partition_cols=["ba"])
    want = {r.ts: (r.storage_change, r.storage_change_pct) for r in batch.collect()}
    v = np.array([np.nan if r[2] is None else r[2] for r in rows])
    columns, _ = window_columns(v, len(v), np.nan, "v", (1,), (), True)
    for r, a, b in zip(rows, columns["v_change"], columns["v_change_pct"]):
        assert _close(want[r[1]][0], None if np.isnan(a) else a) and _close(want[r[1]][1], None if np.isnan(b) else b)


@pytest.mark.parametrize("splits", [(10, 20, 30), (1, 2, 3, 59), ()])
def test_state_carries_windows_over_any_cut(splits):
    rng = np.random.default_rng(5)
    v = np.where(rng.random(60) < 0.2, np.nan, rng.normal(size=60))
    whole, _ = window_columns(v, 60, np.nan, "v", (1, 5), (3, 6), True)
    parts, filled, ring = [], np.nan, np.empty(0)
    for a, b in zip((0, *splits), (*splits, 60)):
        values = np.r_[ring, v[a:b]]
        columns, filled = window_columns(values, b - a, filled, "v", (1, 5), (3, 6), True)
        parts.append(columns)
        ring = values[-5:]
    for name, column in whole.items():
        assert np.allclose(np.concatenate([p[name] for p in parts]), column, equal_nan=True)


def test_late_tied_and_timeless_rows_come_out_marked(spark, tmp_path):
    folder = str(tmp_path / "in")
    h = lambda i: T0 + dt.timedelta(hours=i)
    _land(spark, folder, "a", [("x", h(i), float(i)) for i in range(10)] + [("x", None, 7.0)])
    got, _ = _run(spark, folder, str(tmp_path / "out"), str(tmp_path / "ck"), delay_seconds=3 * 3600)
    _land(spark, folder, "b", [("x", h(2), 99.0), ("x", h(8), 98.0), ("x", h(20), 20.0)])
    got, _ = _run(spark, folder, str(tmp_path / "out"), str(tmp_path / "ck"), delay_seconds=3 * 3600)    # restarted from its state
    rows = got.collect()
    assert sorted((r.ts, r.v) for r in rows if r.status == "ok") == [(h(i), float(i)) for i in range(10)]
    assert {(r.status, r.ts, r.v) for r in rows if r.status != "ok"} == {("late", h(2), 99.0), ("tie", h(8), 98.0), ("no_time", None, 7.0)}
    assert all(r.v_lag_1 is None for r in rows if r.status != "ok")
    assert {r.ts: r.v_lag_3 for r in rows if r.status == "ok"}[h(9)] == 6.0
    assert got.filter(F.col("ts") == F.lit(h(20))).count() == 0      # still waiting


def test_an_idle_series_puts_out_what_it_holds(spark, tmp_path):
    import time

    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    _land(spark, folder, "a", [("x", T0 + dt.timedelta(hours=i), float(i)) for i in range(5)])
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    q = (stream_windows(stream, "v", "ts", ["ba"], (1,), delay_seconds=1e6, idle_ms=500).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="300 milliseconds").start())
    try:
        for _ in range(100):
            time.sleep(0.5)
            if spark.read.schema("v double").parquet(out).count() == 5 if os.path.isdir(out) else False:
                break
        assert sorted((r.v, r.v_lag_1) for r in spark.read.parquet(out).collect()) == [(0.0, None), (1.0, 0.0), (2.0, 1.0), (3.0, 2.0), (4.0, 3.0)]
    finally:
        q.stop()
