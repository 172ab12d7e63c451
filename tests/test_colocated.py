"""Co-located tables: same rows, no exchange on the fact sides."""

import datetime as dt
import re

import numpy as np
import pytest

from tidewise.operators import joins as jn
from tidewise.sources import colocated as cl
from tidewise.sources import landed as ld


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast: every join has to co-locate its sides."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _below_exchange(plan):
    """The scans under an exchange."""
    out, depth = [], None
    for line in plan.split("\n"):
        at = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if depth is not None and at <= depth:
            depth = None
        if depth is None and "Exchange" in line:
            depth = at
        elif depth is not None and "FileScan" in line:
            out.append(re.search(r"colocated_([a-z_]+)_[0-9a-f]{12}", line)[1])
    return out


def test_feature_matrix_of_bucketed_tables_shuffles_nothing(spark, sf_small, tmp_path, shuffled_joins):
    plain = {k: v.cache() for k, v in ld.tables(spark, sf_small).items()}
    stored = cl.write_by_date(plain, f"file:{tmp_path}/db", buckets=8)
    for options in ({}, {"rollup_entities": True}, {"start": "1995-01-01", "end": "1996-06-30", "rollup_entities": True}):
        got = jn.feature_matrix(stored, **options)
        assert "Exchange" not in _plan(got), _plan(got)
        want = jn.feature_matrix(plain, **options)
        key = lambda r: str(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    asof = jn.feature_matrix(stored, mode="asof", rollup_entities=True)
    assert not set(_below_exchange(_plan(asof))) & {"power_burn", "weather_daily"}
    assert asof.count() == plain["prices"].count()
    assert "Exchange" in _plan(jn.feature_matrix(plain))     # what the layout saves


def test_a_later_session_opens_the_layout(spark, tmp_path, shuffled_joins):
    root = f"file:{tmp_path}/db"
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(i), float(i)) for i in range(50)], "date date, `odd name` double")
    cl.write_table(df, root, "a", ["date"], 4)
    cl.write_table(df.withColumnRenamed("odd name", "w"), root, "b", ["date"], 4)
    for t in "ab":
        spark.sql(f"drop table {cl._name(root, t)}")      # as a new session: the files stay
    a, b = cl.open_table(spark, root, "a"), cl.open_table(spark, root, "b")
    joined = a.join(b, "date")
    assert "Exchange" not in _plan(joined) and joined.count() == 50
    assert sorted(a.collect()) == sorted(df.collect())
    again = cl.write_table(df.limit(3), root, "a", ["date"], 4)
    assert again.count() == 3


def test_asof_of_stored_tables_equals_the_general_join(spark, tmp_path, shuffled_joins):
    rng = np.random.default_rng(7)
    day = lambda i: dt.date(2023, 1, 1) + dt.timedelta(int(i))
    left = spark.createDataFrame([(k, day(i), float(i)) for k in ("a", "b", None, "none") for i in sorted(rng.choice(700, 200, False))],
                                 "k string, date date, x double")
    right = spark.createDataFrame(
        [(k, day(i), None if rng.random() < 0.2 else float(rng.integers(0, 99)), int(i)) for k in ("a", "b", None, "other")
         for i in sorted(rng.choice(700, 25, False))], "k string, d date, v double, n int")
    root = f"file:{tmp_path}/db"
    ls, rs = cl.write_by_month(left, root, "l", "date", ["k"], 8), cl.write_by_month(right, root, "r", "d", ["k"], 8)
    got = cl.asof_stored(ls, rs, "date", "d", ["v", "n"], ["k"])
    want = jn.asof_join(left, right.filter("k is not null"), "date", "d", ["v", "n"], ["k"])
    pick = ["k", "date", "x", "v", "n"]
    assert sorted(map(str, got.select(*pick).collect())) == sorted(map(str, want.select(*pick).collect()))
    # the only scan under an exchange is grouped to months first
    plan = _plan(got)
    for part in re.split(r"\n(?=[^\n]*Exchange)", plan)[1:]:
        assert part.index("Aggregate") < part.index("FileScan") if "FileScan" in part else True, part
    assert plan.count("Bucketed: true") == plan.count("FileScan")
