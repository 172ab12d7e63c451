"""Plan checks: one Window operator for a stage's feature
columns, SinglePartition only on the small prefix frames, pruning and
pushdown into scans."""

import re
import tempfile

from tidewise.plans import features as fe
from tidewise.sources import landed as ld
from tidewise.sources import store as sto
from tidewise.sources import views as vw


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_weather_stage_uses_one_feature_window(spark, sf_small):
    plan = _plan(fe.weather_features(vw.v_weather(spark, sf_small)))
    windows = re.findall(r"\bWindow \[", plan)
    # prefix sum over the bucket counts, row number inside buckets, and a
    # single Window evaluating all 34 lag/rolling columns
    assert len(windows) == 3
    single = re.findall(r"Exchange SinglePartition", plan)
    assert len(single) == 1  # the per-month count frame only


def test_view_scan_reads_only_needed_columns(spark, sf_small):
    # the shared daily lineitem aggregate reads the five columns its views
    # use, out of eleven
    plan = vw.daily_lineitem(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    m = re.search(r"FileScan parquet \[([^\]]*)\]", plan)
    assert m and set(re.sub(r"#\d+", "", x) for x in m.group(1).split(",")) == {
        "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_extendedprice"}


def test_a_matrix_scans_each_fact_table_once_for_its_daily_views(spark, sf_small):
    from collections import Counter

    from tidewise.operators.joins import feature_matrix

    for options in ({}, {"rollup_entities": True}, {"mode": "asof", "rollup_entities": True}):
        df = feature_matrix(ld.tables(spark, sf_small), **options)
        df.collect()
        ran = _plan(df).split("== Initial Plan ==")[0]
        scans = Counter(re.findall(r"FileScan parquet .*?/([a-z]+)\.parquet", ran))
        # orders: daily views, and the regional weather that joins customers
        assert scans == {"orders": 2, "lineitem": 1, "events": 1, "customer": 1, "nation": 1, "region": 1}, options


def test_a_view_on_its_own_reads_its_columns_only(spark, sf_small):
    scan = re.search(r"FileScan parquet \[([^\]]*)\].*", _plan(vw.v_storage(spark, sf_small)))
    assert set(re.sub(r"#\d+", "", x) for x in scan.group(1).split(",")) == {"l_shipdate", "l_quantity"}


def test_stored_scan_prunes_partitions(spark, sf_small):
    root = tempfile.mkdtemp(prefix="tidewise-prune-")
    sto.append(ld.weather_daily(spark, sf_small), root, "weather_daily")
    q = sto.scan_range(sto.read_stored(spark, root, "weather_daily"), "weather_daily", "1996-03-05", "1996-04-20")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(ym" in plan and "1996-03" in plan
    assert "GreaterThanOrEqual(date,1996-03-05)" in plan
    assert all(r.date.isoformat() >= "1996-03-05" and r.date.isoformat() <= "1996-04-20" for r in q.collect())


def _text(df):
    return df._jdf.queryExecution().toString()


def test_training_window_bounds_reach_the_scans(spark, sf_small):
    import re

    from tidewise.registry import QUERIES

    plan = _text(QUERIES["p11_training_window"](spark, sf_small))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p for p in pushed)
    assert any("GreaterThanOrEqual(l_shipdate" in p for p in pushed)


def test_asof_matrix_has_one_lookup_per_date(spark, sf_small):
    from tidewise.operators.joins import feature_matrix
    from tidewise.sources import landed

    plan = _text(feature_matrix(landed.tables(spark, sf_small), mode="asof")).split("== Physical Plan ==")[1]
    # the fill's windows run over dates, not over date x region x balancing area
    for line in plan.splitlines():
        if "Window [" in line and "_r0" in line:
            assert "region" not in line and "ba#" not in line


def test_exact_quantiles_agree_across_the_size_boundary(spark):
    import numpy as np

    from tidewise.operators.impute import exact_quantiles

    rng = np.random.default_rng(3)
    accuracy = 20
    for n in (4 * accuracy - 1, 4 * accuracy, 4 * accuracy + 1, 400, 1500):
        v = np.round(rng.normal(size=n), 1)  # many ties
        df = spark.createDataFrame([(float(x), float(i % 7)) for i, x in enumerate(v)], "v double, w double")
        got = {(r.name, r.q): r.value for r in exact_quantiles(df, ["v", "w"], [0.1, 0.5, 0.9], accuracy=accuracy).collect()}
        for q in (0.1, 0.5, 0.9):
            assert abs(got["v", q] - np.quantile(v, q)) < 1e-12
            assert abs(got["w", q] - np.quantile(np.arange(n) % 7, q)) < 1e-12


def test_parts_hold_their_share_when_values_crowd(spark):
    """99 % of the values lie in a millionth of the range."""
    import numpy as np

    from tidewise.operators.impute import exact_quantiles, ranked_parts

    rng = np.random.default_rng(8)
    v = np.r_[rng.random(39_600) * 1e-6, rng.random(400) * 1e9 - 5e8]
    df = spark.createDataFrame(enumerate(v.tolist()), "id long, v double").repartition(6)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        parts = ranked_parts(df.selectExpr("'v' as g", "v", "1L as m"), ["g"])
        sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1.5 * 40_000 / 8
        ranges = parts.groupBy("part").agg({"v": "min"}).orderBy("part").collect()
        assert [r[1] for r in ranges] == sorted(r[1] for r in ranges)
        for accuracy in (50, 20_000):   # a narrow band inside the crowd, and the whole range
            got = {r.q: r.value for r in exact_quantiles(df, ["v"], [0.1, 0.5, 0.9, 0.997], accuracy=accuracy).collect()}
            assert all(abs(got[q] - np.quantile(v, q)) <= 1e-12 * max(1, abs(got[q])) for q in got)
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)


def test_quantiles_of_groups_with_null_keys_and_null_values(spark):
    import numpy as np

    from tidewise.operators.impute import exact_quantiles

    rng = np.random.default_rng(9)
    rows = [(None if g == 0 else f"g{g}", None if i % 5 == 0 else float(rng.integers(0, 50)), None) for g in range(3) for i in range(200 * (g + 1))]
    df = spark.createDataFrame(rows, "g string, v double, none double")
    got = {(r.g, r.name, r.q): r.value for r in exact_quantiles(df, ["v", "none"], [0.25, 0.5], ["g"], accuracy=30).collect()}
    want = {(g, "v", q): float(np.quantile([r[1] for r in rows if r[0] == g and r[1] is not None], q))
            for g in (None, "g1", "g2") for q in (0.25, 0.5)}
    assert got == want
