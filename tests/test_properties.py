"""Property tests: the halo plan equals the plain window for random series,
bucket sizes and look-backs; fold formulas equal the loop bounds."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewise.operators.weather import lag_cols, rolling_cols
from tidewise.plans import backtest as bt
from tidewise.plans.ordered import windowed


@settings(max_examples=300, deadline=None)
@given(n=st.integers(0, 2000), w=st.integers(1, 300), s=st.integers(1, 100))
def test_fold_count_equals_loop(n, w, s):
    assert bt.fold_count(n, w, s) == len(range(w, n - s, s))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    lengths=st.lists(st.integers(1, 60), min_size=1, max_size=3),
    bucket=st.integers(8, 40),
    look=st.integers(1, 7),
    seed=st.integers(0, 1000),
)
def test_halo_equals_plain(spark, lengths, bucket, look, seed):
    if look >= bucket:
        look = bucket - 1
    rows = []
    for k, n in enumerate(lengths):
        d0 = dt.date(2020, 1, 1) + dt.timedelta(days=seed % 50)
        for i in range(n):
            v = None if (i * 7 + seed) % 9 == 0 else float((i * 31 + seed) % 17)
            rows.append((f"k{k}", d0 + dt.timedelta(days=i * (1 + seed % 3)), v))
    df = spark.createDataFrame(rows, "k string, date date, v double")

    def build(w):
        return lag_cols(w, "v", [1, look]) + rolling_cols(w, "v", [look + 1])

    a = windowed(df, build, "date", ["k"], look, "halo", bucket_rows=bucket).orderBy("k", "date").collect()
    b = windowed(df, build, "date", ["k"], look, "partition").orderBy("k", "date").collect()
    assert len(a) == len(b) == len(rows)
    for x, y in zip(a, b):
        for c in x.asDict():
            u, v = x[c], y[c]
            if isinstance(u, float) and isinstance(v, float):
                assert abs(u - v) <= 1e-9 * max(1.0, abs(u), abs(v))
            else:
                assert u == v
