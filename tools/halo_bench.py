"""W2 on one long generated series: plain single-partition window versus
the halo-bucket plan. usage: python tools/halo_bench.py 1000000 10000000

Rows are one per second (a single key-less series), so the plain plan is an
``Exchange SinglePartition`` followed by one sorted task; the halo plan
indexes rows by day buckets and windows over 131,072-row buckets.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidewise.operators.weather import lag_cols, rolling_cols  # noqa: E402
from tidewise.plans.ordered import windowed  # noqa: E402
from tidewise.session import get_spark  # noqa: E402


def series(spark, n):
    i = F.col("id")
    return spark.range(0, n, numPartitions=16).select(
        F.timestamp_seconds(F.lit(1_600_000_000) + i).alias("ts"),
        (F.sin(i.cast("double") / 86400.0) * 20 + F.randn(7) * 3 + 50).alias("temperature"),
    )


def main():
    spark = get_spark("local[8]", app_name="halo-bench", shuffle_partitions=16,
                      extra_conf={"spark.driver.memory": "16g"})

    def build(w):
        return lag_cols(w, "temperature", [1, 3, 7, 14, 30]) + rolling_cols(w, "temperature", [7, 14, 30])

    out = {}
    for n in [int(a) for a in sys.argv[1:]] or [1_000_000]:
        df = series(spark, n)
        for plan in ("partition", "halo"):
            t0 = time.perf_counter()
            windowed(df, build, "ts", (), 30, plan, coarse_unit="day").write.format("noop").mode("overwrite").save()
            out[f"{plan}_{n}"] = round(time.perf_counter() - t0, 2)
            spark.catalog.clearCache()
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
