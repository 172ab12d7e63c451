"""Synthetic daily series for demos and tests (not a registered job -
it reads no landed table). Generated with ``spark.range`` so any length is
produced in parallel; the noise comes from Spark's seeded ``randn`` and is
therefore not numpy's stream (only the shape of the data is the same)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the demo series: (base, seasonal amplitude, noise sd).
HDD = (20.0, 30.0, 5.0)
CDD = (10.0, 20.0, 3.0)
STORAGE = (3000.0, 500.0, 100.0)
TEMPERATURE = (50.0, 30.0, 5.0)
PRODUCTION = (100.0, 0.1, 5.0)  # base, trend per day, noise sd
PRICE = {"base": 3.0, "hdd": 0.01, "cdd": 0.005, "storage": -0.0001, "production": 0.001, "noise": 0.1,
         "floor": 0.5}


def sample_series(spark: SparkSession, n: int = 1000, start: str = "2020-01-01", seed: int = 42,
                  clip: bool = True, partitions: int | None = None) -> DataFrame:
    """Daily (date, spot_price, hdd, cdd, storage, temperature, production):
    365-day sinusoid plus gaussian noise; hdd/cdd clipped at 0 and the price
    at 0.5 when ``clip``."""
    base = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    i = F.col("id").cast("double")
    s = F.sin(F.lit(2 * math.pi) * i / F.lit(365.0))

    def seasonal(spec, k):
        b, a, sd = spec
        return F.lit(b) + F.lit(a) * s + F.randn(seed + k) * F.lit(sd)

    hdd, cdd = seasonal(HDD, 1), seasonal(CDD, 2)
    if clip:
        hdd, cdd = F.greatest(hdd, F.lit(0.0)), F.greatest(cdd, F.lit(0.0))
    x = base.select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"),
        hdd.alias("hdd"), cdd.alias("cdd"), seasonal(STORAGE, 3).alias("storage"),
        seasonal(TEMPERATURE, 4).alias("temperature"),
        (F.lit(PRODUCTION[0]) + F.lit(PRODUCTION[1]) * i + F.randn(seed + 5) * F.lit(PRODUCTION[2]))
        .alias("production"),
        (F.randn(seed + 6) * F.lit(PRICE["noise"])).alias("_noise"),
    )
    price = (F.lit(PRICE["base"]) + F.lit(PRICE["hdd"]) * F.col("hdd") + F.lit(PRICE["cdd"]) * F.col("cdd")
             + F.lit(PRICE["storage"]) * F.col("storage") + F.lit(PRICE["production"]) * F.col("production")
             + F.col("_noise"))
    if clip:
        price = F.greatest(price, F.lit(PRICE["floor"]))
    return x.select("date", price.alias("spot_price"), "hdd", "cdd", "storage", "temperature", "production")
