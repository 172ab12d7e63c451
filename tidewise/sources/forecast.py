"""Forecast payloads ``{"properties": {"periods": [...]}}`` (S3), station
tagging (S4) and the weather bundle (S5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.operators.weather import degree_days
from tidewise.sources.series import from_payload

FORECAST_SCHEMA = T.StructType([
    T.StructField("properties", T.StructType([
        T.StructField("periods", T.ArrayType(T.StructType([
            T.StructField("startTime", T.StringType()),
            T.StructField("temperature", T.DoubleType()),
            T.StructField("windSpeed", T.StringType()),
            T.StructField("probabilityOfPrecipitation", T.StructType([T.StructField("value", T.DoubleType())])),
        ]))),
    ])),
])

# Fixed station list: name, latitude, longitude, region.
STATIONS = [
    ("New York", 40.7128, -74.0060, "Northeast"),
    ("Chicago", 41.8781, -87.6298, "Midwest"),
    ("Houston", 29.7604, -95.3698, "South"),
    ("Los Angeles", 34.0522, -118.2437, "West"),
    ("Boston", 42.3601, -71.0589, "Northeast"),
    ("Atlanta", 33.7490, -84.3880, "South"),
]


def station_region(station: F.Column) -> F.Column:
    """Region of a station (literal six-entry map; NULL for unknown)."""
    m = F.create_map(*[e for n, _, _, r in STATIONS for e in (F.lit(n), F.lit(r))])
    return m[station]


def region_stations(region: F.Column) -> F.Column:
    """Stations of a region as an array (empty for a region with none)."""
    by_region: dict[str, list[str]] = {}
    for n, _, _, r in STATIONS:
        by_region.setdefault(r, []).append(n)
    m = F.create_map(*[e for r, ns in by_region.items() for e in (F.lit(r), F.array(*[F.lit(n) for n in ns]))])
    return F.coalesce(m[region], F.array().cast("array<string>"))


def parse_forecast(payloads: DataFrame, days: int = 14, payload_col: str = "payload",
                   keep: tuple[str, ...] = ("station",), on_corrupt: str = "raise") -> DataFrame:
    """S3: first ``days`` periods of each payload -> (keep..., period_no, date,
    temperature, wind_speed, wind_mph, precipitation).

    The date is the local calendar date written in ``startTime`` (its first
    ten characters, no time-zone shift); ``wind_speed`` keeps the text
    (missing -> ""), ``wind_mph`` is its leading number; a missing
    precipitation object gives 0, an explicit null value stays null. A corrupt
    payload fails the job unless ``on_corrupt="skip"``
    (``series.corrupt_payloads`` with ``FORECAST_SCHEMA`` returns it).
    """
    p = payloads.select(*keep, from_payload(F.col(payload_col), FORECAST_SCHEMA, on_corrupt).alias("_p"))
    first = p.select(*keep, F.posexplode(F.slice(F.col("_p.properties.periods"), 1, days)).alias("period_no", "_r"))
    r = F.col("_r")
    pop = r["probabilityOfPrecipitation"]
    wind = F.coalesce(r["windSpeed"], F.lit(""))
    return first.select(
        *keep,
        "period_no",
        F.to_date(F.substring(r["startTime"], 1, 10)).alias("date"),
        r["temperature"].alias("temperature"),
        wind.alias("wind_speed"),
        F.regexp_extract(wind, r"(\d+)", 1).try_cast("double").alias("wind_mph"),
        F.when(pop.isNull(), F.lit(0.0)).otherwise(pop["value"]).alias("precipitation"),
    )


def regional_forecast(payloads: DataFrame, days: int = 14) -> DataFrame:
    """Parsed forecasts tagged with region via the station dimension;
    payloads of unknown stations are skipped, as are empty ones."""
    parsed = parse_forecast(payloads, days)
    return parsed.withColumn("region", station_region(F.col("station"))).filter(F.col("region").isNotNull())


def weather_bundle(payloads: DataFrame, history: DataFrame | None = None, days: int = 14) -> DataFrame:
    """Forecast, optional history and degree days in one long frame with
    a ``source`` column."""
    fc = regional_forecast(payloads, days).withColumn("source", F.lit("forecast"))
    out = fc
    if history is not None:
        out = out.unionByName(history.withColumn("source", F.lit("historical")), allowMissingColumns=True)
    dd = degree_days(out, keep_input=True)
    return dd


def forecast_pages(regional: DataFrame, spark: SparkSession) -> DataFrame:
    """Landing format built from a regional temperature frame: every station
    of a region gets the region's series, one payload per (station, ISO week).

    ``startTime`` carries a -05:00 offset late in the local evening, so its
    UTC instant falls on the next day (the parser must keep the local date).
    Wind text is "<n> mph" except on day 1 of a month (""), precipitation is
    missing on day 2, explicitly null on day 3, else 3 x day-of-month.
    """
    x = regional.withColumn("station", F.explode(region_stations(F.col("region"))))
    d = F.col("date")
    dom = F.dayofmonth(d)
    wind = F.when(dom == 1, F.lit("")).otherwise(
        F.concat(F.floor(F.col("temperature") / 10 + 0.5).cast("int").cast("string"), F.lit(" mph")))
    pop = (F.when(dom == 2, F.lit(None))
           .when(dom == 3, F.struct(F.lit(None).cast("double").alias("value")))
           .otherwise(F.struct((dom * 3).cast("double").alias("value"))))
    period = F.struct(
        F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T22:00:00-05:00")).alias("startTime"),
        F.col("temperature").alias("temperature"),
        wind.alias("windSpeed"),
        pop.alias("probabilityOfPrecipitation"),
    )
    wk = F.date_trunc("week", d)
    g = x.groupBy("station", wk.alias("_wk")).agg(F.array_sort(F.collect_list(period)).alias("periods"))
    return g.select("station", "_wk", F.to_json(F.struct(F.struct("periods").alias("properties"))).alias("payload"))
