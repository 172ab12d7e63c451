"""Stored-table frames built from the landed series (K3-K5 mapping).

The landed views play the role of the fetched series; each builder shapes
one into its stored table (columns, constants, typed NULLs), exactly as the
ingest step maps a series to a table. Values stay double here (features are
computed in double); ``store.conform`` casts to the stored DECIMAL types on
write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.functions.nulls import clip_lower
from tidewise.operators.power import gas_burn_proxy
from tidewise.operators.weather import BASE_TEMP
from tidewise.sources import views as vw
from tidewise.sources.tables import Bounds

def _null_d() -> F.Column:
    return F.lit(None).cast("double")


def prices(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """K3 henry-hub spot -> prices (hub constant, futures columns null)."""
    p = vw.v_prices(spark, sf_dir, bounds, shared)
    return p.select("date", F.lit("HenryHub").alias("hub"), "spot_price",
                    _null_d().alias("front_month"), _null_d().alias("m1_m2_spread"))


def storage_weekly(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """K3 storage -> storage_weekly; the declared deviation column is filled
    (D2: working_gas - five_year_avg), the week-over-week change is left to
    the window stage (null here, as ingested)."""
    s = vw.v_storage(spark, sf_dir, bounds, shared)
    return s.select(F.col("date").alias("report_date"), "working_gas", "five_year_avg",
                    (F.col("working_gas") - F.col("five_year_avg")).alias("yoy_deviation"),
                    _null_d().alias("wow_change"))


def production_monthly(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    return vw.v_production(spark, sf_dir, bounds, shared)


def lng_monthly(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """K3 lng exports -> lng_monthly (price null, notes empty)."""
    lng = vw.v_lng(spark, sf_dir, bounds, shared)
    return lng.select("month", "exports_bcf", _null_d().alias("avg_price"), F.lit("").alias("terminal_notes"),
                      "lng_capacity_bcfpd")


def power_burn(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """K5 gas burn per balancing area and day; loads null."""
    burn = gas_burn_proxy(vw.v_power(spark, sf_dir, bounds), "ts", by=["ba"], out_col="gas_mwh")
    return burn.select("date", "ba", "gas_mwh", _null_d().alias("total_load_mwh"), _null_d().alias("renewables_mwh"))


def weather_daily(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """K4 regional temperatures -> weather_daily.

    Stations that share a region collide on (date, region); they are averaged
    before the write (one row per key). HDD/CDD are filled from P1.
    """
    w = vw.v_weather_region(spark, sf_dir, bounds).groupBy("date", "region").agg(F.avg("temperature").alias("temperature"))
    t = F.col("temperature")
    return w.select("date", "region", clip_lower(F.lit(BASE_TEMP) - t).alias("hdd"),
                    clip_lower(t - F.lit(BASE_TEMP)).alias("cdd"), _null_d().alias("hdd_norm_delta"),
                    _null_d().alias("cdd_norm_delta"), "temperature", _null_d().alias("wind_speed"))


def rigs_weekly(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    return vw.v_rigs(spark, sf_dir, bounds, shared)


BUILDERS = {
    "prices": prices,
    "storage_weekly": storage_weekly,
    "production_monthly": production_monthly,
    "lng_monthly": lng_monthly,
    "power_burn": power_burn,
    "weather_daily": weather_daily,
    "rigs_weekly": rigs_weekly,
}


def tables(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> dict[str, DataFrame]:
    """All stored-table frames; ``bounds`` limits the scans to the rows that
    stamps within them need. Frames of one fact table share its daily aggregate:
    a plan that uses several scans the table once for them."""
    return {k: f(spark, sf_dir, bounds, True) for k, f in BUILDERS.items()}


def latest_price_date(spark: SparkSession, sf_dir: str) -> str:
    """The last date of the price table, from a scan of its date column."""
    return str(vw.daily_orders(spark, sf_dir).agg(F.max("date")).first()[0])


# DuckDB twins (CTE bodies over the view CTEs).
TABLE_SQL = {
    "prices": "select date, 'HenryHub' as hub, spot_price, cast(null as double) as front_month, "
              "cast(null as double) as m1_m2_spread from v_prices",
    "storage_weekly": "select date as report_date, working_gas, five_year_avg, working_gas - five_year_avg as "
                      "yoy_deviation, cast(null as double) as wow_change from v_storage",
    "production_monthly": "select * from v_production",
    "lng_monthly": "select month, exports_bcf, cast(null as double) as avg_price, '' as terminal_notes, "
                   "lng_capacity_bcfpd from v_lng",
    "power_burn": "select cast(ts as date) as date, ba, coalesce(sum(total_load * 0.4), 0) as gas_mwh, "
                  "cast(null as double) as total_load_mwh, cast(null as double) as renewables_mwh from v_power "
                  "where ts is not null group by ba, cast(ts as date)",
    "weather_daily": "select date, region, case when t is null then null else greatest(65.0 - t, 0) end as hdd, "
                     "case when t is null then null else greatest(t - 65.0, 0) end as cdd, "
                     "cast(null as double) as hdd_norm_delta, cast(null as double) as cdd_norm_delta, "
                     "t as temperature, cast(null as double) as wind_speed from "
                     "(select date, region, avg(temperature) as t from v_weather_region group by date, region) x",
    "rigs_weekly": "select * from v_rigs",
}

TABLE_VIEWS = {
    "prices": ["v_prices"],
    "storage_weekly": ["v_storage"],
    "production_monthly": ["v_production"],
    "lng_monthly": ["v_lng"],
    "power_burn": ["v_power"],
    "weather_daily": ["v_weather_region"],
    "rigs_weekly": ["v_rigs"],
}


def tables_sql(*names: str) -> str:
    """``with`` clause defining the named stored tables (and their views)."""
    views: list[str] = []
    for n in names:
        for v in TABLE_VIEWS[n]:
            if v not in views:
                views.append(v)
    parts = [f"{v} as ({vw.VIEW_SQL[v].strip()})" for v in views]
    parts += [f"{n} as ({TABLE_SQL[n]})" for n in names]
    return "with " + ",\n".join(parts)
