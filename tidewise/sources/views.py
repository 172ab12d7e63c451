"""Time-series inputs derived from the landed TPC-H style tables.

Each view turns a fact table into one of the series the feature library
consumes (daily prices, daily weather, weekly storage, ...). Nulls are injected
deterministically (fixed day-of-month / ISO week) because the landed tables
carry none and the null rules are the riskiest part of the library.

Every builder has a twin SQL text in ``VIEW_SQL`` used as a common table
expression by the DuckDB oracle; both must give identical rows. Sums are exact
(integer cents here, DECIMAL in the twins), so they do not depend on
summation order.

All builders are aggregations: partial (map-side) aggregation runs before the
shuffle, so at any scale the shuffle carries one row per (task, group).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.sources.tables import Bounds, read_table


def _cents(c: str | Column) -> Column:
    """A fixed-point amount with two decimals as an exact count of cents.

    The summed TPC-H fields (prices, quantities, rates, event values) are
    two-decimal fixed-point values by definition; for them
    floor(x * 100 + 0.5) is the exact cent count - the same value the SQL
    twins obtain with ``cast(x as decimal(18,2))`` - computed with primitive
    arithmetic instead of a per-value decimal conversion. A value with more
    digits fails the job instead of being rounded.
    """
    col = F.col(c) if isinstance(c, str) else c
    cents = F.floor(col * F.lit(100.0) + F.lit(0.5))
    excess = F.abs(col * F.lit(100.0) - cents) > F.lit(1e-4)
    return F.when(excess, F.raise_error(F.lit("an amount has more than two decimals")).cast("long")).otherwise(cents)


def _csum(c: str | Column) -> Column:
    """Exact, order-independent sum in cents (64-bit integer)."""
    return F.sum(_cents(c))


def _as_amount(cents: str | Column) -> Column:
    """Cents back to a double: the correctly rounded value of cents / 100,
    i.e. what casting the exact decimal sum to double gives."""
    col = F.col(cents) if isinstance(cents, str) else cents
    return col.cast("double") / F.lit(100.0)


def _dsum(c: str | Column) -> Column:
    """Exact sum of a two-decimal amount, returned as double."""
    return _as_amount(_csum(c))


# One daily aggregate per fact table serves every view of that table: the
# weekly and monthly views roll the daily sums up (exact, so equal to
# aggregating the raw rows directly). In a plan that needs several views (the
# feature matrix) the aggregates' exchanges are equal, so Spark computes one
# and reuses it: nothing stays cached. They stay equal because a daily row comes
# out of one packed value: what a view needs of it, or joins it by, does not reach
# below. (So a view on its own, which should read its own columns only and take
# filters down to the scan, is not ``shared``.)
def _daily(days: DataFrame, shared: bool) -> DataFrame:
    return days.select(F.inline(F.array(F.struct(*days.columns)))) if shared else days


def daily_orders(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """orders per (order date, status): exact price sum (cents) and order count."""
    o = read_table(spark, sf_dir, "orders", "o_orderdate", bounds)
    return _daily(o.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("status")).agg(
        _csum("o_totalprice").alias("s"), F.count(F.lit(1)).alias("n")), shared)


def daily_lineitem(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """lineitem per ship date: exact sums (cents) of quantity, discount, tax
    and extended price, and the line count."""
    li = read_table(spark, sf_dir, "lineitem", "l_shipdate", bounds)
    return _daily(li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        _csum("l_quantity").alias("q"), _csum("l_discount").alias("d"), _csum("l_tax").alias("t"),
        _csum("l_extendedprice").alias("e"), F.count(F.lit(1)).alias("n")), shared)


def v_prices(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    d = daily_orders(spark, sf_dir, bounds, shared).groupBy("date").agg(F.sum("s").alias("_s"), F.sum("n").alias("_n"))
    return d.select(
        "date",
        F.when(F.dayofmonth("date") == 13, F.lit(None))
        .otherwise(_as_amount("_s") / F.col("_n") / 100000)
        .cast("double")
        .alias("spot_price"),
    )


def v_weather(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    d = daily_lineitem(spark, sf_dir, bounds, shared)
    return d.select(
        "date",
        F.when(F.dayofmonth("date") == 17, F.lit(None))
        .otherwise(_as_amount("q") / F.col("n") * 2.6)
        .cast("double")
        .alias("temperature"),
        (_as_amount("d") / F.col("n") * 100).alias("wind_speed"),
    )


# Fixed mapping from TPC-H region names to the four gas-demand regions.
REGION_NAME_MAP = {
    "AMERICA": "Northeast",
    "ASIA": "Midwest",
    "AFRICA": "South",
    "EUROPE": "West",
}


def v_weather_region(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderdate", bounds).select("o_custkey", "o_orderdate", "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions;
    # customer grows with the data and is left to AQE (shuffle or broadcast
    # decided from runtime size).
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")
    region = F.col("r_name")
    mapped = F.lit("Other")
    for k, v in reversed(list(REGION_NAME_MAP.items())):
        mapped = F.when(region == k, F.lit(v)).otherwise(mapped)
    return (
        o.join(cust, o.o_custkey == cust.c_custkey)
        .groupBy(F.to_date("o_orderdate").alias("date"), "r_name")
        .agg(_dsum("o_totalprice").alias("_s"), F.count(F.lit(1)).alias("_n"))
        .select("date", mapped.alias("region"), (F.col("_s") / F.col("_n") / 3850).alias("temperature"))
    )


def v_forecast(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    d = daily_lineitem(spark, sf_dir, bounds, shared).filter(F.col("date") >= F.lit("1998-01-01").cast("date"))
    return d.select("date", (_as_amount("t") / F.col("n") * 1600).alias("temperature"))


def v_storage(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    wk = F.date_trunc("week", "date")
    w = daily_lineitem(spark, sf_dir, bounds, shared).groupBy(wk.alias("_wk")).agg(F.sum("q").alias("_q"), F.sum("n").alias("_n"))
    return w.select(
        F.to_date("_wk").alias("date"),
        F.when(F.weekofyear("_wk") == 30, F.lit(None)).otherwise(_as_amount("_q")).cast("double")
        .alias("working_gas"),
        F.when(F.weekofyear("_wk") == 31, F.lit(0.0)).otherwise(F.col("_n").cast("double") * 25.5)
        .alias("five_year_avg"),
    )


def v_power(spark: SparkSession, sf_dir: str, bounds: Bounds = None) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "ts", bounds)
    return (
        ev.groupBy(F.date_trunc("hour", "ts").alias("ts"), F.col("event_type").alias("ba"))
        .agg(_dsum("value").alias("total_load"))
    )


def v_production(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    m = daily_orders(spark, sf_dir, bounds, shared).groupBy(F.date_trunc("month", "date").alias("_m")).agg(F.sum("s").alias("_s"))
    return m.select(F.to_date("_m").alias("month"), (_as_amount("_s") / 1000000).alias("dry_gas_bcfpd"))


def v_rigs(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    st = F.col("status")
    w = daily_orders(spark, sf_dir, bounds, shared).groupBy(F.date_trunc("week", "date").alias("_w")).agg(
        F.sum("n").cast("int").alias("total_rigs"),
        F.sum(F.when(st == "O", F.col("n")).otherwise(0)).cast("int").alias("oil_rigs"),
        F.sum(F.when(st == "F", F.col("n")).otherwise(0)).cast("int").alias("gas_rigs"),
    )
    return w.select(F.to_date("_w").alias("date"), "total_rigs", "oil_rigs", "gas_rigs")


def v_lng(spark: SparkSession, sf_dir: str, bounds: Bounds = None, shared: bool = False) -> DataFrame:
    """Monthly LNG exports stand-in: shipped value and line count per month."""
    m = daily_lineitem(spark, sf_dir, bounds, shared).groupBy(F.date_trunc("month", "date").alias("_m")).agg(
        F.sum("e").alias("_s"), F.sum("n").alias("_n"))
    return m.select(
        F.to_date("_m").alias("month"),
        (_as_amount("_s") / 1000000).alias("exports_bcf"),
        (F.col("_n").cast("double") / 1000).alias("lng_capacity_bcfpd"),
    )


VIEWS = {
    "v_prices": v_prices,
    "v_weather": v_weather,
    "v_weather_region": v_weather_region,
    "v_forecast": v_forecast,
    "v_storage": v_storage,
    "v_power": v_power,
    "v_production": v_production,
    "v_rigs": v_rigs,
    "v_lng": v_lng,
}


# DuckDB twins of the builders above (also valid Spark SQL).
VIEW_SQL = {
    "v_prices": """
select cast(o_orderdate as date) as date,
  case when day(o_orderdate) = 13 then null else cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) / 100000 end as spot_price
from orders group by cast(o_orderdate as date), day(o_orderdate)""",
    "v_weather": """
select cast(l_shipdate as date) as date,
  case when day(l_shipdate) = 17 then null else cast(sum(cast(l_quantity as decimal(18,2))) as double) / count(*) * 2.6 end as temperature,
  cast(sum(cast(l_discount as decimal(18,2))) as double) / count(*) * 100 as wind_speed
from lineitem group by cast(l_shipdate as date), day(l_shipdate)""",
    "v_weather_region": """
select cast(o_orderdate as date) as date,
  case r_name when 'AMERICA' then 'Northeast' when 'ASIA' then 'Midwest' when 'AFRICA' then 'South' when 'EUROPE' then 'West' else 'Other' end as region,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) / 3850 as temperature
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by cast(o_orderdate as date), r_name""",
    "v_forecast": """
select cast(l_shipdate as date) as date,
  cast(sum(cast(l_tax as decimal(18,2))) as double) / count(*) * 1600 as temperature
from lineitem where l_shipdate >= timestamp '1998-01-01 00:00:00' group by cast(l_shipdate as date)""",
    "v_storage": """
select cast(date_trunc('week', l_shipdate) as date) as date,
  case when weekofyear(date_trunc('week', l_shipdate)) = 30 then null else cast(sum(cast(l_quantity as decimal(18,2))) as double) end as working_gas,
  case when weekofyear(date_trunc('week', l_shipdate)) = 31 then cast(0 as double) else cast(count(*) as double) * 25.5 end as five_year_avg
from lineitem group by date_trunc('week', l_shipdate)""",
    "v_power": """
select date_trunc('hour', ts) as ts, event_type as ba,
  cast(sum(cast(value as decimal(18,2))) as double) as total_load from events group by date_trunc('hour', ts), event_type""",
    "v_production": """
select cast(date_trunc('month', o_orderdate) as date) as month,
  cast(sum(cast(o_totalprice as decimal(18,2))) as double) / 1000000 as dry_gas_bcfpd from orders group by date_trunc('month', o_orderdate)""",
    "v_rigs": """
select cast(date_trunc('week', o_orderdate) as date) as date, cast(count(*) as int) as total_rigs,
  cast(sum(case when o_orderstatus = 'O' then 1 else 0 end) as int) as oil_rigs,
  cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as int) as gas_rigs from orders group by date_trunc('week', o_orderdate)""",
    "v_lng": """
select cast(date_trunc('month', l_shipdate) as date) as month,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / 1000000 as exports_bcf,
  cast(count(*) as double) / 1000 as lng_capacity_bcfpd
from lineitem group by date_trunc('month', l_shipdate)""",
}


def ctes(*names: str) -> str:
    """``with v1 as (...), v2 as (...)`` for the named views; callers may
    append further ``, name as (...)`` clauses before their select."""
    body = ",\n".join(f"{n} as ({VIEW_SQL[n].strip()})" for n in names)
    return f"with {body}"


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named views as common table expressions."""
    return f"{ctes(*names)}\n{sql}"
