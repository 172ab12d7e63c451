"""Registered jobs of the model half and of the edges: rejects, corrupt
payloads, null metrics, horizons, keyed comparisons, model facts. Imported by
``tidewise.registry``; same comparison form."""

from __future__ import annotations

import datetime
import uuid

import numpy as np
from pyspark.sql import functions as F

from tidewise import registry as rg
from tidewise.operators import extensions as ex
from tidewise.operators import joins as jn
from tidewise.operators import power as pw
from tidewise.operators import weather as wx
from tidewise.plans import backtest as bt
from tidewise.plans import features as fe
from tidewise.plans import models as md
from tidewise.plans import training as tr
from tidewise.plans.bands import running_bands
from tidewise.plans.ordered import add_row_index
from tidewise.plans.trees import Ensemble
from tidewise.registry import register, rsql
from tidewise.session import cut_lineage, scratch_path
from tidewise.sources import colocated as cl
from tidewise.sources import forecast as fc
from tidewise.sources import landed as ld
from tidewise.sources import payload_source as ps
from tidewise.sources import series as se
from tidewise.sources import store as sto
from tidewise.sources import views as vw
from tidewise.streaming.windows import stream_windows

W, S = rg.WF_WINDOW, rg.WF_STEP
_TEN = "cast(cast(spot_price as decimal(10,4)) as double)"


# ---------------------------------------------------------- rejects, corrupt
@register("k2_rejects", rsql(
    vw.with_views("""select date, hub, spot_price, reason from (
      select date, 'HenryHub' as hub, case day(date) when 9 then null else cast(cast(spot_price as decimal(10,4)) as double) end
        as spot_price, case day(date) when 5 then 'type' when 7 then 'null_key' when 9 then 'duplicate' else 'stored' end as reason
      from v_prices where spot_price is not null or day(date) <> 5) x
    union all select date, 'HenryHub', null, 'duplicate' from v_prices where day(date) = 9""", "v_prices")
    .replace("select date, hub, spot_price, reason from (", """select date, case when reason = 'null_key' then null else hub end as hub,
      case when reason = 'stored' then spot_price end as spot_price, reason from (""", 1), ["spot_price"]))
def q_k2_rejects(spark, sf_dir):
    """K2: a batch with a price that does not fit (day 5), a missing hub (day
    7) and conflicting rows (day 9) is split: accepted rows are stored and
    read back, the others come back with their reason."""
    p = ld.prices(spark, sf_dir).filter("spot_price is not null or day(date) <> 5")
    day = F.dayofmonth("date")
    batch = p.withColumns({"spot_price": F.when(day == 5, F.lit(1e12)).otherwise(F.col("spot_price")),
                           "hub": F.when(day == 7, F.lit(None)).otherwise(F.col("hub"))})
    clash = p.filter(day == 9).withColumn("spot_price", F.coalesce(F.col("spot_price"), F.lit(0.0)) + 1)
    root = scratch_path(spark, f"store/{uuid.uuid4().hex}")
    _, rejected = sto.append_accepted(batch.unionByName(clash), root, "prices")
    stored = sto.read_stored(spark, root, "prices").select(
        "date", "hub", F.col("spot_price").cast("double").alias("spot_price"), F.lit("stored").alias("reason"))
    return stored.unionByName(rejected.select(F.col("date").cast("date").alias("date"), "hub",
                                              F.lit(None).cast("double").alias("spot_price"), "reason"))


@register("s1_corrupt_pages", rsql(
    vw.with_views("""select date, spot_price as value, cast(null as varchar) as page from v_prices
      where spot_price is not null and month(date) not in (6, 11)
    union all select distinct cast(null as date), cast(null as double), strftime(date, '%Y-%m') from v_prices
      where month(date) in (6, 11)""", "v_prices"), ["value"]))
def q_s1_corrupt(spark, sf_dir):
    """Price pages of which June's are cut and November's are plain text:
    the others parse, the corrupt ones are returned."""
    pages = se.pages(vw.v_prices(spark, sf_dir), "NG.RNGWHHD.D", "spot_price")
    month = F.substring("_page", 6, 2)
    broken = F.when(month == "06", F.expr("substring(payload, 1, cast(length(payload) / 2 as int))")).when(
        month == "11", F.lit("Service unavailable")).otherwise(F.col("payload"))
    pages = cut_lineage(pages.withColumn("payload", broken))
    good = se.parse_series(pages, on_corrupt="skip").select("date", "value", F.lit(None).cast("string").alias("page"))
    bad = se.corrupt_payloads(pages).select(F.lit(None).cast("date").alias("date"),
                                            F.lit(None).cast("double").alias("value"), F.col("_page").alias("page"))
    return good.unionByName(bad)


_LANDED = ("1995-03-10", "1997-08-05")


def _landed(spark, sf_dir) -> str:
    """Price and production pages as files of a landing folder."""
    folder = scratch_path(spark, f"landing/{uuid.uuid4().hex}")
    ps.write_payloads(se.pages(vw.v_prices(spark, sf_dir), "NG.RNGWHHD.D", "spot_price"), folder)
    ps.write_payloads(se.pages(vw.v_production(spark, sf_dir), "NG.N9010US2.M", "dry_gas_bcfpd", "month", monthly=True), folder)
    return folder


@register("s1_payload_files", rsql(f"""{vw.ctes('v_prices')} select 'NG.RNGWHHD.D' as key, strftime(date, '%Y-%m') as page, date,
    spot_price as value from v_prices where spot_price is not null and date between date '{_LANDED[0]}' and date '{_LANDED[1]}'""",
    ["value"]))
def q_s1_files(spark, sf_dir):
    """S1 as a data source: one series and a date window of a landing folder."""
    return ps.payloads(spark, _landed(spark, sf_dir), keys=["NG.RNGWHHD.D"], start=_LANDED[0], end=_LANDED[1],
                       on_corrupt="raise").select("key", "page", "date", "value")


@register("s1_payload_stream", rsql(f"""{vw.ctes('v_prices', 'v_production')} select 'NG.RNGWHHD.D' as key, date, spot_price as value
    from v_prices where spot_price is not null union all select 'NG.N9010US2.M', month, dry_gas_bcfpd from v_production""", ["value"]))
def q_s1_stream(spark, sf_dir):
    """S1 as a stream: the landing folder read to its end and started again,
    which adds nothing."""
    folder = _landed(spark, sf_dir)
    out, state = (scratch_path(spark, f"landed_{k}/{uuid.uuid4().hex}") for k in ("rows", "state"))
    for _ in range(2):
        query = (ps.payloads(spark, folder, on_corrupt="raise", stream=True).writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", state).trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.schema(ps.SCHEMAS["series"]).parquet(out).select("key", "date", "value")


_NULLED = rg._PRED_SQL.replace(", pred as (", ", pred0 as (") + (
    ", pred as (select model, fold, idx, date, case when fold % 3 = 1 and idx % 21 = 5 then null else actual end as actual, "
    "prediction from pred0)")
_STRICT_METRICS = (
    ", d as (select *, cast(sign(actual - lag(actual) over w) = sign(prediction - lag(prediction) over w) as double)"
    " as dir, actual is null as gone from pred window w as (partition by model, fold order by idx))"
    f", m as (select model, fold, fold * {S} as train_start, fold * {S} + {W - 1} as train_end, fold * {S} + {W} as"
    f" test_start, fold * {S} + {W + S - 1} as test_end,"
    " case when bool_or(gone) then null else avg(abs(actual - prediction)) end as mae,"
    " case when bool_or(gone) then null else sqrt(avg((actual - prediction) * (actual - prediction))) end as rmse,"
    " case when bool_or(gone) then null else avg(abs((actual - prediction) / nullif(actual, 0))) * 100 end as mape,"
    " case when bool_or(gone) then null else avg(dir) * 100 end as direction_accuracy,"
    " case when bool_or(gone) then null else 1 - avg((actual - prediction) * (actual - prediction)) /"
    " nullif(var_pop(actual), 0) end as r2, count(*) as n_test, count(*) filter (gone) as n_null,"
    " count(*) filter (actual = 0) as mape_skipped from d group by model, fold)")


@register("a4_null_metrics", rsql(f"{vw.ctes('v_prices', 'v_weather')}{_NULLED}{_STRICT_METRICS}\nselect * from m",
                                  ["mae", "rmse", "mape", "direction_accuracy", "r2"]))
def q_a4_null(spark, sf_dir):
    """A4 with NULL actuals in every third fold: those folds' metrics are NULL
    and the NULLs are counted."""
    pred = bt.walk_forward_lstsq(rg.walk_forward_input(spark, sf_dir), ["x"], "spot_price", W, S)
    gone = (F.col("fold") % 3 == 1) & (F.col("idx") % 21 == 5)
    return bt.fold_metrics(pred.withColumn("actual", F.when(~gone, F.col("actual"))), W, S)


# -------------------------------------------------------------- E1, S5, S6, K3
@register("e1_weather_features_region_weighted", rsql(f"""{vw.ctes('v_weather_region')}, h as (select date, region, temperature,
    {rg._hdd('temperature')} as hdd, {rg._cdd('temperature')} as cdd,
    case region when 'Northeast' then .25 when 'Midwest' then .2 when 'South' then .3 when 'West' then .25 else .1 end as w
  from v_weather_region), g as (select date, sum(hdd * w) as hw, sum(cdd * w) as cw from h group by date)
  select h.date, region, hdd as "HDD", cdd as "CDD", hw as "HDD_weighted", cw as "CDD_weighted",
    lag(hdd, 7) over s as "HDD_lag_7", case when count(temperature) over r = 14 then avg(temperature) over r end
      as temperature_rolling_14, hdd * cdd as "HDD_CDD_interaction"
  from h join g on h.date = g.date window s as (partition by region order by h.date),
    r as (partition by region order by h.date rows between 13 preceding and current row)""",
    ["HDD", "CDD", "HDD_weighted", "CDD_weighted", "HDD_lag_7", "temperature_rolling_14", "HDD_CDD_interaction"]))
def q_e1_region(spark, sf_dir):
    """E1 in full mode on rows of several regions: weighted sums of the date
    joined back, row-ordered stages per region (a few of the columns)."""
    w = vw.v_weather_region(spark, sf_dir).groupBy("date", "region").agg(F.avg("temperature").alias("temperature"))
    return fe.weather_features(w, mode="full").select(
        "date", "region", "HDD", "CDD", "HDD_weighted", "CDD_weighted", "HDD_lag_7", "temperature_rolling_14",
        "HDD_CDD_interaction")


@register("s6_power_bundle", rsql(f"""{vw.ctes('v_power')}
  select 'pjm' as source, cast(ts as date) as date, sum(total_load * 0.5) as gas_burn_mwh from v_power where ba = 'click' group by 2
  union all select 'ercot', cast(ts as date), sum(total_load * 0.4) from v_power where ba = 'view' group by 2""",
  ["gas_burn_mwh"]))
def q_s6(spark, sf_dir):
    """One source with gas_generation, one without, one empty."""
    p = vw.v_power(spark, sf_dir)
    return pw.power_bundle({
        "pjm": p.filter("ba = 'click'").withColumn("gas_generation", F.col("total_load") * 0.5),
        "ercot": p.filter("ba = 'view'"), "iso_ne": p.filter("false")})


@register("s5_weather_bundle", rsql(f"""{vw.ctes('v_weather_region')}, s as (select * from (values ('New York', 'Northeast'),
    ('Chicago', 'Midwest'), ('Houston', 'South'), ('Los Angeles', 'West'), ('Boston', 'Northeast'), ('Atlanta', 'South')) t(station, region)),
  x as (select station, v.date, temperature, v.region, 'forecast' as source from v_weather_region v join s on v.region = s.region
    union all select cast(null as varchar), date, temperature, region, 'historical' from v_weather_region)
  select station, date, region, source, temperature, {rg._hdd('temperature')} as "HDD", {rg._cdd('temperature')} as "CDD" from x""",
  ["temperature", "HDD", "CDD"]))
def q_s5(spark, sf_dir):
    """Forecast pages parsed, history appended, degree days of both."""
    r = vw.v_weather_region(spark, sf_dir)
    return fc.weather_bundle(fc.forecast_pages(r, spark), r).select(
        "station", "date", "region", "source", "temperature", "HDD", "CDD")


_STORED = {"prices": ("date", "spot_price", "decimal(10,4)"), "storage_weekly": ("report_date", "working_gas", "decimal(10,2)"),
           "production_monthly": ("month", "dry_gas_bcfpd", "decimal(10,2)"), "lng_monthly": ("month", "exports_bcf", "decimal(10,2)")}
_FROM_SERIES = [("prices", "v_prices", "date", "spot_price", "henry_hub_spot"),
                ("storage_weekly", "v_storage", "date", "working_gas", "storage"),
                ("production_monthly", "v_production", "month", "dry_gas_bcfpd", "production"),
                ("lng_monthly", "v_lng", "month", "exports_bcf", "lng_exports")]
_CHAIN = ("1995-01-01", "1997-12-31")


@register("e3_series_to_store", rsql(vw.ctes(*[v for _, v, *_ in _FROM_SERIES]) + " " + " union all ".join(
    f"select '{t}' as table_name, {d} as date, cast(cast({c} as {_STORED[t][2]}) as double) as value from {v} "
    f"where {c} is not null and {d} between date '{_CHAIN[0]}' and date '{_CHAIN[1]}'"
    for t, v, d, c, _ in _FROM_SERIES), ["value"]))
def q_e3_series(spark, sf_dir):
    """S2 -> K3 -> K2 -> C1 with a date window: series pages parsed, mapped to
    the stored tables, appended and scanned back by value."""
    ids = se.SERIES_IDS
    parts = [se.pages(vw.VIEWS[v](spark, sf_dir), ids[name], c, d, monthly=t.endswith("monthly"))
             for t, v, d, c, name in _FROM_SERIES]
    pages = parts[0]
    for p in parts[1:]:
        pages = pages.unionByName(p)
    root = scratch_path(spark, f"store/{uuid.uuid4().hex}")
    sto.ingest_all(se.series_to_tables(se.core_series(pages)), root, start=_CHAIN[0], end=_CHAIN[1])
    out = None
    for t, (d, c, _) in _STORED.items():
        scan = sto.scan_range(sto.read_stored(spark, root, t), t, *_CHAIN).select(
            F.lit(t).alias("table_name"), F.col(d).alias("date"), F.col(c).cast("double").alias("value"))
        out = scan if out is None else out.unionByName(scan)
    return out


@register("j4_asof_keyed", rsql(f"""{vw.ctes('v_weather_region')}, l as (select distinct date, region from v_weather_region),
  r as (select date as d, region, temperature as t from v_weather_region where day(date) in (1, 15))
  select l.date, l.region, arg_max(r.t, r.d) as t from l left join r on l.region = r.region and r.d + 3 <= l.date
  group by l.date, l.region""", ["t"]))
def q_j4_keyed(spark, sf_dir):
    """J4 per region with a release lag of 3 days: the latest reading of the
    1st or 15th that was out on each date."""
    v = vw.v_weather_region(spark, sf_dir)
    right = v.filter(F.dayofmonth("date").isin(1, 15)).select(F.col("date").alias("d"), "region", F.col("temperature").alias("t"))
    return jn.asof_join(v.select("date", "region").distinct(), right, "date", "d", ["t"], by=["region"], release_lag_days=3)


@register("j1_colocated_tables", rsql(f"""{ld.tables_sql(*rg._ALL_TABLES)}
  {rg._J1_COLS}left join storage_weekly s on p.date = s.report_date left join production_monthly pr on p.date = pr.month
  left join lng_monthly l on p.date = l.month {rg._J1_FROM_ROLLUP} left join rigs_weekly r on p.date = r.date""", rg._J1_DOUBLES))
def q_j1_colocated(spark, sf_dir):
    """J1 over stored tables in buckets of their date: no table is shuffled."""
    root = scratch_path(spark, f"colocated/{uuid.uuid4().hex}")
    cl.write_by_date(ld.tables(spark, sf_dir), root, buckets=8)
    return jn.feature_matrix({t: cl.open_table(spark, root, t) for t in rg._ALL_TABLES}, rollup_entities=True)


@register("j4_asof_stored", rsql(f"""{vw.ctes('v_weather_region')}, l as (select distinct date, region from v_weather_region),
  r as (select date as d, region, max(temperature) as t from v_weather_region where day(date) in (3, 17) group by date, region)
  select l.date, l.region, arg_max(r.t, r.d) as t from l left join r on l.region = r.region and r.d <= l.date
  group by l.date, l.region""", ["t"]))
def q_j4_stored(spark, sf_dir):
    """J4 over stored tables in buckets of (region, month)."""
    v = vw.v_weather_region(spark, sf_dir)
    root = scratch_path(spark, f"colocated/{uuid.uuid4().hex}")
    left = cl.write_by_month(v.select("date", "region").distinct(), root, "days", "date", ["region"], 8)
    readings = v.filter(F.dayofmonth("date").isin(3, 17)).groupBy(F.col("date").alias("d"), "region").agg(F.max("temperature").alias("t"))
    right = cl.write_by_month(readings, root, "readings", "d", ["region"], 8)
    return cl.asof_stored(left, right, "date", "d", ["t"], ["region"]).select("date", "region", "t")


@register("j2_forecast_dedupe", rsql(f"""{vw.ctes('v_weather', 'v_weather_region')}, f as (select date, avg(temperature) as t
    from v_weather_region group by date)
  select h.date, h.temperature, f.t as temperature_forecast, f.t - h.temperature as temp_forecast_error,
    {rg._hdd('f.t')} as "HDD_forecast", {rg._cdd('f.t')} as "CDD_forecast" from v_weather h left join f on h.date = f.date""",
    ["temperature", "temperature_forecast", "temp_forecast_error", "HDD_forecast", "CDD_forecast"]))
def q_j2_dedupe(spark, sf_dir):
    """J2 with several forecast rows per date, averaged first."""
    forecast = vw.v_weather_region(spark, sf_dir).select("date", "temperature")
    return wx.forecast_merge(vw.v_weather(spark, sf_dir).select("date", "temperature"), forecast, dedupe=True)


@register("st2_stream_windows", rsql(f"""{vw.ctes('v_power')}, r as (select ba, ts, total_load, lag(total_load, 1) over s as l1,
      lag(total_load, 7) over s as l7, case when count(total_load) over f = 14 then avg(total_load) over f end as a,
      case when count(total_load) over f = 14 then stddev_samp(total_load) over f end as d, total_load - lag(total_load, 1) over s as c,
      max(ts) over (partition by ba) as top
    from v_power window s as (partition by ba order by ts), f as (partition by ba order by ts rows between 13 preceding and current row))
    select ba, strftime(ts, '%Y-%m-%d %H') as hour, total_load, l1 as total_load_lag_1, l7 as total_load_lag_7, a as total_load_rolling_14,
      d as total_load_rolling_14_std, c as total_load_change from r where ts <= top - interval 12 hour""",
    ["total_load", "total_load_lag_1", "total_load_lag_7", "total_load_rolling_14", "total_load_rolling_14_std", "total_load_change"]))
def q_st2(spark, sf_dir):
    """W1, W2, W5 on a stream: hourly load per area, replayed in two halves with
    a restart between them; state holds the look-back and 12 hours."""
    folder, out, state = (scratch_path(spark, f"stream_{k}/{uuid.uuid4().hex}") for k in ("in", "out", "state"))
    load = cut_lineage(vw.v_power(spark, sf_dir).select("ba", F.col("ts").cast("timestamp").alias("ts"), "total_load"))
    middle = F.lit(load.agg(F.timestamp_micros((F.unix_micros(F.min("ts")) / 2 + F.unix_micros(F.max("ts")) / 2).cast("long"))).first()[0])
    for half in (load.filter(F.col("ts") < middle), load.filter(F.col("ts") >= middle)):
        half.write.mode("append").parquet(folder)
        windows = stream_windows(spark.readStream.schema(load.schema).parquet(folder), "total_load", "ts", ["ba"], (1, 7), (14,),
                                 True, delay_seconds=12 * 3600)
        query = (windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    done = spark.read.schema(windows.schema).parquet(out).filter("status = 'ok'")
    return done.select("ba", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "total_load", "total_load_lag_1", "total_load_lag_7",
                       "total_load_rolling_14", "total_load_rolling_14_std", "total_load_change")


# ------------------------------------------------------------------- horizons
HORIZONS = (7, 14, 30)


def _horizon_sql(h: int) -> str:
    n = f"(select count(*) from hx{h})"
    last = f"greatest(0, ceil(({n} - {S} - {W}) / {S}))"
    return (
        f", hx{h} as (select * from (select *, lead(spot_price, {h}) over (order by date) as y from ix) q where y is not null)"
        f", hf{h} as (select distinct cast(floor((idx - {W}) / {S}) as bigint) as fold from hx{h} where idx >= {W}"
        f" and floor((idx - {W}) / {S}) < {last})"
        f", hg{h} as (select f.fold, sum(x * y) / nullif(sum(x * x), 0) as b from hf{h} f join hx{h} t"
        f" on t.idx >= f.fold * {S} and t.idx < f.fold * {S} + {W - h} group by f.fold)"
        f", hp{h} as (select 'lstsq' as model, {h} as horizon_days, t.date, t.y as actual, t.x * coalesce(g.b, 0) as prediction"
        f" from hx{h} t join hg{h} g on g.fold = cast(floor((t.idx - {W}) / {S}) as bigint) where t.idx >= {W})"
        f", hb{h} as (select quantile_cont(actual - prediction, 0.1) as lo, quantile_cont(actual - prediction, 0.9) as hi from hp{h})")


@register("m1_horizon_walk_forward", rsql(
    vw.ctes("v_prices", "v_weather") + rg._WF_BASE + "".join(_horizon_sql(h) for h in HORIZONS) + " " + " union all ".join(
        f"select date, model as model_name, horizon_days, prediction, prediction + lo as confidence_lower, "
        f"prediction + hi as confidence_upper, actual as actual_value, actual - prediction as error from hp{h}, hb{h}"
        for h in HORIZONS), ["prediction", "confidence_lower", "confidence_upper", "actual_value", "error"]))
def q_m1_horizon(spark, sf_dir):
    """D6 -> M1 -> D7 -> D9: 7-, 14- and 30-row-ahead targets, training cut h
    rows before the test block, bands per model and horizon."""
    pred = cut_lineage(bt.horizon_walk_forward(rg.walk_forward_input(spark, sf_dir), {"lstsq": bt.Linear(("x",))},
                                               HORIZONS, "spot_price", W, S))
    by = ("model", "horizon_days")
    return ex.prediction_rows(pred, ex.residual_bands(pred, by), horizon="horizon_days", by=by)


@register("d7_running_bands", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._M2_PRED},
    r as (select model, fold, actual - prediction as e from pred), f as (select distinct model, fold from r)
    select f.model, f.fold, quantile_cont(r.e, 0.1) as residual_q10, quantile_cont(r.e, 0.5) as residual_q50,
      quantile_cont(r.e, 0.9) as residual_q90 from f left join r on f.model = r.model and r.fold < f.fold group by f.model, f.fold""",
    ["residual_q10", "residual_q50", "residual_q90"]))
def q_d7_running(spark, sf_dir):
    """D7 known at the time: each fold's band from the residuals of earlier folds."""
    pred = bt.compare_lstsq(rg.walk_forward_input(spark, sf_dir), {"hdd": ["x"], "hdd_cdd": ["x", "x2"]}, "spot_price", W, S)
    return running_bands(pred)


# ------------------------------------------------------------- keyed backtests
_REGION_BASE = f"""{vw.ctes('v_prices', 'v_weather_region')}, b as (select w.region, p.date, p.spot_price,
    {rg._hdd('w.temperature')} + 1 as x from v_prices p join v_weather_region w on p.date = w.date
    where p.spot_price is not null and w.temperature is not null),
  ix as (select *, row_number() over (partition by region order by date) - 1 as idx,
    count(*) over (partition by region) as n from b),
  t as (select *, cast(floor((idx - 120) / 60) as bigint) as fold from ix where idx >= 120
    and floor((idx - 120) / 60) < greatest(0, ceil((n - 180) / 60))),
  f as (select distinct region, fold from t),
  g as (select f.region, f.fold, sum(x * spot_price) / nullif(sum(x * x), 0) as b0, regr_slope(spot_price, x) as b1,
      regr_intercept(spot_price, x) as a1 from f join ix on ix.region = f.region and ix.idx >= f.fold * 60
      and ix.idx < f.fold * 60 + 120 group by f.region, f.fold)"""


def _by_region(spark, sf_dir):
    w = vw.v_weather_region(spark, sf_dir)
    j = vw.v_prices(spark, sf_dir).join(w, "date").filter("spot_price is not null and temperature is not null")
    return wx.degree_days(j, keep_input=True).select("region", "date", "spot_price", (F.col("HDD") + 1).alias("x"))


@register("m1_walk_forward_by_region", rsql(f"""{_REGION_BASE} select t.region, 'lstsq' as model, t.fold, t.idx, t.date,
    t.spot_price as actual, t.x * coalesce(g.b0, 0) as prediction from t join g on t.region = g.region and t.fold = g.fold""",
    ["actual", "prediction"]))
def q_m1_region(spark, sf_dir):
    """M1 per region: positions, folds and fits of each region on its own."""
    return bt.walk_forward_lstsq(_by_region(spark, sf_dir), ["x"], "spot_price", 120, 60, partition_cols=["region"])


class Mean:
    """The mean of the training target: the weakest model worth comparing with."""

    def fit(self, x, y):
        self.value = float(np.mean(y))
        return self

    def predict(self, x):
        return np.full(len(x), self.value)


@register("d9_predictions_by_region", rsql(f"""{_REGION_BASE}, p as (select t.region, t.fold, t.date, t.spot_price as actual,
      t.x * coalesce(g.b0, 0) as prediction from t join g on t.region = g.region and t.fold = g.fold),
    pf as (select distinct region, fold from p),
    pb as (select pf.region, pf.fold, quantile_cont(p.actual - p.prediction, 0.1) as lo, quantile_cont(p.actual - p.prediction, 0.9) as hi
      from pf left join p on pf.region = p.region and p.fold < pf.fold group by pf.region, pf.fold)
    select p.date, p.region, 'lstsq' as model_name, cast(0 as int) as horizon_days, prediction, prediction + lo as confidence_lower,
      prediction + hi as confidence_upper, actual as actual_value, actual - prediction as error
    from p join pb on p.region = pb.region and p.fold = pb.fold""",
    ["prediction", "confidence_lower", "confidence_upper", "actual_value", "error"]))
def q_d9_region(spark, sf_dir):
    """D9 per region (the entity key stays) with bands of earlier folds."""
    pred = cut_lineage(bt.walk_forward_lstsq(_by_region(spark, sf_dir), ["x"], "spot_price", 120, 60, partition_cols=["region"]))
    by = ["region", "model"]
    return ex.prediction_rows(pred, running_bands(pred, by), by=[*by, "fold"])


@register("m2_compare_by_region", rsql(f"""{_REGION_BASE}, gm as (select f.region, f.fold, avg(spot_price) as m from f join ix
      on ix.region = f.region and ix.idx >= f.fold * 60 and ix.idx < f.fold * 60 + 120 group by f.region, f.fold),
    p as (select t.region, 'ols' as model, t.fold, t.spot_price - (g.a1 + g.b1 * t.x) as e from t join g
        on t.region = g.region and t.fold = g.fold
      union all select t.region, 'mean', t.fold, t.spot_price - gm.m from t join gm on t.region = gm.region and t.fold = gm.fold),
    q as (select region, model, fold, avg(abs(e)) as mae, sqrt(avg(e * e)) as rmse from p group by all)
  select region, model, avg(mae) as mae_mean, stddev_pop(mae) as mae_std, avg(rmse) as rmse_mean, stddev_pop(rmse) as rmse_std,
    count(*) as n_folds from q group by region, model""", ["mae_mean", "mae_std", "rmse_mean", "rmse_std"]))
def q_m2_region(spark, sf_dir):
    """M2: a linear and an arbitrary fit/predict model per region, summarised."""
    models = {"ols": bt.Linear(("x",), "ols"), "mean": bt.Fitted(Mean, ("x",))}
    pred = bt.compare(_by_region(spark, sf_dir), models, "spot_price", 120, 60, partition_cols=["region"])
    s = bt.summary(bt.fold_metrics(pred, 120, 60, ["region"]), ("region", "model"))
    return s.select("region", "model", "mae_mean", "mae_std", "rmse_mean", "rmse_std", "n_folds")


def _log_target(pdf, target):
    return pdf[["x"]].to_numpy(float) * 2.0, pdf[target].to_numpy(float)


@register("x2_prepare_hook", rsql(f"{vw.ctes('v_prices', 'v_weather')}{rg._PRED_SQL}\nselect * from pred", ["actual", "prediction"]))
def q_x2_prepare(spark, sf_dir):
    """X2 with the prepare hook: a doubled regressor gives the same predictions."""
    return bt.walk_forward_grouped(rg.walk_forward_input(spark, sf_dir), bt.NumpyLeastSquares, ["x"], "spot_price", W, S,
                                   model_name="lstsq", prepare=_log_target)


# --------------------------------------------------------------- linear models
_FOLD_FIT = (", fit as (select f.fold, regr_slope(spot_price, x) as b, regr_intercept(spot_price, x) as a, "
             "covar_pop(spot_price, x) as cxy, var_pop(x) as vx, avg(x) as mx, avg(spot_price) as my from folds f join ix "
             f"on ix.idx >= f.fold * {S} and ix.idx < f.fold * {S} + {W} group by f.fold)")


@register("m4_linear", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE}{_FOLD_FIT} select 'ols' as model, t.fold, t.idx,
    t.date, t.spot_price as actual, coalesce(a, my) + coalesce(b, 0) * t.x as prediction from test t join fit on t.fold = fit.fold""",
    ["actual", "prediction"]))
def q_m4_linear(spark, sf_dir):
    """M4: ordinary least squares with intercept per fold, from centred moments."""
    return bt.walk_forward_linear(rg.walk_forward_input(spark, sf_dir), {"ols": bt.Linear(("x",), "ols")}, "spot_price", W, S)


_EN = md.ELASTIC_NET


@register("m4_elastic_net", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE}{_FOLD_FIT}, en as (select fold, mx, my,
      sign(cxy) * greatest(abs(cxy) - {_EN['alpha'] * _EN['l1_ratio']}, 0) / (vx + {_EN['alpha'] * (1 - _EN['l1_ratio'])}) as b from fit)
    select 'elastic_net' as model, t.fold, t.idx, t.date, t.spot_price as actual, en.my + en.b * (t.x - en.mx) as prediction
    from test t join en on t.fold = en.fold""", ["actual", "prediction"]))
def q_m4_elastic(spark, sf_dir):
    """M4: elastic net (alpha .01, l1 .5) per fold; one feature has the closed
    form S(cov, alpha l1) / (var + alpha (1 - l1))."""
    model = bt.Linear(("x",), "elastic_net", _EN["alpha"], _EN["l1_ratio"], _EN["max_iter"])
    return bt.walk_forward_linear(rg.walk_forward_input(spark, sf_dir), {"elastic_net": model}, "spot_price", W, S)


# ----------------------------------------------------------------- tree models
def _tree_facts(spark, sf_dir, kind: str, **params):
    """Facts that hold for a right model and can be stated in SQL: importances
    sum to 1, predictions stay inside the target's range, the error is below
    that of the mean."""
    df = cut_lineage(rg.walk_forward_input(spark, sf_dir))
    model = md.RegressionModel(kind, "spot_price", ["x", "x2"], **params)
    model.train_final_model(df)
    scored = model.model.transform(df)
    total = model.get_feature_importance().agg(F.abs(F.sum("importance") - 1) < 1e-9).first()[0]
    y, p = F.col("spot_price"), F.col("prediction")
    top, low, mean = df.agg(F.max(y), F.min(y), F.avg(y)).first()
    margin = 1e-9 + 0.2 * (top - low) * (kind != "random_forest")  # boosting adds steps, a forest averages leaves
    return scored.agg(F.lit(kind).alias("kind"), F.count("*").alias("n_rows"), F.lit(bool(total)).alias("importances_sum_to_one"),
                      ((F.min(p) >= low - margin) & (F.max(p) <= top + margin)).alias("predictions_in_range"),
                      (F.avg(F.abs(y - p)) < F.avg(F.abs(y - mean))).alias("better_than_mean"))


def _facts_sql(kind: str) -> str:
    return (f"{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE} select '{kind}' as kind, count(*) as n_rows, "
            "true as importances_sum_to_one, true as predictions_in_range, true as better_than_mean from ix")


@register("m6_random_forest", _facts_sql("random_forest"))
def q_m6(spark, sf_dir):
    """M6 + M3: random forest (seed 42) trained on the whole series, as facts."""
    return _tree_facts(spark, sf_dir, "random_forest")


def _fold_facts(spark, sf_dir, kind: str):
    """Facts of a tree kind's walk-forward that SQL can state: folds, test rows
    and their values, and that predictions stay near the range of the fold's
    training targets (boosting adds steps, a forest averages leaves)."""
    df = rg.walk_forward_input(spark, sf_dir)
    ix = cut_lineage(add_row_index(df, "date"))
    pred = bt.compare(ix, {kind: md.fold_model(kind, ("x", "x2"))}, "spot_price", W, S)
    per_fold = pred.groupBy("model", "fold").agg(
        F.count("*").alias("n_test"), F.avg("actual").alias("actual_mean"), F.min("prediction").alias("low"),
        F.max("prediction").alias("high"))
    y = F.col("spot_price")
    train = ix.select(y, F.explode(bt.train_folds(W, S)).alias("fold")).groupBy("fold").agg(
        F.min(y).alias("y0"), F.max(y).alias("y1"))
    margin = 1e-9 + (F.col("y1") - F.col("y0")) * (0.5 if kind != "random_forest" else 0.0)
    return per_fold.join(train, "fold").select(
        "model", "fold", "n_test", "actual_mean",
        ((F.col("low") >= F.col("y0") - margin) & (F.col("high") <= F.col("y1") + margin)).alias("near_training_range"))


def _fold_facts_sql(kind: str) -> str:
    return rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE} select '{kind}' as model, test.fold, count(*) as n_test,
      avg(spot_price) as actual_mean, true as near_training_range from test join folds on test.fold = folds.fold group by test.fold""",
                ["actual_mean"])


@register("m6_forest_walk_forward", _fold_facts_sql("random_forest"))
def q_m6_walk(spark, sf_dir):
    """M6 in M1: a forest of the configured size per fold, all folds in one job."""
    return _fold_facts(spark, sf_dir, "random_forest")


@register("m7_boosted_trees", _fold_facts_sql("xgboost"))
def q_m7(spark, sf_dir):
    """M7 in M1: the configured 1000 rounds per fold, all folds in one job."""
    return _fold_facts(spark, sf_dir, "xgboost")


@register("m6_tree_stump_walk_forward", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE}, tr as (select f.fold, x, spot_price
      from folds f join ix on ix.idx >= f.fold * {S} and ix.idx < f.fold * {S} + {W}),
    v as (select fold, x, sum(spot_price) as s, count(*) as n from tr group by fold, x),
    c as (select fold, x, sum(s) over w as ls, sum(n) over w as ln, sum(s) over (partition by fold) as ts,
      sum(n) over (partition by fold) as tn, lead(x) over (partition by fold order by x) as nx from v
      window w as (partition by fold order by x)),
    g as (select *, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn as gain from c where nx is not null),
    b as (select fold, arg_max((x + nx) / 2, round(gain, 9)) as cut from g where gain > 0 group by fold),
    l as (select tr.fold, avg(spot_price) as mean, avg(spot_price) filter (x <= cut) as low, avg(spot_price) filter (x > cut) as high,
      any_value(cut) as cut from tr left join b on tr.fold = b.fold group by tr.fold)
    select 'stump' as model, t.fold, t.idx, t.date, t.spot_price as actual,
      case when cut is null then mean when t.x <= cut then low else high end as prediction
    from test t join l on t.fold = l.fold""", ["actual", "prediction"]))
def q_m6_stump(spark, sf_dir):
    """M6's split search by value: a tree of one split per fold against the
    exhaustive search in SQL."""
    stump = bt.Fitted(lambda: Ensemble(False, 1, 1, bootstrap=False, max_bins=W), ("x",))
    return bt.compare(rg.walk_forward_input(spark, sf_dir), {"stump": stump}, "spot_price", W, S)


@register("k8_save_load", f"{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE} select count(*) as n_rows, "
                          "cast(0 as bigint) as n_different from ix")
def q_k8(spark, sf_dir):
    """K8: a saved forest, loaded with its features and target, predicts the same."""
    df = cut_lineage(rg.walk_forward_input(spark, sf_dir))
    model = md.RegressionModel("random_forest", "spot_price", ["x", "x2"])
    model.train_final_model(df)
    path = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    model.save(path)
    again = md.RegressionModel.load(path)
    both = again.model.transform(model.model.transform(df).withColumnRenamed("prediction", "before").drop("features"))
    same = F.lit((again.kind, again.target, again.features) == (model.kind, model.target, model.features))
    return both.agg(F.count("*").alias("n_rows"),
                    F.count_if((F.col("before") != F.col("prediction")) | ~same).alias("n_different"))


@register("k8_window_models", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE}, f as (select regr_slope(spot_price, x) as b,
      regr_intercept(spot_price, x) as a, covar_pop(spot_price, x) as cxy, var_pop(x) as vx, avg(x) as mx, avg(spot_price) as my from ix),
    k as (select unnest(['elastic_net', 'lightgbm', 'linear', 'random_forest', 'xgboost']) as model),
    e as (select 'linear' as model, avg(abs(spot_price - a - b * x)) as linear_mae from ix, f
      union all select 'elastic_net', avg(abs(spot_price - my - (x - mx) * sign(cxy) * greatest(abs(cxy)
        - {md.ELASTIC_NET['alpha'] * md.ELASTIC_NET['l1_ratio']}, 0) / (vx + {md.ELASTIC_NET['alpha'] * (1 - md.ELASTIC_NET['l1_ratio'])})))
      from ix, f)
    select k.model, (select count(*) from ix) as n_rows, true as better_than_mean, linear_mae from k left join e on k.model = e.model""",
    ["linear_mae"]))
def q_k8_window(spark, sf_dir):
    """E4's final fits: all five kinds on one window, saved as a table, loaded
    and scored; the linear kinds' error by value."""
    df = cut_lineage(rg.walk_forward_input(spark, sf_dir))
    kinds = tr.BASELINE_KINDS + tr.TREE_KINDS
    path = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    md.save_models(md.fit_window(df, {k: md.fold_model(k, ("x",)) for k in kinds}), path)
    scored = md.predict_with(md.load_models(spark, path), df.crossJoin(F.broadcast(df.agg(F.avg("spot_price").alias("mean")))))
    error, plain = F.avg(F.abs(F.col("spot_price") - F.col("prediction"))), F.avg(F.abs(F.col("spot_price") - F.col("mean")))
    return scored.groupBy("model").agg(F.count("*").alias("n_rows"), (error < plain).alias("better_than_mean"), error.alias("e")).select(
        "model", "n_rows", "better_than_mean", F.when(F.col("model").isin("linear", "elastic_net"), F.col("e")).alias("linear_mae"))


@register("m3_permutation_importance", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE}{_FOLD_FIT}, p as (select t.fold, t.x,
      t.spot_price, coalesce(a, my) + coalesce(b, 0) * t.x as ols, coalesce(b, 0) as b from test t join fit on t.fold = fit.fold),
    g as (select f.fold, sum(x * spot_price) / nullif(sum(x * x), 0) as b from folds f join ix on ix.idx >= f.fold * {S}
      and ix.idx < f.fold * {S} + {W} group by f.fold)
    select 'ols' as model, fold, 'x' as feature, 2 * any_value(b) * any_value(b) * var_pop(x)
      + 2 * any_value(b) * covar_pop(spot_price - ols, x) as importance from p group by fold
    union all select 'lstsq', p.fold, 'x', 2 * coalesce(any_value(g.b), 0) * coalesce(any_value(g.b), 0) * var_pop(x)
      + 2 * coalesce(any_value(g.b), 0) * covar_pop(spot_price - x * coalesce(g.b, 0), x) from p join g on p.fold = g.fold group by p.fold""",
    ["importance"]))
def q_m3_permutation(spark, sf_dir):
    """M3 for models without importances: a linear one in sums, an arbitrary
    fit/predict one by moving its test columns round; both have the closed form."""
    models = {"ols": bt.Linear(("x",), "ols"), "lstsq": bt.Fitted(bt.NumpyLeastSquares, ("x",))}
    return bt.permutation_importance(rg.walk_forward_input(spark, sf_dir), models, "spot_price", W, S)


@register("m8_holdout", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE}, c as (select cast(floor(count(*) * 0.8) as bigint)
      as cut from ix), tr as (select regr_slope(spot_price, x) as b, regr_intercept(spot_price, x) as a from ix, c where idx < cut)
    select avg(abs(spot_price - (a + b * x))) as mae, sqrt(avg((spot_price - (a + b * x)) * (spot_price - (a + b * x)))) as rmse
    from ix, c, tr where idx >= cut""", ["mae", "rmse"]))
def q_m8(spark, sf_dir):
    """M8: time-ordered hold-out (last fifth) of a linear model."""
    x = rg.walk_forward_input(spark, sf_dir).select("date", "spot_price", "x")
    # No feature list given, every column but target and date is one
    got = md.RegressionModel("linear", "spot_price").evaluate_model(x)
    return spark.createDataFrame([(got["mae"], got["rmse"])], "mae double, rmse double")


# ------------------------------------------------------------------------- E4, E5
_E4_DATA = f"""{ld.tables_sql('prices', 'weather_daily')}, w as (select date, avg(hdd) as hdd from weather_daily group by date),
  mat as (select p.date, p.spot_price, w.hdd from prices p left join w on p.date = w.date
    where p.date between (select max(date) from prices) - 730 and (select max(date) from prices)),
  med as (select median(spot_price) as y, median(hdd) as h from mat),
  base as (select date, coalesce(spot_price, med.y) as spot_price, coalesce(hdd, med.h) as x from mat, med){rg._WF_FOLDS}"""


def _training(spark, sf_dir, **options):
    end = ld.latest_price_date(spark, sf_dir)
    start = str(datetime.date.fromisoformat(end) - datetime.timedelta(days=730))
    out = scratch_path(spark, f"training/{uuid.uuid4().hex}")
    return out, tr.run_training(ld.tables(spark, sf_dir, (start, end)), out, **options)


@register("e4_training_report", rsql(f"""{_E4_DATA}, k as (select unnest(['elastic_net', 'lightgbm', 'linear', 'random_forest',
      'xgboost']) as model), t as (select count(distinct test.fold) as n_folds, count(*) as n_test, avg(spot_price) as actual_mean,
      min(date) as first_date, max(date) as last_date from test join folds on test.fold = folds.fold)
    select k.model, n_folds, n_test, actual_mean, first_date, last_date, true as report_matches, true as model_saved from k, t""",
    ["actual_mean"]))
def q_e4(spark, sf_dir):
    """Training window -> matrix -> medians -> final fits of the five kinds,
    saved models, walk-forward over identical folds with the default window and
    step, and the report; the report is recomputed from the stored predictions."""
    out, rep = _training(spark, sf_dir)
    pred = spark.read.parquet(f"{out}/predictions")
    facts = pred.groupBy("model").agg(
        F.countDistinct("fold").alias("n_folds"), F.count("*").alias("n_test"), F.avg("actual").alias("actual_mean"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    error = F.abs(F.col("actual") - F.col("prediction"))
    folds = pred.groupBy("model", "fold").agg(F.avg(error).alias("mae"), F.avg(error / F.col("actual")).alias("mape"))
    again = folds.groupBy("model").agg(
        F.format_string("%.4f ± %.4f", F.avg("mae"), F.stddev_pop("mae")).alias("a"),
        F.format_string("%.2f%% ± %.2f%%", F.avg("mape") * 100, F.stddev_pop("mape") * 100).alias("b"))
    saved = md.load_models(spark, f"{out}/models").groupBy("model").agg((F.count("*") == 1).alias("model_saved"))
    return rep.join(facts, "model").join(again, "model").join(saved, "model").select(
        "model", "n_folds", "n_test", "actual_mean", "first_date", "last_date",
        ((F.col("mae") == F.col("a")) & (F.col("mape") == F.col("b"))).alias("report_matches"), "model_saved")


@register("e4_linear_report", f"""{_E4_DATA}{_FOLD_FIT}, pred as (
      select 'linear' as model, t.fold, t.idx, t.spot_price as actual, coalesce(a, my) + coalesce(b, 0) * t.x as prediction
        from test t join fit on t.fold = fit.fold
      union all select 'elastic_net', t.fold, t.idx, t.spot_price, my + (t.x - mx) * sign(cxy) * greatest(abs(cxy)
        - {_EN['alpha'] * _EN['l1_ratio']}, 0) / (vx + {_EN['alpha'] * (1 - _EN['l1_ratio'])}) from test t join fit on t.fold = fit.fold)
    {rg._METRICS_SQL}, r as ({rg._SUMMARY_SQL})
    select model, printf('%.4f ± %.4f', mae_mean, mae_std) as mae, printf('%.4f ± %.4f', rmse_mean, rmse_std) as rmse,
      printf('%.2f%% ± %.2f%%', mape_mean, mape_std) as mape,
      printf('%.2f%% ± %.2f%%', direction_accuracy_mean, direction_accuracy_std) as direction_accuracy from r""")
def q_e4_linear(spark, sf_dir):
    """E4's report by value, for the kinds whose one-feature fits have a closed form."""
    return _training(spark, sf_dir, kinds=("linear", "elastic_net"), features=["hdd"])[1]


@register("e5_demo", rsql(f"""{vw.ctes('v_prices', 'v_weather')}{rg._WF_BASE}, h as (select date, spot_price, greatest(x - 1 - x2, 0) as t,
      (x - 1) * 10 + 2000 as gas from ix),
    k as (select cast(greatest(0, ceil((count(*) - 250) / 50)) as bigint) as n_folds from ix)
    select date, spot_price, t as hdd, lag(t, 7) over w as hdd_lag_7, case when count(t) over s = 14 then avg(t) over s end as hdd_rolling_14,
      lag(gas, 14) over w as gas_lag_14, case when count(gas) over r = 8 then stddev_samp(gas) over r end as gas_rolling_8w_std,
      gas - lag(gas) over w as gas_change, n_folds
    from h, k window w as (order by date), s as (order by date rows between 13 preceding and current row),
      r as (order by date rows between 7 preceding and current row)""",
    ["spot_price", "hdd", "hdd_lag_7", "hdd_rolling_14", "gas_lag_14", "gas_rolling_8w_std", "gas_change"]))
def q_e5(spark, sf_dir):
    """E5: the demo walk-through on the landed daily series: combined features
    by value, and the folds of its walk-forward."""
    d = rg.walk_forward_input(spark, sf_dir).select(
        "date", "spot_price", (F.col("x") - 1).alias("hdd"), F.col("x2").alias("cdd"))
    d = d.withColumns({"temperature": F.lit(65.0) - F.col("hdd") + F.col("cdd"), "storage": F.col("hdd") * 10 + 2000,
                       "production": F.col("cdd") + 90})
    out = tr.demo(d)
    folds = out["summary"].agg(F.coalesce(F.sum("n_folds"), F.lit(0)).alias("n_folds"))
    named = {"wx_HDD": "hdd", "wx_HDD_lag_7": "hdd_lag_7", "wx_HDD_rolling_14": "hdd_rolling_14",
             "st_working_gas_lag_14": "gas_lag_14", "st_working_gas_rolling_8w_std": "gas_rolling_8w_std", "st_storage_change": "gas_change"}
    features = out["features"].select("date", "spot_price", *[F.col(c).alias(n) for c, n in named.items()])
    return features.crossJoin(F.broadcast(folds))
