"""Registered jobs (one per operator of the inventory) and their DuckDB twins.

Every job reads the landed tables under ``sf_dir`` (through the views of
``tidewise.sources.views``) and returns a lazy DataFrame. Double columns are
rounded to 6 digits on both sides so that the engines' last-bit differences
(window sums, std algorithms) do not flip a value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.operators import storage as st
from tidewise.operators import weather as wx
from tidewise.plans import features as fe
from tidewise.plans.ordered import add_row_index, windowed
from tidewise.sources import views as vw

DIGITS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def round6(c) -> "F.Column":
    """Round half up to 6 decimals as floor(x * 1e6 + 0.5) / 1e6.

    Plain IEEE double arithmetic, evaluated bit-identically by Spark and by
    the SQL twin (the engines' own ``round`` functions differ on exact
    halves). Magnitudes >= 1e12 are left as they are.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(x) < F.lit(1e12), F.floor(x * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).otherwise(x)


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (the comparison form of a result); one
    ``selectExpr`` of the same expression as ``round6``."""
    def qn(n):
        return "`" + n.replace("`", "``") + "`"

    return df.selectExpr(*[
        f"{_r6_spark(qn(f.name))} as {qn(f.name)}" if isinstance(f.dataType, T.DoubleType) else qn(f.name)
        for f in df.schema.fields
    ])


def _r6_spark(e: str) -> str:
    """Spark SQL text of ``round6`` (double literals: same IEEE operations)."""
    return f"case when abs({e}) < 1.0E12D then floor({e} * 1000000.0D + 0.5D) / 1000000.0D else {e} end"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: finish(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def rsql(inner: str, doubles: list[str], digits: int = DIGITS) -> str:
    """Wrap ``inner`` so the listed double columns are rounded."""
    if not doubles:
        return inner
    rep = ", ".join(f'{_r6(chr(34) + c + chr(34))} as "{c}"' for c in doubles)
    return f"select * replace ({rep}) from (\n{inner}\n) q"


def _r6(e: str) -> str:
    """SQL twin of ``round6``."""
    return (f"case when abs({e}) < cast(1e12 as double) then floor({e} * cast(1000000 as double) + cast(0.5 as double))"
            f" / cast(1000000 as double) else {e} end")


# ---------------------------------------------------------------- SQL pieces
def _hdd(t: str) -> str:
    return f"case when {t} is null then null else greatest(65.0 - {t}, 0) end"


def _cdd(t: str) -> str:
    return f"case when {t} is null then null else greatest({t} - 65.0, 0) end"


def _flag(cond: str) -> str:
    return f"coalesce(cast(({cond}) as int), 0)"


def _months(d: str, months: list[int]) -> str:
    return f"cast(month({d}) in ({', '.join(map(str, months))}) as int)"


def _weather_cal_sql(d: str = "date") -> list[str]:
    return [
        f"cast(month({d}) as int) as month",
        f"cast(quarter({d}) as int) as quarter",
        f"cast(dayofyear({d}) as int) as day_of_year",
        f"sin(2 * pi() * month({d}) / 12) as month_sin",
        f"cos(2 * pi() * month({d}) / 12) as month_cos",
        f"sin(2 * pi() * dayofyear({d}) / 365) as day_sin",
        f"cos(2 * pi() * dayofyear({d}) / 365) as day_cos",
        f"{_months(d, [12, 1, 2])} as is_winter",
        f"{_months(d, [3, 4, 5])} as is_spring",
        f"{_months(d, [6, 7, 8])} as is_summer",
        f"{_months(d, [9, 10, 11])} as is_fall",
    ]


WEATHER_CAL_DOUBLES = ["month_sin", "month_cos", "day_sin", "day_cos"]


def _storage_cal_sql(d: str = "date") -> list[str]:
    return [
        f"cast(month({d}) as int) as month",
        f"cast(quarter({d}) as int) as quarter",
        f"cast(weekofyear({d}) as int) as week_of_year",
        f"{_months(d, [4, 5, 6, 7, 8, 9, 10])} as is_injection_season",
        f"{_months(d, [11, 12, 1, 2, 3])} as is_withdrawal_season",
        f"sin(2 * pi() * month({d}) / 12) as month_sin",
        f"cos(2 * pi() * month({d}) / 12) as month_cos",
    ]


def _lag_sql(c: str, lags: list[int], w: str = "w") -> list[tuple[str, str]]:
    return [(f'lag("{c}", {k}) over {w}', f"{c}_lag_{k}") for k in lags]


def _roll_sql(c: str, windows: list[int], suffix: str = "", order=("mean", "std", "max", "min")):
    fns = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}
    out = []
    for n in windows:
        frame = f"(order by date rows between {n - 1} preceding and current row)"
        base = f"{c}_rolling_{n}{suffix}"
        for stat in order:
            name = base if stat == "mean" else f"{base}_{stat}"
            expr = f'case when count("{c}") over {frame} = {n} then {fns[stat]}("{c}") over {frame} end'
            out.append((expr, name))
    return out


def _sel(pairs: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f'{e} as "{n}"' for e, n in pairs)


# ------------------------------------------------------------ P: projections
@register(
    "p1_degree_days",
    rsql(vw.with_views(f"select date, {_hdd('temperature')} as HDD, {_cdd('temperature')} as CDD from v_weather",
                       "v_weather"), ["HDD", "CDD"]),
)
def q_p1(spark, sf_dir):
    """P1 degree days on the daily weather series (only date, HDD, CDD)."""
    return wx.degree_days(vw.v_weather(spark, sf_dir))


@register(
    "p2_weather_calendar",
    rsql(vw.with_views("select *, " + ", ".join(_weather_cal_sql()) + " from v_weather", "v_weather"),
         ["temperature", "wind_speed"] + WEATHER_CAL_DOUBLES),
)
def q_p2(spark, sf_dir):
    """P2 weather calendar terms."""
    return wx.weather_calendar(vw.v_weather(spark, sf_dir))


@register(
    "p3_storage_calendar",
    rsql(vw.with_views("select *, " + ", ".join(_storage_cal_sql()) + " from v_storage", "v_storage"),
         ["working_gas", "five_year_avg", "month_sin", "month_cos"]),
)
def q_p3(spark, sf_dir):
    """P3 storage calendar terms (ISO week)."""
    return st.storage_calendar(vw.v_storage(spark, sf_dir))


@register(
    "p4_storage_deviation",
    rsql(vw.with_views(
        "select *, working_gas - five_year_avg as storage_yoy_deviation, "
        "(working_gas - five_year_avg) / nullif(five_year_avg, 0) * 100 as storage_yoy_deviation_pct from v_storage",
        "v_storage"), ["working_gas", "five_year_avg", "storage_yoy_deviation", "storage_yoy_deviation_pct"]),
)
def q_p4(spark, sf_dir):
    """P4 deviation from the five-year average, absolute and percent."""
    return st.storage_deviation(vw.v_storage(spark, sf_dir))


@register(
    "p5_days_cover",
    rsql(vw.with_views(
        "select *, cast(100 as int) as estimated_daily_consumption, working_gas / 100 as storage_cover_days "
        "from v_storage", "v_storage"), ["working_gas", "five_year_avg", "storage_cover_days"]),
)
def q_p5(spark, sf_dir):
    """P5 days of cover."""
    return st.days_cover(vw.v_storage(spark, sf_dir))


_T = "(working_gas - five_year_avg) / nullif(five_year_avg, 0)"


@register(
    "p6_tightness",
    rsql(vw.with_views(
        f"select *, {_T} as storage_tightness, "
        f"{_flag(f'{_T} < -0.1')} as storage_very_tight, "
        f"{_flag(f'{_T} >= -0.1 and {_T} < -0.05')} as storage_tight, "
        f"{_flag(f'{_T} >= -0.05 and {_T} < 0.05')} as storage_normal, "
        f"{_flag(f'{_T} >= 0.05')} as storage_loose from v_storage", "v_storage"),
        ["working_gas", "five_year_avg", "storage_tightness"]),
)
def q_p6(spark, sf_dir):
    """P6 tightness ratio and its four bins."""
    return st.tightness(vw.v_storage(spark, sf_dir))


@register(
    "p7_weather_interactions",
    rsql(vw.with_views(
        "select *, HDD * CDD as HDD_CDD_interaction, temperature * wind_speed as temp_wind_interaction, "
        "HDD * wind_speed as HDD_wind_interaction from ("
        f"select *, {_hdd('temperature')} as HDD, {_cdd('temperature')} as CDD from v_weather) x", "v_weather"),
        ["temperature", "wind_speed", "HDD", "CDD", "HDD_CDD_interaction", "temp_wind_interaction",
         "HDD_wind_interaction"]),
)
def q_p7(spark, sf_dir):
    """P7 weather interactions on the daily series with degree days."""
    return wx.weather_interactions(wx.degree_days(vw.v_weather(spark, sf_dir), keep_input=True))


@register(
    "p8_storage_interactions",
    rsql(vw.with_views(
        "select *, working_gas * is_injection_season as storage_injection_interaction, "
        "working_gas * temperature as storage_temp_interaction from ("
        "select s.*, w.temperature, " + ", ".join(_storage_cal_sql("s.date")) +
        " from v_storage s left join v_weather w on s.date = w.date) x", "v_storage", "v_weather"),
        ["working_gas", "five_year_avg", "temperature", "month_sin", "month_cos",
         "storage_injection_interaction", "storage_temp_interaction"]),
)
def q_p8(spark, sf_dir):
    """P8 storage interactions (weekly storage with that day's temperature)."""
    s = vw.v_storage(spark, sf_dir)
    t = vw.v_weather(spark, sf_dir).select("date", "temperature")
    return st.storage_interactions(st.storage_calendar(s.join(t, "date", "left")))


_TREND = ('(1.5 * working_gas + 0.5 * lag(working_gas, 1) over w - 0.5 * lag(working_gas, 2) over w '
          '- 1.5 * lag(working_gas, 3) over w) / 5')


@register(
    "w6_trend",
    rsql(vw.with_views(f"select *, {_TREND} as storage_trend from v_storage window w as (order by date)",
                       "v_storage"), ["working_gas", "five_year_avg", "storage_trend"]),
)
def q_w6(spark, sf_dir):
    """W6 four-week least-squares slope."""
    return st.storage_trend(vw.v_storage(spark, sf_dir), project=False)


@register(
    "p9_projection",
    rsql(vw.with_views(
        "select *, working_gas + storage_trend * 4 as storage_projected_4w, "
        "working_gas + storage_trend * 8 as storage_projected_8w from ("
        f"select *, {_TREND} as storage_trend from v_storage window w as (order by date)) x", "v_storage"),
        ["working_gas", "five_year_avg", "storage_trend", "storage_projected_4w", "storage_projected_8w"]),
)
def q_p9(spark, sf_dir):
    """P9 projections from the W6 slope."""
    return st.storage_trend(vw.v_storage(spark, sf_dir))


# ---------------------------------------------------------------- W: windows
_WX_DD = f"select *, {_hdd('temperature')} as HDD, {_cdd('temperature')} as CDD from v_weather"


def _w1_sql() -> str:
    pairs = [p for c in ("HDD", "CDD", "temperature") for p in _lag_sql(c, wx.WEATHER_LAGS)]
    inner = f"select *, {_sel(pairs)} from ({_WX_DD}) x window w as (order by date)"
    return rsql(vw.with_views(inner, "v_weather"), ["temperature", "wind_speed", "HDD", "CDD"] + [n for _, n in pairs])


@register("w1_weather_lags", _w1_sql())
def q_w1(spark, sf_dir):
    """W1 lags 1,3,7,14,30 of HDD, CDD and temperature in one window pass."""
    df = wx.degree_days(vw.v_weather(spark, sf_dir), keep_input=True)
    return windowed(df, lambda w: [e for c in ("HDD", "CDD", "temperature") for e in wx.lag_cols(w, c, wx.WEATHER_LAGS)],
                       "date", (), max(wx.WEATHER_LAGS))


def _w2_sql() -> str:
    pairs = [p for c in ("HDD", "CDD", "temperature") for p in _roll_sql(c, wx.WEATHER_WINDOWS)]
    inner = f"select *, {_sel(pairs)} from ({_WX_DD}) x"
    return rsql(vw.with_views(inner, "v_weather"), ["temperature", "wind_speed", "HDD", "CDD"] + [n for _, n in pairs])


@register("w2_weather_rolling", _w2_sql())
def q_w2(spark, sf_dir):
    """W2 rolling mean/std/max/min over 7, 14, 30 rows with the full-window rule."""
    df = wx.degree_days(vw.v_weather(spark, sf_dir), keep_input=True)
    return windowed(df, lambda w: [e for c in ("HDD", "CDD", "temperature") for e in wx.rolling_cols(w, c, wx.WEATHER_WINDOWS)],
                       "date", (), max(wx.WEATHER_WINDOWS) - 1)


_ST_BASE = ("select *, working_gas - five_year_avg as storage_yoy_deviation, "
            "(working_gas - five_year_avg) / nullif(five_year_avg, 0) * 100 as storage_yoy_deviation_pct, "
            "cast(100 as int) as estimated_daily_consumption, working_gas / 100 as storage_cover_days from v_storage")
_ST_BASE_DOUBLES = ["working_gas", "five_year_avg", "storage_yoy_deviation", "storage_yoy_deviation_pct",
                    "storage_cover_days"]


def _storage_base(spark, sf_dir):
    return st.days_cover(st.storage_deviation(vw.v_storage(spark, sf_dir)))


def _w3_sql() -> str:
    pairs = [p for c in ("working_gas", "storage_yoy_deviation", "storage_cover_days") for p in _lag_sql(c, st.STORAGE_LAGS)]
    inner = f"select *, {_sel(pairs)} from ({_ST_BASE}) x window w as (order by date)"
    return rsql(vw.with_views(inner, "v_storage"), _ST_BASE_DOUBLES + [n for _, n in pairs])


@register("w3_storage_lags", _w3_sql())
def q_w3(spark, sf_dir):
    """W3 storage lags 1,7,14,30 (weekly rows)."""
    return st.storage_lags(_storage_base(spark, sf_dir), ["working_gas", "storage_yoy_deviation", "storage_cover_days"])


def _w4_sql() -> str:
    pairs = [p for c in ("working_gas", "storage_yoy_deviation")
             for p in _roll_sql(c, st.STORAGE_WINDOWS, "w", ("mean", "std", "min", "max"))]
    inner = f"select *, {_sel(pairs)} from ({_ST_BASE}) x"
    return rsql(vw.with_views(inner, "v_storage"), _ST_BASE_DOUBLES + [n for _, n in pairs])


@register("w4_storage_rolling", _w4_sql())
def q_w4(spark, sf_dir):
    """W4 storage rolling 4/8/12-week statistics."""
    return st.storage_rolling(_storage_base(spark, sf_dir), ["working_gas", "storage_yoy_deviation"])


_W5_INNER = (
    "select date, working_gas, five_year_avg, "
    "working_gas - lag(working_gas) over w as storage_change, "
    "(f / nullif(lag(f) over w, 0) - 1) * 100 as storage_change_pct, "
    "working_gas - lag(working_gas) over w as storage_velocity, "
    "(f / nullif(lag(f) over w, 0) - 1) * 100 as storage_velocity_pct "
    "from (select *, last_value(working_gas ignore nulls) over "
    "(order by date rows between unbounded preceding and current row) as f from v_storage) x "
    "window w as (order by date)"
)


@register(
    "w5_change",
    rsql(vw.with_views(_W5_INNER, "v_storage"),
         ["working_gas", "five_year_avg", "storage_change", "storage_change_pct", "storage_velocity",
          "storage_velocity_pct"]),
)
def q_w5(spark, sf_dir):
    """W5 difference and padded percent change, under both names."""
    return st.storage_change(vw.v_storage(spark, sf_dir), names=("storage_change", "storage_velocity"))


@register(
    "w8_row_index",
    vw.with_views(f"select date, {_r6('spot_price')} as spot_price, row_number() over (order by date) - 1 as idx "
                  "from v_prices", "v_prices"),
)
def q_w8(spark, sf_dir):
    """W8 0-based row position over the whole daily price series."""
    return add_row_index(vw.v_prices(spark, sf_dir), "date", index_col="idx")


# ----------------------------------------------------------- E: compositions
def _e1_sql() -> str:
    lag_pairs = [p for c in ("HDD", "CDD") for p in _lag_sql(c, wx.WEATHER_LAGS)]
    roll_pairs = [p for c in ("HDD", "CDD") for p in _roll_sql(c, wx.WEATHER_WINDOWS)]
    dd = f"select date, {_hdd('temperature')} as HDD, {_cdd('temperature')} as CDD from v_weather"
    inner = (f"select *, HDD * CDD as HDD_CDD_interaction from (select *, {', '.join(_weather_cal_sql())} from ("
             f"select *, {_sel(lag_pairs + roll_pairs)} from ({dd}) a window w as (order by date)) b) c")
    doubles = ["HDD", "CDD"] + [n for _, n in lag_pairs + roll_pairs] + WEATHER_CAL_DOUBLES + ["HDD_CDD_interaction"]
    return rsql(vw.with_views(inner, "v_weather"), doubles)


@register("e1_weather_features", _e1_sql())
def q_e1(spark, sf_dir):
    """E1 weather features, literal mode (49 columns)."""
    return fe.weather_features(vw.v_weather(spark, sf_dir))


def _e2_sql() -> str:
    lag_pairs = [p for c in ("working_gas", "storage_yoy_deviation", "storage_cover_days")
                 for p in _lag_sql(c, st.STORAGE_LAGS)]
    roll_pairs = [p for c in ("working_gas", "storage_yoy_deviation")
                  for p in _roll_sql(c, st.STORAGE_WINDOWS, "w", ("mean", "std", "min", "max"))]
    chg = ("working_gas - lag(working_gas) over w", "(f / nullif(lag(f) over w, 0) - 1) * 100")
    t = _T
    cols = [
        ("date", "date"), ("working_gas", "working_gas"), ("five_year_avg", "five_year_avg"),
        ("storage_yoy_deviation", "storage_yoy_deviation"), ("storage_yoy_deviation_pct", "storage_yoy_deviation_pct"),
        ("estimated_daily_consumption", "estimated_daily_consumption"), ("storage_cover_days", "storage_cover_days"),
        (chg[0], "storage_change"), (chg[1], "storage_change_pct"),
    ] + lag_pairs + roll_pairs
    cal = _storage_cal_sql()
    tight = [
        (t, "storage_tightness"),
        (_flag(f"{t} < -0.1"), "storage_very_tight"),
        (_flag(f"{t} >= -0.1 and {t} < -0.05"), "storage_tight"),
        (_flag(f"{t} >= -0.05 and {t} < 0.05"), "storage_normal"),
        (_flag(f"{t} >= 0.05"), "storage_loose"),
        (chg[0], "storage_velocity"), (chg[1], "storage_velocity_pct"),
        (_TREND, "storage_trend"),
    ]
    base = (f"select *, last_value(working_gas ignore nulls) over "
            f"(order by date rows between unbounded preceding and current row) as f from ({_ST_BASE}) s0")
    inner = (
        "select * exclude (f), working_gas + storage_trend * 4 as storage_projected_4w, "
        "working_gas + storage_trend * 8 as storage_projected_8w, "
        "working_gas * is_injection_season as storage_injection_interaction from ("
        f"select {_sel(cols)}, {', '.join(cal)}, {_sel(tight)}, f from ({base}) s1 window w as (order by date)) s2"
    )
    doubles = (_ST_BASE_DOUBLES + ["storage_change", "storage_change_pct"] + [n for _, n in lag_pairs + roll_pairs]
               + ["month_sin", "month_cos", "storage_tightness", "storage_velocity", "storage_velocity_pct",
                  "storage_trend", "storage_projected_4w", "storage_projected_8w", "storage_injection_interaction"])
    return rsql(vw.with_views(inner, "v_storage"), doubles)


@register("e2_storage_features", _e2_sql())
def q_e2(spark, sf_dir):
    """E2 storage features (63 columns)."""
    return fe.storage_features(vw.v_storage(spark, sf_dir))


# ---------------------------------------------------- A: aggregations, joins
from tidewise.operators import impute as im  # noqa: E402
from tidewise.operators import joins as jn  # noqa: E402
from tidewise.operators.power import gas_burn_proxy  # noqa: E402
from tidewise.sources import landed as ld  # noqa: E402
from tidewise.sources import store as sto  # noqa: E402


@register(
    "a1_gas_burn",
    rsql(vw.with_views("select ba, cast(ts as date) as date, coalesce(sum(total_load * 0.4), 0) as gas_burn_mwh "
                       "from v_power where ts is not null group by ba, cast(ts as date)", "v_power"),
         ["gas_burn_mwh"]),
)
def q_a1(spark, sf_dir):
    """A1 daily gas-burn proxy per balancing area (0.4 x total load)."""
    return gas_burn_proxy(vw.v_power(spark, sf_dir), "ts", by=["ba"])


_W_CASE = ("case region when 'Northeast' then 0.25 when 'Midwest' then 0.20 when 'South' then 0.30 "
           "when 'West' then 0.25 else 0.1 end")


@register(
    "a2_regional_degree_days",
    rsql(vw.with_views(
        "select date, case when count(hdd * w) = count(*) then sum(hdd * w) end as HDD_weighted, "
        "case when count(cdd * w) = count(*) then sum(cdd * w) end as CDD_weighted from ("
        f"select date, {_hdd('temperature')} as hdd, {_cdd('temperature')} as cdd, {_W_CASE} as w "
        "from v_weather_region) x group by date", "v_weather_region"), ["HDD_weighted", "CDD_weighted"]),
)
def q_a2(spark, sf_dir):
    """A2 population-weighted degree days per date (J5 weight lookup)."""
    return wx.regional_degree_days(vw.v_weather_region(spark, sf_dir))


_ALL_TABLES = ("prices", "storage_weekly", "production_monthly", "lng_monthly", "power_burn", "weather_daily",
               "rigs_weekly")
_J1_SELECT = (
    "select p.date, p.spot_price, p.front_month, p.m1_m2_spread, s.working_gas, s.five_year_avg, s.yoy_deviation, "
    "s.wow_change, pr.dry_gas_bcfpd, l.exports_bcf, l.lng_capacity_bcfpd, pb.gas_mwh, pb.total_load_mwh, "
    "pb.renewables_mwh, w.hdd, w.cdd, w.temperature, r.total_rigs, r.gas_rigs from prices p "
    "left join storage_weekly s on p.date = s.report_date left join production_monthly pr on p.date = pr.month "
    "left join lng_monthly l on p.date = l.month left join power_burn pb on p.date = pb.date "
    "left join weather_daily w on p.date = w.date left join rigs_weekly r on p.date = r.date"
)
_J1_DOUBLES = [c for _, c in jn.MATRIX_COLUMNS if c not in ("date", "total_rigs", "gas_rigs")]


@register("j1_feature_matrix", rsql(f"{ld.tables_sql(*_ALL_TABLES)}\n{_J1_SELECT}", _J1_DOUBLES))
def q_j1(spark, sf_dir):
    """J1 exact-date feature matrix (fan-out by region / balancing area)."""
    return jn.feature_matrix(ld.tables(spark, sf_dir))


@register(
    "j2_forecast_merge",
    rsql(vw.with_views(
        "select h.*, f.temperature as temperature_forecast, f.temperature - h.temperature as temp_forecast_error, "
        f"{_hdd('f.temperature')} as HDD_forecast, {_cdd('f.temperature')} as CDD_forecast from ({_WX_DD}) h "
        "left join v_forecast f on h.date = f.date", "v_weather", "v_forecast"),
        ["temperature", "wind_speed", "HDD", "CDD", "temperature_forecast", "temp_forecast_error", "HDD_forecast",
         "CDD_forecast"]),
)
def q_j2(spark, sf_dir):
    """J2 forecast merge with suffixing, forecast error and forecast degree days."""
    hist = wx.degree_days(vw.v_weather(spark, sf_dir), keep_input=True)
    return wx.forecast_merge(hist, vw.v_forecast(spark, sf_dir))


@register(
    "j3_combine",
    rsql(vw.with_views(
        "select p.date, p.spot_price, w.temperature as wx_temperature, w.wind_speed as wx_wind_speed, "
        "s.working_gas as st_working_gas, s.five_year_avg as st_five_year_avg from v_prices p "
        "left join v_weather w on p.date = w.date left join v_storage s on p.date = s.date",
        "v_prices", "v_weather", "v_storage"),
        ["spot_price", "wx_temperature", "wx_wind_speed", "st_working_gas", "st_five_year_avg"]),
)
def q_j3(spark, sf_dir):
    """J3 side-by-side combination on date with per-frame prefixes."""
    return fe.combine({"base": vw.v_prices(spark, sf_dir), "wx": vw.v_weather(spark, sf_dir),
                       "st": vw.v_storage(spark, sf_dir)})


@register(
    "j4_asof",
    rsql(vw.with_views(
        "select p.date, p.spot_price, s.working_gas, s.five_year_avg, pr.dry_gas_bcfpd from v_prices p "
        "asof left join v_storage s on p.date >= s.date asof left join v_production pr on p.date >= pr.month",
        "v_prices", "v_storage", "v_production"),
        ["spot_price", "working_gas", "five_year_avg", "dry_gas_bcfpd"]),
)
def q_j4(spark, sf_dir):
    """J4 as-of carry-forward of weekly storage and monthly production to days."""
    p = vw.v_prices(spark, sf_dir)
    s = vw.v_storage(spark, sf_dir)
    pr = vw.v_production(spark, sf_dir)
    x = jn.asof_join(p, s, "date", "date", ["working_gas", "five_year_avg"])
    return jn.asof_join(x, pr, "date", "month", ["dry_gas_bcfpd"])


_WD_DOUBLES = ["hdd", "cdd", "hdd_norm_delta", "cdd_norm_delta", "temperature", "wind_speed"]


@register(
    "c1_scan_range",
    rsql(f"{ld.tables_sql('weather_daily')}\nselect * from weather_daily "
         "where date >= date '1995-06-01' and date <= date '1997-06-30' order by date", _WD_DOUBLES),
)
def q_c1(spark, sf_dir):
    """C1 inclusive date-range scan of weather_daily, ordered by date."""
    return sto.scan_range(ld.weather_daily(spark, sf_dir), "weather_daily", "1995-06-01", "1997-06-30")


@register(
    "c2_latest",
    rsql(f"{ld.tables_sql('weather_daily')}\nselect * from weather_daily "
         "where date = (select max(date) from weather_daily)", _WD_DOUBLES),
)
def q_c2(spark, sf_dir):
    """C2 all rows at the latest date (ties across regions kept)."""
    return sto.latest(ld.weather_daily(spark, sf_dir), "weather_daily")


@register(
    "u1_concat",
    rsql(vw.with_views("select date, temperature, wind_speed, 'All' as region from v_weather "
                       "union all by name select * from v_weather_region", "v_weather", "v_weather_region"),
         ["temperature", "wind_speed"]),
)
def q_u1(spark, sf_dir):
    """U1 row concatenation aligned by column name (missing columns null)."""
    a = vw.v_weather(spark, sf_dir).withColumn("region", F.lit("All"))
    return a.unionByName(vw.v_weather_region(spark, sf_dir), allowMissingColumns=True)


_MED_COLS = [c for _, c in jn.MATRIX_COLUMNS if c != "date"]


def _p10_sql() -> str:
    meds = ", ".join(f"median(cast({c} as double)) as {c}" for c in _MED_COLS)
    fills = ", ".join(f"coalesce(cast(m.{c} as double), med.{c}) as {c}" for c in _MED_COLS)
    return rsql(
        f"{ld.tables_sql(*_ALL_TABLES)}, m as ({_J1_SELECT}), med as (select {meds} from m)\n"
        f"select m.date, {fills} from m cross join med where coalesce(m.spot_price, med.spot_price) is not null",
        _MED_COLS)


@register("p10_median_impute", _p10_sql())
def q_p10(spark, sf_dir):
    """P10 whole-sample exact-median fill of every numeric column of the matrix."""
    return im.median_impute(jn.feature_matrix(ld.tables(spark, sf_dir)), "spot_price", _MED_COLS)


@register(
    "p11_training_window",
    rsql(f"{ld.tables_sql(*_ALL_TABLES)}, m as ({_J1_SELECT})\nselect * from m where date >= "
         "(select max(date) from m) - 730 and date <= (select max(date) from m)", _J1_DOUBLES),
)
def q_p11(spark, sf_dir):
    """P11 trailing 730-day training window ending at the latest date."""
    start, end = im.window_bounds(vw.daily_orders(spark, sf_dir), 730)
    return jn.feature_matrix(ld.tables(spark, sf_dir, (start, end)), start, end)


# ----------------------------------------------------------- D: extensions
from tidewise.operators import extensions as ex  # noqa: E402


@register(
    "d1_five_year_avg",
    rsql(vw.with_views(
        "select date, working_gas, cast(isoyear(date) as int) as iso_year, cast(weekofyear(date) as int) as iso_week, "
        "avg(working_gas) over (partition by weekofyear(date) order by isoyear(date) "
        "range between 5 preceding and 1 preceding) as five_year_avg from v_storage", "v_storage"),
        ["working_gas", "five_year_avg"]),
)
def q_d1(spark, sf_dir):
    """D1 five-year average of the same ISO week over the prior five ISO years."""
    return ex.five_year_average(vw.v_storage(spark, sf_dir).drop("five_year_avg"))


@register(
    "d6_horizon_target",
    rsql(vw.with_views(
        "select date, spot_price, lead(spot_price, 7) over w as target_7, lead(spot_price, 14) over w as target_14, "
        "lead(spot_price, 30) over w as target_30 from v_prices window w as (order by date)", "v_prices"),
        ["spot_price", "target_7", "target_14", "target_30"]),
)
def q_d6(spark, sf_dir):
    """D6 horizon targets: the price h rows ahead for h = 7, 14, 30."""
    return ex.horizon_targets(vw.v_prices(spark, sf_dir), "spot_price")


def _d8_sql() -> str:
    return (f"with e2 as (select * from ({_e2_sql()}))\n"
            "select date, feature_name, cast(feature_value as double) as feature_value from "
            "(unpivot e2 on columns(* exclude (date)) into name feature_name value feature_value) u")


@register("d8_unpivot_features", _d8_sql())
def q_d8(spark, sf_dir):
    """D8 wide storage features to the long (date, feature_name, feature_value) table."""
    return ex.to_long(finish(fe.storage_features(vw.v_storage(spark, sf_dir))), ["date"])


# ------------------------------------------------------- M: walk-forward
from tidewise.plans import backtest as bt  # noqa: E402

WF_WINDOW, WF_STEP = 252, 21


def walk_forward_input(spark, sf_dir):
    """Daily prices joined to daily weather (both non-null), x = HDD + 1 and
    x2 = CDD as regressors."""
    p = vw.v_prices(spark, sf_dir)
    w = vw.v_weather(spark, sf_dir).select("date", "temperature")
    j = p.join(w, "date").filter(F.col("spot_price").isNotNull() & F.col("temperature").isNotNull())
    dd = wx.degree_days(j, keep_input=True)
    return dd.select("date", "spot_price", (F.col("HDD") + 1).alias("x"), F.col("CDD").alias("x2"))


_WF_BASE = (
    ", base as (select p.date, p.spot_price, "
    f"{_hdd('w.temperature')} + 1 as x, {_cdd('w.temperature')} as x2 "
    "from v_prices p join v_weather w on p.date = w.date "
    "where p.spot_price is not null and w.temperature is not null)"
)
# positions, folds and test rows of any "base" (date, spot_price, x, ...)
_WF_FOLDS = (
    ", ix as (select *, row_number() over (order by date) - 1 as idx from base)"
    f", kk as (select greatest(0, ceil((count(*) - {WF_STEP} - {WF_WINDOW}) / {WF_STEP})) as k from ix)"
    f", folds as (select distinct cast(floor((idx - {WF_WINDOW}) / {WF_STEP}) as bigint) as fold from ix "
    f"where idx >= {WF_WINDOW} and floor((idx - {WF_WINDOW}) / {WF_STEP}) < (select k from kk))"
    f", test as (select ix.*, cast(floor((idx - {WF_WINDOW}) / {WF_STEP}) as bigint) as fold from ix "
    f"where idx >= {WF_WINDOW})"
)
_WF_BASE += _WF_FOLDS


def _gram(model: str, two: bool) -> str:
    s = (f"select f.fold, sum(x * x) as a, sum(x * x2) as b, sum(x2 * x2) as d, sum(x * spot_price) as u, "
         f"sum(x2 * spot_price) as v from folds f join ix on ix.idx >= f.fold * {WF_STEP} "
         f"and ix.idx < f.fold * {WF_STEP} + {WF_WINDOW} group by f.fold")
    if not two:
        pred = "t.x * coalesce(g.u / nullif(g.a, 0), 0)"
    else:
        det = "(g.a * g.d - g.b * g.b)"
        pred = f"t.x * ((g.d * g.u - g.b * g.v) / {det}) + t.x2 * ((g.a * g.v - g.b * g.u) / {det})"
    return (f"select '{model}' as model, t.fold, t.idx, t.date, t.spot_price as actual, {pred} as prediction "
            f"from test t join ({s}) g on t.fold = g.fold")


_PRED_SQL = _WF_BASE + f", pred as ({_gram('lstsq', False)})"
_METRICS_SQL = (
    ", d as (select *, cast(sign(actual - lag(actual) over w) = sign(prediction - lag(prediction) over w) as double)"
    " as dir from pred window w as (partition by model, fold order by idx))"
    ", m as (select model, fold, fold * 21 as train_start, fold * 21 + 251 as train_end, fold * 21 + 252 as test_start,"
    " fold * 21 + 272 as test_end, avg(abs(actual - prediction)) as mae,"
    " sqrt(avg((actual - prediction) * (actual - prediction))) as rmse,"
    " avg(abs((actual - prediction) / nullif(actual, 0))) * 100 as mape, avg(dir) * 100 as direction_accuracy,"
    " 1 - avg((actual - prediction) * (actual - prediction)) / nullif(var_pop(actual), 0) as r2,"
    " count(*) as n_test, cast(0 as bigint) as n_null, count(*) filter (actual = 0) as mape_skipped from d group by model, fold)"
)
_SUMMARY_SQL = ("select model, " + ", ".join(f"avg({m}) as {m}_mean, stddev_pop({m}) as {m}_std" for m in bt.METRICS)
                + ", count(*) as n_folds from m group by model")
_SUMMARY_DOUBLES = [f"{m}_{s}" for m in bt.METRICS for s in ("mean", "std")]


@register(
    "m1_walk_forward_lstsq",
    rsql(f"{vw.ctes('v_prices', 'v_weather')}{_PRED_SQL}\nselect * from pred", ["actual", "prediction"]),
)
def q_m1(spark, sf_dir):
    """M1 + M5: walk-forward (W=252, s=21) no-intercept least squares, row-level test predictions."""
    return bt.walk_forward_lstsq(walk_forward_input(spark, sf_dir), ["x"], "spot_price", WF_WINDOW, WF_STEP)


@register(
    "a4_fold_metrics",
    rsql(f"{vw.ctes('v_prices', 'v_weather')}{_PRED_SQL}{_METRICS_SQL}\nselect * from m",
         ["mae", "rmse", "mape", "direction_accuracy", "r2"]),
)
def q_a4(spark, sf_dir):
    """A4 per-fold MAE / RMSE / MAPE / direction accuracy (+ R²) of the M1 run."""
    pred = bt.walk_forward_lstsq(walk_forward_input(spark, sf_dir), ["x"], "spot_price", WF_WINDOW, WF_STEP)
    return bt.fold_metrics(pred, WF_WINDOW, WF_STEP)


@register(
    "w7_direction",
    rsql(f"{vw.ctes('v_prices', 'v_weather')}{_PRED_SQL}{_METRICS_SQL}\n"
         "select model, fold, direction_accuracy from m", ["direction_accuracy"]),
)
def q_w7(spark, sf_dir):
    """W7 direction agreement per fold."""
    pred = bt.walk_forward_lstsq(walk_forward_input(spark, sf_dir), ["x"], "spot_price", WF_WINDOW, WF_STEP)
    return bt.fold_metrics(pred, WF_WINDOW, WF_STEP).select("model", "fold", "direction_accuracy")


@register(
    "a5_summary",
    rsql(f"{vw.ctes('v_prices', 'v_weather')}{_PRED_SQL}{_METRICS_SQL}\n{_SUMMARY_SQL}", _SUMMARY_DOUBLES),
)
def q_a5(spark, sf_dir):
    """A5 across-fold mean and population std of the four metrics."""
    pred = bt.walk_forward_lstsq(walk_forward_input(spark, sf_dir), ["x"], "spot_price", WF_WINDOW, WF_STEP)
    return bt.summary(bt.fold_metrics(pred, WF_WINDOW, WF_STEP))


_M2_PRED = _WF_BASE + (f", pred as ({_gram('hdd', False)} union all {_gram('hdd_cdd', True)})")


@register(
    "m2_compare",
    rsql(f"{vw.ctes('v_prices', 'v_weather')}{_M2_PRED}{_METRICS_SQL}\n{_SUMMARY_SQL}", _SUMMARY_DOUBLES),
)
def q_m2(spark, sf_dir):
    """M2 two least-squares models (1 and 2 regressors) over identical folds."""
    pred = bt.compare_lstsq(walk_forward_input(spark, sf_dir), {"hdd": ["x"], "hdd_cdd": ["x", "x2"]},
                            "spot_price", WF_WINDOW, WF_STEP)
    return bt.summary(bt.fold_metrics(pred, WF_WINDOW, WF_STEP))


# ------------------------------------------------------------- S: sources
from tidewise.operators import extensions as _ex  # noqa: E402
from tidewise.plans import report as rp  # noqa: E402
from tidewise.sources import forecast as fc  # noqa: E402
from tidewise.sources import series as se  # noqa: E402


@register(
    "s1_series_json",
    rsql(vw.with_views(
        "select 'NG.RNGWHHD.D' as series_id, 'henry_hub_spot' as series, 'daily' as frequency, date, "
        "spot_price as value from v_prices where spot_price is not null and day(date) <> 29 union all "
        "select 'NG.N9010US2.M', 'production', 'monthly', month, dry_gas_bcfpd from v_production "
        "where dry_gas_bcfpd is not null", "v_prices", "v_production"), ["value"]),
)
def q_s1(spark, sf_dir):
    """Series payload pages derived from the tables, parsed back
    (bad numbers and nulls dropped, monthly periods to first-of-month)."""
    daily = se.pages(vw.v_prices(spark, sf_dir), "NG.RNGWHHD.D", "spot_price", bad_value_day=29)
    monthly = se.pages(vw.v_production(spark, sf_dir).withColumnRenamed("month", "date"), "NG.N9010US2.M",
                       "dry_gas_bcfpd", monthly=True)
    long = se.core_series(daily.unionByName(monthly))
    return long.select("series_id", "series", "frequency", "date", "value")


_STATIONS_SQL = "(values " + ", ".join(f"('{n}', '{r}')" for n, _, _, r in fc.STATIONS) + ") st(station, region)"


@register(
    "s3_forecast_json",
    rsql(vw.with_views(
        "select station, period_no, date, temperature, "
        "case when day(date) = 1 then '' else cast(cast(floor(temperature / 10 + 0.5) as int) as varchar) || ' mph' end "
        "as wind_speed, case when day(date) = 1 then null else cast(cast(floor(temperature / 10 + 0.5) as int) as double) "
        "end as wind_mph, case when day(date) = 2 then 0.0 when day(date) = 3 then null "
        "else cast(day(date) * 3 as double) end as precipitation, region from ("
        "select s.station, v.region, v.date, v.temperature, cast(row_number() over (partition by s.station, "
        "date_trunc('week', v.date) order by v.date) - 1 as int) as period_no "
        f"from v_weather_region v join {_STATIONS_SQL} on v.region = st.region join "
        f"(select * from {_STATIONS_SQL}) s on s.station = st.station) x where period_no < 5",
        "v_weather_region"), ["temperature", "wind_mph", "precipitation"]),
)
def q_s3(spark, sf_dir):
    """Forecast pages per (station, week) derived from regional
    temperatures, parsed (first 5 periods) and tagged with the region."""
    payloads = fc.forecast_pages(vw.v_weather_region(spark, sf_dir), spark)
    return fc.regional_forecast(payloads, days=5)


def _o2_sql() -> str:
    e1 = _e1_sql()
    return (
        vw.ctes("v_prices") + f", e1 as (select * from ({e1}))"
        ", lng as (unpivot e1 on columns(* exclude (date)) into name feature_name value feature_value)"
        ", imp as (select feature_name, abs(covar_pop(cast(l.feature_value as double), p.spot_price) / "
        "nullif(stddev_pop(cast(l.feature_value as double)) * stddev_pop(p.spot_price), 0)) as importance "
        "from lng l join v_prices p on l.date = p.date group by feature_name)\n"
        f"select feature_name, {_r6('importance')} as importance from imp "
        "where importance is not null and not isnan(importance) order by importance desc, feature_name limit 10"
    )


@register("o2_topk", _o2_sql())
def q_o2(spark, sf_dir):
    """O2: top-10 weather features by |correlation| with the price (the
    model-free importance table), a TakeOrderedAndProject."""
    e1 = finish(fe.weather_features(vw.v_weather(spark, sf_dir)))
    long = _ex.to_long(e1, ["date"])
    imp = rp.correlation_importance(long, vw.v_prices(spark, sf_dir), "spot_price")
    return rp.top_k(imp, "importance", 10, tiebreak="feature_name")


@register(
    "k7_report",
    f"{vw.ctes('v_prices', 'v_weather')}{_M2_PRED}{_METRICS_SQL}, s as ({_SUMMARY_SQL})\n"
    "select model, printf('%.4f ± %.4f', mae_mean, mae_std) as mae, printf('%.4f ± %.4f', rmse_mean, rmse_std) as rmse, "
    "printf('%.2f%% ± %.2f%%', mape_mean, mape_std) as mape, "
    "printf('%.2f%% ± %.2f%%', direction_accuracy_mean, direction_accuracy_std) as direction_accuracy from s",
)
def q_k7(spark, sf_dir):
    """K7 evaluation report rows (mean ± std per model) of the M2 comparison."""
    pred = bt.compare_lstsq(walk_forward_input(spark, sf_dir), {"hdd": ["x"], "hdd_cdd": ["x", "x2"]},
                            "spot_price", WF_WINDOW, WF_STEP)
    return rp.report(bt.summary(bt.fold_metrics(pred, WF_WINDOW, WF_STEP)))


# ------------------------------------- models, grouped map, streams, sinks
import uuid  # noqa: E402

from tidewise.session import scratch_path  # noqa: E402
from tidewise.streaming import power as sp  # noqa: E402


@register("x2_grouped_lstsq", rsql(f"{vw.ctes('v_prices', 'v_weather')}{_PRED_SQL}\nselect * from pred",
                                   ["actual", "prediction"]))
def q_x2(spark, sf_dir):
    """X2(b): any fit/predict Python model through one applyInPandas group per
    fold (here the numpy least-squares model, so it must equal M1)."""
    return bt.walk_forward_grouped(walk_forward_input(spark, sf_dir), bt.NumpyLeastSquares, ["x"], "spot_price",
                                   WF_WINDOW, WF_STEP, model_name="lstsq")


@register(
    "st1_stream_gas_burn",
    rsql("select event_type as ba, cast(ts as date) as date, "
         "cast(sum(cast(value as decimal(18,2))) as double) * 0.4 as gas_burn_mwh from events "
         "where ts is not null group by event_type, cast(ts as date)", ["gas_burn_mwh"]),
)
def q_st1(spark, sf_dir):
    """A1 on a stream of the event files: exactly-once per-batch partial
    sums in the shared folder, merged."""
    return sp.run_gas_burn_batches(sp.events_stream(spark, sf_dir), scratch_path(spark, f"gas_burn/{uuid.uuid4().hex}"))


@register(
    "k2_append_roundtrip",
    vw.with_views(f"select date, 'HenryHub' as hub, {_r6('cast(cast(spot_price as decimal(10,4)) as double)')} "
                  "as spot_price from v_prices", "v_prices"),
)
def q_k2(spark, sf_dir):
    """K1/K2/K3: prices appended to a fresh stored table (typed, partitioned
    by year-month, key-checked) and read back."""
    root = scratch_path(spark, f"store/{uuid.uuid4().hex}")
    sto.append(ld.prices(spark, sf_dir), root, "prices")
    back = sto.read_stored(spark, root, "prices")
    return back.select("date", "hub", F.col("spot_price").cast("double").alias("spot_price"))


# ------------------------------------------------ matrix variants, D3, D9, E3, A6
_J1_FROM_ROLLUP = (
    "left join (select date, sum(gas_mwh) as gas_mwh, sum(total_load_mwh) as total_load_mwh, "
    "sum(renewables_mwh) as renewables_mwh from power_burn group by date) pb on p.date = pb.date "
    "left join (select date, avg(hdd) as hdd, avg(cdd) as cdd, avg(temperature) as temperature from weather_daily "
    "group by date) w on p.date = w.date"
)
_J1_COLS = (
    "select p.date, p.spot_price, p.front_month, p.m1_m2_spread, s.working_gas, s.five_year_avg, s.yoy_deviation, "
    "s.wow_change, pr.dry_gas_bcfpd, l.exports_bcf, l.lng_capacity_bcfpd, pb.gas_mwh, pb.total_load_mwh, "
    "pb.renewables_mwh, w.hdd, w.cdd, w.temperature, r.total_rigs, r.gas_rigs from prices p "
)


@register(
    "j1_feature_matrix_rollup",
    rsql(f"{ld.tables_sql(*_ALL_TABLES)}\n{_J1_COLS}"
         "left join storage_weekly s on p.date = s.report_date left join production_monthly pr on p.date = pr.month "
         f"left join lng_monthly l on p.date = l.month {_J1_FROM_ROLLUP} left join rigs_weekly r on p.date = r.date",
         _J1_DOUBLES),
)
def q_j1r(spark, sf_dir):
    """J1 with entity roll-up: one row per price date (power summed, weather averaged)."""
    return jn.feature_matrix(ld.tables(spark, sf_dir), rollup_entities=True)


@register(
    "j1_feature_matrix_asof",
    rsql(f"{ld.tables_sql(*_ALL_TABLES)}\n{_J1_COLS}"
         "asof left join storage_weekly s on p.date >= s.report_date "
         "asof left join production_monthly pr on p.date >= pr.month "
         f"asof left join lng_monthly l on p.date >= l.month {_J1_FROM_ROLLUP} "
         "asof left join rigs_weekly r on p.date >= r.date", _J1_DOUBLES),
)
def q_j1a(spark, sf_dir):
    """J1 + J4: weekly/monthly tables carried forward to every price date
    (one fill pass for all four), entity tables rolled up."""
    return jn.feature_matrix(ld.tables(spark, sf_dir), mode="asof", rollup_entities=True)


@register(
    "a6_series_summary",
    vw.with_views(
        "select 'prices' as series, min(date) as first_date, max(date) as last_date, count(*) as n_rows, "
        "count(spot_price) as n_values from v_prices union all "
        "select 'weather', min(date), max(date), count(*), count(temperature) from v_weather union all "
        "select 'storage', min(date), max(date), count(*), count(working_gas) from v_storage",
        "v_prices", "v_weather", "v_storage"),
)
def q_a6(spark, sf_dir):
    """A6 first/last date and counts of the three core series."""
    return (_ex.series_summary(vw.v_prices(spark, sf_dir), "prices", "spot_price")
            .unionByName(_ex.series_summary(vw.v_weather(spark, sf_dir), "weather", "temperature"))
            .unionByName(_ex.series_summary(vw.v_storage(spark, sf_dir), "storage", "working_gas")))


@register(
    "d3_norm_delta",
    rsql(f"{ld.tables_sql('weather_daily')}\nselect date, region, hdd, cdd, "
         "hdd - avg(hdd) over w as hdd_norm_delta, cdd - avg(cdd) over w as cdd_norm_delta from weather_daily "
         "window w as (partition by region, dayofyear(date) order by year(date) "
         "range between unbounded preceding and 1 preceding)",
         ["hdd", "cdd", "hdd_norm_delta", "cdd_norm_delta"]),
)
def q_d3(spark, sf_dir):
    """D3 degree days minus the same region / day-of-year mean of earlier years."""
    wd = ld.weather_daily(spark, sf_dir).select("date", "region", "hdd", "cdd")
    return _ex.norm_deltas(wd)


@register(
    "d9_predictions",
    rsql(f"{vw.ctes('v_prices', 'v_weather')}{_M2_PRED}"
         ", b as (select model, quantile_cont(actual - prediction, 0.1) as q10, "
         "quantile_cont(actual - prediction, 0.9) as q90 from pred group by model)\n"
         "select p.date, p.model as model_name, cast(0 as int) as horizon_days, p.prediction, "
         "p.prediction + b.q10 as confidence_lower, p.prediction + b.q90 as confidence_upper, "
         "p.actual as actual_value, p.actual - p.prediction as error from pred p left join b on p.model = b.model",
         ["prediction", "confidence_lower", "confidence_upper", "actual_value", "error"]),
)
def q_d9(spark, sf_dir):
    """D7 + D9: predictions-table rows with exact residual-quantile bands (10 % / 90 %) and error."""
    pred = bt.compare_lstsq(walk_forward_input(spark, sf_dir), {"hdd": ["x"], "hdd_cdd": ["x", "x2"]},
                            "spot_price", WF_WINDOW, WF_STEP)
    from tidewise.session import cut_lineage

    pred = cut_lineage(pred)
    return _ex.prediction_rows(pred, _ex.residual_bands(pred))


def _e3_sql() -> str:
    parts = [f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in _ALL_TABLES]
    return f"{ld.tables_sql(*_ALL_TABLES)}\n" + " union all ".join(parts)


@register("e3_ingest_all", _e3_sql())
def q_e3(spark, sf_dir):
    """Every landed table appended to a fresh store (typed, key-checked,
    year-month partitioned) and counted back from storage."""
    root = scratch_path(spark, f"store/{uuid.uuid4().hex}")
    sto.ingest_all(ld.tables(spark, sf_dir), root)
    parts = [sto.read_stored(spark, root, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for t in _ALL_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "d2_storage_declared",
    rsql(f"{ld.tables_sql('storage_weekly')}\nselect report_date, working_gas, five_year_avg, "
         "working_gas - five_year_avg as yoy_deviation, "
         "working_gas - lag(working_gas) over (order by report_date) as wow_change from storage_weekly",
         ["working_gas", "five_year_avg", "yoy_deviation", "wow_change"]),
)
def q_d2(spark, sf_dir):
    """D2 declared storage columns: deviation and week-over-week change."""
    return _ex.fill_declared_storage(ld.storage_weekly(spark, sf_dir))


@register(
    "d5_power_lags",
    rsql(f"{ld.tables_sql('power_burn')}\nselect date, ba, gas_mwh, "
         "lag(gas_mwh, 1) over w as gas_mwh_lag_1, lag(gas_mwh, 7) over w as gas_mwh_lag_7, "
         "lag(gas_mwh, 14) over w as gas_mwh_lag_14 from power_burn window w as (partition by ba order by date)",
         ["gas_mwh", "gas_mwh_lag_1", "gas_mwh_lag_7", "gas_mwh_lag_14"]),
)
def q_d5(spark, sf_dir):
    """D5 gas-burn lags 1, 7, 14 per balancing area (keyed halo window)."""
    return _ex.power_burn_lags(ld.power_burn(spark, sf_dir).select("date", "ba", "gas_mwh"))


@register(
    "j5_region_weight",
    rsql(vw.with_views(f"select *, {_W_CASE} as weight from v_weather_region", "v_weather_region"),
         ["temperature", "weight"]),
)
def q_j5(spark, sf_dir):
    """J5 region weight lookup with the 0.1 default for unmatched regions."""
    return wx.with_region_weight(vw.v_weather_region(spark, sf_dir))


def _w2r_sql() -> str:
    pairs = []
    for n in wx.WEATHER_WINDOWS:
        frame = f"(partition by region order by date rows between {n - 1} preceding and current row)"
        for stat, fn in (("", "avg"), ("_std", "stddev_samp"), ("_max", "max"), ("_min", "min")):
            pairs.append((f"case when count(temperature) over {frame} = {n} then {fn}(temperature) over {frame} end",
                          f"temperature_rolling_{n}{stat}"))
    lags = [(f"lag(temperature, {k}) over (partition by region order by date)", f"temperature_lag_{k}")
            for k in wx.WEATHER_LAGS]
    inner = f"select *, {_sel(lags + pairs)} from v_weather_region"
    return rsql(vw.with_views(inner, "v_weather_region"), ["temperature"] + [n for _, n in lags + pairs])


@register("w2_weather_rolling_by_region", _w2r_sql())
def q_w2r(spark, sf_dir):
    """W1 + W2 per region (keyed halo plan: lags and rolling statistics of
    each region's own series)."""
    df = vw.v_weather_region(spark, sf_dir)
    return windowed(df, lambda w: wx.lag_cols(w, "temperature", wx.WEATHER_LAGS)
                    + wx.rolling_cols(w, "temperature", wx.WEATHER_WINDOWS), "date", ["region"], 30)


def _e1_full_sql() -> str:
    targets = ("HDD", "CDD", "temperature")
    lag_pairs = [p for c in targets for p in _lag_sql(c, wx.WEATHER_LAGS)]
    roll_pairs = [p for c in targets for p in _roll_sql(c, wx.WEATHER_WINDOWS)]
    win = f"select *, {_sel(lag_pairs + roll_pairs)} from ({_WX_DD}) a window w as (order by date)"
    merged = (f"select b.*, f.temperature as temperature_forecast, f.temperature - b.temperature as "
              f"temp_forecast_error, {_hdd('f.temperature')} as HDD_forecast, {_cdd('f.temperature')} as CDD_forecast "
              f"from ({win}) b left join v_forecast f on b.date = f.date")
    inner = (f"select *, HDD * CDD as HDD_CDD_interaction, temperature * wind_speed as temp_wind_interaction, "
             f"HDD * wind_speed as HDD_wind_interaction from (select *, {', '.join(_weather_cal_sql())} "
             f"from ({merged}) c) d")
    doubles = (["temperature", "wind_speed", "HDD", "CDD"] + [n for _, n in lag_pairs + roll_pairs]
               + ["temperature_forecast", "temp_forecast_error", "HDD_forecast", "CDD_forecast"]
               + WEATHER_CAL_DOUBLES + ["HDD_CDD_interaction", "temp_wind_interaction", "HDD_wind_interaction"])
    return rsql(vw.with_views(inner, "v_weather", "v_forecast"), doubles)


@register("e1_weather_features_full", _e1_full_sql())
def q_e1_full(spark, sf_dir):
    """E1, full mode with the forecast: inputs kept, so temperature lags and
    rolling statistics, the forecast merge (suffix, error, forecast degree
    days) and the wind interactions all fire (74 columns)."""
    return fe.weather_features(vw.v_weather(spark, sf_dir), vw.v_forecast(spark, sf_dir), mode="full")


def _p10f_sql() -> str:
    W, S = WF_WINDOW, WF_STEP
    j1r = (f"{_J1_COLS}left join storage_weekly s on p.date = s.report_date left join production_monthly pr "
           f"on p.date = pr.month left join lng_monthly l on p.date = l.month {_J1_FROM_ROLLUP} "
           "left join rigs_weekly r on p.date = r.date")
    det = "(g.a * g.d - g.b * g.b)"
    return rsql(
        f"{ld.tables_sql(*_ALL_TABLES)}, m as ({j1r})"
        ", ix as (select date, spot_price, hdd, working_gas, row_number() over (order by date) - 1 as idx from m)"
        f", kk as (select greatest(0, ceil((count(*) - {S} - {W}) / {S})) as k from ix)"
        f", folds as (select distinct cast(floor((idx - {W}) / {S}) as bigint) as fold from ix where idx >= {W} "
        f"and floor((idx - {W}) / {S}) < (select k from kk))"
        f", roles as (select f.fold, 0 as test, ix.* from folds f join ix on ix.idx >= f.fold * {S} "
        f"and ix.idx < f.fold * {S} + {W} union all select f.fold, 1 as test, ix.* from folds f join ix "
        f"on ix.idx >= f.fold * {S} + {W} and ix.idx < f.fold * {S} + {W + S})"
        ", med as (select fold, median(hdd) as mh, median(working_gas) as mw, median(spot_price) as ms "
        "from roles where test = 0 group by fold)"
        ", filled as (select r.fold, r.test, r.idx, r.date, coalesce(r.hdd, med.mh) as x1, "
        "coalesce(r.working_gas, med.mw) as x2, coalesce(r.spot_price, med.ms) as y from roles r "
        "left join med on r.fold = med.fold)"
        ", g as (select fold, sum(x1 * x1) as a, sum(x1 * x2) as b, sum(x2 * x2) as d, sum(x1 * y) as u, "
        "sum(x2 * y) as v from filled where test = 0 and y is not null group by fold)\n"
        "select 'lstsq' as model, t.fold, t.idx, t.date, t.y as actual, "
        f"t.x1 * ((g.d * g.u - g.b * g.v) / {det}) + t.x2 * ((g.a * g.v - g.b * g.u) / {det}) as prediction "
        "from filled t join g on t.fold = g.fold where t.test = 1 and t.y is not null",
        ["actual", "prediction"])


@register("p10_train_fold_walk_forward", _p10f_sql())
def q_p10f(spark, sf_dir):
    """P10 at scope="train_fold" inside M1: per-fold medians of the training
    rows fill the gaps of the rolled-up matrix (hdd, sparse weekly
    working_gas, target), then fold least squares."""
    m = jn.feature_matrix(ld.tables(spark, sf_dir), rollup_entities=True).select(
        "date", "spot_price", "hdd", "working_gas")
    return bt.walk_forward_lstsq_fold_imputed(m, ["hdd", "working_gas"], "spot_price", WF_WINDOW, WF_STEP)


def _e1_region_sql() -> str:
    targets = ("HDD", "CDD", "temperature")
    w = "(partition by region order by date)"
    lags = [(f'lag("{c}", {k}) over {w}', f"{c}_lag_{k}") for c in targets for k in wx.WEATHER_LAGS]
    rolls = []
    for c in targets:
        for n in wx.WEATHER_WINDOWS:
            frame = f"(partition by region order by date rows between {n - 1} preceding and current row)"
            for stat, fn in (("", "avg"), ("_std", "stddev_samp"), ("_max", "max"), ("_min", "min")):
                rolls.append((f'case when count("{c}") over {frame} = {n} then {fn}("{c}") over {frame} end',
                              f"{c}_rolling_{n}{stat}"))
    dd = (f"select *, {_hdd('temperature')} as HDD, {_cdd('temperature')} as CDD from v_weather_region")
    inner = (f"select *, HDD * CDD as HDD_CDD_interaction from (select *, {', '.join(_weather_cal_sql())} from ("
             f"select *, {_sel(lags + rolls)} from ({dd}) a) b) c")
    doubles = (["temperature", "HDD", "CDD"] + [n for _, n in lags + rolls] + WEATHER_CAL_DOUBLES
               + ["HDD_CDD_interaction"])
    return rsql(vw.with_views(inner, "v_weather_region"), doubles)


@register("e1_weather_features_by_region", _e1_region_sql())
def q_e1_region(spark, sf_dir):
    """E1 over many series: full mode per region (lags, rolling statistics,
    calendar and interactions of each region's own series; keyed halo plan)."""
    return fe.weather_features(vw.v_weather_region(spark, sf_dir), mode="full", partition_cols=["region"])


from tidewise import registry_models  # noqa: E402, F401
