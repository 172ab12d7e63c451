"""Composed feature stages (E1 weather, E2 storage) and the side-by-side
combination of feature frames (J3).

Each composition builds one lazy plan: the row index is computed once, and
every lag / rolling / trend / difference column of a stage is evaluated by a
single Window operator after a single sort, instead of one pass per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.functions.calendar import storage_calendar_cols, weather_calendar_cols
from tidewise.functions.nulls import clip_lower, flag, safe_div, without_nan
from tidewise.operators.storage import (
    DAILY_CONSUMPTION,
    STORAGE_LAGS,
    STORAGE_WINDOWS,
    TIGHTNESS_EDGES,
    storage_rolling_cols,
    trend_col,
)
from tidewise.operators.weather import (
    BASE_TEMP,
    WEATHER_LAGS,
    WEATHER_WINDOWS,
    forecast_merge,
    lag_cols,
    regional_degree_days,
    rolling_cols,
    weather_interactions,
)
from tidewise.plans.ordered import IDX, add_row_index, forward_fill, windowed


def weather_features(
    weather: DataFrame,
    forecast: DataFrame | None = None,
    mode: str = "literal",
    date_col: str = "date",
    partition_cols: Sequence[str] = (),
    plan: str = "halo",
) -> DataFrame:
    """Degree days -> regional weighting -> lags -> rolling -> forecast
    merge -> calendar -> interactions.

    ``mode="literal"`` keeps only (date, HDD, CDD) after the degree-day step,
    so temperature/region branches do not fire (49 columns for a temperature
    input). ``mode="full"`` keeps the inputs so every branch works: rows of
    several regions (a ``region`` column that is not a partition column) get
    their date's weighted sums ``HDD_weighted`` and ``CDD_weighted`` joined
    back, and the row-ordered stages run per region.
    """
    df = without_nan(weather)
    cols = set(df.columns)
    if "temperature" in cols:
        t = F.col("temperature")
        hdd = clip_lower(F.lit(BASE_TEMP) - t).alias("HDD")
        cdd = clip_lower(t - F.lit(BASE_TEMP)).alias("CDD")
        if mode == "literal":
            df = df.select(date_col, *partition_cols, hdd, cdd)
        else:
            df = df.select("*", hdd, cdd)
    if "region" in df.columns and "region" not in partition_cols:
        df = df.join(regional_degree_days(df, date_col=date_col), date_col)
        partition_cols = [*partition_cols, "region"]
    targets = [c for c in ("HDD", "CDD", "temperature") if c in df.columns]
    if targets:
        def build(w):
            lags = [e for c in targets for e in lag_cols(w, c, WEATHER_LAGS)]
            rolls = [e for c in targets for e in rolling_cols(w, c, WEATHER_WINDOWS)]
            return lags + rolls

        df = windowed(df, build, date_col, partition_cols, max(max(WEATHER_LAGS), max(WEATHER_WINDOWS) - 1), plan)
    if forecast is not None:
        df = forecast_merge(df, forecast, date_col)
    df = df.selectExpr("*", *weather_calendar_cols(date_col))
    return weather_interactions(df)


def storage_features(
    storage: DataFrame,
    date_col: str = "date",
    partition_cols: Sequence[str] = (),
    plan: str = "halo",
    daily_consumption: int = DAILY_CONSUMPTION,
) -> DataFrame:
    """Metrics -> lags -> rolling -> calendar -> tightness -> trend ->
    projections -> interactions (63 columns for date, working_gas,
    five_year_avg)."""
    storage = without_nan(storage)
    cols = set(storage.columns)
    has_wg = "working_gas" in cols
    has_avg = "five_year_avg" in cols
    base = list(storage.columns)
    df = storage
    stage1 = []
    if has_wg and has_avg:
        dev = F.col("working_gas") - F.col("five_year_avg")
        df = df.withColumn("storage_yoy_deviation", dev).withColumn(
            "storage_yoy_deviation_pct", safe_div(F.col("storage_yoy_deviation"), F.col("five_year_avg")) * 100
        )
        stage1 += ["storage_yoy_deviation", "storage_yoy_deviation_pct"]
    if has_wg:
        c = F.lit(daily_consumption).cast("int")
        df = df.withColumn("estimated_daily_consumption", c).withColumn(
            "storage_cover_days", F.col("working_gas") / c
        )
        stage1 += ["estimated_daily_consumption", "storage_cover_days"]

    lag_targets = [c for c in ("working_gas", "storage_yoy_deviation", "storage_cover_days") if c in df.columns]
    roll_targets = [c for c in ("working_gas", "storage_yoy_deviation") if c in df.columns]

    own_idx = plan == "halo" and IDX not in df.columns
    if own_idx and (has_wg or lag_targets):
        # read by the fill summary and by the window: the exchanges below are reused
        df = add_row_index(df, date_col, partition_cols)
    if has_wg:
        df = forward_fill(df, "working_gas", "_wg_pad", date_col, partition_cols, plan=plan)

    def build(w):
        out = []
        if has_wg:
            out += [f"lag(working_gas, 1) {w()} as _wg_prev", f"lag(_wg_pad, 1) {w()} as _wg_pad_prev", trend_col(w)]
        out += [e for c in lag_targets for e in lag_cols(w, c, STORAGE_LAGS)]
        out += [e for c in roll_targets for e in storage_rolling_cols(w, c, STORAGE_WINDOWS)]
        return out

    lookback = max(max(STORAGE_LAGS), max(STORAGE_WINDOWS) - 1)
    if has_wg or lag_targets:
        df = windowed(df, build, date_col, partition_cols, lookback, plan)

    sel = [F.col(c) for c in base + stage1]
    diff = F.col("working_gas") - F.col("_wg_prev")
    pct = (safe_div(F.col("_wg_pad"), F.col("_wg_pad_prev")) - 1) * 100
    if has_wg:
        sel += [diff.alias("storage_change"), pct.alias("storage_change_pct")]
    sel += [F.col(f"{c}_lag_{k}") for c in lag_targets for k in STORAGE_LAGS]
    for c in roll_targets:
        for n in STORAGE_WINDOWS:
            b = f"{c}_rolling_{n}w"
            sel += [F.col(b), F.col(f"{b}_std"), F.col(f"{b}_min"), F.col(f"{b}_max")]
    sel += [F.expr(e) for e in storage_calendar_cols(date_col)]
    if has_wg and has_avg:
        lo, mid, hi = TIGHTNESS_EDGES
        t = safe_div(F.col("working_gas") - F.col("five_year_avg"), F.col("five_year_avg"))
        sel += [
            t.alias("storage_tightness"),
            flag(t < lo).alias("storage_very_tight"),
            flag((t >= lo) & (t < mid)).alias("storage_tight"),
            flag((t >= mid) & (t < hi)).alias("storage_normal"),
            flag(t >= hi).alias("storage_loose"),
        ]
    if has_wg:
        tr = F.col("storage_trend")
        sel += [
            diff.alias("storage_velocity"),
            pct.alias("storage_velocity_pct"),
            tr,
            (F.col("working_gas") + tr * 4).alias("storage_projected_4w"),
            (F.col("working_gas") + tr * 8).alias("storage_projected_8w"),
        ]
    out = df.select(*sel)
    extra = []
    if has_wg:
        extra.append((F.col("working_gas") * F.col("is_injection_season")).alias("storage_injection_interaction"))
    if has_wg and "temperature" in cols:
        extra.append((F.col("working_gas") * F.col("temperature")).alias("storage_temp_interaction"))
    return out.select("*", *extra) if extra else out


def combine(frames: dict[str, DataFrame], on: Sequence[str] = ("date",), how: str = "left") -> DataFrame:
    """Side-by-side combination keyed on ``on`` (not row position).

    The first frame is the base; every other frame's non-key columns get the
    frame's name as prefix (``wx_HDD``...), so duplicate or case-colliding
    names cannot clash. Keys are expected unique per side; duplicates
    multiply rows as in any equi-join.
    """
    items = list(frames.items())
    (_, base), rest = items[0], items[1:]
    out = base
    for name, f in rest:
        renamed = f.select(*on, *[F.col(c).alias(f"{name}_{c}") for c in f.columns if c not in on])
        out = out.join(renamed, list(on), how)
    return out
