"""Storage features: deviation, cover, changes, lags, rolling statistics,
calendar, tightness bins, trend, projections and interactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.functions.calendar import storage_calendar_cols
from tidewise.functions.nulls import flag, safe_div
from tidewise.operators.weather import lag_cols, rolling_cols
from tidewise.plans.ordered import IDX, Over, add_row_index, forward_fill, q, windowed

# Fixed values of the feature definitions.
STORAGE_LAGS = [1, 7, 14, 30]
STORAGE_WINDOWS = [4, 8, 12]
DAILY_CONSUMPTION = 100  # rough daily consumption used for days of cover
TIGHTNESS_EDGES = (-0.1, -0.05, 0.05)
TREND_ROWS = 4


def storage_deviation(df: DataFrame) -> DataFrame:
    """working_gas - five_year_avg and that deviation in percent of the
    average (NULL when the average is 0)."""
    if not {"working_gas", "five_year_avg"} <= set(df.columns):
        return df
    dev = F.col("working_gas") - F.col("five_year_avg")
    return df.select(
        "*",
        dev.alias("storage_yoy_deviation"),
        (safe_div(dev, F.col("five_year_avg")) * 100).alias("storage_yoy_deviation_pct"),
    )


def days_cover(df: DataFrame, daily_consumption: int = DAILY_CONSUMPTION) -> DataFrame:
    """P5: constant consumption column and working_gas / consumption."""
    if "working_gas" not in df.columns:
        return df
    c = F.lit(daily_consumption).cast("int")
    return df.select(
        "*",
        c.alias("estimated_daily_consumption"),
        (F.col("working_gas") / c).alias("storage_cover_days"),
    )


def storage_change(
    df: DataFrame,
    names: Sequence[str] = ("storage_change",),
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
    plan: str = "halo",
    fill: str | None = "pad",
) -> DataFrame:
    """First difference and percent change x100 of working_gas.

    The percent change pads gaps first (previous non-null value), the
    difference does not. Computed once; each name in ``names`` gets an alias
    pair ``{name}``, ``{name}_pct``.
    """
    if "working_gas" not in df.columns:
        return df
    x = df
    own_idx = plan == "halo" and IDX not in df.columns
    if own_idx:
        x = add_row_index(x, order_col, partition_cols)
    if fill == "pad":
        x = forward_fill(x, "working_gas", "_wg_pad", order_col, partition_cols, plan=plan)
    else:
        x = x.withColumn("_wg_pad", F.col("working_gas"))

    def build(w):
        return [f"lag(working_gas, 1) {w()} as _wg_prev", f"lag(_wg_pad, 1) {w()} as _wg_pad_prev"]

    x = windowed(x, build, order_col, partition_cols, 1, plan)
    diff = F.col("working_gas") - F.col("_wg_prev")
    pct = (safe_div(F.col("_wg_pad"), F.col("_wg_pad_prev")) - 1) * 100
    out = []
    for n in names:
        out += [diff.alias(n), pct.alias(f"{n}_pct")]
    return x.select(*df.columns, *out)


def storage_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Month, quarter, ISO week, season flags, month terms."""
    return df.selectExpr("*", *storage_calendar_cols(date_col))


def tightness(df: DataFrame) -> DataFrame:
    """Ratio (wg - avg)/avg and four disjoint 0/1 bins; a null ratio
    (missing gas or zero average) sets all four to 0."""
    if not {"working_gas", "five_year_avg"} <= set(df.columns):
        return df
    lo, mid, hi = TIGHTNESS_EDGES
    r = safe_div(F.col("working_gas") - F.col("five_year_avg"), F.col("five_year_avg"))
    x = df.withColumn("storage_tightness", r)
    t = F.col("storage_tightness")
    return x.select(
        "*",
        flag(t < lo).alias("storage_very_tight"),
        flag((t >= lo) & (t < mid)).alias("storage_tight"),
        flag((t >= mid) & (t < hi)).alias("storage_normal"),
        flag(t >= hi).alias("storage_loose"),
    )


def trend_col(w: Over, col: str = "working_gas") -> str:
    """Least-squares slope of the last 4 rows (x = 0..3).

    Closed form of a degree-1 fit: (1.5 y0 + 0.5 y-1 - 0.5 y-2 - 1.5 y-3) / 5,
    null when any of the four is null.
    """
    c = q(col)
    lag = lambda k: f"lag({c}, {k}) {w()}"
    return (f"(1.5D * {c} + 0.5D * {lag(1)} - 0.5D * {lag(2)} - 1.5D * {lag(3)}) / 5.0D "
            f"as storage_trend")


def storage_trend(df: DataFrame, order_col: str = "date", partition_cols: Sequence[str] = (),
                  plan: str = "halo", project: bool = True) -> DataFrame:
    """W6 + P9: slope, and projections wg + 4·slope, wg + 8·slope."""
    if "working_gas" not in df.columns:
        return df
    x = windowed(df, lambda w: [trend_col(w)], order_col, partition_cols, TREND_ROWS - 1, plan)
    if not project:
        return x
    return projections(x)


def projections(df: DataFrame) -> DataFrame:
    """P9."""
    wg, tr = F.col("working_gas"), F.col("storage_trend")
    return df.select("*", (wg + tr * 4).alias("storage_projected_4w"), (wg + tr * 8).alias("storage_projected_8w"))


def storage_interactions(df: DataFrame) -> DataFrame:
    """Gas x injection flag; gas x temperature when temperature exists."""
    cols = set(df.columns)
    extra = []
    if {"working_gas", "is_injection_season"} <= cols:
        extra.append((F.col("working_gas") * F.col("is_injection_season")).alias("storage_injection_interaction"))
    if {"working_gas", "temperature"} <= cols:
        extra.append((F.col("working_gas") * F.col("temperature")).alias("storage_temp_interaction"))
    return df.select("*", *extra) if extra else df


def storage_lags(df: DataFrame, cols: Sequence[str], lags: Sequence[int] = STORAGE_LAGS, order_col: str = "date",
                 partition_cols: Sequence[str] = (), plan: str = "halo") -> DataFrame:
    """``{c}_lag_{k}`` for every column (rows are weeks)."""
    cols = [c for c in cols if c in df.columns]
    return windowed(df, lambda w: [e for c in cols for e in lag_cols(w, c, lags)], order_col, partition_cols,
                    max(lags), plan)


def storage_rolling_cols(w: Over, col: str, windows: Sequence[int] = STORAGE_WINDOWS) -> list[str]:
    return rolling_cols(w, col, windows, suffix="w", order=("mean", "std", "min", "max"))


def storage_rolling(df: DataFrame, cols: Sequence[str], windows: Sequence[int] = STORAGE_WINDOWS,
                    order_col: str = "date", partition_cols: Sequence[str] = (), plan: str = "halo") -> DataFrame:
    """``{c}_rolling_{n}w`` mean and ``_std``, ``_min``, ``_max``."""
    cols = [c for c in cols if c in df.columns]
    return windowed(df, lambda w: [e for c in cols for e in storage_rolling_cols(w, c, windows)], order_col,
                    partition_cols, max(windows) - 1, plan)
