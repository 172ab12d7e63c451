"""Weather features: degree days, lags, rolling statistics, forecast merge,
calendar terms, interactions and regional weighting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewise.functions.calendar import weather_calendar_cols
from tidewise.functions.nulls import clip_lower, strict_sum
from tidewise.plans.ordered import Over, q, windowed

# Fixed values of the feature definitions.
BASE_TEMP = 65.0
WEATHER_LAGS = [1, 3, 7, 14, 30]
WEATHER_WINDOWS = [7, 14, 30]
# Population weights of the gas-consuming regions; other regions weigh 0.1.
REGION_WEIGHTS = {"Northeast": 0.25, "Midwest": 0.20, "South": 0.30, "West": 0.25}
DEFAULT_REGION_WEIGHT = 0.1


def degree_days(
    df: DataFrame, temp_col: str = "temperature", base_temp: float = BASE_TEMP, keep_input: bool = False,
    hdd_col: str = "HDD", cdd_col: str = "CDD", date_col: str = "date",
) -> DataFrame:
    """HDD = max(base - T, 0), CDD = max(T - base, 0); null T gives null.

    ``keep_input=False`` returns only (date, HDD, CDD) like the definition;
    ``True`` keeps every input column.
    """
    t = F.col(temp_col)
    hdd = clip_lower(F.lit(base_temp) - t).alias(hdd_col)
    cdd = clip_lower(t - F.lit(base_temp)).alias(cdd_col)
    if keep_input:
        return df.select("*", hdd, cdd)
    return df.select(date_col, hdd, cdd)


def weather_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Seasonal terms appended to every row."""
    return df.selectExpr("*", *weather_calendar_cols(date_col))


def weather_interactions(df: DataFrame) -> DataFrame:
    """Products of the inputs that exist (schema check at plan time)."""
    cols = set(df.columns)
    extra = []
    if {"HDD", "CDD"} <= cols:
        extra.append((F.col("HDD") * F.col("CDD")).alias("HDD_CDD_interaction"))
    if {"temperature", "wind_speed"} <= cols:
        extra.append((F.col("temperature") * F.col("wind_speed")).alias("temp_wind_interaction"))
    if {"HDD", "wind_speed"} <= cols:
        extra.append((F.col("HDD") * F.col("wind_speed")).alias("HDD_wind_interaction"))
    return df.select("*", *extra) if extra else df


def lag_cols(w: Over, col: str, lags: Sequence[int]) -> list[str]:
    """``{col}_lag_{k}``: the value k rows earlier in the series."""
    return [f"lag({q(col)}, {k}) {w()} as {q(f'{col}_lag_{k}')}" for k in lags]


def rolling_cols(w: Over, col: str, windows: Sequence[int], suffix: str = "",
                 order=("mean", "std", "max", "min")) -> list[str]:
    """Trailing row-window statistics with the full-window null rule: a
    value only when all n rows of the frame are non-null (``rolling(n)``)."""
    out = []
    fns = {"mean": "avg", "std": "stddev_samp", "max": "max", "min": "min"}
    for n in windows:
        frame = w(-(n - 1), 0)
        base = f"{col}_rolling_{n}{suffix}"
        for stat in order:
            name = base if stat == "mean" else f"{base}_{stat}"
            out.append(f"case when count({q(col)}) {frame} = {n} then {fns[stat]}({q(col)}) {frame} end as {q(name)}")
    return out


def weather_lags(df: DataFrame, col: str, lags: Sequence[int] = WEATHER_LAGS, order_col: str = "date",
                 partition_cols: Sequence[str] = (), plan: str = "halo") -> DataFrame:
    """``{col}_lag_{k}`` = value k rows earlier in the series."""
    return windowed(df, lambda w: lag_cols(w, col, lags), order_col, partition_cols, max(lags), plan)


def weather_rolling(df: DataFrame, col: str, windows: Sequence[int] = WEATHER_WINDOWS, order_col: str = "date",
                    partition_cols: Sequence[str] = (), plan: str = "halo") -> DataFrame:
    """Trailing mean / sample std / max / min over n rows."""
    return windowed(df, lambda w: rolling_cols(w, col, windows), order_col, partition_cols, max(windows) - 1, plan)


def region_weight(region: Column, default: float = DEFAULT_REGION_WEIGHT) -> Column:
    """The region's weight, ``default`` when unmatched. The four-entry
    table is a literal map evaluated inside the projection - no join."""
    m = F.create_map(*[e for k, v in REGION_WEIGHTS.items() for e in (F.lit(k), F.lit(v))])
    return F.coalesce(m[region], F.lit(default))


def with_region_weight(df: DataFrame, region_col: str = "region", default: float = DEFAULT_REGION_WEIGHT) -> DataFrame:
    """J5 as a column ``weight``."""
    return df.withColumn("weight", region_weight(F.col(region_col), default))


def regional_degree_days(df: DataFrame, temp_col: str = "temperature", region_col: str = "region",
                         date_col: str = "date") -> DataFrame:
    """A2: per date Σ HDD·w and Σ CDD·w over the rows of that date.

    Not normalised (each row adds its full weight). A null temperature on any
    row of a date makes that date's sums null, like the accumulation loop it
    replaces. Partial aggregation happens before the shuffle on ``date``.
    """
    x = with_region_weight(df, region_col)
    if not {"HDD", "CDD"} <= set(df.columns):
        x = degree_days(x, temp_col, keep_input=True)
    return x.groupBy(date_col).agg(
        strict_sum(F.col("HDD") * F.col("weight")).alias("HDD_weighted"),
        strict_sum(F.col("CDD") * F.col("weight")).alias("CDD_weighted"),
    )


def forecast_merge(hist: DataFrame, fc: DataFrame, date_col: str = "date", base_temp: float = BASE_TEMP,
                   dedupe: bool = False) -> DataFrame:
    """Left join of the forecast on date; colliding forecast columns get
    the ``_forecast`` suffix; then forecast error and forecast degree days.

    ``dedupe=True`` first averages the forecast to one row per date (otherwise
    duplicate forecast dates multiply history rows, as in a plain merge).
    """
    if dedupe:
        value_cols = [c for c in fc.columns if c != date_col]
        fc = fc.groupBy(date_col).agg(*[F.avg(c).alias(c) for c in value_cols])
    hist_cols = set(hist.columns)
    renamed = fc
    for c in fc.columns:
        if c != date_col and c in hist_cols:
            renamed = renamed.withColumnRenamed(c, f"{c}_forecast")
    merged = hist.join(renamed, date_col, "left")
    cols = set(merged.columns)
    extra = []
    if {"temperature", "temperature_forecast"} <= cols:
        extra.append((F.col("temperature_forecast") - F.col("temperature")).alias("temp_forecast_error"))
    if "temperature_forecast" in cols:
        t = F.col("temperature_forecast")
        extra.append(clip_lower(F.lit(base_temp) - t).alias("HDD_forecast"))
        extra.append(clip_lower(t - F.lit(base_temp)).alias("CDD_forecast"))
    return merged.select("*", *extra) if extra else merged
