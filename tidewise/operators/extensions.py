"""Columns the stored schema and configuration declare but no feature step
computes; the definitions here are this library's (SURVEY §2.14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.plans.ordered import join_keyed, q, windowed
from tidewise.session import cut_lineage

HORIZONS = [7, 14, 30]


def five_year_average(df: DataFrame, value_col: str = "working_gas", date_col: str = "date",
                      by: Sequence[str] = (), years: int = 5, out_col: str = "five_year_avg") -> DataFrame:
    """Mean of ``value_col`` in the same ISO week over the previous
    ``years`` ISO years (current year excluded; nulls skipped).

    A range frame over the ISO year inside (keys, ISO week) partitions: no
    self-join, and a partition holds only one week-of-year of one series.
    """
    iso_year = F.expr(f"extract(YEAROFWEEK FROM {date_col})").cast("int")
    x = df.withColumn("iso_year", iso_year).withColumn("iso_week", F.weekofyear(date_col))
    w = Window.partitionBy(*by, "iso_week").orderBy("iso_year").rangeBetween(-years, -1)
    return x.withColumn(out_col, F.avg(value_col).over(w))


def horizon_targets(df: DataFrame, value_col: str = "spot_price", horizons: Sequence[int] = HORIZONS,
                    order_col: str = "date", partition_cols: Sequence[str] = (), plan: str = "halo") -> DataFrame:
    """``target_{h}`` = value ``h`` rows ahead (look-ahead halo)."""
    return windowed(
        df,
        lambda w: [f"lead({q(value_col)}, {h}) {w()} as {q(f'target_{h}')}" for h in horizons],
        order_col, partition_cols, 0, plan, lookahead=max(horizons),
    )


def to_long(df: DataFrame, ids: Sequence[str], name_col: str = "feature_name", value_col: str = "feature_value",
            keep_nulls: bool = False) -> DataFrame:
    """Wide feature frame to the long ``features`` table layout."""
    values = [c for c in df.columns if c not in ids]
    x = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    long = x.unpivot(list(ids), values, name_col, value_col)
    return long if keep_nulls else long.filter(F.col(value_col).isNotNull())


def to_wide(long: DataFrame, ids: Sequence[str], names: Sequence[str], name_col: str = "feature_name",
            value_col: str = "feature_value") -> DataFrame:
    """Inverse of ``to_long`` for a known feature list (pivot values given, so
    no extra pass to discover them)."""
    return long.groupBy(*ids).pivot(name_col, list(names)).agg(F.first(value_col))


QUANTILE_LEVELS = [0.1, 0.5, 0.9]


def residual_bands(pred: DataFrame, by: Sequence[str] = ("model",), quantiles: Sequence[float] = QUANTILE_LEVELS,
                   actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    """Exact residual quantiles (actual - prediction) per model (and
    horizon), used as confidence offsets around each prediction. They see all
    folds; ``plans.bands.running_bands`` gives each fold those of earlier folds."""
    from tidewise.operators.impute import exact_quantiles

    r = cut_lineage(pred.select(*by, (F.col(actual) - F.col(prediction)).alias("residual")))
    q = exact_quantiles(r, ["residual"], quantiles, by)
    names = [f"residual_q{int(round(x * 100))}" for x in quantiles]
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("q") == F.lit(float(x)), F.col("value"))).alias(nm)
                                for x, nm in zip(quantiles, names)])


def norm_deltas(df: DataFrame, cols: Sequence[str] = ("hdd", "cdd"), date_col: str = "date",
                by: Sequence[str] = ("region",)) -> DataFrame:
    """D3: ``{c}_norm_delta`` = value minus the mean of the same key and
    day-of-year over all earlier years (NULL without history). A range frame
    over the year inside (keys, day-of-year) partitions."""
    x = df.withColumn("_doy", F.dayofyear(date_col)).withColumn("_yr", F.year(date_col))
    w = Window.partitionBy(*by, "_doy").orderBy("_yr").rangeBetween(Window.unboundedPreceding, -1)
    return x.select(*df.columns, *[(F.col(c) - F.avg(c).over(w)).alias(f"{c}_norm_delta") for c in cols])


def prediction_rows(pred: DataFrame, bands: DataFrame, model_col: str = "model", horizon: int | str = 0,
                    by: Sequence[str] = ("model",), date_col: str = "date") -> DataFrame:
    """D9 + D7: rows of the ``predictions`` table: prediction, band, actual and
    ``error = actual - prediction``. ``horizon`` is a number of days or the
    name of the column that holds it. ``by`` names the bands' keys (with
    ``fold`` for running bands; NULL is a key like others); those that are
    neither model, horizon nor fold are entity keys and stay as columns."""
    days = F.col(horizon) if isinstance(horizon, str) else F.lit(horizon)
    entity = [k for k in by if k not in (model_col, horizon, "fold")]
    return join_keyed(pred, bands, list(by), "left").select(
        F.col(date_col).alias("date"),
        *entity,
        F.col(model_col).alias("model_name"),
        days.cast(T.IntegerType()).alias("horizon_days"),
        "prediction",
        (F.col("prediction") + F.col("residual_q10")).alias("confidence_lower"),
        (F.col("prediction") + F.col("residual_q90")).alias("confidence_upper"),
        F.col("actual").alias("actual_value"),
        (F.col("actual") - F.col("prediction")).alias("error"),
    )


def series_summary(df: DataFrame, name: str, value_col: str, date_col: str = "date") -> DataFrame:
    """first/last date, row count and non-null value count of a series
    (one aggregate row)."""
    return df.agg(
        F.lit(name).alias("series"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value_col).alias("n_values"),
    )


POWER_BURN_LAGS = [1, 7, 14]


def fill_declared_storage(storage: DataFrame, date_col: str = "report_date", plan: str = "halo") -> DataFrame:
    """The declared storage columns - ``yoy_deviation`` = working_gas -
    five_year_avg (P4) and ``wow_change`` = week-over-week difference (W5)."""
    base = [c for c in storage.columns if c not in ("yoy_deviation", "wow_change")]
    x = windowed(storage, lambda w: [f"lag(working_gas, 1) {w()} as _prev"], date_col, (), 1, plan)
    return x.select(*base, (F.col("working_gas") - F.col("five_year_avg")).alias("yoy_deviation"),
                    (F.col("working_gas") - F.col("_prev")).alias("wow_change"))


def power_burn_lags(power_burn: DataFrame, col: str = "gas_mwh", lags: Sequence[int] = POWER_BURN_LAGS,
                    by: Sequence[str] = ("ba",), date_col: str = "date", plan: str = "halo") -> DataFrame:
    """Lags of the gas burn per balancing area (rows = days of that
    area); keyed halo plan, so one dominant area is still split."""
    return windowed(power_burn, lambda w: [f"lag({q(col)}, {k}) {w()} as {q(f'{col}_lag_{k}')}" for k in lags],
                    date_col, by, max(lags), plan)
