"""Evaluation report (K7), importance tables (M3 model-free form) and top-k (O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report(summary: DataFrame, by: str = "model") -> DataFrame:
    """K7: one row per model with ``mean ± std`` strings of the four metrics
    (4 decimals for errors, 2 decimals and a percent sign for percentages).
    A DataFrame, so it can be written as a table or shown."""
    def pm(m: str, fmt: str) -> F.Column:
        return F.format_string(f"{fmt} ± {fmt}", F.col(f"{m}_mean"), F.col(f"{m}_std")).alias(m)

    return summary.select(by, pm("mae", "%.4f"), pm("rmse", "%.4f"), pm("mape", "%.2f%%"),
                          pm("direction_accuracy", "%.2f%%")).orderBy(by)


def correlation_importance(long: DataFrame, target: DataFrame, target_col: str, on: str = "date",
                           name_col: str = "feature_name", value_col: str = "feature_value") -> DataFrame:
    """|Pearson correlation| of every feature with the target, one row per
    feature. Partial aggregation per task, then one small group per feature."""
    j = long.join(target.select(on, target_col), on)
    x, y = F.col(value_col), F.col(target_col)
    # Pearson r = cov / (sd_x sd_y); a constant feature has no correlation
    # (NULL) instead of a division-by-zero failure
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    imp = j.groupBy(name_col).agg(F.abs(r).alias("importance"))
    return imp.filter(F.col("importance").isNotNull() & ~F.isnan("importance"))


def top_k(df: DataFrame, score_col: str, k: int = 10, tiebreak: str | None = None) -> DataFrame:
    """O2: the k rows with the highest score (a top-k report; the limit is
    the feature). Planned as TakeOrderedAndProject: each task keeps k rows."""
    order = [F.col(score_col).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*order).limit(k)
