"""Readers for the landed parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.functions.nulls import without_nan


# (first date, last date) of the rows wanted from a table, either may be None
Bounds = tuple[str | None, str | None] | None


def read_table(spark: SparkSession, sf_dir: str, name: str, time_col: str | None = None,
               bounds: Bounds = None) -> DataFrame:
    """Read one landed table, NaN as NULL; column pruning reaches the scan, as
    do filters on all but floating-point columns.

    ``bounds`` filters the raw ``time_col``, so it is pushed into the scan. A
    week or month whose stamp lies within the bounds keeps all its rows: the
    upper bound is a month later (views filter their stamps exactly)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if bounds and time_col:
        kind, (first, last) = df.schema[time_col].dataType, bounds
        if first:
            df = df.filter(F.col(time_col) >= F.lit(str(first)).cast(kind))
        if last:
            df = df.filter(F.col(time_col) < F.date_add(F.lit(str(last)).cast("date"), 32).cast(kind))
    return without_nan(df)
