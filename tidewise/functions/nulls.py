"""Null-safe column expressions.

The engine never holds NaN: ``without_nan`` maps NaN to NULL on every read of
a table, a payload or a caller's frame, and each expression here
reproduces the pandas/numpy rule the feature definitions were written against
(see SURVEY §1.3). All are plain Catalyst expressions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_lower(x: str | Column, floor: float = 0.0) -> Column:
    """``np.maximum(x, floor)``: null and NaN give null (``greatest`` would
    give floor and NaN)."""
    x = col(x)
    return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(x, F.lit(float(floor))))


def flag(cond: Column) -> Column:
    """``cond.astype(int)`` where a null comparison counts as False (0)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero denominator (pandas gives ±inf;
    the engine keeps no infinities)."""
    return F.try_divide(col(num), col(den))


def strict_sum(x: str | Column) -> Column:
    """Aggregate sum that is NULL as soon as any input is NULL (a Python loop
    ``total += value`` with a NaN poisons the total)."""
    x = col(x)
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(x))


def strict_avg(x: str | Column) -> Column:
    """``np.mean`` over an array: NULL if any element is NULL."""
    x = col(x)
    return F.when(F.count(x) == F.count(F.lit(1)), F.avg(x))


def zero_sum(x: str | Column) -> Column:
    """pandas ``groupby().sum()``: nulls skipped, an all-null group sums to 0."""
    return F.coalesce(F.sum(col(x)), F.lit(0.0))


def nan_to_null(x: str | Column) -> Column:
    x = col(x)
    return F.when(~F.isnan(x), x)


def without_nan(df: DataFrame) -> DataFrame:
    """``df`` with NULL for NaN in its floating-point columns."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.select(*[nan_to_null(F.col(f"`{c}`")).alias(c) if c in floating else F.col(f"`{c}`") for c in df.columns])
