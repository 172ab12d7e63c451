"""Median imputation (P10 with A3) and the default training window."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.functions.nulls import nan_to_null
from tidewise.plans.ordered import _null_safe_join, join_keyed
from tidewise.session import cut_lineage

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def exact_quantiles(df: DataFrame, cols: Sequence[str], quantiles: Sequence[float], by: Sequence[str] = (),
                    accuracy: int = 1000) -> DataFrame:
    """A3 generalised: exact continuous quantiles of each column, per ``by``
    group; one row per (by, name, q) with ``value``. Nulls are skipped; the
    q-quantile interpolates linearly between the values at 0-based ranks
    floor((n-1)q) and ceil((n-1)q) (the median is q = 0.5).

    Exact without gathering a column in one task, all columns at once:
    1. one wide aggregation: per column its count, minimum, maximum and an
       approximate quantile sketch. For each q the sketch gives a band [lo,
       hi] guaranteed to contain both ranks it needs (its rank error is
       count/accuracy; the band is widened by three times that). A group of
       at most 4 * accuracy rows has the band [minimum, maximum];
    2. a second wide aggregation counts the values below each band, and only
       values inside a band (about 6/accuracy of the rows) are put into long
       form and counted by value;
    3. those distinct values are range-partitioned by sampled bounds
       (``ranked_parts``), so parts hold equal shares however the values lie;
       prefix counts over the parts find the one that holds each rank, and only
       its values are ordered.

    The result is exact for any ``accuracy``; it only trades the sketch's cost
    against the band's size. ``df`` is read three times: hand over a frame that
    is cheap to read again.
    """
    keys = list(by)
    qs = [float(q) for q in quantiles]
    eps = 3.0 / accuracy
    probes = [x for q in qs for x in (max(0.0, q - eps), min(1.0, q + eps))]
    src = df.select(*keys, *[nan_to_null(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    parts = [f(F.col(f"v{i}")).alias(f"{k}{i}") for i in range(len(cols))
             for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]
    parts += [F.percentile_approx(f"v{i}", probes, accuracy).alias(f"b{i}") for i in range(len(cols))]
    sketch = src.groupBy(*keys).agg(*parts)
    each = [(i, j) for i in range(len(cols)) for j in range(len(qs))]
    bands = []
    for i, j in each:
        big = F.col(f"n{i}") > F.lit(4 * accuracy)
        bands += [F.when(big, F.col(f"b{i}")[2 * j]).otherwise(F.col(f"lo{i}")).alias(f"lo{i}_{j}"),
                  F.when(big, F.col(f"b{i}")[2 * j + 1]).otherwise(F.col(f"hi{i}")).alias(f"hi{i}_{j}")]
    # a sketch need not come out the same twice: its bands are fixed by a checkpoint (a row per group)
    bounds = cut_lineage(sketch.select(*keys, *[f"n{i}" for i in range(len(cols))], *bands))
    x = join_keyed(src, bounds, keys)
    below = x.groupBy(*keys).agg(*[F.count_if(F.col(f"v{i}") < F.col(f"lo{i}_{j}")).alias(f"w{i}_{j}") for i, j in each])
    # (by, i, j): rows and rows below the band
    spec = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"n{i}").alias("n"),
                                        F.col(f"w{i}_{j}").alias("below")) for i, j in each])).alias("f")
    facts = join_keyed(bounds, below, keys).select(*keys, spec).select(*keys, "f.*").filter("n > 0")
    inside = F.array(*[F.when(F.col(f"v{i}").between(F.col(f"lo{i}_{j}"), F.col(f"hi{i}_{j}")),
                              F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"v{i}").alias("v")))
                       for i, j in each])
    long = x.select(*keys, F.explode(F.filter(inside, lambda e: e.isNotNull())).alias("e")).select(*keys, "e.*")
    group = [*keys, "i", "j"]
    counted = ranked_parts(long.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("m")), group)
    pos = (F.col("n") - 1) * F.element_at(F.array(*[F.lit(q) for q in qs]), F.col("j") + 1)
    k1, k2 = F.floor(pos), F.ceil(pos)
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row per part
    sizes = counted.groupBy(*group, "part").agg(F.sum("m").alias("size"))
    sizes = _null_safe_join(sizes, facts, group).withColumn(
        "start", F.col("below") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    hit = sizes.filter((F.col("start") <= k2) & (k1 < F.col("start") + F.col("size")))
    ranked = _null_safe_join(counted, hit.select(*group, "part", "start", "n"), [*group, "part"])
    within = Window.partitionBy(*group, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") + F.coalesce(F.sum("m").over(within), F.lit(0))
    ranked = ranked.withColumn("first", first)
    last = F.col("first") + F.col("m")
    picked = ranked.groupBy(*group, "n").agg(
        F.max(F.when((F.col("first") <= k1) & (k1 < last), F.col("v"))).alias("v1"),
        F.max(F.when((F.col("first") <= k2) & (k2 < last), F.col("v"))).alias("v2"))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1).alias("name")
    q = F.element_at(F.array(*[F.lit(q) for q in qs]), F.col("j") + 1).alias("q")
    return picked.select(*keys, name, q, (F.col("v1") + (F.col("v2") - F.col("v1")) * (pos - F.floor(pos))).alias("value"))


def ranked_parts(counted: DataFrame, group: Sequence[str], parts: int | None = None) -> DataFrame:
    """``counted`` (group, v, m; one row per value) with ``part``: range
    partitions by (group, v). Their bounds come from a sample of the rows, so a
    part holds about its share of them wherever the values crowd, and repeated
    values weigh one row. ``parts``: their number (default: by size). Checkpointed:
    a second pass must see the same parts."""
    dealt = counted.repartitionByRange(*([parts] if parts else []), *group, "v")
    return cut_lineage(dealt.withColumn("part", F.spark_partition_id()))


def exact_medians(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), accuracy: int = 1000) -> DataFrame:
    """A3: exact median of each column (mean of the two middle values for an
    even count, nulls skipped); one row per (by, name) with ``median``."""
    q = exact_quantiles(df, cols, [0.5], by, accuracy)
    return q.select(*by, "name", F.col("value").alias("median"))


def median_impute(df: DataFrame, target: str = "spot_price", cols: Sequence[str] | None = None,
                  exclude: Sequence[str] = ("date",)) -> DataFrame:
    """P10: fill NULLs of every numeric column (target included) with that
    column's whole-sample median, then drop rows whose target is still NULL.

    Filled columns become double (a median of integers may be fractional); an
    all-null column stays null. The medians form a one-row frame (one value
    per column) that is broadcast - its size is fixed by the column count.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    df = cut_lineage(df)  # read by the medians and by the fill
    med = exact_medians(df, cols)
    wide = med.agg(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(f"_med_{c}") for c in cols])
    x = df.crossJoin(F.broadcast(wide))
    out = x.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])
    return out.dropna(subset=[target])


def window_bounds(prices: DataFrame, days: int = 730, date_col: str = "date") -> tuple[str | None, str | None]:
    """P11 as a pair of dates: ``days`` back from the latest date of the
    price table, and that date (None, None for an empty table)."""
    last = prices.agg(F.max(date_col)).first()[0]
    if last is None:
        return None, None
    return str(last - datetime.timedelta(days=days)), str(last)


def training_window(df: DataFrame, days: int = 730, end: str | None = None, date_col: str = "date") -> DataFrame:
    """Rows with end - days <= date <= end. The clock is injected:
    ``end`` defaults to the latest date of the data (a one-row frame)."""
    if end is not None:
        e = F.lit(end).cast("date")
        return df.filter((F.col(date_col) >= F.date_sub(e, days)) & (F.col(date_col) <= e))
    mx = df.agg(F.max(date_col).alias("_end"))
    x = df.crossJoin(F.broadcast(mx))
    return x.filter((F.col(date_col) >= F.date_sub(F.col("_end"), days)) & (F.col(date_col) <= F.col("_end"))).drop(
        "_end"
    )
