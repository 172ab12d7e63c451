"""Prediction bands without look-ahead (D7): the band of a fold comes from the
residuals of earlier folds only.

Every fold needs exact quantiles of a growing prefix of the residuals. Neither
the prefixes are copied nor does one task walk a series:

1. the distinct residuals of all series are range-partitioned by value into
   parts of at most about PART_VALUES of them (``impute.ranked_parts``);
2. counts per (series, part, fold), summed up over the folds, tell for every
   fold which part holds each rank it needs and the rank inside that part;
3. one group per (series, part) answers all folds that hit it: its residuals,
   in fold order, are indexed by a wavelet matrix, and the k-th smallest of a
   prefix is read off in one step per bit of the part's ranks, for all folds at
   once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.operators.impute import ranked_parts
from tidewise.plans.ordered import join_keyed, running_total
from tidewise.session import cut_lineage

PART_VALUES = 100_000


def kth_of_prefix(codes: np.ndarray, lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The ranks-th smallest (0-based) of each prefix codes[:length] of small
    non-negative integers, all queries at once (wavelet matrix, high bit first)."""
    out, low, high, ranks = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), lengths.copy(), ranks.copy()
    top = int(codes.max()).bit_length() if len(codes) else 0
    for bit in range(top - 1, -1, -1):
        ones = (codes >> bit) & 1
        zeros_before = np.r_[0, np.cumsum(1 - ones)]
        a, b = zeros_before[low], zeros_before[high]
        right = ranks >= b - a
        total = zeros_before[-1]
        ranks = np.where(right, ranks - (b - a), ranks)
        low = np.where(right, total + low - a, a)
        high = np.where(right, total + high - b, b)
        out |= right.astype(np.int64) << bit
        codes = np.concatenate([codes[ones == 0], codes[ones == 1]])
    return out


def _answers(pdf: pd.DataFrame) -> pd.DataFrame:
    """Residuals (v, m times in a fold) and queries (slot, rank) of a part."""
    items = pdf[pdf["slot"].isna()].sort_values(["fold", "v"])
    asks = pdf[pdf["slot"].notna()]
    values, codes = np.unique(items["v"].to_numpy(), return_inverse=True)
    times = items["m"].to_numpy().astype(np.int64)
    folds = np.repeat(items["fold"].to_numpy(), times)
    lengths = np.searchsorted(folds, asks["fold"].to_numpy(), side="left")     # of earlier folds
    found = kth_of_prefix(np.repeat(codes, times), lengths, asks["m"].to_numpy().astype(np.int64))
    return asks.assign(v=values[found])


def running_bands(pred: DataFrame, by: Sequence[str] = ("model",), quantiles: Sequence[float] = (0.1, 0.5, 0.9),
                  actual: str = "actual", prediction: str = "prediction", part_values: int = PART_VALUES) -> DataFrame:
    """(by, fold, residual_q10, ...): exact quantiles (linear between ranks) of
    the residuals actual - prediction of the series' earlier folds. NULL
    residuals are skipped; a fold without earlier residuals has NULL bands. The
    quantile with fraction p is named ``residual_q{100 p}``."""
    keys, qs = list(by), [float(p) for p in quantiles]
    rows = cut_lineage(pred.select(*keys, "fold", (F.col(actual) - F.col(prediction)).alias("v")))
    folds = rows.select(*keys, "fold").distinct()
    known = rows.filter("v is not null")
    distinct = known.groupBy(*keys, "v").agg(F.count("*").alias("m"))
    n = distinct.count()
    parts = ranked_parts(distinct, keys, max(1, -(-n // part_values)))
    items = join_keyed(known.groupBy(*keys, "v", "fold").agg(F.count("*").alias("m")),
                       parts.select(*keys, "v", "part"), [*keys, "v"])
    items = cut_lineage(items)
    # residuals of earlier folds, per part and in all
    grid = join_keyed(folds, parts.select(*keys, "part").distinct(), keys)
    sizes = items.groupBy(*keys, "part", "fold").agg(F.sum("m").alias("c"))
    grid = join_keyed(grid, sizes, [*keys, "part", "fold"], "left")
    grid = running_total(grid.withColumn("c", F.coalesce("c", F.lit(0))), "c", "fold", [*keys, "part"], "before")
    ends = running_total(grid, "before", "part", [*keys, "fold"], "lower")
    total = grid.groupBy(*keys, "fold").agg(F.sum("before").alias("n"))
    slots = F.explode(F.array(*[F.struct(F.lit(2 * j + s).alias("slot"), (F.floor if s == 0 else F.ceil)(
        (F.col("n") - 1) * F.lit(p)).alias("rank")) for j, p in enumerate(qs) for s in (0, 1)])).alias("s")
    asks = total.filter("n > 0").select(*keys, "fold", slots).select(*keys, "fold", "s.slot", "s.rank")
    hit = join_keyed(asks, ends.select(*keys, "fold", "part", "lower", "before"), [*keys, "fold"]).filter(
        (F.col("lower") <= F.col("rank")) & (F.col("rank") < F.col("lower") + F.col("before")))
    asked = hit.select(*keys, "part", "fold", (F.col("rank") - F.col("lower")).cast("long").alias("m"),
                       F.col("slot").cast("double").alias("slot"), F.lit(None).cast("double").alias("v"))
    shown = items.select(*keys, "part", "fold", F.col("m").cast("long").alias("m"), F.lit(None).cast("double").alias("slot"), "v")
    schema = T.StructType(asked.schema.fields)
    found = shown.union(asked).groupBy(*keys, "part").applyInPandas(_answers, schema)
    value = [F.max(F.when(F.col("slot") == s, F.col("v"))) for s in range(2 * len(qs))]
    wide = found.groupBy(*keys, "fold").agg(*[v.alias(f"v{s}") for s, v in enumerate(value)])
    wide = join_keyed(wide, total, [*keys, "fold"])
    out = []
    for j, p in enumerate(qs):
        pos = (F.col("n") - 1) * F.lit(p)
        low, high = F.col(f"v{2 * j}"), F.col(f"v{2 * j + 1}")
        out.append((low + (high - low) * (pos - F.floor(pos))).alias(f"residual_q{int(round(p * 100))}"))
    return join_keyed(folds, wide.select(*keys, "fold", *out), [*keys, "fold"], "left")
