"""Walk-forward backtesting (M1), model comparison (M2), per-fold metrics
(A4 with W7) and the across-fold summary (A5).

Positions: rows are numbered 0..n-1 per series (``add_row_index``). With
window W and step s, fold k (0 <= k < K, K = max(0, ceil((n - s - W) / s)))
trains on positions [k*s, k*s + W) and tests on [k*s + W, k*s + W + s). The
last block is dropped when it would end exactly at n (strict loop bound).

Two fitting paths:

* **Linear models** (``Linear``) without copying rows: positions are cut where
  folds start and end; each block's sums (of differences to the series' means,
  and of their products) are aggregated map-side, summed up inside super-blocks
  of one window, and a fold reads two of those running sums: a p x p system per
  fold, solved in an Arrow batch over the folds, which number K, not n.
* **Any Python model** (``fit(X, y)`` / ``predict(X)``, tree ensembles too): each
  row is copied to the folds that use it (at most ceil(W/s) + 1 copies) and every
  fold and model is fitted in its own ``applyInPandas`` group of W + s rows, all
  in one job - the group size is fixed by the parameters, never by the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.functions.nulls import strict_avg
from tidewise.plans.ordered import IDX, add_row_index, join_keyed
from tidewise.session import cut_lineage

# Fixed defaults of the backtest loop.
DEFAULT_WINDOW = 252
DEFAULT_STEP = 21


def fold_count(n: int, window: int, step: int) -> int:
    return max(0, math.ceil((n - step - window) / step))


def _k_expr(n: F.Column, window: int, step: int) -> F.Column:
    return F.greatest(F.lit(0), F.ceil((n - F.lit(step + window)) / F.lit(step))).cast("long")


def _indexed(df: DataFrame, order_col: str, keys: list[str]) -> DataFrame:
    """``df`` with positions, checkpointed as several parts of a plan read it; a
    frame that has them already is taken as it is."""
    return df if IDX in df.columns else cut_lineage(add_row_index(df, order_col, keys))


def _fold_bounds(window: int, step: int) -> list[F.Column]:
    k = F.col("fold")
    return [
        (k * step).alias("train_start"),
        (k * step + window - 1).alias("train_end"),
        (k * step + window).alias("test_start"),
        (k * step + window + step - 1).alias("test_end"),
    ]


def test_rows(x: DataFrame, keys: list[str], window: int, step: int) -> DataFrame:
    """Rows of ``x`` (indexed) that fall in some test block, tagged with fold."""
    n = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    fold = F.floor((F.col(IDX) - F.lit(window)) / F.lit(step)).cast("long")
    t = x.withColumn("fold", fold).filter(F.col(IDX) >= F.lit(window))
    t = join_keyed(t, n, keys)
    return t.filter(F.col("fold") < _k_expr(F.col("_n"), window, step)).drop("_n")


@dataclass(frozen=True)
class Linear:
    """A linear model fitted from a fold's moments.

    ``lstsq``: least squares without intercept (minimum norm); ``ols``: with
    intercept; ``elastic_net``: minimises 1/(2n) |y - a - Xb|^2 + alpha *
    (l1_ratio |b|_1 + (1 - l1_ratio)/2 |b|^2) by coordinate descent, the
    intercept unpenalised, columns not standardised."""

    features: tuple[str, ...]
    kind: str = "lstsq"
    alpha: float = 0.01
    l1_ratio: float = 0.5
    max_iter: int = 1000

    def solve(self, n: float, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
        """(intercept, slopes) from the row count, the column means and the
        centred sums of products; the target is the last column."""
        p = len(self.features)
        mu, my, sxx, sxy = mean[:p], mean[p], cov[:p, :p], cov[:p, p]
        if self.kind == "lstsq":
            # rows of a square root of the centred sums, and the means as one
            # more row: conditioned as X itself, not as X'X
            scale = np.sqrt(np.diag(sxx) + n * mu * mu)
            scale[scale == 0] = 1.0
            w, v = np.linalg.eigh(sxx / np.outer(scale, scale))
            keep = w > 1e-14 * max(w.max(), 1e-300)
            root = np.sqrt(w[keep])
            rows = np.vstack([root[:, None] * v[:, keep].T, np.sqrt(n) * mu / scale])
            rhs = np.r_[(v[:, keep].T @ (sxy / scale)) / root, np.sqrt(n) * my]
            return np.r_[0.0, np.linalg.lstsq(rows, rhs, rcond=None)[0] / scale]
        if self.kind == "ols":
            scale = np.sqrt(np.diag(sxx))
            scale[scale == 0] = 1.0
            b = np.linalg.lstsq(sxx / np.outer(scale, scale), sxy / scale, rcond=None)[0] / scale
            return np.r_[my - mu @ b, b]
        if self.kind == "elastic_net":
            b = np.zeros(p)
            l1, l2 = self.alpha * self.l1_ratio, self.alpha * (1 - self.l1_ratio)
            for _ in range(self.max_iter):
                before = b.copy()
                for j in range(p):
                    rho = (sxy[j] - sxx[j] @ b + sxx[j, j] * b[j]) / n
                    size = sxx[j, j] / n + l2
                    b[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / size if size else 0.0
                if np.abs(b - before).max() <= 1e-12 * max(np.abs(b).max(), 1e-300):
                    break
            return np.r_[my - mu @ b, b]
        raise ValueError(f"unknown kind {self.kind!r}")


def _complete(df: DataFrame, cols: Sequence[str], nulls: str) -> DataFrame:
    """Rows for a fit: a NULL in ``cols`` fails the job (``nulls="raise"``)
    or drops its row before positions are assigned (``"drop"``)."""
    if nulls == "drop":
        return df.dropna(subset=list(cols))
    if nulls != "raise":
        raise ValueError(nulls)
    last = cols[-1]
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    guarded = F.when(missing, F.raise_error(F.lit("a model column is NULL")).cast(df.schema[last].dataType)).otherwise(
        F.col(last))
    return df.withColumn(last, guarded)


def _shifted(x: DataFrame, cols: Sequence[str], keys: list[str]) -> DataFrame:
    """``x`` with ``_m{i}``, the mean of each column over its whole series:
    sums of differences to it keep their digits whatever the columns' offset."""
    means = x.groupBy(*keys).agg(*[F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(cols)])
    return join_keyed(x, means, keys)


def _moment_sums(cols: Sequence[str]) -> list[F.Column]:
    d = [F.col(c).cast("double") - F.col(f"_m{i}") for i, c in enumerate(cols)]
    p = len(cols)
    return [F.count(F.lit(1)).alias("_rows"), *[F.first(f"_m{i}").alias(f"_m{i}") for i in range(p)],
            *[F.sum(d[i]).alias(f"_s{i}") for i in range(p)],
            *[F.sum(d[i] * d[j]).alias(f"_q{i}_{j}") for i in range(p) for j in range(i, p)]]


def fold_moments(x: DataFrame, cols: Sequence[str], keys: list[str], train_rows: int, step: int) -> DataFrame:
    """(keys, fold, _rows, _m{i}, _s{i}, _q{i}_{j}) of every fold's training
    rows [fold * step, fold * step + train_rows), two rows read per fold
    whatever the window and the step.

    Folds start at multiples of the step and end train_rows later, so cutting
    every step there (one or two blocks a step) leaves each fold a stretch of
    ``per_fold`` whole blocks. Blocks are summed map-side. A stretch of
    per_fold blocks meets at most two of the super-blocks of per_fold blocks: a
    fold is the sum of one super-block from its first block on and of the next
    one up to its last block. Both running sums stay inside super-blocks, and
    nothing is subtracted, so no digits are lost on the way."""
    rest = train_rows % step
    cuts = 2 if rest else 1
    per_fold = cuts * (train_rows // step) + (1 if rest else 0)
    within = F.when(F.col(IDX) % F.lit(step) >= F.lit(rest), F.lit(1)).otherwise(F.lit(0)) if rest else F.lit(0)
    block = F.floor(F.col(IDX) / F.lit(step)) * F.lit(cuts) + within
    blk = _shifted(x, cols, keys).withColumn("_blk", block.cast("long"))
    sums = blk.groupBy(*keys, "_blk").agg(*_moment_sums(cols))
    p = len(cols)
    means = [f"_m{i}" for i in range(p)]
    added = ["_rows", *[f"_s{i}" for i in range(p)], *[f"_q{i}_{j}" for i in range(p) for j in range(i, p)]]
    sums = sums.withColumn("_super", F.floor(F.col("_blk") / F.lit(per_fold)).cast("long"))

    def running(order: F.Column, fold: F.Column, needed: F.Column) -> DataFrame:
        # at most per_fold rows in a window partition
        w = Window.partitionBy(*keys, "_super").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        part = sums.select(*keys, "_blk", *means, *[F.sum(n).over(w).alias(n) for n in added])
        return part.filter(needed).select(*keys, fold.cast("long").alias("fold"), *means, *added)

    first, last = F.col("_blk"), F.col("_blk") - F.lit(per_fold - 1)    # a fold's first block, from either end
    starts = running(F.desc("_blk"), first / F.lit(cuts), first % F.lit(cuts) == 0)
    ends = running(F.asc("_blk"), last / F.lit(cuts),
                   (last >= 0) & (last % F.lit(cuts) == 0) & (last % F.lit(per_fold) != 0))
    folds = starts.union(ends).groupBy(*keys, "fold").agg(
        *[F.sum(n).alias(n) for n in added], *[F.first(m).alias(m) for m in means])
    return folds.filter(F.col("_rows") == F.lit(train_rows))  # only folds whose whole window exists


def all_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The moments of all rows, in the form of one fold's."""
    return _shifted(df, cols, []).groupBy(F.lit(0).cast("long").alias("fold")).agg(*_moment_sums(cols))


def solve_moments(moments: DataFrame, keys: list[str], cols: Sequence[str], models: dict[str, Linear]) -> DataFrame:
    """(keys, model, fold, coef): intercept and slopes of each model on each
    fold. ``cols`` are the moments' columns, the target last; one row per fold
    reaches Python, p values wide."""
    p = len(cols)
    place = {c: i for i, c in enumerate(cols)}
    picked = {name: [place[f] for f in m.features] + [p - 1] for name, m in models.items()}
    packed = moments.select(
        *keys, "fold", F.col("_rows").cast("double").alias("n"), F.array(*[f"_m{i}" for i in range(p)]).alias("m"),
        F.array(*[f"_s{i}" for i in range(p)]).alias("s"),
        F.array(*[F.col(f"_q{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p)]).alias("q"))
    schema = T.StructType([*[packed.schema[k] for k in keys], T.StructField("fold", T.LongType()),
                           T.StructField("model", T.StringType()), T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def solve(batches):
        for pdf in batches:
            parts = []
            for name, at in picked.items():
                coefs = []
                for n, m, s, q in zip(pdf["n"], pdf["m"], pdf["s"], pdf["q"]):
                    s = np.asarray(s, float)
                    cov = np.asarray(q, float).reshape(p, p) - np.outer(s, s) / n
                    coefs.append(models[name].solve(n, (np.asarray(m, float) + s / n)[at], cov[np.ix_(at, at)]).tolist())
                parts.append(pdf[[*keys, "fold"]].assign(model=name, coef=coefs))
            yield pd.concat(parts, ignore_index=True)

    return packed.mapInPandas(solve, schema)


def _predicted(test: DataFrame, coefs: DataFrame, keys: list[str], models: dict[str, Linear], target: str,
               order_col: str) -> DataFrame:
    pred = join_keyed(test, coefs, [*keys, "fold"])
    yhat = F.lit(None).cast("double")
    for name, m in models.items():
        value = F.col("coef")[0]
        for i, f in enumerate(m.features):
            value = value + F.col(f).cast("double") * F.col("coef")[i + 1]
        yhat = F.when(F.col("model") == name, value).otherwise(yhat)
    return pred.select(*keys, "model", "fold", F.col(IDX).alias("idx"), order_col,
                       F.col(target).cast("double").alias("actual"), yhat.alias("prediction"))


def walk_forward_linear(
    df: DataFrame,
    models: dict[str, Linear],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
    horizon: int = 0,
    nulls: str = "raise",
) -> DataFrame:
    """M1 for any number of linear models over identical folds, per series:
    row-level test predictions (keys, model, fold, idx, ``order_col``, actual,
    prediction). One frame of moments over the union of the models' columns
    serves all of them.

    ``horizon`` h > 0 is the embargo of a target that lies h rows ahead: a
    fold trains on its window's rows before ``test_start - h``, so that no
    training target lies in the test block."""
    keys = list(partition_cols)
    cols: list[str] = []
    for m in models.values():
        cols += [f for f in m.features if f not in cols]
    cols.append(target)
    x = _indexed(_complete(df, cols, nulls), order_col, keys)
    coefs = solve_moments(fold_moments(x, cols, keys, window - horizon, step), keys, cols, models)
    return _predicted(test_rows(x, keys, window, step), coefs, keys, models, target, order_col)


def horizon_walk_forward(
    df: DataFrame,
    models: dict[str, Linear],
    horizons: Sequence[int],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """Walk-forward for targets h rows ahead, one run per horizon: the last h
    rows have no target and take no part; folds train before test_start - h.
    Adds ``horizon_days``; ``order_col`` is the day of the prediction."""
    from tidewise.operators.extensions import horizon_targets

    ahead = cut_lineage(horizon_targets(df, target, horizons, order_col, partition_cols))
    parts = []
    for h in horizons:
        rows = ahead.drop(target).withColumnRenamed(f"target_{h}", target).filter(F.col(target).isNotNull())
        pred = walk_forward_linear(rows, models, target, window, step, order_col, partition_cols, horizon=h)
        parts.append(pred.withColumn("horizon_days", F.lit(h)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def walk_forward_lstsq(
    df: DataFrame,
    features: Sequence[str],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
    model_name: str = "lstsq",
    nulls: str = "raise",
) -> DataFrame:
    """M1 with the M5 model: row-level test predictions.

    Output: keys, model, fold, idx, ``order_col``, actual, prediction.
    """
    return walk_forward_linear(df, {model_name: Linear(tuple(features))}, target, window, step, order_col,
                               partition_cols, nulls=nulls)


def train_folds(window: int, step: int) -> F.Column:
    """The folds, bounded or not by the series' end, whose training window
    holds a row (needs ``_idx``)."""
    low = F.greatest(F.lit(0), F.ceil((F.col(IDX) - F.lit(window - 1)) / F.lit(step))).cast("long")
    return F.sequence(low, F.greatest(low, F.floor(F.col(IDX) / F.lit(step)).cast("long")))


def _fold_roles(window: int, step: int) -> F.Column:
    """Array of (fold, test) roles of a row (needs ``_idx`` and ``_n``):
    train for folds k with k*s <= idx < k*s + W, test for the fold whose
    block [k*s + W, k*s + W + s) holds it."""
    kmax = _k_expr(F.col("_n"), window, step) - 1
    idx = F.col(IDX)
    tr_lo = F.greatest(F.lit(0), F.ceil((idx - F.lit(window - 1)) / F.lit(step))).cast("long")
    tr_hi = F.least(kmax, F.floor(idx / F.lit(step)).cast("long"))
    te_k = F.floor((idx - F.lit(window)) / F.lit(step)).cast("long")
    empty = F.array().cast("array<struct<fold:bigint,test:int>>")
    return F.concat(
        F.when(tr_lo <= tr_hi, F.transform(F.sequence(tr_lo, tr_hi),
                                           lambda k: F.struct(k.alias("fold"), F.lit(0).alias("test"))))
        .otherwise(empty),
        F.when((idx >= F.lit(window)) & (te_k <= kmax), F.array(F.struct(te_k.alias("fold"), F.lit(1).alias("test"))))
        .otherwise(empty),
    )


@dataclass(frozen=True)
class Fitted:
    """Any Python model with ``fit(X, y)`` and ``predict(X)``, made by
    ``make()``, on ``features`` or on what ``prepare(pdf, target)`` returns."""

    make: Callable[[], object]
    features: tuple[str, ...]
    prepare: Callable | None = None

    def matrix(self, pdf: pd.DataFrame, target: str) -> tuple[np.ndarray, np.ndarray]:
        if self.prepare is not None:
            return self.prepare(pdf, target)
        return pdf[list(self.features)].to_numpy(float), pdf[target].to_numpy(float)


def _fold_rows(x: DataFrame, cols: Sequence[str], keys: list[str], window: int, step: int) -> DataFrame:
    """The rows of ``x`` (indexed) once per fold that uses them (at most
    ceil(W/s) + 1 copies): ``cols``, fold, test (0 or 1)."""
    x = join_keyed(x, x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
    cols = list(dict.fromkeys(cols))
    return x.select(*cols, F.explode(_fold_roles(window, step)).alias("_r")).select(*cols, "_r.fold", "_r.test")


def spread(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Groups dealt out for fits that take long over few bytes: several times
    as many partitions as cores, which adaptive execution leaves alone."""
    spark = df.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *cols)


def walk_forward_imputed(
    df: DataFrame,
    models: dict[str, Linear | Fitted],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
    folds_per_group: int | None = None,
) -> DataFrame:
    """M1 with P10 at ``scope="train_fold"``, for any models: every fold fills
    the NULLs of its features and target with the exact medians of its own
    training rows (no look-ahead), drops rows whose target stays NULL, then fits.

    Rows are not copied to folds. ``folds_per_group`` (default: 4 windows' worth)
    neighbouring folds are one group of consecutive rows; only the W + s rows
    that reach into the next group are sent twice. A group's folds are slices of
    its rows, whose number the parameters fix.
    """
    keys = list(partition_cols)
    cols = list(dict.fromkeys([*[f for m in models.values() for f in m.features], target]))
    per = folds_per_group or max(1, -(-4 * window // step))
    x = _indexed(df, order_col, keys)
    x = join_keyed(x, x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys)
    folds = _k_expr(F.col("_n"), window, step)
    # group u holds folds [u * per, (u + 1) * per), so rows [u * per * s, ((u + 1) * per - 1) * s + W + s)
    span = per * step
    low = F.greatest(F.lit(0), F.floor((F.col(IDX) - F.lit(window)) / F.lit(span))).cast("long")
    high = F.least(F.floor(F.col(IDX) / F.lit(span)), F.floor((folds - 1) / F.lit(per))).cast("long")
    base = [*keys, order_col, IDX, *[F.col(c).cast("double").alias(c) for c in cols]]
    grouped = x.filter(low <= high).select(*base, folds.alias("_folds"), F.explode(F.sequence(low, high)).alias("_group"))
    schema = T.StructType([
        *[x.schema[k] for k in keys], T.StructField("model", T.StringType()), T.StructField("fold", T.LongType()),
        T.StructField("idx", T.LongType()), T.StructField(order_col, x.schema[order_col].dataType),
        T.StructField("actual", T.DoubleType()), T.StructField("prediction", T.DoubleType())])

    def predict(spec: Linear | Fitted, train: pd.DataFrame, test: pd.DataFrame) -> np.ndarray:
        if isinstance(spec, Fitted):
            model = spec.make()
            model.fit(*spec.matrix(train, target))
            return np.asarray(model.predict(spec.matrix(test, target)[0]), float)
        a = train[[*spec.features, target]].to_numpy(float)
        mean = a.mean(0)
        coef = spec.solve(len(a), mean, (a - mean).T @ (a - mean))
        return coef[0] + test[list(spec.features)].to_numpy(float) @ coef[1:]

    def fit_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(IDX, ignore_index=True)
        first, group = pdf[IDX].iloc[0], pdf["_group"].iloc[0]
        out = []
        for k in range(group * per, min((group + 1) * per, pdf["_folds"].iloc[0])):
            at = k * step - first
            rows = pdf.iloc[at:at + window + step]
            medians = pd.Series(_medians(rows[cols].to_numpy()[:window]), cols)
            rows = rows.fillna(medians.dropna().to_dict())
            rows = rows[rows[target].notna()]
            test = rows[rows[IDX] >= k * step + window]
            for name, spec in models.items() if (rows[IDX] < k * step + window).any() else ():
                part = test[[*keys, IDX, order_col]].rename(columns={IDX: "idx"})
                out.append(part.assign(model=name, fold=k, actual=test[target].to_numpy(),
                                       prediction=predict(spec, rows[rows[IDX] < k * step + window], test)))
        names = [f.name for f in schema.fields]
        return pd.concat(out, ignore_index=True)[names] if out else pd.DataFrame(columns=names)

    group = [*keys, "_group"]
    return spread(grouped, group).groupBy(*group).applyInPandas(fit_group, schema)


def _medians(a: np.ndarray) -> np.ndarray:
    """Exact median of each column, NaN skipped (NaN if there is nothing else)."""
    ordered = np.sort(a, axis=0)                      # NaN last
    n = (~np.isnan(a)).sum(0)
    low, high, column = np.maximum((n - 1) // 2, 0), np.maximum(n // 2, 0), np.arange(a.shape[1])
    mid = (ordered[low, column] + ordered[np.minimum(high, len(a) - 1), column]) / 2
    return np.where(n > 0, mid, np.nan)


def walk_forward_lstsq_fold_imputed(
    df: DataFrame,
    features: Sequence[str],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
    model_name: str = "lstsq",
) -> DataFrame:
    """``walk_forward_imputed`` with the M5 model."""
    return walk_forward_imputed(df, {model_name: Linear(tuple(features))}, target, window, step, order_col, partition_cols)


def walk_forward_fitted(
    df: DataFrame,
    models: dict[str, Fitted],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
) -> DataFrame:
    """M1 for any number of Python model objects with ``fit(X, y)`` and
    ``predict(X)`` (the duck-typed protocol) over identical folds: one Spark
    job, one ``applyInPandas`` group of W + s rows per fold and model. A row is
    shuffled once per fold that uses it and model."""
    keys = list(partition_cols)
    x = _indexed(df, order_col, keys)
    used = [f for m in models.values() for f in m.features]
    ex = _fold_rows(x, [*keys, order_col, IDX, *used, target], keys, window, step)
    ex = ex.withColumn("model", F.explode(F.array(*[F.lit(n) for n in models])))
    out_schema = T.StructType([
        *[ex.schema[k] for k in keys], T.StructField("model", T.StringType()), T.StructField("fold", T.LongType()),
        T.StructField("idx", T.LongType()), T.StructField(order_col, ex.schema[order_col].dataType),
        T.StructField("actual", T.DoubleType()), T.StructField("prediction", T.DoubleType()),
    ])

    def fit_fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(IDX)
        train, test = pdf[pdf["test"] == 0], pdf[pdf["test"] == 1]
        spec = models[pdf["model"].iloc[0]]
        xte, yte = spec.matrix(test, target)
        model = spec.make()
        model.fit(*spec.matrix(train, target))
        res = test[[*keys, "model", "fold", IDX, order_col]].rename(columns={IDX: "idx"})
        return res.assign(actual=np.asarray(yte, float), prediction=np.asarray(model.predict(xte), float))

    group = [*keys, "model", "fold"]
    return spread(ex, group).groupBy(*group).applyInPandas(fit_fold, out_schema)


def walk_forward_grouped(
    df: DataFrame,
    make_model: Callable[[], object],
    features: Sequence[str],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
    model_name: str = "model",
    prepare: Callable[[pd.DataFrame, str], tuple[np.ndarray, np.ndarray]] | None = None,
) -> DataFrame:
    """``walk_forward_fitted`` for one model. ``prepare(pdf, target) -> (X, y)``
    is the optional feature hook; by default X is ``features``."""
    model = Fitted(make_model, tuple(features), prepare)
    return walk_forward_fitted(df, {model_name: model}, target, window, step, order_col, partition_cols)


def _shift_effects(model, x: np.ndarray, error: np.ndarray, actual: np.ndarray, shifts: Sequence[int]) -> list[float]:
    """Per column, the mean over the shifts of the squared error's rise when
    the column's values move round by that many rows."""
    out = []
    for j in range(x.shape[1]):
        moved = np.concatenate([x] * len(shifts))
        moved[:, j] = np.concatenate([np.roll(x[:, j], k) for k in shifts])
        again = np.tile(actual, len(shifts)) - np.asarray(model.predict(moved), float)
        out.append(float(np.mean(again**2) - np.mean(error**2)))
    return out


def permutation_importance(
    df: DataFrame,
    models: dict[str, Linear | Fitted],
    target: str = "spot_price",
    window: int = DEFAULT_WINDOW,
    step: int = DEFAULT_STEP,
    order_col: str = "date",
    partition_cols: Sequence[str] = (),
    max_shifts: int = 64,
) -> DataFrame:
    """M3 for any model, whether it has importances of its own or not: (keys,
    model, fold, feature, importance), the mean rise of the squared error on a
    fold's test rows when one feature's values are dealt to other rows while
    the rest stay.

    A column is dealt by moving it round by 0, 1, ..., s - 1 rows (``max_shifts``
    evenly spaced ones for longer steps), so every row meets every value once
    and the result is the same in every run. For a linear model that is
    2 b^2 var(x) + 2 b cov(error, x), which the test rows' sums give without a
    fit being repeated; the other models are scored where they are fitted, in
    one grouped job over all folds and models."""
    keys = list(partition_cols)
    x = _indexed(df, order_col, keys)
    linear = {n: m for n, m in models.items() if isinstance(m, Linear)}
    fitted = {n: m for n, m in models.items() if isinstance(m, Fitted)}
    shifts = sorted({k * step // min(step, max_shifts) for k in range(min(step, max_shifts))})
    parts = []
    if linear:
        cols = list(dict.fromkeys([f for m in linear.values() for f in m.features])) + [target]
        coefs = solve_moments(fold_moments(x, cols, keys, window, step), keys, cols, linear)
        test = test_rows(x, keys, window, step)
        pred = _predicted(test, coefs, keys, linear, target, order_col)
        rows = join_keyed(pred, x.select(*keys, F.col(IDX).alias("idx"), *cols[:-1]), [*keys, "idx"])
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in cols[:-1]]))
        long = rows.select(*keys, "model", "fold", (F.col("actual") - F.col("prediction")).alias("e"), each.alias("f"))
        sums = long.groupBy(*keys, "model", "fold", F.col("f.feature").alias("feature")).agg(
            F.var_pop("f.x").alias("v"), F.covar_pop("e", "f.x").alias("c"))
        slope = F.lit(None).cast("double")
        for name, m in linear.items():
            for i, f in enumerate(m.features):
                slope = F.when((F.col("model") == name) & (F.col("feature") == f), F.col("coef")[i + 1]).otherwise(slope)
        both = join_keyed(sums, coefs, [*keys, "model", "fold"]).withColumn("b", slope).filter("b is not null")
        parts.append(both.select(*keys, "model", "fold", "feature", F.expr("2 * b * b * v + 2 * b * c").alias("importance")))
    if fitted:
        used = [f for m in fitted.values() for f in m.features]
        ex = _fold_rows(x, [*keys, IDX, *used, target], keys, window, step)
        ex = ex.withColumn("model", F.explode(F.array(*[F.lit(n) for n in fitted])))
        schema = T.StructType([*[ex.schema[k] for k in keys], T.StructField("model", T.StringType()), T.StructField("fold", T.LongType()),
                               T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])

        def score(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(IDX)
            spec = fitted[pdf["model"].iloc[0]]
            test = pdf[pdf["test"] == 1]
            xte, yte = (np.asarray(a, float) for a in spec.matrix(test, target))
            model = spec.make()
            model.fit(*spec.matrix(pdf[pdf["test"] == 0], target))
            effects = _shift_effects(model, xte, yte - np.asarray(model.predict(xte), float), yte, shifts)
            names = spec.features if spec.prepare is None else [str(j) for j in range(xte.shape[1])]
            head = test[[*keys, "model", "fold"]].head(1)
            return pd.concat([head.assign(feature=f, importance=v) for f, v in zip(names, effects)])[[f.name for f in schema.fields]]

        group = [*keys, "model", "fold"]
        parts.append(spread(ex, group).groupBy(*group).applyInPandas(score, schema))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fold_metrics(pred: DataFrame, window: int = DEFAULT_WINDOW, step: int = DEFAULT_STEP,
                 partition_cols: Sequence[str] = ()) -> DataFrame:
    """A4 (+ W7, + R² as M9): per (keys, model, fold) MAE, RMSE, MAPE %,
    direction accuracy % and R², with the fold's train/test positions.

    Direction: sign of the step-to-step change of actual vs prediction inside
    the fold (first row has no change; 0 equals 0). A NULL actual or
    prediction makes all error metrics of its fold NULL (``n_null`` counts
    them). MAPE leaves out rows whose actual is 0 (no infinities) and
    ``mape_skipped`` counts those. Fold groups hold ``step`` rows.
    """
    keys = list(partition_cols)
    w = Window.partitionBy(*keys, "model", "fold").orderBy("idx")
    a, p = F.col("actual"), F.col("prediction")
    d = pred.select(
        "*",
        (F.signum(a - F.lag(a).over(w)) == F.signum(p - F.lag(p).over(w))).cast("double").alias("_dir"),
    )
    err = a - p
    full = F.count(err) == F.count(F.lit(1))
    m = d.groupBy(*keys, "model", "fold").agg(
        strict_avg(F.abs(err)).alias("mae"),
        F.sqrt(strict_avg(err * err)).alias("rmse"),
        F.when(full, F.avg(F.abs(F.try_divide(err, a))) * 100).alias("mape"),
        F.when(full, F.avg("_dir") * 100).alias("direction_accuracy"),
        F.when(full, F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(a))).alias("r2"),
        F.count(F.lit(1)).alias("n_test"),
        F.count_if(err.isNull()).alias("n_null"),
        F.count_if(a == 0).alias("mape_skipped"),
    )
    return m.select(*keys, "model", "fold", *_fold_bounds(window, step), "mae", "rmse", "mape",
                    "direction_accuracy", "r2", "n_test", "n_null", "mape_skipped")


METRICS = ("mae", "rmse", "mape", "direction_accuracy")


def summary(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """A5: across folds, mean and population std of each metric (a model
    with no folds has no row)."""
    aggs = []
    for m in METRICS:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return metrics.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n_folds"))


def compare(df: DataFrame, models: dict[str, Linear | Fitted], target: str = "spot_price",
            window: int = DEFAULT_WINDOW, step: int = DEFAULT_STEP, order_col: str = "date",
            partition_cols: Sequence[str] = (), nulls: str = "raise") -> DataFrame:
    """M2: named models over identical folds, per series: one prediction frame
    holding every model, ready for ``fold_metrics`` / ``summary``. One indexed
    frame serves all: the linear models share one frame of moments, the others
    one grouped job over all folds and models."""
    keys = list(partition_cols)
    x = _indexed(_complete(df, sorted({f for m in models.values() for f in m.features}) + [target], nulls), order_col, keys)
    linear = {name: m for name, m in models.items() if isinstance(m, Linear)}
    fitted = {name: m for name, m in models.items() if isinstance(m, Fitted)}
    parts = [walk_forward_linear(x, linear, target, window, step, order_col, keys)] if linear else []
    parts += [walk_forward_fitted(x, fitted, target, window, step, order_col, keys)] if fitted else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compare_lstsq(df: DataFrame, models: dict[str, Sequence[str]], target: str = "spot_price",
                  window: int = DEFAULT_WINDOW, step: int = DEFAULT_STEP, order_col: str = "date",
                  partition_cols: Sequence[str] = ()) -> DataFrame:
    """M2 for least-squares models given by their feature lists."""
    return compare(df, {n: Linear(tuple(f)) for n, f in models.items()}, target, window, step, order_col, partition_cols)


class NumpyLeastSquares:
    """No-intercept least squares (the self-test model of the backtester)."""

    def fit(self, X, y):
        self.coef_ = np.linalg.lstsq(np.asarray(X, float), np.asarray(y, float), rcond=None)[0]
        return self

    def predict(self, X):
        return np.asarray(X, float) @ self.coef_
