"""Positional (row-based) windows that scale.

Row frames over a series need a total order. ``Window.partitionBy(keys)``
puts a whole series into one task, and with no key at all Spark plans
``Exchange SinglePartition``. Neither survives a series (or one hot key) that
holds a large share of the data. The plan here splits every series into
fixed-size row buckets:

1. **Row index.** Count rows per (keys, coarse time bucket: month for dates,
   hour for timestamps) - a small frame -
   prefix-sum those counts per key to get each bucket's offset, join the
   offsets back and add ``row_number`` inside the coarse bucket. The only
   global ordering runs on the count frame.
2. **Halo buckets.** ``_bk = idx div B``. The last ``H`` rows of each bucket
   (``H`` = longest look-back) are copied into the next bucket. The window is
   partitioned by (keys, ``_bk``), so a task holds at most ``B + H`` rows, and
   only the rows that live in their own bucket are kept.

Lags and trailing row frames of length <= H+1 are then exactly those of the
unsplit series. ``forward_fill`` handles the one unbounded look-back (pad
filling) by carrying each bucket's last non-null value through a prefix over
the bucket summary frame.

``plan="partition"`` keeps the plain ``partitionBy(keys)`` window for callers
that know their series are balanced and short.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDX = "_idx"
BK = "_bk"
CB = "_cb"

DEFAULT_BUCKET_ROWS = 1 << 17  # 131,072 rows per window task (+ halo)


def q(name: str) -> str:
    """Quote a column name for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


class Over:
    """SQL text of a series' row-ordered window.

    ``w()`` is the ordered window; ``w(lo, hi)`` adds a rows frame where a
    negative bound counts preceding rows, 0 is the current row and a
    positive bound counts following rows. Stage builders return SQL
    expression strings over it, so a whole stage is added with one
    ``selectExpr`` (one driver round trip, the same Catalyst plan as the
    equivalent Column expressions).
    """

    def __init__(self, partition: Sequence[str], order: Sequence[str]):
        self.partition, self.order = list(partition), list(order)

    @staticmethod
    def _bound(k: int) -> str:
        if k == 0:
            return "current row"
        return f"{-k} preceding" if k < 0 else f"{k} following"

    def __call__(self, lo: int | None = None, hi: int | None = None) -> str:
        parts = []
        if self.partition:
            parts.append("partition by " + ", ".join(q(c) for c in self.partition))
        parts.append("order by " + ", ".join(q(c) for c in self.order))
        if lo is not None:
            parts.append(f"rows between {self._bound(lo)} and {self._bound(0 if hi is None else hi)}")
        return "over (" + " ".join(parts) + ")"


def _order_list(order_col: str | Sequence[str]) -> list[str]:
    return [order_col] if isinstance(order_col, str) else list(order_col)


def _coarse(df: DataFrame, order_col: str | Sequence[str], unit: str | int | None) -> Column:
    """Coarse time bucket of the (first) order column.

    Default (``unit=None``): calendar month for a DATE order column - at most
    31 rows per key and bucket when dates are unique per key, a proven bound -
    and hour for a timestamp column; numeric order columns use ranges of
    65,536. An explicit unit ("day", "minute", ... or an integer width)
    overrides it for unusually dense series.
    """
    order_col = _order_list(order_col)[0]
    dtype = df.schema[order_col].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if unit is None:
            unit = "month" if isinstance(dtype, T.DateType) else "hour"
        return F.date_trunc(str(unit), F.col(order_col))
    # numeric order column: fixed-width integer ranges
    width = int(unit) if unit is not None and not isinstance(unit, str) else 1 << 16
    return F.floor(F.col(order_col) / F.lit(width))


def materialize(df: DataFrame, how: str | None = "persist") -> DataFrame:
    """Make a frame that a plan reads more than once cheap to re-read.

    ``persist`` (memory, spilling to disk; lost blocks are recomputed from
    lineage) or ``checkpoint`` (written to the shared checkpoint folder,
    lineage cut). Already-cached frames are returned unchanged.
    """
    if how is None or df.storageLevel != StorageLevel.NONE:
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        from tidewise.session import cut_lineage

        return cut_lineage(df)
    raise ValueError(f"unknown materialization {how!r}")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join on ``keys`` where NULL keys also match (window partitions
    treat NULL as a value)."""
    if not keys:
        raise ValueError("keys required")
    r = right
    renamed = {k: f"__r_{k}" for k in keys}
    for k, rk in renamed.items():
        r = r.withColumnRenamed(k, rk)
    cond = [left[k].eqNullSafe(r[rk]) for k, rk in renamed.items()]
    return left.join(r, cond).drop(*renamed.values())


def join_keyed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a frame with one that has a row per series (NULL keys are a series
    of their own); without keys, with a one-row frame."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    return _null_safe_join(left, right, keys) if how == "inner" else _left_null_safe(left, right, keys)


def add_row_index(
    df: DataFrame,
    order_col: str | Sequence[str],
    partition_cols: Sequence[str] = (),
    index_col: str = IDX,
    coarse_unit: str | int | None = None,
    reuse: str | None = None,
) -> DataFrame:
    """0-based row position per series (``iloc`` position), distributed.

    ``(partition_cols, order_col)`` must be unique: a tie fails the job, as
    its rows would have no fixed position. ``order_col`` may list tiebreak
    columns after the time column.

    The input is read twice: the count pass needs the key and time columns
    only, and equal aggregates below it are computed once. Pass
    ``reuse="persist"`` for an input that is costly or not deterministic (and
    release it afterwards).
    """
    keys = list(partition_cols)
    x = materialize(df, reuse).withColumn(CB, _coarse(df, order_col, coarse_unit))
    counts = x.groupBy(*keys, CB).agg(F.count(F.lit(1)).alias("_n"))
    prefix = Window.partitionBy(*keys).orderBy(CB).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, CB, F.coalesce(F.sum("_n").over(prefix), F.lit(0)).cast("long").alias("_off"))
    joined = _null_safe_join(x, offsets, keys + [CB])
    order = _order_list(order_col)
    w = Window.partitionBy(*keys, CB).orderBy(*order)
    here = F.struct(*order)
    tie = F.lag(here).over(w) == here
    fail = F.raise_error(F.lit(f"rows tie in {order}; add a tiebreak column")).cast("long")
    idx = F.when(tie, fail).otherwise(F.col("_off") + F.row_number().over(w) - 1)
    return joined.withColumn(index_col, idx).drop("_off", CB)


def running_total(df: DataFrame, value_col: str, order_col: str, partition_cols: Sequence[str], out_col: str,
                  width: int = 1 << 16) -> DataFrame:
    """``out_col`` = sum of ``value_col`` over the rows of a series before each
    row by the integer ``order_col`` (unique in the series; 0 at the first).
    Sums run inside ranges of ``width`` positions and are carried over from a
    frame with one row per range, so no task holds a whole series."""
    keys = list(partition_cols)
    x = df.withColumn(CB, F.floor(F.col(order_col) / F.lit(width)))
    totals = x.groupBy(*keys, CB).agg(F.sum(value_col).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(CB).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, CB, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carry"))
    inside = Window.partitionBy(*keys, CB).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    own = x.withColumn("_own", F.coalesce(F.sum(value_col).over(inside), F.lit(0)))
    out = _null_safe_join(own, carry, [*keys, CB])
    return out.withColumn(out_col, F.col("_own") + F.col("_carry")).drop(CB, "_own", "_carry")


def _halo(df: DataFrame, bucket_rows: int, halo_rows: int, index_col: str, ahead_rows: int = 0) -> DataFrame:
    """Assign each row to its bucket, plus the next bucket when it is among
    the last ``halo_rows`` of its own (look-back), plus the previous bucket
    when it is among the first ``ahead_rows`` (look-ahead)."""
    if halo_rows >= bucket_rows or ahead_rows >= bucket_rows:
        raise ValueError("bucket_rows must exceed the look-back and look-ahead")
    b = F.floor(F.col(index_col) / F.lit(bucket_rows))
    pos = F.col(index_col) % F.lit(bucket_rows)
    parts = [F.array(b)]
    if halo_rows > 0:
        parts.append(F.when(pos >= F.lit(bucket_rows - halo_rows), F.array(b + 1)).otherwise(F.array().cast("array<bigint>")))
    if ahead_rows > 0:
        parts.append(F.when((pos < F.lit(ahead_rows)) & (b > 0), F.array(b - 1)).otherwise(F.array().cast("array<bigint>")))
    buckets = parts[0] if len(parts) == 1 else F.concat(*parts)
    return df.withColumn(BK, F.explode(buckets))


def windowed(
    df: DataFrame,
    build: Callable[[Over], list[str | Column]],
    order_col: str | Sequence[str] = "date",
    partition_cols: Sequence[str] = (),
    lookback: int = 30,
    plan: str = "halo",
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
    coarse_unit: str | int | None = None,
    keep_index: bool = False,
    lookahead: int = 0,
) -> DataFrame:
    """Add the columns returned by ``build(w)``: SQL expression strings
    (``"lag(`x`, 1) " + w() + " as `x_lag_1`"``) over the series'
    row-ordered window ``w`` (an ``Over``; frames via ``w(lo, hi)``).

    ``lookback`` is the largest number of preceding rows any column reads,
    ``lookahead`` the largest number of following rows (``lead``).
    All columns share one window spec, so Spark evaluates them in one Window
    operator after one sort.
    """
    keys = list(partition_cols)
    if plan == "partition":
        return _add_exprs(df, build(Over(keys, _order_list(order_col))))
    if plan != "halo":
        raise ValueError(f"unknown plan {plan!r}")
    has_idx = IDX in df.columns
    x = df if has_idx else add_row_index(df, order_col, keys, IDX, coarse_unit)
    x = _halo(x, bucket_rows, lookback, IDX, lookahead)
    out = _add_exprs(x, build(Over(keys + [BK], [IDX])))
    out = out.filter(F.col(BK) == F.floor(F.col(IDX) / F.lit(bucket_rows))).drop(BK)
    if not keep_index and not has_idx:
        out = out.drop(IDX)
    return out


def _add_exprs(df: DataFrame, exprs: list[str | Column]) -> DataFrame:
    texts = [e for e in exprs if isinstance(e, str)]
    if len(texts) == len(exprs):
        return df.selectExpr("*", *texts)
    return df.select("*", *[F.expr(e) if isinstance(e, str) else e for e in exprs])


def forward_fill(
    df: DataFrame,
    value_col: str | Sequence[str],
    out_col: str | Sequence[str],
    order_col: str | Sequence[str] = "date",
    partition_cols: Sequence[str] = (),
    plan: str = "halo",
    coarse_unit: str | int | None = None,
) -> DataFrame:
    """``out_col`` = last non-null ``value_col`` at or before each row (in
    ``order_col`` order, per ``partition_cols``). Several value columns are
    filled in the same pass.

    Distributed plan (no row index needed): the fill runs inside (keys,
    coarse time bucket) window partitions; a row whose bucket has no earlier
    non-null value takes the carry - the last non-null value of the previous
    buckets - from a summary frame with one row per (keys, bucket), built by
    one aggregation and a prefix window over that small frame. A bucket's
    rows are bounded by the rows per key and ``coarse_unit``; name a finer unit
    for series denser than one row a day (dates) or second (timestamps).
    """
    keys = list(partition_cols)
    order = _order_list(order_col)
    vals = [value_col] if isinstance(value_col, str) else list(value_col)
    outs = [out_col] if isinstance(out_col, str) else list(out_col)
    if plan == "partition":
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.last(v, ignorenulls=True).over(w).alias(o) for v, o in zip(vals, outs)])
    x = df.withColumn(CB, _coarse(df, order, coarse_unit))
    okey = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    # per bucket: last non-null value (max_by skips rows whose ordering is null)
    summary = x.groupBy(*keys, CB).agg(
        *[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), okey)).alias(f"_last{i}") for i, v in enumerate(vals)])
    prev = Window.partitionBy(*keys).orderBy(CB).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, CB, *[F.last(f"_last{i}", ignorenulls=True).over(prev).alias(f"_carry{i}")
                                        for i in range(len(vals))])
    inb = Window.partitionBy(*keys, CB).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    y = x.select("*", *[F.last(v, ignorenulls=True).over(inb).alias(f"_inb{i}") for i, v in enumerate(vals)])
    y = _left_null_safe(y, carry, keys + [CB])
    filled = [F.coalesce(F.col(f"_inb{i}"), F.col(f"_carry{i}")).alias(o) for i, o in enumerate(outs)]
    helpers = [f"_inb{i}" for i in range(len(vals))] + [f"_carry{i}" for i in range(len(vals))] + [CB]
    return y.select("*", *filled).drop(*helpers)


def _left_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right
    renamed = {k: f"__r_{k}" for k in keys}
    for k, rk in renamed.items():
        r = r.withColumnRenamed(k, rk)
    cond = [left[k].eqNullSafe(r[rk]) for k, rk in renamed.items()]
    return left.join(r, cond, "left").drop(*renamed.values())


