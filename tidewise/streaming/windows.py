"""Row windows on streams: lags (W1), rolling statistics (W2) and changes
per series, equal to the batch operators.

Spark has no row frames on streams. Here each series keeps a small state: the
last H rows it has put out (H = longest look-back), the previous gap-filled
value, and the rows that still wait because an earlier one may come. A row goes
out when the newest time of its series is ``delay`` ahead of it, in time order,
with its windows; after ``idle`` without news (a processing-time timer) the
series puts out all it holds. So the state of a series is H rows and those of one
``delay``, whatever the stream's length.

Rows are never dropped silently: one that comes after its place has been put
out, or shares its time with another, comes out at once with ``status`` "late"
or "tie" and NULL windows. A row without a time has status "no_time". NaN is
NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = T.StructType([T.StructField(n, t) for n, t in (
    ("done_time", T.LongType()), ("newest", T.LongType()), ("filled", T.DoubleType()),
    ("ring", T.ArrayType(T.DoubleType())), ("wait_time", T.ArrayType(T.LongType())), ("wait", T.ArrayType(T.DoubleType())))])
_START = -(1 << 62)


def window_columns(values: np.ndarray, keep: int, filled: float, name: str, lags: Sequence[int], windows: Sequence[int],
                   change: bool) -> tuple[dict[str, np.ndarray], float]:
    """Columns of the last ``keep`` of consecutive rows (those before are the
    look-back; rows before them do not exist), and the last gap-filled value.
    ``filled`` is the gap-filled value before the kept rows."""
    n = len(values)
    at = np.arange(n - keep, n)
    padded = np.r_[np.full(max([*lags, *windows, 1]), np.nan), values]
    back = len(padded) - n
    out = {f"{name}_lag_{k}": padded[at + back - k] for k in lags}
    for w in windows:
        frames = np.lib.stride_tricks.sliding_window_view(padded, w)[at + back - w + 1]
        # before the series' start and at a gap a frame has fewer than w values: NaN, as the count guard
        out[f"{name}_rolling_{w}"] = frames.mean(1)
        out[f"{name}_rolling_{w}_std"] = frames.std(1, ddof=1) if w > 1 else np.full(keep, np.nan)
        out[f"{name}_rolling_{w}_max"], out[f"{name}_rolling_{w}_min"] = frames.max(1), frames.min(1)
    own = values[n - keep:]
    last = pd.Series(np.r_[filled, own]).ffill().to_numpy()
    if change:
        out[f"{name}_change"] = own - padded[at + back - 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            out[f"{name}_change_pct"] = np.where(last[:-1] == 0, np.nan, (last[1:] / last[:-1] - 1) * 100)
    return out, float(last[-1])


def stream_windows(stream: DataFrame, value_col: str, order_col: str, partition_cols: Sequence[str], lags: Sequence[int] = (),
                   windows: Sequence[int] = (), change: bool = False, delay_seconds: float = 0.0,
                   idle_ms: int | None = None) -> DataFrame:
    """The rows of a stream (timestamp ``order_col``) with status ("ok", "late",
    "tie", "no_time"), ``{value}_lag_{k}``, ``{value}_rolling_{w}`` with
    ``_std``, ``_max``, ``_min``, and, with ``change``, ``{value}_change`` and
    ``{value}_change_pct`` (gaps filled first). Use append mode."""
    keys = list(partition_cols)
    names = [*[f"{value_col}_lag_{k}" for k in lags],
             *[f"{value_col}_rolling_{w}{s}" for w in windows for s in ("", "_std", "_max", "_min")],
             *([f"{value_col}_change", f"{value_col}_change_pct"] if change else [])]
    look = max([0, *lags, *[w - 1 for w in windows], int(change)])
    delay = int(delay_seconds * 1_000_000)
    rows = stream.select(*keys, F.unix_micros(F.col(order_col).cast("timestamp")).alias(order_col),
                         F.col(value_col).cast("double").alias(value_col))
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField(order_col, T.LongType()),
                           T.StructField(value_col, T.DoubleType()), T.StructField("status", T.StringType()),
                           *[T.StructField(n, T.DoubleType()) for n in names]])

    def frame(key: tuple, times, values, status: str, columns: dict | None = None) -> pd.DataFrame:
        out = pd.DataFrame({order_col: np.asarray(times, object), value_col: np.asarray(values, float)})
        for k, v in zip(keys, key):
            out[k] = v
        out["status"] = status
        for n in names:
            out[n] = np.nan if columns is None else columns[n]
        return out[[f.name for f in schema.fields]]

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, newest, filled, ring, wait_time, wait = state.get if state.exists else (_START, _START, None, [], [], [])
        waiting = dict(zip(wait_time, wait))
        for pdf in batches:
            for kind, part in (("no_time", pdf[pdf[order_col].isna()]), ("row", pdf[pdf[order_col].notna()])):
                if kind == "no_time":
                    if len(part):
                        yield frame(key, [None] * len(part), part[value_col], kind)
                    continue
                odd = {"late": ([], []), "tie": ([], [])}
                for t, v in zip(part[order_col].astype("int64"), part[value_col]):
                    if t <= done or t in waiting:
                        odd["late" if t <= done else "tie"][0].append(t)
                        odd["late" if t <= done else "tie"][1].append(v)
                    else:
                        waiting[t] = v
                        newest = max(newest, t)
                for status, (times, values) in odd.items():
                    if times:
                        yield frame(key, times, values, status)
        ready = sorted(t for t in waiting if state.hasTimedOut or t <= newest - delay)
        if ready:
            values = np.array([np.nan if v is None else v for v in [*ring, *[waiting.pop(t) for t in ready]]], float)
            columns, last = window_columns(values, len(ready), np.nan if filled is None else filled, value_col, lags, windows, change)
            yield frame(key, ready, values[len(ring):], "ok", columns)
            done, filled = ready[-1], None if math.isnan(last) else last
            ring = [None if math.isnan(v) else v for v in values[max(0, len(values) - look):].tolist()] if look else []
        held = sorted(waiting)
        state.update((done, newest, filled, ring, held, [None if v is None or math.isnan(v) else v for v in map(waiting.get, held)]))
        if idle_ms is not None and held:
            state.setTimeoutDuration(idle_ms)

    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    out = rows.groupBy(*keys).applyInPandasWithState(advance, schema, _STATE, "append", timeout)
    return out.withColumn(order_col, F.timestamp_micros(order_col))
