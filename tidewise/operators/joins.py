"""Joins of date-keyed frames: the feature matrix (J1) and the as-of
carry-forward join (J4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.plans.ordered import forward_fill

# Output columns of the feature matrix, with their source table.
MATRIX_COLUMNS = [
    ("prices", "date"), ("prices", "spot_price"), ("prices", "front_month"), ("prices", "m1_m2_spread"),
    ("storage_weekly", "working_gas"), ("storage_weekly", "five_year_avg"), ("storage_weekly", "yoy_deviation"),
    ("storage_weekly", "wow_change"), ("production_monthly", "dry_gas_bcfpd"), ("lng_monthly", "exports_bcf"),
    ("lng_monthly", "lng_capacity_bcfpd"), ("power_burn", "gas_mwh"), ("power_burn", "total_load_mwh"),
    ("power_burn", "renewables_mwh"), ("weather_daily", "hdd"), ("weather_daily", "cdd"),
    ("weather_daily", "temperature"), ("rigs_weekly", "total_rigs"), ("rigs_weekly", "gas_rigs"),
]
DATE_KEYS = {"storage_weekly": "report_date", "production_monthly": "month", "lng_monthly": "month",
             "power_burn": "date", "weather_daily": "date", "rigs_weekly": "date"}
ENTITY_TABLES = {"power_burn", "weather_daily"}


def _side(tables: dict[str, DataFrame], name: str, rollup: bool) -> DataFrame:
    cols = [c for t, c in MATRIX_COLUMNS if t == name]
    key = DATE_KEYS[name]
    df = tables[name]
    if rollup and name in ENTITY_TABLES:
        # one row per date: sum the additive power columns, average weather
        agg = F.sum if name == "power_burn" else F.avg
        df = df.groupBy(key).agg(*[agg(c).alias(c) for c in cols])
    return df.select(F.col(key).alias(f"_k_{name}"), *cols)


def feature_matrix(tables: dict[str, DataFrame], start: str | None = None, end: str | None = None,
                   mode: str = "exact", rollup_entities: bool = False) -> DataFrame:
    """Prices LEFT JOIN six tables on exact date equality, 19 columns.

    ``mode="exact"`` matches weekly/monthly rows only on their own stamp date
    and multiplies rows by the entities of power_burn / weather_daily (those
    keys are not selected). ``rollup_entities=True`` pre-aggregates those two
    tables to one row per date first. ``mode="asof"`` carries the latest
    weekly/monthly row forward to every price date (J4) instead.

    The date filter is applied to prices and, through the join keys, to every
    side, so Catalyst pushes it into all scans. Join strategy is left to AQE:
    the date-keyed sides are broadcast at runtime when small, shuffled
    otherwise.
    """
    p = tables["prices"]
    if start:
        p = p.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        p = p.filter(F.col("date") <= F.lit(end).cast("date"))
    out = p.select("date", "spot_price", "front_month", "m1_m2_spread")
    if mode == "asof":
        # one lookup per price date for all weekly / monthly sides, before the
        # entity joins multiply the rows; then one equi-join
        sides = [(n, _side(tables, n, rollup_entities)) for n in DATE_KEYS if n not in ENTITY_TABLES]
        asof = [(side, f"_k_{n}", [c for c in side.columns if c != f"_k_{n}"]) for n, side in sides]
        out = out.join(asof_join_many(out.select("date").distinct(), "date", asof), "date", "left")
    for name in ("storage_weekly", "production_monthly", "lng_monthly", "power_burn", "weather_daily",
                 "rigs_weekly"):
        side = _side(tables, name, rollup_entities)
        k = f"_k_{name}"
        if mode == "asof" and name not in ENTITY_TABLES:
            continue
        if start:
            side = side.filter(F.col(k) >= F.lit(start).cast("date"))
        if end:
            side = side.filter(F.col(k) <= F.lit(end).cast("date"))
        out = out.join(side, F.col("date") == F.col(k), "left").drop(k)
    return out.select(*[c for _, c in MATRIX_COLUMNS])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_date: str,
    right_date: str,
    value_cols: Sequence[str],
    by: Sequence[str] = (),
    release_lag_days: int = 0,
) -> DataFrame:
    """For each left row, the latest right row (per ``by`` keys) whose
    ``right_date + release_lag_days <= left_date``; its ``value_cols`` are
    attached (null when no such row)."""
    return asof_join_many(left, left_date, [(right, right_date, list(value_cols))], by, release_lag_days)


def asof_join_many(
    left: DataFrame,
    left_date: str,
    rights: Sequence[tuple[DataFrame, str, Sequence[str]]],
    by: Sequence[str] = (),
    release_lag_days: int = 0,
) -> DataFrame:
    """As-of lookups into several right frames in one pass.

    No range join: the left rows and every right frame are unioned into one
    time-ordered stream per key; each right frame's values are packed into
    its own struct column and all structs are forward-filled together by the
    distributed fill of ``plans.ordered`` (time-bucketed, so one long key is
    split over many tasks); finally the left rows are kept. At equal dates a
    right row sorts first, so a value released on day d is visible on day d.
    """
    keys = list(by)
    lcols = left.columns
    packs = [F.struct(*[F.col(c).alias(c) for c in cols]) for _, _, cols in rights]
    types = [r.select(p.alias("_p")).schema["_p"].dataType for (r, _, _), p in zip(rights, packs)]
    parts = [left.select("*", F.col(left_date).alias("_t"), F.lit(1).alias("_side"),
                         *[F.lit(None).cast(t).alias(f"_r{i}") for i, t in enumerate(types)])]
    for i, ((r, rdate, _), p) in enumerate(zip(rights, packs)):
        parts.append(r.select(*keys, F.date_add(F.col(rdate), release_lag_days).alias("_t"), F.lit(0).alias("_side"),
                              *[(p if j == i else F.lit(None).cast(t)).alias(f"_r{j}") for j, t in enumerate(types)]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    n = len(rights)
    filled = forward_fill(u, [f"_r{i}" for i in range(n)], [f"_f{i}" for i in range(n)], ["_t", "_side"], keys)
    out = filled.filter(F.col("_side") == 1)
    vals = [F.col(f"_f{i}.{c}").alias(c) for i, (_, _, cols) in enumerate(rights) for c in cols]
    return out.select(*lcols, *vals)
