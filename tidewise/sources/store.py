"""The ten stored tables: schema registry (K1), appends with key checks (K2),
range scans (C1) and latest rows (C2).

Tables are parquet directories partitioned by year-month of their date
column, so a date-bounded scan prunes whole partitions.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.session import cut_lineage
from tidewise.sources.publish import begin, publish, recover, staging_path


def _d(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


@dataclass(frozen=True)
class TableSpec:
    schema: T.StructType
    keys: tuple[str, ...]
    date_col: str


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# K1: fixed schemas of the stored tables (column name, type), primary key and
# the date column each table is ordered and partitioned by.
TABLES: dict[str, TableSpec] = {
    "prices": TableSpec(_st(("date", T.DateType()), ("hub", T.StringType()), ("spot_price", _d(10, 4)),
                            ("front_month", _d(10, 4)), ("m1_m2_spread", _d(10, 4))), ("date", "hub"), "date"),
    "storage_weekly": TableSpec(_st(("report_date", T.DateType()), ("working_gas", _d(10, 2)),
                                    ("five_year_avg", _d(10, 2)), ("yoy_deviation", _d(10, 2)),
                                    ("wow_change", _d(10, 2))), ("report_date",), "report_date"),
    "production_monthly": TableSpec(_st(("month", T.DateType()), ("dry_gas_bcfpd", _d(10, 2))), ("month",), "month"),
    "lng_monthly": TableSpec(_st(("month", T.DateType()), ("exports_bcf", _d(10, 2)), ("avg_price", _d(10, 4)),
                                 ("terminal_notes", T.StringType()), ("lng_capacity_bcfpd", _d(10, 2))),
                             ("month",), "month"),
    "power_burn": TableSpec(_st(("date", T.DateType()), ("ba", T.StringType()), ("gas_mwh", _d(10, 2)),
                                ("total_load_mwh", _d(10, 2)), ("renewables_mwh", _d(10, 2))), ("date", "ba"), "date"),
    "weather_daily": TableSpec(_st(("date", T.DateType()), ("region", T.StringType()), ("hdd", _d(8, 2)),
                                   ("cdd", _d(8, 2)), ("hdd_norm_delta", _d(8, 2)), ("cdd_norm_delta", _d(8, 2)),
                                   ("temperature", _d(6, 2)), ("wind_speed", _d(6, 2))), ("date", "region"), "date"),
    "rigs_weekly": TableSpec(_st(("date", T.DateType()), ("total_rigs", T.IntegerType()),
                                 ("oil_rigs", T.IntegerType()), ("gas_rigs", T.IntegerType())), ("date",), "date"),
    "events": TableSpec(_st(("date", T.DateType()), ("label", T.StringType()),
                            ("lng_cap_offline_bcfpd", _d(10, 2))), ("date", "label"), "date"),
    "features": TableSpec(_st(("date", T.DateType()), ("feature_name", T.StringType()),
                              ("feature_value", _d(15, 6))), ("date", "feature_name"), "date"),
    "predictions": TableSpec(_st(("date", T.DateType()), ("model_name", T.StringType()),
                                 ("horizon_days", T.IntegerType()), ("prediction", _d(10, 4)),
                                 ("confidence_lower", _d(10, 4)), ("confidence_upper", _d(10, 4)),
                                 ("actual_value", _d(10, 4)), ("error", _d(10, 4))),
                             ("date", "model_name", "horizon_days"), "date"),
}

PART_COL = "ym"


REASONS = ("type", "null_key", "duplicate")


class RejectedRowsError(ValueError):
    """Rows that do not fit the stored types, or lack a part of the key."""


class DuplicateKeyError(ValueError):
    """Different rows with one key, or a key that is already stored."""


def _columns(df: DataFrame, table: str) -> list[F.Column]:
    """The table's columns in order, in the stored types (NULL where a value
    does not fit; ``split_batch`` tells those apart). Missing columns: NULL."""
    return [(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
            .alias(f.name) for f in TABLES[table].schema.fields]


def _misfit(df: DataFrame, table: str) -> F.Column:
    bad = F.lit(False)
    for f in TABLES[table].schema.fields:
        if f.name in df.columns:
            bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    return bad


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in the stored types; a value that does not fit
    fails the job (``split_batch`` sets such rows apart instead)."""
    bad = F.when(_misfit(df, table), F.raise_error(F.lit(f"{table}: a value does not fit its stored type")))
    checked = df.withColumn("_misfit", bad.cast("int"))
    return checked.filter(F.col("_misfit").isNull()).select(*_columns(df, table))


def split_batch(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a batch.

    Accepted rows have the stored columns and types, complete keys, and one
    row per key; rows equal in every column count as one. Rejected rows keep
    the batch's columns as text and add ``reason``: ``type`` (a value does
    not fit), ``null_key`` (a key part is NULL) or ``duplicate`` (different
    rows with one key: none of them is chosen)."""
    return _split(_flagged(df, table), table)


def _flagged(df: DataFrame, table: str) -> DataFrame:
    """The batch's rows: stored columns, the original ones as text, the
    ``_reason`` of a rejected row and ``_copy`` (1 for the row to keep of equal
    ones). One shuffle, by key."""
    spec = TABLES[table]
    keys, names = list(spec.keys), [f.name for f in spec.schema.fields]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    raw = F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns]).alias("_raw")
    x = df.select(raw, _misfit(df, table).alias("_bad"), *_columns(df, table))
    x = x.withColumn("_reason", F.when(F.col("_bad"), "type").when(no_key, "null_key")).drop("_bad")
    content = F.to_json(F.struct(*names))
    one = Window.partitionBy(*keys, "_reason")
    clash = F.col("_reason").isNull() & (F.min(content).over(one) < F.max(content).over(one))
    copy = F.row_number().over(one.orderBy(content))
    return x.select("_raw", *names, F.when(clash, "duplicate").otherwise(F.col("_reason")).alias("_reason"),
                    copy.alias("_copy"))


def _split(flagged: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    names = [f.name for f in TABLES[table].schema.fields]
    accepted = flagged.filter("_reason is null and _copy = 1").select(*names)
    return accepted, flagged.filter("_reason is not null").select("_raw.*", F.col("_reason").alias("reason"))


def _raise_rejects(flagged: DataFrame, table: str) -> None:
    counts = {r["_reason"]: r["n"] for r in flagged.filter("_reason is not null").groupBy("_reason").agg(
        F.count("*").alias("n")).collect()}
    if counts.get("duplicate"):
        raise DuplicateKeyError(f"{table}: {counts}")
    if counts:
        raise RejectedRowsError(f"{table}: {counts}")


def reject_count(df: DataFrame, table: str) -> DataFrame:
    """Rejected rows by reason: (reason, n), one row per reason that occurs."""
    return split_batch(df, table)[1].groupBy("reason").agg(F.count("*").alias("n"))


def table_path(root: str, table: str) -> str:
    return os.path.join(root, table)


def create_tables(spark: SparkSession, root: str, names: tuple[str, ...] | None = None) -> None:
    """K1: create the tables that are absent. A table is a directory; its
    schema lives in ``TABLES`` and is applied on every read, so an empty
    table needs no files."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in names or tuple(TABLES):
        p = jvm.org.apache.hadoop.fs.Path(table_path(root, name))
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            fs.mkdirs(p)


def _write_partitioned(out: DataFrame, path: str, mode: str, date_col: str) -> None:
    """Write by year-month partition. Rows are range-partitioned on
    (year-month, date) first, so each task writes one or a few months (few,
    large files) and a busy month is still split across tasks."""
    spark = out.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(n, PART_COL, date_col).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(PART_COL).parquet(path))


def read_stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table, after the commits that a stopped writer left are done."""
    recover(spark, root)
    spec = TABLES[table]
    schema = T.StructType(list(spec.schema.fields) + [T.StructField(PART_COL, T.StringType(), True)])
    return spark.read.schema(schema).parquet(table_path(root, table))


def append(df: DataFrame, root: str, table: str, on_conflict: str = "error", on_reject: str = "raise") -> int:
    """K2: append rows to a stored table with primary-key semantics.

    Keys already present in the table are an error (``on_conflict="error"``),
    skipped (``"skip"``, left anti join) or replace the stored rows of the
    touched partitions (``"replace"``). Rows that ``split_batch`` rejects
    raise ``RejectedRowsError`` / ``DuplicateKeyError`` before anything is
    written; ``on_reject="separate"`` writes the accepted rows only, and the
    caller reads the others from ``split_batch`` (or ``append_accepted``).
    Returns the number of rows written; an empty batch is a no-op.
    """
    flagged = cut_lineage(_flagged(df, table))  # read by the checks and by the write
    if on_reject == "raise":
        _raise_rejects(flagged, table)
    elif on_reject != "separate":
        raise ValueError(on_reject)
    return _append_flagged(flagged, root, table, on_conflict)


def _append_flagged(flagged: DataFrame, root: str, table: str, on_conflict: str) -> int:
    batch, n, _ = _resolved(flagged, root, table, on_conflict)
    if n:
        mode = "overwrite" if on_conflict == "replace" else "append"
        _write_partitioned(batch, table_path(root, table), mode, TABLES[table].date_col)
    return n


def _resolved(flagged: DataFrame, root: str, table: str, on_conflict: str) -> tuple[DataFrame, int, list[str]]:
    """(rows to write, their number, year-months whose stored rows they
    replace): the accepted rows against the keys already stored."""
    if on_conflict not in ("error", "skip", "replace"):
        raise ValueError(on_conflict)
    spark, spec = flagged.sparkSession, TABLES[table]
    keys = list(spec.keys)
    create_tables(spark, root, (table,))
    batch = _split(flagged, table)[0].withColumn(PART_COL, F.date_format(F.col(spec.date_col), "yyyy-MM"))
    n, first, last = batch.agg(F.count("*"), F.min(PART_COL), F.max(PART_COL)).first()
    if not n:
        return batch, 0, []
    # only the year-months of the batch can hold its keys: the filter prunes the others' files
    stored = read_stored(spark, root, table).filter(F.col(PART_COL).between(first, last))
    by = [*keys, PART_COL]
    if on_conflict == "error":
        if not batch.join(stored.select(*by), by, "left_semi").isEmpty():
            raise DuplicateKeyError(f"{table}: key already stored")
        return batch, n, []
    if on_conflict == "skip":
        batch = cut_lineage(batch.join(stored.select(*by), by, "left_anti"))
        return batch, batch.count(), []
    touched = batch.select(PART_COL).distinct()
    keep = stored.join(touched, PART_COL, "left_semi").join(batch.select(*by), by, "left_anti")
    # the rewrite reads partitions that it overwrites: cut the lineage first
    months = [r[0] for r in touched.collect()]
    batch = cut_lineage(batch.unionByName(keep.select(*batch.columns)))
    return batch, batch.count(), months


def append_accepted(df: DataFrame, root: str, table: str, on_conflict: str = "error") -> tuple[int, DataFrame]:
    """``append`` of the accepted rows, with the rejected ones as a frame."""
    flagged = cut_lineage(_flagged(df, table))
    return _append_flagged(flagged, root, table, on_conflict), _split(flagged, table)[1]


def scan_range(df: DataFrame, table: str | None = None, start: str | None = None, end: str | None = None,
               date_col: str | None = None) -> DataFrame:
    """Rows with start <= date <= end (either bound optional), ordered by
    the table's date column. The filter reaches the parquet scan and prunes
    year-month partitions of stored tables."""
    dc = date_col or (TABLES[table].date_col if table else "date")
    x = df
    part = PART_COL in df.columns  # a stored table: bound the partitions too
    if start:
        x = x.filter(F.col(dc) >= F.lit(start).cast("date"))
        if part:
            x = x.filter(F.col(PART_COL) >= F.lit(str(start)[:7]))
    if end:
        x = x.filter(F.col(dc) <= F.lit(end).cast("date"))
        if part:
            x = x.filter(F.col(PART_COL) <= F.lit(str(end)[:7]))
    return x.orderBy(dc)


def latest(df: DataFrame, table: str | None = None, date_col: str | None = None) -> DataFrame:
    """All rows at the maximum date (ties kept).

    A stored table is first bounded by its latest year-month (a scan of the
    partition column only), so one month's files are read. The maximum is a
    one-row aggregate joined back; a one-row frame is the only thing
    broadcast.
    """
    dc = date_col or (TABLES[table].date_col if table else "date")
    if PART_COL in df.columns:
        df = df.filter(F.col(PART_COL) == F.lit(df.agg(F.max(PART_COL)).first()[0]))
    mx = df.agg(F.max(dc).alias("_max"))
    return df.join(F.broadcast(mx), F.col(dc) == F.col("_max")).drop("_max")


def ingest_all(tables: dict[str, DataFrame], root: str, on_conflict: str = "error", start: str | None = None,
               end: str | None = None, days: int | None = None, parallelism: int = 4,
               on_reject: str = "raise") -> dict[str, int]:
    """Append every landed table frame to its stored table (K1
    schemas, K2 key checks); returns rows written per table. All or nothing:
    every batch is checked, then every table is staged, then all are published
    by one commit (``publish``), so a rejected row or a failure anywhere before
    it leaves every table as it was, and one after it is made good by the next
    read.

    Optional window on each table's date column: ``start``/``end``
    (inclusive), or ``days`` back from ``end`` (the clock is injected through
    ``end``; the usual default is the trailing 365 days)."""
    import datetime as _dt

    if days is not None:
        if end is None:
            raise ValueError("days needs an explicit end date (no wall clock inside jobs)")
        start = (_dt.date.fromisoformat(end) - _dt.timedelta(days=days)).isoformat()
    from concurrent.futures import ThreadPoolExecutor

    def within(name, df):
        dc = TABLES[name].date_col
        if start:
            df = df.filter(F.col(dc) >= F.lit(start).cast("date"))
        if end:
            df = df.filter(F.col(dc) <= F.lit(end).cast("date"))
        return df

    if not tables:
        return {}
    spark, batch = next(iter(tables.values())).sparkSession, uuid.uuid4().hex
    begin(spark, root)
    # the tables are independent: their jobs run concurrently on the cluster
    with ThreadPoolExecutor(max_workers=min(parallelism, max(1, len(tables)))) as pool:
        flagged = dict(pool.map(lambda t: (t[0], cut_lineage(_flagged(within(*t), t[0]))), tables.items()))
        if on_reject == "raise":
            list(pool.map(lambda t: _raise_rejects(t[1], t[0]), flagged.items()))
        staged = dict(pool.map(lambda t: (t[0], _stage(t[1], root, t[0], on_conflict, batch)), flagged.items()))
    publish(spark, root, batch, {t: [f"{PART_COL}={m}" for m in months] for t, (_, months) in staged.items()})
    return {t: n for t, (n, _) in staged.items()}


def _stage(flagged: DataFrame, root: str, table: str, on_conflict: str, batch: str) -> tuple[int, list[str]]:
    rows, n, months = _resolved(flagged, root, table, on_conflict)
    if n:
        _write_partitioned(rows, f"{staging_path(root, batch)}/{table}", "append", TABLES[table].date_col)
    return n, months
