"""Streaming form of the gas-burn proxy (A1) and the stream-safe stages.

Row-level stages (degree days, calendar terms, interactions, tightness bins)
are plain projections and run unchanged on a streaming DataFrame. Row-frame
windows (lags, rolling) are not supported on streams by Spark and stay batch.

Two ways to run A1 on a stream:

* ``daily_gas_burn_stream`` - event-time daily windows with a watermark for
  append-mode sinks: a day is emitted once the watermark passes its end,
  and its state is dropped then (bounded state).
* ``run_gas_burn_batches`` - each micro-batch is pre-aggregated to exact
  decimal partial sums per (source, day) and written to its own
  ``batch_id`` partition of a table in the shared checkpoint folder
  (overwrite of that partition: a retried batch replaces, never doubles).
  A batch merge of the partials gives the totals; decimal sums make the
  merge exact and independent of how rows fell into micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.operators.power import GAS_SHARE


def events_stream(spark: SparkSession, folder: str, file_glob: str = "events.parquet",
                  schema: T.StructType | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the landed event files of a folder (file source, explicit
    schema as streaming sources require). Without a limit a micro-batch takes
    all files that have arrived."""
    if schema is None:
        schema = spark.read.parquet(f"{folder}/{file_glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def _exact(df: DataFrame, value_col: str) -> T.DecimalType:
    """Type of exact sums: the column's own decimal type, or two decimals."""
    kind = df.schema[value_col].dataType
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(18, 2)


def daily_gas_burn_stream(stream: DataFrame, ts_col: str = "ts", source_col: str = "event_type",
                          value_col: str = "value", watermark: str = "1 day",
                          gas_share: float = GAS_SHARE) -> DataFrame:
    """A1 on a stream: (window, source) -> gas burn, with a watermark.

    Watermarks need an instant type; a wall-clock (NTZ) event time is read in
    the session time zone."""
    x = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
    agg = x.groupBy(F.window(ts_col, "1 day").alias("w"), F.col(source_col).alias("ba")).agg(
        F.sum(F.col(value_col).cast(_exact(stream, value_col))).alias("_s"))
    return agg.select("ba", F.to_date(F.col("w.start")).alias("date"),
                      (F.col("_s").cast("double") * F.lit(gas_share)).alias("gas_burn_mwh"))


def run_gas_burn_batches(stream: DataFrame, out_dir: str, ts_col: str = "ts",
                         source_col: str = "event_type", value_col: str = "value",
                         gas_share: float = GAS_SHARE) -> DataFrame:
    """Drain the stream (available-now trigger) through per-batch exact
    partial sums, then merge; returns (ba, date, gas_burn_mwh). ``out_dir``
    holds the stream's checkpoint: the same folder after a restart resumes
    the stream, so every event counts once."""
    spark = stream.sparkSession
    exact = _exact(stream, value_col)
    total = T.DecimalType(min(38, exact.precision + 10), exact.scale)
    partials, ckpt = f"{out_dir}/partials", f"{out_dir}/_checkpoint"

    def sink(batch: DataFrame, batch_id: int) -> None:
        part = batch.filter(F.col(ts_col).isNotNull()).groupBy(
            F.col(source_col).alias("ba"), F.to_date(ts_col).alias("date")
        ).agg(F.sum(F.col(value_col).cast(exact)).cast(total).alias("s"))
        (part.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(partials))

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    schema = f"ba string, date date, s {total.simpleString()}, batch_id long"
    merged = spark.read.schema(schema).parquet(partials).groupBy("ba", "date").agg(F.sum("s").alias("s"))
    return merged.select("ba", "date", (F.col("s").cast("double") * F.lit(gas_share)).alias("gas_burn_mwh"))
