"""Co-located stored tables: joins without moving the fact sides.

A table is written in ``buckets`` hash buckets of its join columns, sorted by
them inside, one file per bucket and write. Tables with the same number of
buckets join on those columns bucket by bucket: the feature matrix of tables
bucketed by date, a roll-up to dates, or an as-of lookup of tables bucketed by
(entity, month) reads every fact once and shuffles none.

The layout needs Spark's catalog; a small file beside the data says what a
session needs to open the table again. More buckets than cores keep tasks even;
an entity that dominates is split by the month in the key.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewise.sources.publish import _Files

BUCKETS = 64
MONTH = "ym"


def _name(root: str, table: str) -> str:
    return f"colocated_{table}_{hashlib.blake2b(root.encode(), digest_size=6).hexdigest()}"


def write_table(df: DataFrame, root: str, table: str, by: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` in buckets of ``by`` (replacing the table) and open it."""
    spark = df.sparkSession
    spark.sql(f"drop table if exists {_name(root, table)}")
    path = f"{root}/{table}"
    # the same hash as the buckets': a task writes whole buckets, one file each
    (df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
     .option("path", path).format("parquet").saveAsTable(_name(root, table)))
    facts = {"schema": json.loads(df.schema.json()), "by": list(by), "buckets": buckets}
    _Files(spark, root).write(f"{root}/{table}.layout", json.dumps(facts))
    return spark.table(_name(root, table))


def open_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table that this or another session wrote."""
    name = _name(root, table)
    if not spark.catalog.tableExists(name):
        facts = json.loads(_Files(spark, root).read(f"{root}/{table}.layout"))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(facts["schema"]).fields)
        by = ", ".join(f"`{c}`" for c in facts["by"])
        spark.sql(f"create table {name} ({columns}) using parquet clustered by ({by}) sorted by ({by}) "
                  f"into {facts['buckets']} buckets location '{root}/{table}'")
    return spark.table(name)


def write_by_date(tables: dict[str, DataFrame], root: str, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """The tables of a feature matrix, each in buckets of its date column, for
    ``joins.feature_matrix``."""
    from tidewise.operators.joins import DATE_KEYS

    return {t: write_table(df, root, t, [DATE_KEYS.get(t, "date")], buckets) for t, df in tables.items()}


def write_by_month(df: DataFrame, root: str, table: str, date_col: str, by: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """A table in buckets of (``by``, month of ``date_col``), for ``asof_stored``."""
    dated = df.withColumn(MONTH, F.trunc(date_col, "month"))
    return write_table(dated, root, table, [*by, MONTH], buckets)


def asof_stored(left: DataFrame, right: DataFrame, left_date: str, right_date: str, value_cols: Sequence[str],
                by: Sequence[str]) -> DataFrame:
    """J4 over two tables of ``write_by_month``: each left row with the values of
    the latest right row of its entity at or before its date.

    The latest row of the same month comes from a bucket-wise join (a month of
    one entity has at most 31 x 31 pairs of days); what earlier months left
    behind from a frame with one row per entity and month. Only that frame is
    shuffled. (entity, date) is unique on the left and without NULL, as a stored
    key is; a row with a NULL entity finds nothing."""
    keys = [*by, MONTH]
    packed = F.struct(*[F.col(c).alias(c) for c in value_cols])
    cols = left.columns
    r = right.select(*keys, F.col(right_date).alias("_at"), packed.alias("_values"))
    month = left.join(r, keys, "left").withColumn("_known", F.col("_at") <= F.col(left_date))
    at = F.when(F.col("_known"), F.col("_at"))               # a NULL is no maximum
    own = month.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.max_by("_values", at).alias("_own"), F.max(at).alias("_seen"))
    # the last values of earlier months, for every month that has rows on either side
    ends = right.groupBy(*keys).agg(F.max_by(packed, right_date).alias("_end"))
    months = left.select(*keys).distinct().withColumn("_end", F.lit(None).cast(ends.schema["_end"].dataType))
    stretch = months.unionByName(ends).groupBy(*keys).agg(F.first("_end", True).alias("_end"))
    before = Window.partitionBy(*by).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, -1)
    carry = stretch.select(*keys, F.last("_end", True).over(before).alias("_carry"))
    joined = own.join(carry, keys, "left")
    values = F.when(F.col("_seen").isNotNull(), F.col("_own")).otherwise(F.col("_carry"))
    return joined.withColumn("_values", values).select(*cols, *[F.col(f"_values.{c}").alias(c) for c in value_cols])
