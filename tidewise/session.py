"""Spark session and lineage helpers.

The library never creates a session implicitly inside an operator; callers
pass one in. ``get_spark`` is a convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library relies on: UTC so that date/timestamp
# casts are stable across engines, AQE so that joins of date-keyed frames are
# re-planned (broadcast / skew split / coalesce) from runtime sizes instead of
# hard-coded hints.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle partitions to the advisory size (64 MB), not to the
    # default parallelism: right-sized tasks at scale, no empty tasks on
    # small stages
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # plan descriptions and job/stage records are kept by the driver's status
    # store even without the UI; bound them so long sessions of deep plans do
    # not fill the driver heap
    "spark.sql.maxPlanStringLength": str(1 << 18),
    "spark.sql.ui.retainedExecutions": "50",
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "20000",
}


def get_spark(
    master: str | None = None,
    app_name: str = "tidewise",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return ship_package(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a single-machine ``local[...]`` session may leave the setting out (as
    tests do); it gets a scratch folder of its own. Any other master without
    the setting is an error: a machine-local folder would be lost with its
    machine and unseen by the others.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidewise-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the
    Python workers, once per application, so that functions which run there
    import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return spark
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(here)
    target = os.path.join(tempfile.mkdtemp(prefix="tidewise-ship-"), "tidewise_pkg.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the checkpoint folder for intermediate tables; it is made
    here and removed when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path


class Scratch:
    """Tables between the steps of one job, as compressed files below the
    checkpoint folder. A table goes with ``drop``, all of them with the job."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, scratch_path(spark, f"{name}/{uuid.uuid4().hex}")

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` (after the rows that ``name`` has, if any); the table."""
        path = f"{self.root}/{name}"
        df.write.mode("append").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Scratch]:
    """A ``Scratch`` that is gone afterwards. Inside, shuffle files go with the
    action that wrote them instead of waiting for the driver's garbage
    collection; frames that outlive the block have to be made after it."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    tables, before = Scratch(spark, name), spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield tables
    finally:
        spark.conf.set(setting, before)
        tables.drop()
