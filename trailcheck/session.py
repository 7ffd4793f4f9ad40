"""SparkSession defaults used by tests, the bench and the CLI-less entry points.

Library functions never depend on these settings for correctness: epoch
conversions and calendar days are computed without the session time zone, and
divisions are guarded so ANSI mode never raises.  The settings below are what
we recommend for a cluster run; the local test session mirrors them.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "trailcheck") -> SparkSession:
    """Return (or create) a session with the audit defaults applied.

    Under spark-submit the master, memory and shuffle width of the submission stay; only what the caller names here
    overrides them.  A plain Python process gets a local session.
    """
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if master or not submitted:
        builder = builder.master(master or f"local[{cpus}]")
    if shuffle_partitions or not submitted:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    if not submitted:
        builder = builder.config("spark.driver.memory", os.environ.get("TRAILCHECK_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a directory and return it.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is read from the session.  Where it is
    unset, a folder beside the session's tables is used, whatever the master.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_checkpoints")
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the checkpoint folder for tables that later steps read; deleted when the driver's JVM ends."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/trailcheck-{uuid.uuid4().hex}")
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return fs.makeQualified(hadoop).toString()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in a new scratch folder and read back: lineage ends here, several plans read it once made."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove files of a scratch folder that no later step reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
