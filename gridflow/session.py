"""Spark session and the shared folder that jobs may write to."""

import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name="gridflow", master=None, shuffle_partitions=None, packages=(), extra=None):
    """A session in UTC with adaptive execution and RocksDB state.

    The master, executor sizes and shuffle width belong to the cluster, so they are only
    set when given. Connector packages are fetched only when asked for.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    settings.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Where that is unset, a folder in the session's warehouse, which executors share as well.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_runs"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_dir(spark, label):
    """A new folder name under the shared folder; nothing is created or removed."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
