"""Writing a micro-batch to its own folder, once."""

import uuid

from .. import storage


def write_once(df, root, folder, partition_by=(), keep_empty=False):
    """Write `df` as Parquet to root/folder and say whether anything was published.

    The rows go to a hidden folder first and appear by one rename, so a reader never sees
    half a batch. A batch counts as published by its marker, and then stays as it is: a rerun after a crash
    brings the same rows, and a stream reading this table may have taken the files. It is
    computed all the same, since a stateful query has to bring its state up to date.

    An empty batch publishes nothing; that is looked up in what was written, so the batch
    is computed only once.
    """
    spark, final = df.sparkSession, f"{root}/{folder}"
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(staging)
    empty = not keep_empty and spark.read.schema(df.schema).parquet(staging).isEmpty()
    if empty or storage.is_published(spark, final):
        storage.remove(spark, staging)
        return False
    storage.publish(spark, staging, final)
    return True


def append_rows(df, path, partition_by=()):
    """Plain append, for logs: dead letters, heartbeats."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
