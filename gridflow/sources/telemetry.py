"""Telemetry records as (key binary, value binary, timestamp), from a topic or from files."""

from pyspark.sql import functions as F

from ..fixed_values import TELEMETRY_TOPIC


def read_topic(spark, servers, topic=TELEMETRY_TOPIC, starting_offsets="earliest", streaming=True,
               max_per_trigger=None, min_partitions=None, fail_on_data_loss=True):
    """Records of a Kafka topic. Needs Spark's Kafka connector on the cluster.

    Starts at the earliest record, so a first run covers the history; pass "latest" to
    skip it. `max_per_trigger` bounds a micro-batch, `min_partitions` splits the topic
    partitions that hold most of the records. A query fails when records expired before
    they were read; with `fail_on_data_loss` off it goes on without them, unreported.
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_per_trigger and streaming:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return reader.options(**options).load().select("key", "value", "timestamp")


def read_text_files(spark, path, streaming=True, max_files=None):
    """The same columns from text files with one JSON record per line."""
    reader = spark.readStream if streaming else spark.read
    if max_files and streaming:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.text(path).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def first_deliveries(raw, within="1 hour"):
    """A stream of records without those that a retrying producer sent again: the same key and value within so long of the
    first one's arrival.

    The time is that of arrival, so no record is too late to be looked at, however old its reading; the state holds one
    digest of 32 bytes per record for that time, and goes on over restarts. Meter and time of a reading are part of its value.
    Checkpoints from when the digest was text do not fit: Spark refuses them, as the type of the key differs.
    """
    size = lambda c: F.coalesce(F.octet_length(c), F.lit(-1)).cast("string").cast("binary")
    part = lambda c: F.coalesce(c, F.lit(b""))
    slash = F.lit(b"/")
    whole = F.concat(size("key"), slash, size("value"), slash, part("key"), part("value"))
    seen = raw.withColumns({"_digest": F.unhex(F.sha2(whole, 256)), "_arrived": F.current_timestamp()})
    return seen.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest", "_arrived")
