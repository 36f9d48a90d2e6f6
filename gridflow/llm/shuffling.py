"""Two-pass external shuffle: records are scattered into memory-sized buckets by seeded hashes, then each bucket gets a
Fisher-Yates shuffle and is written. Shards are equal stretches of the buckets laid end to end."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, Scratch

#: Bytes of texts in a bucket, which one task holds in memory; buckets for each shard at least; buckets at most.
BUCKET_BYTES, PER_SHARD, MOST_BUCKETS = 32 << 20, 4, 1 << 20


def external_shuffle(docs, shards, seed=7, bucket_bytes=BUCKET_BYTES, scratch=None):
    """All records in random order, dealt to shards whose counts differ by one at most: (record, shard, slot, bucket).

    `record` is a struct of all columns of docs, so no name can clash. slot counts from 0 in each shard. The bucket is a
    seeded hash of doc_id and text: null ids and equal texts under different ids scatter like any others. Rows equal in
    both are written with a row number that goes into the hash, so they scatter too. Null and empty texts are records like others; an empty table gives no rows.

    The first pass sends every record to its bucket, the only time that texts are shuffled (those of rows equal in both
    are written once before; a number that a rerun of a task might give anew would lose rows). In the second a task sorts
    its bucket by another hash, so that a rerun starts from the same order, and applies Spark's `shuffle`, a seeded
    Fisher-Yates. The written buckets are the result; where a bucket starts follows from their counts, at most 2^20 rows,
    which bounds the broadcast.
    """
    scratch = scratch or Scratch(docs.sparkSession, "shuffle")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    buckets = min(MOST_BUCKETS, max(PER_SHARD * shards, -(-size // bucket_bytes)))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    records = docs.select(F.xxhash64(F.lit(seed), "doc_id", "text").alias("hash"),
                          F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("order"), "doc_id", own, F.lit(0).cast("long").alias("nr"))
    repeated = scratch.save(records.groupBy("hash").count().where("count > 1").select("hash"), "repeated")
    if not repeated.isEmpty():
        few = F.broadcast(repeated) if repeated.count() <= BROADCAST_IDS else repeated
        again = records.join(few, "hash", "left_semi").withColumn("nr", F.monotonically_increasing_id())
        again = scratch.save(again, "again")
        again = again.withColumn("hash", F.xxhash64("hash", "nr")).withColumn("order", F.xxhash64("order", "nr"))
        records = records.join(few, "hash", "left_anti").unionByName(again)
    records = records.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    scattered = records.repartition(buckets, "bucket").sortWithinPartitions("bucket", "order", "doc_id", "nr")
    gathered = scattered.groupBy("bucket").agg(F.collect_list("record").alias("records"))
    mixed = gathered.select("bucket", F.posexplode(F.shuffle("records", seed)).alias("at", "record"))
    written = scratch.save(mixed, "buckets")

    counts = scratch.save(written.groupBy("bucket").agg(F.count("*").alias("n")), "counts")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    placed = written.join(F.broadcast(starts), "bucket").withColumn("place", F.col("start") + F.col("at"))
    placed = placed.withColumn("shard", F.expr(f"place * {shards} div {max(rows, 1)}"))
    first = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return placed.select("record", F.col("shard").cast("int").alias("shard"),
                         (F.col("place") - first).alias("slot"), "bucket")


def write_shards(shuffled, path):
    """Write shuffled records as one folder per shard, each row with its slot."""
    shuffled.select("record.*", "slot", "shard").write.partitionBy("shard").parquet(path)
