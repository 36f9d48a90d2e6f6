"""Order messages from JSON lines or Avro."""

from pyspark.sql import functions as F

from ..schemas import ORDER, ORDER_EVENT


def read_order_json(spark, path, streaming=False, schema=ORDER_EVENT, max_files=None):
    reader = spark.readStream if streaming else spark.read
    if max_files and streaming:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.schema(schema).json(path)


def read_order_avro(spark, path, streaming=False):
    """Order messages as Avro files. Needs Spark's Avro module on the cluster."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("avro").schema(ORDER).load(path)


def as_order_messages(records):
    """Any frame with orderId, product and price, brought to the message schema."""
    return records.select(
        F.col("orderId").cast("string").alias("orderId"),
        F.col("product").cast("string").alias("product"),
        F.col("price").cast("float").alias("price"),
    )
