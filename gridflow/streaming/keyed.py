"""The order flow with keyed state: totals by product that go on across restarts, and failing messages that wait for their
retry in the state store. Both need the RocksDB state store; they are started with it, whatever the session has."""

from contextlib import contextmanager
from decimal import Decimal

from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as V
from ..functions import average
from ..operators.orders import PRICE_TYPE, classify, is_accepted, resolve, total_type, with_audit_trail
from ..session import ROCKSDB
from ..sinks.files import write_once
from . import processors
from .zones import trigger_of

# The processors travel as they are: the processes that run them do not have this package.
cloudpickle.register_pickle_by_value(processors)

#: State keys of one product, over which its orders are dealt: a product with most of the orders is no single task.
SALTS = 16
#: State keys over which waiting messages are dealt: each is one call per batch, however many messages it has.
BUCKETS = 1024
#: Where those without a number wait; they are one message to the state.
NO_SEQ = -1
NO_PRODUCT = ""


def _total_columns(price_type):
    value = T.DoubleType() if price_type == "double" else T._parse_datatype_string(price_type)
    return f"orders long, rejects long, total {total_type(value).simpleString()}"


def _dealt(resolved):
    """What the state needs of an order, with its place in the state."""
    return resolved.select(
        F.coalesce("product", F.lit(NO_PRODUCT)).alias("product"),
        F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int").alias("salt"), is_accepted().alias("accepted"), "price_value")


def history_totals(orders, max_retries=V.MAX_RETRIES, price_type=PRICE_TYPE):
    """The totals of a table of orders, as the state that a stream of later ones starts from."""
    kind = _total_columns(price_type).split("total ")[1]
    return _dealt(resolve(orders, max_retries, price_type)).groupBy("product", "salt").agg(
        F.count_if("accepted").alias("orders"), F.count_if(~F.col("accepted")).alias("rejects"),
        F.coalesce(F.sum(F.when(F.col("accepted"), F.col("price_value"))), F.lit(0)).cast(kind).alias("total"))


def product_totals(orders, history=None, max_retries=V.MAX_RETRIES, price_type=PRICE_TYPE):
    """A stream of orders to (product, salt, orders, rejects, total) as they stand after each batch that touches them.

    `history`, from `history_totals`, is taken over when the stream starts first; a checkpoint goes on from its own state.
    Sums are commutative, so no order within a batch is needed and rows are taken in parts, however many a key has.
    """
    columns = _total_columns(price_type)
    zero = 0.0 if price_type == "double" else Decimal(0)
    grouped = _dealt(resolve(orders, max_retries, price_type)).groupBy("product", "salt")
    return grouped.transformWithStateInPandas(
        processors.ProductTotals(columns, zero), f"product string, salt int, {columns}", "update", "none",
        initialState=None if history is None else history.groupBy("product", "salt"))


class TotalsTable:
    """Where a totals stream goes: one folder per batch; of each key the latest batch counts."""

    def __init__(self, spark, root, history=None):
        self.spark, self.root, self.history = spark, root, history

    def write(self, batch_df, batch_id):
        write_once(batch_df, self.root, f"batch_id={batch_id}", keep_empty=True)

    def by_product(self):
        """(product, orders, rejects, total, avg_price): the keys of a product taken together."""
        rows = self.spark.read.parquet(self.root)
        if self.history is not None:
            rows = rows.unionByName(self.history.withColumn("batch_id", F.lit(-1)))
        newest = rows.groupBy("product", "salt").agg(F.max_by(F.struct("orders", "rejects", "total"), "batch_id").alias("n"))
        kind = rows.schema["total"].dataType
        told = newest.groupBy(F.coalesce(F.nullif("product", F.lit(NO_PRODUCT)), F.lit(V.UNKNOWN_PRODUCT)).alias("product")).agg(
            F.sum("n.orders").alias("orders"), F.sum("n.rejects").alias("rejects"), F.sum("n.total").cast(kind).alias("total"))
        return told.withColumn("avg_price", average(F.col("total"), F.col("orders")))


@contextmanager
def _rocksdb(spark):
    """RocksDB state for the queries started meanwhile: a query takes the settings as they are when it starts."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_totals(totals, table, checkpoint, trigger=V.TRIGGER_INTERVAL):
    with _rocksdb(totals.sparkSession):
        return (totals.writeStream.foreachBatch(table.write).outputMode("update")
                .option("checkpointLocation", checkpoint).trigger(**trigger_of(trigger)).start())


def parked_retries(orders, max_retries=V.MAX_RETRIES, backoff_s=V.BACKOFF_STEP_S, price_type=PRICE_TYPE):
    """A stream of orders to their outcomes, as `resolve` gives them, each when it is known: attempt n of a message that fails
    for a time comes n - 1 backoffs after the one before. `seq` must be unique; a message sent again while it waits is left out.

    Only messages that have to wait go through the state, dealt over `BUCKETS` keys; the others are settled at their first
    attempt, row by row.
    """
    checked = classify(orders, price_type).select(
        "seq", "orderId", "product", "price", F.coalesce("transient_failures", F.lit(0)).alias("failures"), "permanent_error",
        F.col("error_reason").alias("refused"))
    waits = F.col("refused").isNull() & (F.col("failures") > 0) & F.lit(max_retries > 1)
    bucket = F.when(F.col("seq").isNull(), NO_SEQ).otherwise(F.pmod(F.xxhash64("seq"), F.lit(BUCKETS))).cast("int")
    waiting = checked.where(waits).select(bucket.alias("bucket"), "seq", "orderId", "product", "price", "failures")
    parked = waiting.groupBy("bucket").transformWithStateInPandas(
        processors.ParkedRetries(max_retries, int(backoff_s * 1000), (V.ACCEPTED, V.RECOVERED, V.QUARANTINED),
                                 V.REASON_EXHAUSTED % max_retries), processors.OUTCOME, "append", "processingTime")
    return _settled(checked.where(~waits), max_retries).unionByName(parked)


def _settled(checked, max_retries):
    """The outcomes of the messages whose first attempt is the last: they need no state."""
    refused, failures = F.col("refused").isNotNull(), F.greatest(F.col("failures"), F.lit(0))
    fails = refused | (failures > 0)
    return checked.select(
        "seq", "orderId", "product", "price", F.when(refused, F.col("failures")).otherwise(failures).alias("transient_failures"),
        F.when(refused, F.col("permanent_error")).alias("permanent_error"),
        F.when(fails, V.QUARANTINED).otherwise(V.ACCEPTED).alias("status"), F.lit(1).alias("attempts"),
        F.when(refused, 0).otherwise(F.least(failures, F.lit(max_retries))).alias("retries"),
        F.when(refused, F.col("refused")).when(fails, V.REASON_EXHAUSTED % max_retries).alias("error_reason"),
        F.lit(0).cast("long").alias("parked_ms"))


class OutcomeTable:
    """Where outcomes of `parked_retries` go: one folder per batch that has any, nothing for batches without."""

    def __init__(self, spark, root):
        self.spark, self.root, self.stored = spark, root, 0

    def write(self, batch_df, batch_id):
        folder = f"batch_id={batch_id}"
        if write_once(batch_df, self.root, folder):
            self.stored += self.spark.read.schema(batch_df.schema).parquet(f"{self.root}/{folder}").count()

    def outcomes(self):
        """With the audit trail that the attempts left."""
        rows = self.spark.read.parquet(self.root).drop("batch_id")
        permanent = (F.col("status") == V.QUARANTINED) & (F.col("retries") == 0)
        return with_audit_trail(rows.withColumn("_permanent", permanent)).drop("_permanent")


def start_parked(outcomes, table, checkpoint, trigger="0 seconds"):
    """Run `parked_retries` into a table. Timers fire between batches, so the query runs until it is stopped; what is still
    parked then goes on when it is started again."""
    with _rocksdb(outcomes.sparkSession):
        return (outcomes.writeStream.foreachBatch(table.write).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(**trigger_of(trigger)).start())
