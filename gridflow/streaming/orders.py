"""The order flow on a stream: outcomes, dead letters and a running average over all batches."""

from pyspark.sql import functions as F

from .. import fixed_values as V
from .. import storage
from ..functions import padded_key
from ..operators.orders import (
    PRICE_TYPE,
    is_accepted,
    resolve,
    with_audit_trail,
    with_fallback_names,
    with_running_average,
)
from ..sinks.files import write_once
from .zones import trigger_of


class OrderOutcomes:
    """Outcome table of an order stream, one folder per batch, split by acceptance.

    What a batch needs to know of its predecessors, the totals so far, is the one row that
    the batch before it left in its own folder of `totals`; nothing is listed and nothing is
    kept on the driver, and a restarted query goes on from there. Within a batch the totals
    are computed in parallel (see `running_totals`), so the stream has no single task that
    sees every order.
    """

    def __init__(self, spark, root, max_retries=V.MAX_RETRIES, price_type=PRICE_TYPE):
        self.spark, self.root = spark, root
        self.max_retries, self.price_type = max_retries, price_type
        self.totals = f"{root}/_totals"

    def _prior(self, batch_id):
        if not batch_id:
            return {"prior_orders": 0, "prior_rejects": 0, "prior_total": 0}
        return self.spark.read.parquet(f"{self.totals}/batch_id={batch_id - 1}").first().asDict()

    def write(self, batch_df, batch_id):
        prior, folder = self._prior(batch_id), f"batch_id={batch_id}"
        orders = batch_df.persist()
        try:
            rows = self.outcomes(orders, prior)
            write_once(rows, self.root, folder, ["accepted"])
        finally:
            orders.unpersist()
        if storage.is_published(self.spark, f"{self.root}/{folder}"):
            rows = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}")
        else:
            rows = self.spark.createDataFrame([], rows.schema)
        places = (("prior_orders", "total_orders"), ("prior_rejects", "total_rejects"), ("prior_total", "cumulative_price"))
        totals = rows.agg(*[F.coalesce(F.max(c), F.lit(prior[name])).cast(rows.schema[c].dataType).alias(name)
                            for name, c in places])
        write_once(totals, self.totals, folder)

    def outcomes(self, orders, prior):
        numbered = with_running_average(resolve(orders, self.max_retries, self.price_type), **prior)
        return with_audit_trail(numbered).drop("_permanent").withColumns({
            "accepted": is_accepted().cast("int"),  # a folder name; booleans are read back as text
            "dlq_id": F.when(~is_accepted(), padded_key(F.lit("DLQ-"), F.col("total_rejects"))),
            "replayed": F.when(~is_accepted(), F.lit(False)),
            "processed_at": F.current_timestamp(),
        })

    def read(self):
        return with_fallback_names(self.spark.read.parquet(self.root))

    def accepted(self):
        """Reads the accepted folders only."""
        return self.read().where("accepted = 1")

    def rejected(self):
        return self.read().where("accepted = 0")


def start_orders(orders, outcomes, checkpoint, trigger=V.TRIGGER_INTERVAL):
    """Run an order stream into `outcomes`."""
    return (
        orders.writeStream.foreachBatch(outcomes.write)
        .option("checkpointLocation", checkpoint).trigger(**trigger_of(trigger)).start()
    )
