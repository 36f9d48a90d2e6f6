"""Plain forms of two operators, timed beside ours to see what the extra steps cost or save."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import orders, zones
from . import inputs as I


def plain_running_avg(spark, sf):
    """The running average in one unpartitioned window: one task."""
    order = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    resolved = orders.resolve(I.orders(spark, sf), price_type=I.PRICE)
    counted = F.count(F.when(orders.is_accepted(), 1)).over(order)
    total = F.sum(F.when(orders.is_accepted(), F.col("price_value"))).over(order)
    return resolved.select("seq", "status", counted.alias("total_orders"), (total / counted).alias("running_avg"))


def plain_window_metrics(spark, sf):
    """Sliding windows by copying every reading to each of its windows first."""
    rows = I.enriched(spark, sf)
    return rows.groupBy(F.window("event_timestamp", I.WINDOW, I.SLIDE), "grid_zone").agg(*zones._raw_metrics())


def queries():
    return {"plain_running_avg": plain_running_avg, "plain_window_metrics": plain_window_metrics}
