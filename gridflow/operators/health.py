"""Is the serving table still being written to?"""

from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import detail_json
from ..schemas import HEALTH_LOG


def recency(metrics):
    return metrics.agg(
        F.max("window_end").alias("latest_window_end"),
        F.max("updated_at").alias("latest_update"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def _time_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def freshness(metrics, now, limit_s=V.FRESHNESS_LIMIT_S):
    """One row: status, lag_seconds, the recency figures and a JSON document of them.

    `now` is a timestamp column or value, so a check can be repeated for any moment.
    """
    now = now if hasattr(now, "cast") else F.lit(now)
    now = now.cast("timestamp")
    lag = (F.unix_micros(now) - F.unix_micros(F.col("latest_update").cast("timestamp"))) / 1e6
    summary = {
        "total_metrics_records": F.col("total_rows"),
        "latest_window_end": _time_text("latest_window_end"),
        "latest_update": _time_text("latest_update"),
    }
    return recency(metrics).withColumn("lag_seconds", lag).select(
        F.lit(V.STREAM_COMPONENT).alias("component"),
        F.when(F.col("latest_update").isNull(), V.INITIALIZING)
         .when(F.col("lag_seconds") > limit_s, V.DEGRADED).otherwise(V.HEALTHY).alias("status"),
        "latest_window_end", "latest_update", "total_rows", "lag_seconds",
        F.when(F.col("latest_update").isNull(), detail_json(**summary))
         .otherwise(detail_json(**summary, lag_seconds=F.col("lag_seconds"))).alias("details"),
        now.alias("checked_at"),
    )


def unavailable(spark, error, now):
    """The row to log when the serving table could not be read."""
    return spark.range(1).select(
        F.lit(V.STREAM_COMPONENT).alias("component"), F.lit(V.UNAVAILABLE).alias("status"),
        detail_json(error=F.lit(str(error))).alias("details"), F.lit(now).cast("timestamp").alias("checked_at"))


def heartbeat(checked, latency_ms=0.0):
    """Rows for the health log from `freshness` or `unavailable`."""
    return checked.withColumn("latency_ms", F.lit(latency_ms).cast("decimal(10,2)")).select(*HEALTH_LOG.fieldNames())
