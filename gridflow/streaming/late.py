"""Late readings: told from those in time before they are aggregated, kept with their lag, and counted."""

from pyspark.sql import functions as F

from ..sinks.files import write_once

MICROS = 1_000_000


class LateRows:
    """Splits each micro-batch of a stream at the watermark that the batches before it have set.

    The watermark is the latest event time of all earlier batches less `delay`, as Spark's own is. It is state: the row that
    each batch leaves in its folder of root/watermarks is what the next one starts from, so a restarted query and a batch
    that runs again split at the same time. Every batch leaves one, also without rows.

    A reading has `windows` windows; those whose end the watermark has reached are closed, and it is lost to them. It is late
    if it is lost to all. A reading lost to some goes on, to be counted in the others, and its lost windows with it.
    """

    def __init__(self, spark, root, delay, window, slide, time="event_timestamp"):
        self.spark, self.folder, self.time = spark, f"{root}/watermarks", time
        self.delay, self.window, self.slide = (_micros(spark, length) for length in (delay, window, slide))

    def watermark(self, batch_id):
        """In microseconds, as it stands before a batch; None before the first reading."""
        if not batch_id:
            return None
        return self.spark.read.parquet(f"{self.folder}/batch_id={batch_id - 1}").first()["watermark"]

    def mark(self, rows, batch_id):
        """rows with `watermark`, `lag_seconds` behind it (null for rows before it), `windows` and `lost_windows`."""
        watermark = F.lit(self.watermark(batch_id)).cast("long")
        at = F.unix_micros(self.time)
        slide, window = F.lit(self.slide), F.lit(self.window)
        newest = at - F.pmod(at, slide)                      # the start of the last window that holds the reading
        windows = F.floor((window - (at - newest) - 1) / slide) + 1
        still_open = F.floor((newest + window - watermark - 1) / slide) + 1
        lost = windows - F.greatest(F.lit(0), F.least(windows, still_open))
        return rows.withColumns({
            "watermark": F.timestamp_micros(watermark),
            "lag_seconds": F.when(at < watermark, (watermark - at) / MICROS),
            "windows": windows.cast("long"),
            "lost_windows": F.coalesce(lost, F.lit(0)).cast("long"),
        })

    def advance(self, rows, batch_id):
        """Leave the watermark, and the batch's counts, to the next batch."""
        known = F.lit(self.watermark(batch_id)).cast("long")
        late = F.col("lost_windows") == F.col("windows")
        left = rows.agg(
            F.greatest(known, F.max(F.unix_micros(self.time)) - F.lit(self.delay)).alias("watermark"),
            F.count_if(~late).alias("in_time"), F.count_if(late).alias("late"),
            F.coalesce(F.sum("lost_windows"), F.lit(0)).alias("lost_windows"))
        write_once(left, self.folder, f"batch_id={batch_id}")

    def counts(self):
        """Readings in time and late, and windows lost, per batch."""
        return self.spark.read.parquet(self.folder).select("batch_id", "in_time", "late", "lost_windows")


def in_time(marked):
    return marked.where("lost_windows < windows").drop("watermark", "lag_seconds", "windows", "lost_windows")


def late(marked):
    return marked.where("lost_windows = windows")


def _micros(spark, length):
    """The microseconds of a length of time, such as "10 seconds"."""
    since = f"unix_micros(timestamp'2000-01-01' + interval {length}) - unix_micros(timestamp'2000-01-01')"
    return spark.range(1).select(F.expr(since)).first()[0]
