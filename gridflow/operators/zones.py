"""Zone metrics: per window, per micro-batch, and over the whole grid."""

from pyspark.sql import functions as F

from ..fixed_values import GRID_ZONES, SLIDE_DURATION, WINDOW_DURATION
from ..functions import renewable_pct
from .upsert import latest_wins

SUMS = ("power_consumption_kwh", "solar_generation_kwh", "net_grid_load_kwh", "estimated_cost")
METRICS = ("total_consumption_kwh", "total_solar_generation_kwh", "net_load_kwh",
           "renewable_contribution_pct", "total_cost_estimate", "active_meters")
TOTALS_LABEL = "GRID TOTALS"


def _metrics(consumption, solar, net, cost, readings):
    """The metric columns from sums; active_meters counts readings, not distinct meters."""
    return [
        F.round(consumption, 4).cast("double").alias("total_consumption_kwh"),
        F.round(solar, 4).cast("double").alias("total_solar_generation_kwh"),
        F.round(net, 4).cast("double").alias("net_load_kwh"),
        renewable_pct(solar, consumption).alias("renewable_contribution_pct"),
        F.round(cost, 4).cast("double").alias("total_cost_estimate"),
        readings.cast("long").alias("active_meters"),
    ]


def _raw_metrics():
    return _metrics(*[F.sum(c) for c in SUMS], F.count("meter_id"))


def zone_window_metrics(enriched, duration=WINDOW_DURATION, slide=None, event_time="event_timestamp"):
    """Metrics per event-time window and zone; without `slide` the windows are tumbling.

    On tables a sliding window is built from panes one slide long: the readings are
    aggregated once per pane and only the few pane rows are copied to the windows they
    belong to, where copying first would multiply the readings by duration / slide. On a
    stream Spark's own sliding window keeps the state.
    """
    slide = slide or duration
    if enriched.isStreaming or slide == duration or not _panes_fit(duration, slide):
        return enriched.groupBy(F.window(event_time, duration, slide), "grid_zone").agg(*_raw_metrics())
    panes = enriched.groupBy(F.window(event_time, slide).alias("pane"), "grid_zone").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.count("meter_id").alias("readings"))
    return panes.groupBy(F.window("pane.start", duration, slide), "grid_zone").agg(
        *_metrics(*[F.sum(c) for c in SUMS], F.sum("readings")))


def _panes_fit(duration, slide):
    """Whether a window is a whole number of slides; for calendar intervals it is not said."""
    lengths = [_microseconds(i) for i in (duration, slide)]
    return None not in lengths and lengths[0] % lengths[1] == 0


def _microseconds(interval):
    """The length of `n unit [n unit ...]`; None for units of varying length."""
    units = {"microsecond": 1, "millisecond": 1000, "second": 10 ** 6, "minute": 60 * 10 ** 6, "hour": 3600 * 10 ** 6,
             "day": 86400 * 10 ** 6, "week": 7 * 86400 * 10 ** 6}
    words = interval.lower().split()
    numbers, names = words[::2], [w.removesuffix("s") for w in words[1::2]]
    if len(numbers) != len(names) or not all(n.isdigit() for n in numbers) or not set(names) <= set(units):
        return None
    return sum(int(n) * units[u] for n, u in zip(numbers, names)) or None


def sliding_zone_metrics(enriched, duration=WINDOW_DURATION, slide=SLIDE_DURATION, **options):
    return zone_window_metrics(enriched, duration, slide, **options)


def flatten_window(windowed, batch_id=None):
    """window struct to window_start / window_end, stamped with the batch that made it."""
    flat = windowed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                           *[c for c in windowed.columns if c != "window"])
    return flat if batch_id is None else flat.withColumn("batch_id", F.lit(batch_id).cast("long"))


def zone_batch_metrics(enriched, batch_columns=(), zones=None):
    """Metrics per zone of each micro-batch. With `zones`, others are left out and silent
    ones get zeros (see `dense_zones`)."""
    if zones is not None:
        enriched = enriched.where(F.col("grid_zone").isin(*zones))
    metrics = enriched.groupBy(*batch_columns, "grid_zone").agg(*_raw_metrics())
    return metrics if zones is None else dense_zones(metrics, zones, batch_columns)


def dense_zones(metrics, zones=GRID_ZONES, batch_columns=()):
    """A row for every zone (of every batch present), zeros where it was silent.

    The metrics are read once: a batch's few zones become a map, in which every configured
    zone is looked up. Rows without a zone are no zone's.
    """
    batch_columns = list(batch_columns)
    rest = [c for c in metrics.columns if c not in (*batch_columns, "grid_zone")]
    entry = F.struct("grid_zone", F.struct(*rest))
    found = metrics.groupBy(*batch_columns).agg(F.map_from_entries(F.collect_list(
        F.when(F.col("grid_zone").isNotNull(), entry))).alias("_found"))
    spread = found.select(*batch_columns, "_found", F.explode(F.array(*[F.lit(z) for z in zones])).alias("grid_zone"))
    row = F.try_element_at("_found", F.col("grid_zone"))
    zero = {n: F.lit(0).cast(metrics.schema[n].dataType) if n in METRICS else F.lit(None) for n in rest}
    return spread.select(*batch_columns, "grid_zone", *[F.coalesce(row[n], zero[n]).alias(n) for n in rest])


def grid_totals(metrics, period_columns=("window_start", "window_end")):
    """Zone rows plus one total row per period; the totals' percentage comes from their sums."""
    period_columns = list(period_columns)
    zones = [*period_columns, "grid_zone"]
    consumption, solar = F.sum("consumption"), F.sum("solar")
    # Summing numbers rounded to four places as decimals keeps the totals exact.
    exact = metrics.select(
        *zones,
        F.col("total_consumption_kwh").cast("decimal(24,4)").alias("consumption"),
        F.col("total_solar_generation_kwh").cast("decimal(24,4)").alias("solar"),
        F.col("total_cost_estimate").cast("decimal(24,4)").alias("cost"),
        "active_meters",
    )
    return (
        exact.groupingSets([zones, period_columns], *zones)
        .agg(
            F.grouping("grid_zone").alias("_total"),
            consumption.cast("double").alias("total_consumption_kwh"),
            solar.cast("double").alias("total_solar_generation_kwh"),
            (consumption - solar).cast("double").alias("net_load_kwh"),
            renewable_pct(solar, consumption).alias("renewable_contribution_pct"),
            F.sum("cost").cast("double").alias("total_cost_estimate"),
            F.sum("active_meters").alias("active_meters"),
        )
        .withColumn("grid_zone", F.when(F.col("_total") == 1, TOTALS_LABEL).otherwise(F.col("grid_zone")))
        .drop("_total")
    )


def latest_per_zone(metrics):
    return latest_wins(metrics, ["grid_zone"], ["window_start"])


def volume_counters(readings, batch_column="batch_id"):
    """Readings and micro-batches so far."""
    per_batch = readings.groupBy(batch_column).agg(F.count(F.lit(1)).alias("n"))
    return per_batch.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
                         F.count(batch_column).alias("batch_count"))
