"""Registered queries on zone metrics and on the health of the table that holds them."""

from pyspark.sql import functions as F

from ..operators import decode, health, zones
from ..operators.upsert import latest_wins
from ..schemas import TELEMETRY_EXACT
from . import inputs as I
from .jobs import backfill_zone_metrics
from .oracle_parts import ENRICHED, METRIC_NAMES, METRIC_SUMS, METRICS, READINGS
from .queries_readings import as_double, plain_time

NOW = "2024-01-31 00:00:00"
SNAPSHOT_ZONES = (*I.ZONES, "Zone-Silent")


def _plain(flat):
    return flat.select(plain_time("window_start"), plain_time("window_end"),
                       *[c for c in flat.columns if c not in ("window_start", "window_end")])


def metrics(spark, sf):
    return zones.flatten_window(zones.sliding_zone_metrics(I.enriched(spark, sf), I.WINDOW, I.SLIDE))


def served(spark, sf):
    """The metrics as a serving table, last updated when their window ended."""
    return metrics(spark, sf).withColumn("updated_at", F.col("window_end"))


def zone_window_metrics(spark, sf):
    return _plain(metrics(spark, sf))


def sink_flatten_window(spark, sf):
    windowed = zones.sliding_zone_metrics(I.enriched(spark, sf), I.WINDOW, I.SLIDE)
    return _plain(zones.flatten_window(windowed, batch_id=7)).select(
        "window_start", "window_end", "grid_zone", "active_meters", "batch_id")


def zone_tumbling_metrics(spark, sf):
    return _plain(zones.flatten_window(zones.zone_window_metrics(I.enriched(spark, sf), I.WINDOW)))


def _with_batch(spark, sf):
    return I.enriched(spark, sf).withColumn("batch_id", F.unix_date("batch_id").cast("long"))


def zone_batch_metrics(spark, sf):
    return zones.zone_batch_metrics(_with_batch(spark, sf), ["batch_id"], I.ZONES)


def zone_snapshot_dense(spark, sf):
    return zones.zone_batch_metrics(I.enriched(spark, sf), zones=SNAPSHOT_ZONES)


def grid_totals(spark, sf):
    return _plain(zones.grid_totals(metrics(spark, sf)))


def latest_per_zone(spark, sf):
    return _plain(zones.latest_per_zone(metrics(spark, sf)))


def sink_recency(spark, sf):
    return health.recency(served(spark, sf)).select(
        plain_time("latest_window_end"), plain_time("latest_update"), "total_rows")


def freshness_status(spark, sf):
    return health.freshness(served(spark, sf), NOW).select(
        "component", "status", plain_time("latest_update"), "total_rows", "lag_seconds")


def health_details_json(spark, sf):
    return health.freshness(served(spark, sf), NOW).select("status", "details")


def sink_upsert_latest(spark, sf):
    changes = I.readings(spark, sf).select(
        "meter_id", "grid_zone", "event_timestamp", "event_id", "power_consumption_kwh")
    newest = latest_wins(changes, ["meter_id", "grid_zone"], ["event_timestamp", "event_id"])
    return newest.select("meter_id", "grid_zone", plain_time("event_timestamp"), "event_id",
                         *as_double("power_consumption_kwh"))


def backfill_batch(spark, sf):
    """History through the path of the stream: records, decoding, exact sums."""
    readings = decode.good_readings(decode.decode_telemetry(I.records(spark, sf), TELEMETRY_EXACT))
    return _plain(zones.flatten_window(
        backfill_zone_metrics(readings, I.tariffs(spark, sf), I.WINDOW, I.SLIDE)))


def queries():
    found = [zone_window_metrics, sink_flatten_window, zone_tumbling_metrics, zone_batch_metrics, zone_snapshot_dense,
             grid_totals, latest_per_zone, sink_recency, freshness_status, health_details_json, sink_upsert_latest,
             backfill_batch]
    return {f.__name__: f for f in found}


RECENCY = METRICS + """, recency AS (
  SELECT max(window_end) AS latest, count(*) AS n FROM metrics),
lag AS (SELECT *, CAST(date_diff('microsecond', latest, TIMESTAMP '2024-01-31 00:00:00') AS DOUBLE) / 1e6 AS lag_seconds
        FROM recency)"""
STATUS_SQL = "CASE WHEN latest IS NULL THEN 'INITIALIZING' WHEN lag_seconds > 300 THEN 'DEGRADED' ELSE 'HEALTHY' END"


def oracles():
    windows = f"WITH {METRICS} SELECT {METRIC_NAMES} FROM metrics"
    zone_values = ", ".join(f"('{z}')" for z in SNAPSHOT_ZONES)
    known = ", ".join(f"('{z}')" for z in I.ZONES)
    filled = ",\n".join(f"coalesce({n}, 0) AS {n}" for n in zones.METRICS)
    return {
        "zone_window_metrics": windows,
        "backfill_batch": windows,
        "sink_flatten_window": f"""WITH {METRICS} SELECT window_start, window_end, grid_zone, active_meters,
            CAST(7 AS BIGINT) AS batch_id FROM metrics""",
        "zone_tumbling_metrics": f"""WITH {ENRICHED} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
            time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, grid_zone, {METRIC_SUMS}
            FROM enriched GROUP BY 1, 2, 3""",
        "zone_batch_metrics": f"""WITH {ENRICHED}, m AS (
            SELECT batch_id, grid_zone, {METRIC_SUMS} FROM enriched GROUP BY 1, 2),
            frame AS (SELECT b.batch_id, z.grid_zone FROM (SELECT DISTINCT batch_id FROM enriched) b,
                      (VALUES {known}) AS z(grid_zone))
            SELECT batch_id, grid_zone, {filled} FROM frame LEFT JOIN m USING (batch_id, grid_zone)""",
        "zone_snapshot_dense": f"""WITH {ENRICHED}, m AS (SELECT grid_zone, {METRIC_SUMS} FROM enriched GROUP BY 1)
            SELECT grid_zone, {filled} FROM (VALUES {zone_values}) AS z(grid_zone) LEFT JOIN m USING (grid_zone)""",
        "grid_totals": f"""WITH {METRICS}, exact AS (
            SELECT window_start, window_end, grid_zone, CAST(total_consumption_kwh AS DECIMAL(24,4)) AS c,
              CAST(total_solar_generation_kwh AS DECIMAL(24,4)) AS s, CAST(total_cost_estimate AS DECIMAL(24,4)) AS k,
              active_meters AS n FROM metrics),
            rows_and_totals AS (SELECT * FROM exact UNION ALL
              SELECT window_start, window_end, 'GRID TOTALS', sum(c), sum(s), sum(k), sum(n) FROM exact GROUP BY 1, 2)
            SELECT window_start, window_end, grid_zone, CAST(c AS DOUBLE) AS total_consumption_kwh,
              CAST(s AS DOUBLE) AS total_solar_generation_kwh, CAST(c - s AS DOUBLE) AS net_load_kwh,
              CASE WHEN c > 0 THEN round(CAST(s AS DOUBLE) / CAST(c AS DOUBLE) * 100.0, 2) ELSE 0.0 END
                AS renewable_contribution_pct,
              CAST(k AS DOUBLE) AS total_cost_estimate, CAST(n AS BIGINT) AS active_meters FROM rows_and_totals""",
        "latest_per_zone": f"""WITH {METRICS} SELECT {METRIC_NAMES} FROM metrics
            QUALIFY row_number() OVER (PARTITION BY grid_zone ORDER BY window_start DESC) = 1""",
        "sink_recency": f"""WITH {RECENCY} SELECT latest AS latest_window_end, latest AS latest_update,
            n AS total_rows FROM recency""",
        "freshness_status": f"""WITH {RECENCY} SELECT 'PYSPARK_STREAM_SINK' AS component, {STATUS_SQL} AS status,
            latest AS latest_update, n AS total_rows, lag_seconds FROM lag""",
        "health_details_json": f"""WITH {RECENCY} SELECT {STATUS_SQL} AS status,
            '{{"total_metrics_records":' || CAST(n AS VARCHAR) || ',"latest_window_end":"' ||
            strftime(latest, '%Y-%m-%d %H:%M:%S') || '","latest_update":"' || strftime(latest, '%Y-%m-%d %H:%M:%S') ||
            '","lag_seconds":' || CAST(lag_seconds AS VARCHAR) || '}}' AS details FROM lag""",
        "sink_upsert_latest": f"""WITH {READINGS} SELECT meter_id, grid_zone, ts AS event_timestamp, event_id,
            CAST(cons AS DOUBLE) AS power_consumption_kwh FROM readings
            QUALIFY row_number() OVER (PARTITION BY meter_id, grid_zone ORDER BY ts DESC, event_id DESC) = 1""",
    }
