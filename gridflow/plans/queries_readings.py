"""Registered queries on readings: decode, check, enrich, derive."""

from pyspark.sql import functions as F

from .. import functions as X
from ..operators import decode, enrich, quality, zones
from ..schemas import TELEMETRY
from ..session import run_dir
from ..sources.bucketed import BucketedTables
from ..sources.telemetry import read_text_files
from . import inputs as I
from .oracle_parts import ENRICHED, READINGS, tariffs

ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
READING_COLUMNS = ["meter_id", "household_id", "power_consumption_kwh", "solar_generation_kwh", "grid_zone"]
FAULT = "event_id % 100"


def plain_time(name):
    return F.col(name).cast("timestamp_ntz").alias(name)


def as_double(*names):
    return [F.col(n).cast("double").alias(n) for n in names]


def src_telemetry_json(spark, sf):
    """Records written as lines and read back through the file source."""
    folder = run_dir(spark, "telemetry")
    I.records(spark, sf).select(F.col("value").cast("string").alias("value")).write.text(folder)
    good = decode.good_readings(decode.decode_telemetry(read_text_files(spark, folder, streaming=False)))
    return good.select(*READING_COLUMNS, plain_time("event_timestamp"))


def parse_json(spark, sf):
    return decode.parse_json(I.records(spark, sf)).drop("raw_value")


def parse_event_time(spark, sf):
    parsed = decode.with_event_time(decode.parse_json(I.records(spark, sf, damaged=True)))
    return parsed.select("household_id", "timestamp", plain_time("event_timestamp"))


def sink_encode_keyed_json(spark, sf):
    rows = I.readings(spark, sf).select(*READING_COLUMNS, F.date_format("event_timestamp", I.ISO).alias("timestamp"))
    return decode.encode_keyed_json(rows).select(F.col("key").cast("string").alias("key"), "value")


def try_numeric(spark, sf):
    events = I.table(spark, sf, "events")
    return events.select(
        "event_id",
        X.try_number(F.concat(F.lit("  "), F.col("value").cast("string"), F.lit(" "))).alias("padded"),
        X.try_number(F.col("event_type")).alias("word"),
        X.try_number(F.get_json_object("props", "$.k"), "int").alias("whole"),
    )


def format_keys(spark, sf):
    zone_part = F.upper(F.substring("event_type", 1, 6))
    return I.table(spark, sf, "events").select(
        "event_id",
        X.padded_key(F.lit("HH-"), F.col("user_id")).alias("household_id"),
        X.padded_key(F.concat(F.lit("MTR-"), zone_part, F.lit("-")), F.col("user_id")).alias("meter_id"),
        X.padded_key(F.lit("ORD-"), F.col("event_id")).alias("order_id"),
    )


def net_load(spark, sf):
    return I.readings(spark, sf).select("event_id", X.net_load().cast("double").alias("net_grid_load_kwh"))


def cost_estimate(spark, sf):
    return I.enriched(spark, sf).select("event_id", *as_double("estimated_cost"))


def load_direction(spark, sf):
    return I.readings(spark, sf).select(
        "event_id", X.load_direction(X.net_load()).alias("direction"), X.load_label(X.net_load()).alias("label"))


def round_metrics(spark, sf):
    value = F.col("power_consumption_kwh")
    return I.readings(spark, sf).select(
        "event_id",
        F.round(value * F.lit(0.12345).cast("decimal(6,5)"), 4).cast("double").alias("four"),
        F.round(value * F.lit(0.125).cast("decimal(4,3)"), 2).cast("double").alias("two"),
    )


def renewable_pct(spark, sf):
    return I.readings(spark, sf).groupBy("household_id").agg(X.renewable_pct(
        F.sum("solar_generation_kwh"), F.sum("power_consumption_kwh")).alias("renewable_contribution_pct"))


def pct_capped(spark, sf):
    return renewable_pct(spark, sf).select(
        "household_id", X.pct_capped(F.col("renewable_contribution_pct")).alias("progress"))


def known_zone_filter(spark, sf):
    known = enrich.known_zones(I.readings(spark, sf), [z for z in I.ZONES if z != "signup"])
    return known.select("event_id", "grid_zone", *as_double("power_consumption_kwh"))


def fill_tariff_defaults(spark, sf):
    rows = enrich.lookup_tariffs(I.readings(spark, sf), I.tariffs(spark, sf))
    return rows.select("event_id", *as_double("tariff_rate"), "billing_tier", "subsidy_flag")


def _enriched_columns(rows):
    return rows.select("event_id", "household_id", "grid_zone", plain_time("event_timestamp"),
                       *as_double("power_consumption_kwh", "solar_generation_kwh", "tariff_rate"),
                       "billing_tier", "subsidy_flag", *as_double("net_grid_load_kwh", "estimated_cost"))


def enrich_left_join(spark, sf):
    return _enriched_columns(I.enriched(spark, sf))


def enrich_large_dimension(spark, sf):
    """The plan for a dimension too large to broadcast: both sides shuffled, the readings read once."""
    return _enriched_columns(enrich.enrich(I.readings(spark, sf), I.tariffs(spark, sf), max_broadcast_bytes=0))


def enrich_bucketed(spark, sf):
    """Readings and tariffs stored in buckets of their household, and joined there without an exchange."""
    stored = BucketedTables(spark, run_dir(spark, "bucketed"), "household_id", buckets=8).store(
        I.readings(spark, sf), I.tariffs(spark, sf))
    found = _enriched_columns(enrich.with_cost(enrich.fill_tariff_defaults(stored.joined())))
    stored.forget()  # the files stay
    return found


def enrich_lookup_default(spark, sf):
    newest = enrich.one_row_per_household(I.tariffs_with_revisions(spark, sf), ["row_order"])
    return enrich.lookup_tariffs(I.readings(spark, sf), newest).select(
        "event_id", "household_id", *as_double("tariff_rate"), "billing_tier", "subsidy_flag")


def telemetry_quarantine(spark, sf):
    return decode.quarantined_readings(decode.decode_telemetry(I.records(spark, sf, damaged=True)))


def dq_telemetry_violations(spark, sf):
    decoded = decode.decode_telemetry(I.records(spark, sf, damaged=True), TELEMETRY)
    checked = quality.failing(quality.violations(decoded, quality.telemetry_rules(I.ZONES)))
    consumption = F.when(decode.finite("power_consumption_kwh"), F.col("power_consumption_kwh").cast("double"))
    return checked.select("household_id", plain_time("event_timestamp"), consumption.alias("power_consumption_kwh"),
                          F.array_join("violations", ",").alias("violations"))


def volume_counters(spark, sf):
    return zones.volume_counters(I.batches_by_day(spark, sf))


def queries():
    found = [src_telemetry_json, parse_json, parse_event_time, sink_encode_keyed_json, try_numeric, format_keys,
             net_load, cost_estimate, load_direction, round_metrics, renewable_pct, pct_capped, known_zone_filter,
             fill_tariff_defaults, enrich_left_join, enrich_large_dimension, enrich_bucketed, enrich_lookup_default,
             telemetry_quarantine, dq_telemetry_violations, volume_counters]
    return {f.__name__: f for f in found}


READING_SQL = """meter_id, household_id, CAST(cons AS DOUBLE) AS power_consumption_kwh,
  CAST(solar AS DOUBLE) AS solar_generation_kwh, grid_zone"""

ENRICHED_SQL = f"""WITH {ENRICHED} SELECT event_id, household_id, grid_zone, ts AS event_timestamp,
  CAST(cons AS DOUBLE) AS power_consumption_kwh, CAST(solar AS DOUBLE) AS solar_generation_kwh,
  CAST(rate AS DOUBLE) AS tariff_rate, tier AS billing_tier, flag AS subsidy_flag,
  CAST(net AS DOUBLE) AS net_grid_load_kwh, CAST(cost AS DOUBLE) AS estimated_cost FROM enriched"""

SHARE_SQL = """CASE WHEN sum(cons) > 0
  THEN round(CAST(sum(solar) AS DOUBLE) / CAST(sum(cons) AS DOUBLE) * 100.0, 2) ELSE 0.0 END"""


def oracles():
    return {
        "src_telemetry_json": f"WITH {READINGS} SELECT {READING_SQL}, ts AS event_timestamp FROM readings",
        "parse_json": f"WITH {READINGS} SELECT {READING_SQL}, {ISO_SQL} AS timestamp FROM readings",
        "parse_event_time": f"""WITH {READINGS} SELECT CASE WHEN {FAULT} <> 3 THEN household_id END AS household_id,
            CASE WHEN {FAULT} = 3 THEN NULL WHEN {FAULT} = 6 THEN 'not a time' ELSE {ISO_SQL} END AS timestamp,
            CASE WHEN {FAULT} NOT IN (3, 6) THEN ts END AS event_timestamp FROM readings""",
        "sink_encode_keyed_json": f"""WITH {READINGS} SELECT household_id AS key,
            '{{"meter_id":"' || meter_id || '","household_id":"' || household_id || '","power_consumption_kwh":' ||
            CAST(cons AS VARCHAR) || ',"solar_generation_kwh":' || CAST(solar AS VARCHAR) || ',"grid_zone":"' ||
            grid_zone || '","timestamp":"' || {ISO_SQL} || '"}}' AS value FROM readings""",
        "try_numeric": """SELECT event_id, value AS padded, TRY_CAST(event_type AS DOUBLE) AS word,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS whole
            FROM events""",
        "format_keys": """SELECT event_id, format('HH-{:04d}', user_id) AS household_id,
            'MTR-' || upper(substring(event_type, 1, 6)) || format('-{:04d}', user_id) AS meter_id,
            format('ORD-{:04d}', event_id) AS order_id FROM events""",
        "net_load": f"WITH {READINGS} SELECT event_id, CAST(cons - solar AS DOUBLE) AS net_grid_load_kwh FROM readings",
        "cost_estimate": f"WITH {ENRICHED} SELECT event_id, CAST(cost AS DOUBLE) AS estimated_cost FROM enriched",
        "load_direction": f"""WITH {READINGS} SELECT event_id, CASE WHEN cons >= solar THEN 'DRAW' ELSE 'FEED' END AS direction,
            CASE WHEN cons >= solar THEN '+' ELSE '' END || printf('%06.2f', CAST(cons - solar AS DOUBLE)) ||
            CASE WHEN cons >= solar THEN ' (DRAW)' ELSE ' (FEED)' END AS label FROM readings""",
        "round_metrics": f"""WITH {READINGS} SELECT event_id, CAST(round(cons * 0.12345, 4) AS DOUBLE) AS four,
            CAST(round(cons * 0.125, 2) AS DOUBLE) AS two FROM readings""",
        "renewable_pct": f"""WITH {READINGS} SELECT household_id, {SHARE_SQL} AS renewable_contribution_pct
            FROM readings GROUP BY household_id""",
        "pct_capped": f"""WITH {READINGS} SELECT household_id, least(100.0::DOUBLE, {SHARE_SQL}) AS progress
            FROM readings GROUP BY household_id""",
        "known_zone_filter": f"""WITH {READINGS} SELECT event_id, grid_zone, CAST(cons AS DOUBLE) AS power_consumption_kwh
            FROM readings WHERE grid_zone IN ('click', 'error', 'purchase', 'view')""",
        "fill_tariff_defaults": f"""WITH {ENRICHED} SELECT event_id, CAST(rate AS DOUBLE) AS tariff_rate,
            tier AS billing_tier, flag AS subsidy_flag FROM enriched""",
        "enrich_left_join": ENRICHED_SQL,
        "enrich_large_dimension": ENRICHED_SQL,
        "enrich_bucketed": ENRICHED_SQL,
        "enrich_lookup_default": f"""WITH {READINGS}, {tariffs('newest', 1)} SELECT event_id, household_id,
            CAST(coalesce(rate, 0.15) AS DOUBLE) AS tariff_rate, coalesce(tier, 'Standard') AS billing_tier,
            coalesce(flag, 0) AS subsidy_flag FROM readings LEFT JOIN newest USING (household_id)""",
        "telemetry_quarantine": f"""WITH {READINGS} SELECT
            CASE WHEN {FAULT} = 3 THEN 'broken ' || CAST(event_id AS VARCHAR) ELSE
              '{{"meter_id":"' || meter_id || '","household_id":"' || household_id || '","power_consumption_kwh":' ||
              CASE {FAULT} WHEN 7 THEN '"NaN"' WHEN 8 THEN '"Infinity"' ELSE CAST(CAST(cons AS DOUBLE) AS VARCHAR) END ||
              ',"solar_generation_kwh":' || CAST(CAST(solar AS DOUBLE) AS VARCHAR) ||
              CASE WHEN {FAULT} = 4 THEN '' ELSE ',"grid_zone":"' || grid_zone || '"' END ||
              ',"timestamp":"' || CASE WHEN {FAULT} = 6 THEN 'not a time' ELSE {ISO_SQL} END || '"}}' END AS raw_value,
            CASE {FAULT} WHEN 3 THEN 'not a JSON reading' WHEN 4 THEN 'missing grid_zone' WHEN 6 THEN 'unreadable timestamp'
              ELSE 'non-finite power_consumption_kwh' END AS error_reason
            FROM readings WHERE {FAULT} IN (3, 4, 6, 7, 8)""",
        "dq_telemetry_violations": f"""WITH {READINGS}, decoded AS (
            SELECT CASE WHEN {FAULT} <> 3 THEN household_id END AS household_id,
              CASE WHEN {FAULT} NOT IN (3, 6) THEN ts END AS event_timestamp,
              CASE WHEN {FAULT} = 5 THEN -cons WHEN {FAULT} NOT IN (3, 7, 8) THEN cons END AS cons,
              CASE WHEN {FAULT} <> 3 THEN solar END AS solar,
              CASE WHEN {FAULT} NOT IN (3, 4) THEN grid_zone END AS grid_zone FROM readings),
            judged AS (SELECT household_id, event_timestamp, CAST(cons AS DOUBLE) AS power_consumption_kwh, concat_ws(',',
              CASE WHEN household_id IS NULL THEN 'household_id,meter_id' END,
              CASE WHEN event_timestamp IS NULL THEN 'event_timestamp' END,
              CASE WHEN cons IS NULL OR cons <= 0 THEN 'power_consumption_kwh' END,
              CASE WHEN solar IS NULL OR solar < 0 THEN 'solar_generation_kwh' END,
              CASE WHEN grid_zone IS NULL THEN 'grid_zone' END) AS violations FROM decoded)
            SELECT * FROM judged WHERE violations <> ''""",
        "volume_counters": """SELECT count(*) AS total_events, count(DISTINCT CAST(ts AS DATE)) AS batch_count FROM events""",
    }
