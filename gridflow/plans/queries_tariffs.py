"""Registered queries on tariff drops: read, gate, publish, summarise."""

from pyspark.sql import functions as F

from ..operators import enrich, quality, tariffs
from ..operators.zones import METRICS as METRIC_COLUMNS
from ..operators.zones import flatten_window
from ..schemas import HEALTH_LOG, TARIFF_EXACT
from ..session import run_dir
from ..sinks.tariffs import gated_publish, publish_drop, stage_drop
from ..sources.tariffs import CurrentTariffs, read_drop, read_history
from . import inputs as I
from .jobs import backfill_as_of as run_backfill
from .jobs import run_daily_tariffs
from .oracle_parts import METRIC_NAMES, METRICS, READINGS
from .queries_readings import as_double, plain_time
from .queries_zones import NOW, served

#: Labels and times of drops whose tariffs change.
CHANGING = {"20240105_000000": "2024-01-05 00:00:00", "20240110_063000": "2024-01-10 06:30:00",
            "20240115_120000": "2024-01-15 12:00:00", "20240120_180000": "2024-01-20 18:00:00",
            "20240125_000000": "2024-01-25 00:00:00"}
LABELS = ("20240101_000000", "20240102_000000", "20240103_000000")


def _published(spark, sf, drops=len(LABELS)):
    """A fresh folder with the first `drops` daily drops, each with its own rates."""
    root = run_dir(spark, "drops")
    for day, label in enumerate(LABELS[:drops]):
        publish_drop(spark, stage_drop(I.tariffs(spark, sf, revision=day), root), root, label)
    return root


def _columns(rows, *more):
    return rows.select("household_id", *as_double("tariff_rate"), "billing_tier", "subsidy_flag", *more)


def _history(spark, sf):
    return read_history(spark, _published(spark, sf), TARIFF_EXACT)


def changing_history(spark, sf):
    """The archive of drops whose tariffs change, read back."""
    root = run_dir(spark, "drops")
    for day, label in enumerate(CHANGING):
        publish_drop(spark, stage_drop(I.tariff_drop(spark, sf, day), root), root, label)
    return read_history(spark, root, TARIFF_EXACT)


def src_tariffs_csv(spark, sf):
    return _columns(read_drop(spark, f"{_published(spark, sf, 1)}/drop={LABELS[0]}"))


def src_tariffs_refresh(spark, sf):
    """A dimension opened on the first drop and read again after the second one."""
    root = _published(spark, sf, 1)
    current = CurrentTariffs(spark, root)
    current.refresh()
    publish_drop(spark, stage_drop(I.tariffs(spark, sf, revision=1), root), root, LABELS[1])
    return _columns(current.frame())


def src_tariffs_duplicates(spark, sf):
    """A drop with two rows for every household: the later one counts, the others are reported."""
    root = run_dir(spark, "drops")
    twice = I.tariffs_with_revisions(spark, sf).drop("row_order")
    publish_drop(spark, stage_drop(twice, root), root, LABELS[0])
    current = CurrentTariffs(spark, root)
    frame = current.frame()
    return _columns(frame, F.lit(current.duplicates).cast("long").alias("duplicates"))


def src_tariffs_refused(spark, sf):
    """The newest drop has rates that are no numbers, so the one before it stays in force."""
    root = _published(spark, sf, 1)
    bad = I.tariffs(spark, sf, revision=1)
    rate = F.when(F.col("subsidy_flag") == 1, "abc").otherwise(F.col("tariff_rate").cast("string"))
    publish_drop(spark, stage_drop(bad.withColumn("tariff_rate", rate), root), root, LABELS[1])
    return _columns(CurrentTariffs(spark, root).frame())


def src_tariff_history(spark, sf):
    day = F.col("simulated_day_date").cast("string").alias("simulated_day_date")
    return _columns(_history(spark, sf), day, plain_time("effective_timestamp"))


def sink_tariff_publish(spark, sf):
    path, report = gated_publish(I.tariffs(spark, sf), run_dir(spark, "drops"), LABELS[0])
    return _columns(read_drop(spark, path), F.lit(report["record_count"]).cast("long").alias("checked"))


def _report(spark, sf, damaged):
    report = quality.gate_report(I.tariff_text(spark, sf, damaged))
    return report.select("status", "record_count", F.coalesce("first_bad_row", F.lit(0)).alias("first_bad_row"),
                         F.coalesce("message", F.lit("")).alias("message"))


def dq_tariff_gate(spark, sf):
    return _report(spark, sf, damaged=False)


def dq_tariff_gate_refuses(spark, sf):
    return _report(spark, sf, damaged=True)


def dq_tariff_violations(spark, sf):
    rows = quality.violations(I.tariff_text(spark, sf, damaged=True), quality.tariff_rules())
    return quality.failing(rows).select("household_id", "tariff_rate", "subsidy_flag",
                                        F.array_join("violations", ",").alias("violations"))


def tariff_drop_stats(spark, sf):
    return tariffs.drop_statistics(I.tariffs(spark, sf))


def tariff_history_stats(spark, sf):
    rows = tariffs.history_statistics(_history(spark, sf))
    return rows.select(plain_time("effective_timestamp"), "billing_tier", "records_count", "avg_tariff",
                       "subsidized_ratio")


def latest_tariff_per_household(spark, sf):
    return _columns(tariffs.latest_tariffs(_history(spark, sf)), plain_time("effective_timestamp"))


def latest_tariff_of_two(spark, sf):
    """The newest row of each household in drops that name some twice."""
    return _columns(tariffs.latest_tariffs(changing_history(spark, sf)), plain_time("effective_timestamp"))


def tariff_intervals(spark, sf):
    return _columns(tariffs.tariff_intervals(changing_history(spark, sf)), plain_time("valid_from"), plain_time("valid_to"), "drops")


def enrich_as_of(spark, sf):
    """All readings at the tariff in force at their time; a busy household's time is cut into slots."""
    found = enrich.enrich_as_of(I.readings(spark, sf), tariffs.tariff_intervals(changing_history(spark, sf)))
    return found.select("event_id", "household_id", *as_double("tariff_rate", "estimated_cost"), "billing_tier", "subsidy_flag")


def backfill_as_of(spark, sf):
    """Zone metrics of all readings at the prices of their time."""
    found = run_backfill(I.readings(spark, sf), changing_history(spark, sf), I.WINDOW, I.SLIDE)
    return flatten_window(found).select(
        plain_time("window_start"), plain_time("window_end"), "grid_zone", *METRIC_COLUMNS)


def tariff_job(spark, sf):
    """Gate, publish, statistics, freshness and heartbeat; shows the health log."""
    root = run_dir(spark, "tariff-job")
    result = run_daily_tariffs(I.tariffs(spark, sf), f"{root}/drops", LABELS[0], lambda: served(spark, sf),
                               f"{root}/health", NOW)
    heartbeat = spark.read.schema(HEALTH_LOG).parquet(f"{root}/health")
    return heartbeat.select(
        "component", "status", *as_double("latency_ms"), plain_time("checked_at"),
        F.lit(result["records_count"]).cast("long").alias("records_count"),
        F.lit(result["status"]).alias("gate_status"))


def queries():
    found = [src_tariffs_csv, src_tariffs_refresh, src_tariffs_duplicates, src_tariffs_refused, src_tariff_history, sink_tariff_publish, dq_tariff_gate,
             dq_tariff_gate_refuses, dq_tariff_violations, tariff_drop_stats, tariff_history_stats,
             latest_tariff_per_household, latest_tariff_of_two, tariff_intervals, enrich_as_of, backfill_as_of, tariff_job]
    return {f.__name__: f for f in found}


def _tariff_sql(revision):
    return f"""SELECT CASE WHEN c_acctbal < 0 THEN 'CLOSED-' ELSE 'HH-' END || format('{{:04d}}', c_custkey) AS household_id,
      CAST(CAST(0.120004 + 0.01 * (c_nationkey + {revision}) AS DECIMAL(10,6)) AS DOUBLE) AS tariff_rate,
      c_mktsegment AS billing_tier, CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS subsidy_flag"""


# A mean to four places, ties up, from whole millionths.
MEAN_RATE = "CAST((sum(CAST(tariff_rate * 1000000 AS HUGEINT)) * 2 + count(*) * 100) // (count(*) * 200) AS DOUBLE) / 10000.0"
STATISTICS = f"""count(*) AS records_count, {MEAN_RATE} AS avg_tariff,
  round(sum(subsidy_flag) / count(*), 4) AS subsidized_ratio"""
HISTORY = "history AS (" + " UNION ALL ".join(
    f"{_tariff_sql(day)}, DATE '2024-01-0{day + 1}' AS simulated_day_date, "
    f"TIMESTAMP '2024-01-0{day + 1} 00:00:00' AS effective_timestamp FROM customer" for day in range(3)) + ")"

TARIFF_TEXT = """text AS (SELECT c_custkey, format('HH-{:04d}', c_custkey) AS household_id,
  CAST(CAST((0.12 + 0.01 * c_nationkey) * CASE WHEN c_custkey % 50 = 1 THEN 10 ELSE 1 END AS DECIMAL(8,4)) AS VARCHAR)
    AS tariff_rate,
  CASE WHEN c_custkey % 50 = 2 THEN '2' WHEN c_custkey % 3 = 0 THEN '1' ELSE '0' END AS subsidy_flag
  FROM customer),
judged AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS n,
  CAST(tariff_rate AS DOUBLE) NOT BETWEEN 0.05 AND 1.50 AS bad_rate, subsidy_flag NOT IN ('0', '1') AS bad_flag FROM text)"""


CHANGES = "drops (day, since, next_since) AS (VALUES " + ", ".join(
    f"({day}, TIMESTAMP '{at}', {f'TIMESTAMP {chr(39)}{[*CHANGING.values()][day + 1]}{chr(39)}' if day < 4 else 'NULL::TIMESTAMP'})"
    for day, at in enumerate(CHANGING.values())) + """),
listed AS (SELECT format('HH-{:04d}', c_custkey) AS household_id,
    CAST(0.120004 + 0.01 * (c_nationkey + (day + c_custkey % 3) // 3) AS DECIMAL(10,6)) AS rate, c_mktsegment AS tier,
    CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS flag, since, next_since
  FROM customer, drops WHERE c_custkey % 7 <> 3 OR day <> 2)"""
AS_OF = f"""WITH {READINGS}, {CHANGES}, tariffs AS (SELECT * FROM listed),
enriched AS (
  SELECT r.*, coalesce(t.rate, 0.15) AS rate, coalesce(t.tier, 'Standard') AS tier, coalesce(t.flag, 0) AS flag,
         r.cons - r.solar AS net,
         CAST(r.cons * coalesce(t.rate, 0.15) AS DECIMAL(30,8)) * CAST(1 - coalesce(t.flag, 0) * 0.15 AS DECIMAL(4,2)) AS cost
  FROM readings r LEFT JOIN tariffs t ON t.household_id = r.household_id AND r.ts >= t.since AND r.ts < coalesce(t.next_since, TIMESTAMP '2100-01-01'))"""


def oracles():
    return {
        "src_tariffs_csv": f"{_tariff_sql(0)} FROM customer",
        "src_tariffs_refresh": f"{_tariff_sql(1)} FROM customer",
        "src_tariffs_duplicates": f"{_tariff_sql(1)}, (SELECT count(*) FROM customer) AS duplicates FROM customer",
        "src_tariffs_refused": f"{_tariff_sql(0)} FROM customer",
        "src_tariff_history": f"""WITH {HISTORY} SELECT * REPLACE (CAST(simulated_day_date AS VARCHAR) AS simulated_day_date)
            FROM history""",
        "sink_tariff_publish": f"{_tariff_sql(0)}, (SELECT count(*) FROM customer) AS checked FROM customer",
        "dq_tariff_gate": """SELECT 'PASSED' AS status, count(*) AS record_count, CAST(0 AS BIGINT) AS first_bad_row,
            '' AS message FROM customer
            WHERE 0.12 + 0.01 * c_nationkey BETWEEN 0.05 AND 1.50""",
        "dq_tariff_gate_refuses": f"""WITH {TARIFF_TEXT}, first AS (
            SELECT * FROM judged WHERE bad_rate OR bad_flag ORDER BY n LIMIT 1)
            SELECT 'FAILED' AS status, (SELECT count(*) FROM judged WHERE NOT bad_rate AND NOT bad_flag) AS record_count,
              n AS first_bad_row, 'DQ Failure at row ' || CAST(n AS VARCHAR) || ': ' || CASE WHEN bad_rate
                THEN 'Tariff rate ' || CAST(CAST(tariff_rate AS DOUBLE) AS VARCHAR) || ' out of valid bounds [0.05, 1.50]'
                ELSE 'Invalid subsidy flag ' || subsidy_flag END AS message FROM first""",
        "dq_tariff_violations": f"""WITH {TARIFF_TEXT} SELECT household_id, tariff_rate, subsidy_flag,
            concat_ws(',', CASE WHEN bad_rate THEN 'tariff_rate' END, CASE WHEN bad_flag THEN 'subsidy_flag' END)
              AS violations FROM judged WHERE bad_rate OR bad_flag""",
        "tariff_drop_stats": f"SELECT {STATISTICS} FROM ({_tariff_sql(0)} FROM customer)",
        "tariff_history_stats": f"""WITH {HISTORY} SELECT effective_timestamp, billing_tier, {STATISTICS}
            FROM history GROUP BY 1, 2""",
        "latest_tariff_per_household": f"""WITH {HISTORY} SELECT * EXCLUDE (simulated_day_date) FROM history
            QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY effective_timestamp DESC) = 1""",
        "latest_tariff_of_two": f"""WITH {CHANGES} SELECT household_id, CAST(rate AS DOUBLE) AS tariff_rate, tier AS billing_tier,
              CAST(flag AS INTEGER) AS subsidy_flag, since AS effective_timestamp FROM listed WHERE next_since IS NULL""",
        "tariff_intervals": f"""WITH {CHANGES}, marked AS (
            SELECT *, CASE WHEN lag(next_since) OVER w = since AND lag(rate) OVER w = rate THEN 0 ELSE 1 END AS begins
            FROM listed WINDOW w AS (PARTITION BY household_id ORDER BY since)),
            islands AS (SELECT *, sum(begins) OVER (PARTITION BY household_id ORDER BY since) AS island FROM marked)
            SELECT household_id, CAST(any_value(rate) AS DOUBLE) AS tariff_rate, any_value(tier) AS billing_tier,
              CAST(any_value(flag) AS INTEGER) AS subsidy_flag, min(since) AS valid_from,
              CASE WHEN count(*) = count(next_since) THEN max(next_since) END AS valid_to, count(*) AS drops
            FROM islands GROUP BY household_id, island""",
        "enrich_as_of": f"""{AS_OF} SELECT event_id, household_id, CAST(rate AS DOUBLE) AS tariff_rate,
            CAST(cost AS DOUBLE) AS estimated_cost, tier AS billing_tier, CAST(flag AS INTEGER) AS subsidy_flag FROM enriched""",
        "backfill_as_of": AS_OF + METRICS[METRICS.index(", windowed AS"):] + f" SELECT {METRIC_NAMES} FROM metrics",
        "tariff_job": f"""WITH {METRICS} SELECT 'PYSPARK_STREAM_SINK' AS component,
            CASE WHEN max(window_end) IS NULL THEN 'INITIALIZING' WHEN date_diff('microsecond', max(window_end),
              TIMESTAMP '2024-01-31 00:00:00') > 300000000 THEN 'DEGRADED' ELSE 'HEALTHY' END AS status,
            0.0::DOUBLE AS latency_ms, TIMESTAMP '2024-01-31 00:00:00' AS checked_at,
            (SELECT count(*) FROM customer) AS records_count, 'PASSED' AS gate_status FROM metrics""",
    }
