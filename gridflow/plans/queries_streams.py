"""Registered queries that run a stream over a whole table and show what it wrote."""

from pyspark.sql import functions as F

from ..operators import health, orders, zones
from ..operators.enrich import enrich
from ..schemas import TARIFF_EXACT, TELEMETRY_EXACT, ZONE_METRICS
from ..session import run_dir
from ..sinks.change_log import ChangeLog
from ..sinks.files import append_rows, write_once
from ..sinks.guards import FanOut, skip_empty, with_retry
from ..sinks.tariffs import publish_drop, stage_drop
from ..sources.tariffs import CurrentTariffs, FixedTariffs
from ..sources.telemetry import first_deliveries, read_text_files
from ..streaming.keyed import (
    OutcomeTable,
    TotalsTable,
    history_totals,
    parked_retries,
    product_totals,
    start_parked,
    start_totals,
)
from ..streaming.late import LateRows
from ..streaming.orders import OrderOutcomes, start_orders
from ..streaming.recent import RecentRows, start_recent
from ..streaming.zones import enriched_readings, start_enrichment, start_metrics, zone_metrics_stream
from . import inputs as I
from .jobs import run_zone_metrics
from .oracle_parts import (
    LETTERS,
    METRIC_NAMES,
    METRICS,
    READINGS,
    RESOLVED,
    RUNNING,
    half_up_average,
    price_double,
    tariffs,
)
from .queries_readings import FAULT, as_double, oracles as reading_oracles, plain_time
from .queries_tariffs import LABELS, _published
from .queries_zones import NOW, RECENCY, STATUS_SQL, metrics, served

# The tables are not in time order, so the streams wait long enough for nothing to be late.
PATIENCE = "60 days"
CLOSING = "1 day"


def table_stream(spark, sf, name):
    """A table as a stream; the pattern lets it be one file or a folder of files."""
    path = f"{sf}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def _records(spark, sf, damaged=False):
    return I.as_records(table_stream(spark, sf, "events"), damaged)


def _finish(*queries):
    for query in queries:
        query.awaitTermination()


def _plain(rows):
    return rows.select(plain_time("window_start"), plain_time("window_end"), "grid_zone", *zones.METRICS)


def _metrics_stream(spark, sf, watermark):
    return zone_metrics_stream(_records(spark, sf), I.tariffs(spark, sf), watermark, I.WINDOW, I.SLIDE, TELEMETRY_EXACT)


def stream_zone_metrics(spark, sf):
    """Update mode into the change log, read latest-wins."""
    root = run_dir(spark, "stream")
    table = ChangeLog(spark, f"{root}/metrics", ZONE_METRICS)
    _finish(start_metrics(_metrics_stream(spark, sf, PATIENCE), table.writer("r1"), f"{root}/checkpoint", "available"))
    return _plain(table.latest())


def stream_watermark(spark, sf):
    """Append mode: a window is written once, when the watermark has passed its end."""
    root = run_dir(spark, "stream")

    def write_batch(batch_df, batch_id):
        write_once(zones.flatten_window(batch_df), f"{root}/closed", f"batch={batch_id}")

    _finish(start_metrics(_metrics_stream(spark, sf, CLOSING), write_batch, f"{root}/checkpoint", "available", "append"))
    return _plain(spark.read.parquet(f"{root}/closed"))


def _metrics_job(spark, sf):
    root = run_dir(spark, "metrics-job")
    table, queries = run_zone_metrics(
        spark, _records(spark, sf, damaged=True), I.tariffs(spark, sf), root, f"{root}/checkpoint", "r1",
        PATIENCE, I.WINDOW, I.SLIDE, "available", TELEMETRY_EXACT)
    _finish(*queries)
    return root, table


def zone_metrics_job(spark, sf):
    """The whole job on records with faults: the metrics of the good ones."""
    return _plain(_metrics_job(spark, sf)[1].latest())


def stream_quarantine(spark, sf):
    """The same job's quarantine."""
    return spark.read.parquet(f"{_metrics_job(spark, sf)[0]}/quarantine").select("raw_value", "error_reason")


def stream_enrichment(spark, sf):
    """Readings enriched batch by batch with the tariff drop then in force."""
    root = run_dir(spark, "enrichment")
    current = CurrentTariffs(spark, _published(spark, sf, 2), TARIFF_EXACT)
    raw = _records(spark, sf)
    _finish(start_enrichment(raw, current, root, f"{root}/checkpoint", "available", TELEMETRY_EXACT))
    stored = enriched_readings(spark, root, spark.read.parquet(f"{root}/readings").schema, streaming=False)
    return stored.select("household_id", "grid_zone", plain_time("event_timestamp"),
                         *as_double("tariff_rate", "net_grid_load_kwh", "estimated_cost"))


def _arrivals(spark, sf, folder, part, parts=2, damaged=False):
    """Some of the records, by their id, as text files that a stream finds in `folder`."""
    events = I.table(spark, sf, "events").where(F.pmod("event_id", F.lit(parts)) == part)
    lines = I.as_records(events, damaged).select(F.col("value").cast("string").alias("value"))
    lines.write.mode("append").text(folder)


def stream_tariff_refresh(spark, sf):
    """The metrics job run twice; a new drop is published between the records' two halves."""
    root, drops = run_dir(spark, "refresh"), _published(spark, sf, 1)
    for run in range(2):
        _arrivals(spark, sf, f"{root}/in", run)
        if run:
            publish_drop(spark, stage_drop(I.tariffs(spark, sf, revision=1), drops), drops, LABELS[1])
        table, queries = run_zone_metrics(
            spark, read_text_files(spark, f"{root}/in"), CurrentTariffs(spark, drops, TARIFF_EXACT), root,
            f"{root}/checkpoint", "r1", PATIENCE, I.WINDOW, I.SLIDE, "available", TELEMETRY_EXACT)
        _finish(*queries)
    return _plain(table.latest())


def stream_restart(spark, sf):
    """A stream stopped after half of the records and started again on its checkpoint."""
    root = run_dir(spark, "restart")
    table = ChangeLog(spark, f"{root}/metrics", ZONE_METRICS)
    for part in range(2):
        _arrivals(spark, sf, f"{root}/in", part)
        metrics = zone_metrics_stream(read_text_files(spark, f"{root}/in"), I.tariffs(spark, sf), PATIENCE, I.WINDOW,
                                      I.SLIDE, TELEMETRY_EXACT)
        _finish(start_metrics(metrics, table.writer("r1"), f"{root}/checkpoint", "available"))
    return _plain(table.latest())


def stream_late_data(spark, sf):
    """All records sent twice: the second time, those of windows behind the watermark are left out."""
    root = run_dir(spark, "late")
    table = ChangeLog(spark, f"{root}/metrics", ZONE_METRICS)
    for _ in range(2):
        _arrivals(spark, sf, f"{root}/in", 0, parts=1)
        metrics = zone_metrics_stream(read_text_files(spark, f"{root}/in"), I.tariffs(spark, sf), CLOSING, I.WINDOW,
                                      I.SLIDE, TELEMETRY_EXACT)
        _finish(start_metrics(metrics, table.writer("r1"), f"{root}/checkpoint", "available"))
    return _plain(table.latest())


def stream_resent_records(spark, sf):
    """The metrics job where a producer sends half of the records twice in one go, and all of them once more after a restart."""
    root = run_dir(spark, "resent")
    for part in range(2):
        _arrivals(spark, sf, f"{root}/in", 0, parts=1)
        if not part:
            _arrivals(spark, sf, f"{root}/in", 1)
        raw = first_deliveries(read_text_files(spark, f"{root}/in"))
        table, queries = run_zone_metrics(spark, raw, I.tariffs(spark, sf), root, f"{root}/checkpoint", "r1", PATIENCE, I.WINDOW,
                                          I.SLIDE, "available", TELEMETRY_EXACT)
        _finish(*queries)
    return _plain(table.latest())


def stream_late_rows(spark, sf):
    """The metrics job on the second half of the records after the first: each reading once, in time or late, with its lag."""
    root = run_dir(spark, "late-rows")
    for part in range(2):
        _arrivals(spark, sf, f"{root}/in", part)
        _, queries = run_zone_metrics(
            spark, read_text_files(spark, f"{root}/in"), I.tariffs(spark, sf), root, f"{root}/checkpoint", "r1",
            CLOSING, I.WINDOW, I.SLIDE, "available", TELEMETRY_EXACT)
        _finish(*queries)
    shown = ["meter_id", "grid_zone", plain_time("event_timestamp"), *as_double("power_consumption_kwh")]
    schema = spark.read.parquet(f"{root}/readings", f"{root}/archive", recursiveFileLookup=True).schema
    timely = enriched_readings(spark, root, schema, streaming=False).select(
        *shown, F.lit(False).alias("late"), F.lit(None).cast("double").alias("lag_seconds"))
    return timely.union(spark.read.parquet(f"{root}/late").select(*shown, F.lit(True).alias("late"), "lag_seconds"))


def stream_late_counts(spark, sf):
    """What the same job counted, batch by batch."""
    root = run_dir(spark, "late-counts")
    late = LateRows(spark, root, CLOSING, I.WINDOW, I.SLIDE)
    for part in range(2):
        _arrivals(spark, sf, f"{root}/in", part)
        _finish(start_enrichment(read_text_files(spark, f"{root}/in"), FixedTariffs(I.tariffs(spark, sf)), root,
                                 f"{root}/checkpoint", "available", TELEMETRY_EXACT, late))
    return late.counts().withColumn("batch_id", F.col("batch_id").cast("long"))


def sink_manifest(spark, sf):
    """Metrics written zone by zone, folded after the third; what is folded and what is still open is told by the manifest."""
    table, rows = ChangeLog(spark, run_dir(spark, "manifest"), ZONE_METRICS), metrics(spark, sf)
    rows = rows.withColumns({"batch_id": F.lit(0).cast("long"), "updated_at": F.col("window_end")})
    for number, zone in enumerate(I.ZONES):
        table.write(rows.where(F.col("grid_zone") == zone), "r1", number)
        if number == 2:
            table.compact()
    return _plain(table.latest()).withColumn("open_batches", F.lit(len(table.batches())).cast("long"))


def sink_skip_empty(spark, sf):
    """An empty batch and a full one: only the second is written."""
    root, rows = run_dir(spark, "skip"), served(spark, sf)
    write = skip_empty(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{root}/rows"))
    write(rows.limit(0), 0)
    write(rows, 1)
    found = spark.read.parquet(f"{root}/rows")
    return found.select(*_plain(found).columns, F.col("batch").cast("long").alias("batch")).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def sink_retry(spark, sf):
    """A store whose first write fails inside Spark; the second one succeeds."""
    root, calls = run_dir(spark, "retry"), []

    def write(df, n):
        calls.append(n)
        broken = F.raise_error(F.lit("the store is down")).cast("string") if len(calls) == 1 else F.col("grid_zone")
        write_once(df.withColumn("grid_zone", broken), f"{root}/rows", f"batch={n}")

    with_retry(write, sleep=lambda seconds: None)(served(spark, sf), 0)
    return _plain(spark.read.parquet(f"{root}/rows")).withColumn("attempts", F.lit(len(calls)).cast("long"))


def _order_stream(spark, sf):
    root = run_dir(spark, "order-stream")
    outcomes = OrderOutcomes(spark, f"{root}/outcomes", price_type=I.PRICE)
    _finish(start_orders(I.as_orders(table_stream(spark, sf, "orders")), outcomes, f"{root}/checkpoint", "available"))
    return outcomes


def stream_running_avg(spark, sf):
    return _order_stream(spark, sf).read().select("seq", "status", "total_orders", "running_avg")


def stream_dead_letters(spark, sf):
    return _order_stream(spark, sf).rejected().select("seq", "dlq_id", "orderId", "error_reason")


def _order_arrivals(spark, sf, folder, part, parts):
    """Some of the order messages, by their number, as files that a stream finds in `folder`."""
    rows = I.table(spark, sf, "orders").where(F.pmod("o_orderkey", F.lit(parts)) == part)
    rows.write.mode("append").parquet(folder)
    return I.as_orders(spark.readStream.schema(rows.schema).parquet(folder))


def stream_product_totals(spark, sf):
    """Totals by product in keyed state: a third of the orders is history, a third comes before a restart, a third after it."""
    root = run_dir(spark, "product-totals")
    history = history_totals(I.orders(spark, sf).where("seq % 3 = 0"), price_type=I.PRICE)
    table = TotalsTable(spark, f"{root}/totals", history)
    for part in (1, 2):
        orders = _order_arrivals(spark, sf, f"{root}/in", part, 3)
        _finish(start_totals(product_totals(orders, history, price_type=I.PRICE), table, f"{root}/checkpoint", "available"))
    return table.by_product().withColumn("total", F.col("total").cast("double"))


def _recent(spark, sf, name, count, keys=()):
    """Orders in three parts, each between those before; the third takes back every seventh order, among them many new ones."""
    root, resolved = run_dir(spark, name), lambda rows: orders.resolve(rows, price_type=I.PRICE).select("seq", "orderId", "product", "status")
    log = lambda: resolved(I.orders(spark, sf)).where("seq % 7 <> 0")
    recent = RecentRows(spark, f"{root}/recent", count, "seq", keys, spare=2, log=log)
    for part in (2, 0, 1):
        rows = I.table(spark, sf, "orders").withColumn("retracted", F.lit(False)).where(F.col("o_orderkey") % 3 == part)
        if part == 1:
            gone = I.table(spark, sf, "orders").where("o_orderkey % 7 = 0").withColumn("retracted", F.lit(True))
            rows = rows.where("o_orderkey % 7 <> 0").unionByName(gone)
        rows.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        marked = resolved(I.as_orders(stream.where("not retracted"))).withColumn("retracted", F.lit(False)).unionByName(
            resolved(I.as_orders(stream.where("retracted"))).withColumn("retracted", F.lit(True)))
        _finish(start_recent(marked, recent, f"{root}/checkpoint", "available"))
    return recent.read()


def stream_recent_orders(spark, sf):
    """The 40 newest outcomes of a stream, with late, resent and retracted orders."""
    return _recent(spark, sf, "recent", 40)


def stream_recent_per_product(spark, sf):
    return _recent(spark, sf, "recent-products", 5, ["product"])


def stream_parked_retries(spark, sf):
    """Outcomes of all messages whose failing ones wait in keyed state; the query is stopped while some wait, and restarted."""
    root = run_dir(spark, "parked")
    table, expected = OutcomeTable(spark, f"{root}/outcomes"), I.table(spark, sf, "orders").count()
    waiting = I.orders(spark, sf).where("seq % 2 = 0 and transient_failures > 0").count()
    for part in range(2):
        orders = _order_arrivals(spark, sf, f"{root}/in", part, 2)
        query = start_parked(parked_retries(orders, price_type=I.PRICE, backoff_s=0.02 if part else 2.0), table, f"{root}/checkpoint")
        # In the first run the messages that do not fail at once are enough.
        wanted = expected if part else I.table(spark, sf, "orders").where("o_orderkey % 2 = 0").count() - waiting
        while query.isActive and table.stored < wanted:
            query.awaitTermination(0.2)
        if query.exception() is not None:
            raise query.exception()
        query.stop()
    step = F.expr("transform(audit_trail, s -> concat_ws(':', s.attempt, s.status, coalesce(s.backoff_sec, 0.0D)))")
    return table.outcomes().select("seq", "status", "attempts", "retries", "error_reason", F.array_join(step, ",").alias("trail"))


def sink_compaction(spark, sf):
    """Metrics written twice, first with other tariffs; folded into the table in between."""
    table = ChangeLog(spark, run_dir(spark, "change-log"), ZONE_METRICS)
    first = zones.flatten_window(zones.sliding_zone_metrics(
        enrich(I.readings(spark, sf), I.tariffs(spark, sf, revision=1)), I.WINDOW, I.SLIDE), batch_id=0)
    table.write(first.withColumn("updated_at", F.col("window_end")), "r1", 0)
    table.compact()
    second = metrics(spark, sf).withColumn("batch_id", F.lit(1).cast("long"))
    table.write(second.withColumn("updated_at", F.col("window_end")), "r1", 1)
    table.compact()
    return _plain(table.latest())


def sink_fanout(spark, sf):
    """One batch to two stores."""
    root = run_dir(spark, "fan-out")
    both = FanOut(lambda df, n: write_once(df, f"{root}/first", f"batch={n}"),
                  lambda df, n: write_once(df, f"{root}/second", f"batch={n}"))
    both(served(spark, sf), 0)
    stores = [spark.read.parquet(f"{root}/{s}").withColumn("store", F.lit(s)) for s in ("first", "second")]
    rows = stores[0].unionByName(stores[1])
    return rows.groupBy("store", "grid_zone").agg(
        F.sum("active_meters").alias("readings"), F.count(F.lit(1)).alias("windows"))


def sink_health_log(spark, sf):
    """Two heartbeats, the second two days before the first one's moment."""
    folder = run_dir(spark, "health")
    table = served(spark, sf)
    for now in (NOW, "2024-01-29 00:00:00"):
        append_rows(health.heartbeat(health.freshness(table, now)), folder)
    return spark.read.parquet(folder).select(
        "component", "status", *as_double("latency_ms"), plain_time("checked_at"))


def queries():
    found = [stream_zone_metrics, stream_watermark, zone_metrics_job, stream_quarantine, stream_enrichment,
             stream_tariff_refresh, stream_restart, stream_late_data, stream_resent_records, stream_late_rows, stream_late_counts, sink_manifest, sink_skip_empty, sink_retry, stream_running_avg, stream_dead_letters, stream_product_totals, stream_parked_retries, stream_recent_orders,
             stream_recent_per_product, sink_compaction, sink_fanout, sink_health_log]
    return {f.__name__: f for f in found}


def oracles():
    windows = f"WITH {METRICS} SELECT {METRIC_NAMES} FROM metrics"
    good = METRICS.replace("FROM events)", f"FROM events WHERE {FAULT} NOT IN (3, 4, 6, 7, 8))").replace(
        "CAST(value AS DECIMAL(12,2)) AS cons",
        f"CASE WHEN {FAULT} = 5 THEN -1 ELSE 1 END * CAST(value AS DECIMAL(12,2)) AS cons")
    late = READINGS + """, marked AS (
        SELECT *, time_bucket(INTERVAL 30 MINUTES, ts) AS newest, event_id % 2 AS half,
          (SELECT max(ts) FROM readings WHERE event_id % 2 = 0) - INTERVAL 1 DAY AS watermark FROM readings),
      told AS (SELECT *, half = 1 AND newest + INTERVAL 1 HOUR <= watermark AS late,
          CASE WHEN half = 1 AND newest + INTERVAL 30 MINUTES <= watermark THEN 1 ELSE 0 END
          + CASE WHEN half = 1 AND newest + INTERVAL 1 HOUR <= watermark THEN 1 ELSE 0 END AS lost FROM marked)"""
    return {
        "stream_late_rows": f"""WITH {late} SELECT meter_id, grid_zone, ts AS event_timestamp,
            CAST(cons AS DOUBLE) AS power_consumption_kwh, late,
            CASE WHEN late THEN date_diff('microsecond', ts, watermark) / 1000000 END AS lag_seconds FROM told""",
        "stream_late_counts": f"""WITH {late} SELECT half AS batch_id, count(*) FILTER (NOT late) AS in_time,
            count(*) FILTER (late) AS late, CAST(sum(lost) AS BIGINT) AS lost_windows FROM told GROUP BY half""",
        "sink_manifest": f"WITH {METRICS} SELECT {METRIC_NAMES}, CAST(2 AS BIGINT) AS open_batches FROM metrics",
        "stream_zone_metrics": windows,
        "sink_compaction": windows,
        "stream_restart": windows,
        "stream_resent_records": windows,
        "stream_tariff_refresh": "WITH " + METRICS.replace(
            "LEFT JOIN tariffs t USING (household_id)", """LEFT JOIN (SELECT 0 AS half, * FROM tariffs UNION ALL
              SELECT 1, * FROM newer) t ON t.household_id = r.household_id AND t.half = r.event_id % 2""").replace(
            "enriched AS (", tariffs("newer", 1) + ", enriched AS (", 1) + f" SELECT {METRIC_NAMES} FROM metrics",
        "stream_late_data": "WITH " + METRICS.replace(
            "FROM windowed GROUP BY", """FROM (SELECT * FROM windowed UNION ALL SELECT * FROM windowed
              WHERE window_start + INTERVAL 1 HOUR > (SELECT max(ts) FROM events) - INTERVAL 1 DAY) GROUP BY""")
            + f" SELECT {METRIC_NAMES} FROM metrics",
        "sink_skip_empty": f"WITH {METRICS} SELECT {METRIC_NAMES}, CAST(1 AS BIGINT) AS batch FROM metrics",
        "sink_retry": f"WITH {METRICS} SELECT {METRIC_NAMES}, CAST(2 AS BIGINT) AS attempts FROM metrics",
        "stream_watermark": f"""WITH {METRICS} SELECT {METRIC_NAMES} FROM metrics
            WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
        "zone_metrics_job": f"WITH {good} SELECT {METRIC_NAMES} FROM metrics",
        "stream_quarantine": reading_oracles()["telemetry_quarantine"].replace("non-finite", "unreadable"),  # as decimals
        "stream_enrichment": f"""WITH {READINGS}, {tariffs('newest', 1)} SELECT household_id, grid_zone,
            ts AS event_timestamp, CAST(coalesce(rate, 0.15) AS DOUBLE) AS tariff_rate,
            CAST(cons - solar AS DOUBLE) AS net_grid_load_kwh,
            CAST(CAST(cons * coalesce(rate, 0.15) AS DECIMAL(30,8)) * CAST(1 - coalesce(flag, 0) * 0.15 AS DECIMAL(4,2))
              AS DOUBLE) AS estimated_cost
            FROM readings LEFT JOIN newest USING (household_id)""",
        "stream_product_totals": f"""WITH {RESOLVED}, summed AS (
            SELECT coalesce(product, 'Unknown') AS product, count(*) FILTER (status <> 'DLQ_QUARANTINED') AS orders,
              count(*) FILTER (status = 'DLQ_QUARANTINED') AS rejects,
              coalesce(sum(price_value) FILTER (status <> 'DLQ_QUARANTINED'), 0) AS total,
              coalesce(sum(CAST(price_value * 1000 AS HUGEINT)) FILTER (status <> 'DLQ_QUARANTINED'), 0) AS mills
            FROM resolved GROUP BY 1)
            SELECT product, orders, rejects, {price_double('total')} AS total,
              {half_up_average('mills', 'CAST(orders AS HUGEINT)')} AS avg_price FROM summed""",
        "stream_recent_orders": f"""WITH {RESOLVED} SELECT seq, orderId, product, status FROM resolved WHERE seq % 7 <> 0
            ORDER BY seq DESC LIMIT 40""",
        "stream_recent_per_product": f"""WITH {RESOLVED} SELECT seq, orderId, product, status FROM resolved WHERE seq % 7 <> 0
            QUALIFY row_number() OVER (PARTITION BY product ORDER BY seq DESC) <= 5""",
        "stream_parked_retries": f"""WITH {RESOLVED}, told AS (
            SELECT *, CASE WHEN problem IS NOT NULL THEN '1:FATAL:0.0'
                WHEN f >= 3 THEN '1:RETRY:0.15,2:RETRY:0.3,3:RETRY:0.45,3:EXHAUSTED:0.0'
                WHEN f = 2 THEN '1:RETRY:0.15,2:RETRY:0.3,3:SUCCESS:0.0'
                WHEN f = 1 THEN '1:RETRY:0.15,2:SUCCESS:0.0' ELSE '1:SUCCESS:0.0' END AS trail FROM resolved)
            SELECT seq, status, attempts, retries, error_reason, trail FROM told""",
        "stream_running_avg": f"WITH {RUNNING} SELECT seq, status, total_orders, running_avg FROM running",
        "stream_dead_letters": f"WITH {LETTERS} SELECT seq, dlq_id, orderId, error_reason FROM letters",
        "sink_fanout": f"""WITH {METRICS} SELECT store, grid_zone, CAST(sum(active_meters) AS BIGINT) AS readings,
            count(*) AS windows FROM metrics, (VALUES ('first'), ('second')) AS s(store) GROUP BY 1, 2""",
        "sink_health_log": f"""WITH {RECENCY} SELECT 'PYSPARK_STREAM_SINK' AS component, {STATUS_SQL} AS status,
              0.0::DOUBLE AS latency_ms, TIMESTAMP '2024-01-31 00:00:00' AS checked_at FROM lag
            UNION ALL SELECT 'PYSPARK_STREAM_SINK', CASE WHEN latest IS NULL THEN 'INITIALIZING'
              WHEN latest < TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 300 SECONDS THEN 'DEGRADED' ELSE 'HEALTHY' END,
              0.0, TIMESTAMP '2024-01-29 00:00:00' FROM lag""",
    }
