"""The jobs: zone metrics stream, order table, daily tariff drop, status snapshot."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from .. import storage
from ..operators.deadletters import dead_letters, replay
from ..operators.enrich import enrich, enrich_as_of
from ..operators.health import freshness, heartbeat, unavailable
from ..operators.orders import (
    PRICE_TYPE,
    average_price,
    order_kpis,
    resolve,
    with_audit_trail,
    with_running_average,
)
from ..operators.tariffs import drop_statistics, tariff_intervals
from ..operators.zones import latest_per_zone, volume_counters, zone_window_metrics
from ..schemas import TELEMETRY, ZONE_METRICS
from ..sinks.change_log import ChangeLog
from ..sinks.files import append_rows, write_once
from ..sinks.guards import with_retry
from ..sinks.tariffs import gated_publish
from ..sources.tariffs import FixedTariffs, read_drop
from ..streaming.late import LateRows
from ..streaming.zones import enriched_readings, enriched_schema, start_enrichment, start_metrics


def run_zone_metrics(spark, raw, tariffs, root, checkpoint, run, watermark=V.WATERMARK_DELAY,
                     window=V.WINDOW_DURATION, slide=V.SLIDE_DURATION, trigger=V.TRIGGER_INTERVAL,
                     schema=TELEMETRY, **lookup_options):
    """Telemetry records into a latest-wins metrics table and a quarantine folder.

    `tariffs` is a `CurrentTariffs`, asked in every micro-batch, so that a drop published
    during the run takes effect; or a frame with one row per household. One query reads the
    records and writes enriched readings and the quarantine, a second one aggregates the
    readings behind the watermark. Returns the table and the two queries. With the trigger
    "available" the second starts when the first has ended, and sees all it has written.
    `run` names this checkpoint's life and must sort after earlier runs into the same table.
    Readings whose windows have all closed are kept in root/late, and counted per batch.
    """
    current = FixedTariffs(tariffs) if isinstance(tariffs, DataFrame) else tariffs
    table = ChangeLog(spark, f"{root}/metrics", ZONE_METRICS)
    feeding = start_enrichment(raw, current, root, f"{checkpoint}/readings", trigger, schema,
                               LateRows(spark, root, watermark, window, slide), **lookup_options)
    if trigger == "available":
        feeding.awaitTermination()
    readings = enriched_readings(spark, root, enriched_schema(spark, current.frame(), schema))
    metrics = zone_window_metrics(readings.withWatermark("event_timestamp", watermark), window, slide)
    write = with_retry(table.writer(run))
    return table, [feeding, start_metrics(metrics, write, f"{checkpoint}/metrics", trigger)]


def backfill_zone_metrics(readings, tariffs, window=V.WINDOW_DURATION, slide=V.SLIDE_DURATION, **lookup_options):
    """The same metrics from a table of readings."""
    return zone_window_metrics(enrich(readings, tariffs, **lookup_options), window, slide)


def backfill_as_of(readings, history, window=V.WINDOW_DURATION, slide=V.SLIDE_DURATION, **as_of_options):
    """The same metrics, each reading at the price in force at its time, from all archived drops (see `read_history`)."""
    return zone_window_metrics(enrich_as_of(readings, tariff_intervals(history), **as_of_options), window, slide)


def run_orders(orders, root, at, max_retries=V.MAX_RETRIES, price_type=PRICE_TYPE, run="first"):
    """A table of orders into outcomes and dead letters below `root`, once per `run`.

    The orders are read twice, for the bucket totals and for the rows. The letters are the
    rejected part of the written outcomes, whose count of rejects is their number.
    """
    spark = orders.sparkSession
    rows = with_audit_trail(with_running_average(resolve(orders, max_retries, price_type))).drop("_permanent")
    with_retry(lambda df, n: write_once(df, f"{root}/outcomes", f"run={n}"))(rows, run)
    written = spark.read.schema(rows.schema).parquet(f"{root}/outcomes/run={run}")
    _leave_totals(written, root, run)
    with_retry(lambda df, n: write_once(df, f"{root}/dead_letters", f"run={n}"))(dead_letters(written, at), run)
    return stored_outcomes(spark, root)


def _totals(rows):
    return rows.agg(F.max("seq").alias("seq"), F.max("total_orders").alias("prior_orders"),
                    F.max("total_rejects").alias("prior_rejects"), F.max_by("cumulative_price", "seq").alias("prior_total"))


def _leave_totals(written, root, run):
    """What a run came to, as one row beside the log."""
    write_once(_totals(written), f"{root}/totals", f"run={run}")


def log_end(spark, root):
    """The last number of the order log and its totals there, from the rows that the runs left; a log without them is read."""
    if not storage.exists(spark, f"{root}/totals"):
        return _totals(stored_outcomes(spark, root)).first().asDict()
    ends = spark.read.parquet(f"{root}/totals").where("seq is not null").drop("run")
    return ends.orderBy(F.desc("seq")).limit(1).first().asDict()


def stored_outcomes(spark, root):
    """The order log: outcomes and, behind them, what replays came to."""
    rows = spark.read.parquet(f"{root}/outcomes")
    if storage.exists(spark, f"{root}/replays"):
        rows = rows.unionByName(spark.read.parquet(f"{root}/replays").drop("dlq_id"))
    return rows


def stored_letters(spark, root):
    """The dead letters, marked as replayed where a stored replay names them."""
    letters = spark.read.parquet(f"{root}/dead_letters").drop("replayed")
    if not storage.exists(spark, f"{root}/replays"):
        return letters.withColumn("replayed", F.lit(False))
    done = spark.read.parquet(f"{root}/replays").select("dlq_id", F.lit(True).alias("replayed")).distinct()
    return letters.join(done, "dlq_id", "left").withColumn("replayed", F.coalesce("replayed", F.lit(False)))


def run_replay(spark, root, requests, at, run, max_retries=V.MAX_RETRIES, price_type=PRICE_TYPE):
    """Replay the requested letters into the order log, once per `run` and once per letter.

    The replay goes on with the totals at the end of the log, which the run before left in one row. Its rows carry the letter's
    id, and these rows are the mark, so outcome and mark are stored in one step. A message
    that fails again is a new letter. Returns the requests that name no letter.
    """
    last = log_end(spark, root)
    outcomes, _, missing = replay(stored_letters(spark, root), requests, last.pop("seq"), max_retries,
                                  price_type=price_type)
    rows = with_audit_trail(with_running_average(outcomes, **last)).drop("_permanent")
    missing = missing.checkpoint()
    with_retry(lambda df, n: write_once(df, f"{root}/replays", f"run={n}"))(rows, run)
    if storage.is_published(spark, f"{root}/replays/run={run}"):
        written = spark.read.schema(rows.schema).parquet(f"{root}/replays/run={run}")
        _leave_totals(written, root, f"replay-{run}")
        with_retry(lambda df, n: write_once(df, f"{root}/dead_letters", f"run=replay-{n}"))(dead_letters(written, at), run)
    return missing


def run_daily_tariffs(tariffs, root, label, metrics, health_path, now, **gate_options):
    """Gate and publish a drop, then log how fresh the metrics are.

    The gate reads the staged files, so what is published is what was checked; a drop that
    fails raises and leaves the one in force. `metrics` is a function giving the serving
    table, so that a failing read is logged and not raised.
    """
    spark = tariffs.sparkSession
    path, report = gated_publish(tariffs, root, label, **gate_options)
    statistics = drop_statistics(read_drop(spark, path)).first().asDict()
    status = log_freshness(spark, metrics, health_path, now)
    return {"path": path, **report, **statistics, "freshness": status}


def log_freshness(spark, metrics, health_path, now):
    """Append a heartbeat row and return its status; an unreadable table is UNAVAILABLE."""
    try:
        checked = freshness(metrics(), now)
        row = heartbeat(checked)
        status = checked.first()["status"]
    except Exception as error:  # the check must outlive the table it looks at
        row, status = heartbeat(unavailable(spark, error, now)), V.UNAVAILABLE
    append_rows(row, health_path)
    return status


def status_snapshot(resolved, readings, metrics, gate):
    """One row: order figures, volumes, the gate's verdict and the latest metrics per zone."""
    zones = latest_per_zone(metrics).agg(F.sort_array(F.collect_list(F.struct(
        "grid_zone", "window_start", "net_load_kwh", "renewable_contribution_pct"))).alias("latest_zones"))
    snapshot = order_kpis(resolved)
    for part in (average_price(resolved), volume_counters(readings),
                 gate.select(F.col("status").alias("gate_status"), F.col("record_count").alias("gate_records")), zones):
        snapshot = snapshot.withColumns({c: part.select(c).scalar() for c in part.columns})
    return snapshot
