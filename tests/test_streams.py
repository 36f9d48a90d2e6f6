"""Scripted streams: late data, repeated output, restart, refresh, batch equality."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from gridflow import storage
from gridflow.operators import zones
from gridflow.operators.decode import decode_telemetry, good_readings
from gridflow.plans.jobs import backfill_zone_metrics, run_zone_metrics
from gridflow.schemas import ORDER_EVENT, TELEMETRY, ZONE_METRICS
from gridflow.sinks.change_log import ChangeLog
from gridflow.sinks.tariffs import publish_drop, stage_drop
from gridflow.sources.metrics import read_metrics
from gridflow.sources.orders import read_order_json
from gridflow.sources.tariffs import CurrentTariffs
from gridflow.sources.telemetry import read_text_files
from gridflow.streaming.orders import OrderOutcomes, start_orders
from gridflow.streaming.progress import VolumeListener
from gridflow.streaming.zones import (
    enriched_readings,
    start_enrichment,
    start_metrics,
    trigger_of,
    zone_metrics_stream,
)
from test_orders import MALFORMED, model, random_orders


class Feed:
    """A folder of JSON lines; each call adds one file, which becomes one micro-batch."""

    def __init__(self, folder):
        self.folder, self.files = folder, 0
        folder.mkdir()

    def add(self, *lines):
        path = self.folder / f"{self.files:04d}.json"
        path.write_text("".join(line + "\n" for line in lines))
        os.utime(path, (self.files + 1e9, self.files + 1e9))  # files are taken in the order of their times
        self.files += 1

    @property
    def path(self):
        return str(self.folder)


def reading(time, value=1.0, zone="N", household="H1", solar=0.0):
    return json.dumps({"meter_id": "M", "household_id": household, "power_consumption_kwh": value,
                       "solar_generation_kwh": solar, "grid_zone": zone, "timestamp": f"2026-01-01T{time}+00:00"})


def tariffs(spark, **rates):
    return spark.createDataFrame([(h, r, "T", 0) for h, r in rates.items()] or [],
                                 "household_id string, tariff_rate double, billing_tier string, subsidy_flag int")


def collector(out):
    """Keeps what each batch emitted: (start of the window, consumption, readings)."""
    def write_batch(df, batch_id):
        rows = zones.flatten_window(df).withColumn("start", F.date_format("window_start", "HH:mm:ss")).collect()
        if rows:
            out.append(sorted((r.start, r.total_consumption_kwh, r.active_meters) for r in rows))
    return write_batch


def test_late_and_repeated_output(spark, tmp_path):
    feed, out, checkpoint = Feed(tmp_path / "in"), [], str(tmp_path / "checkpoint")
    feed.add(reading("00:00:40", 1.0))
    raw = read_text_files(spark, feed.path, max_files=1)
    query = start_metrics(zone_metrics_stream(raw, tariffs(spark)), collector(out), checkpoint, "0 seconds")
    try:
        query.processAllAvailable()
        assert out == [[("00:00:00", 1.0, 1), ("00:00:30", 1.0, 1)]]
        for time, value in [("00:00:45", 2.0), ("00:02:00", 5.0), ("00:00:50", 100.0)]:
            feed.add(reading(time, value))
            query.processAllAvailable()
    finally:
        query.stop()
    # The windows are emitted again with the second reading; the last one is too late.
    assert out[1:] == [[("00:00:00", 3.0, 2), ("00:00:30", 3.0, 2)], [("00:01:30", 5.0, 1), ("00:02:00", 5.0, 1)]]


def test_volume_listener(spark, tmp_path):
    feed, counter = Feed(tmp_path / "in"), VolumeListener()
    feed.add(reading("00:00:40"), reading("00:00:41"))
    feed.add(reading("00:00:42"))
    spark.streams.addListener(counter)
    try:
        raw = read_text_files(spark, feed.path, max_files=1)
        raw.writeStream.format("noop").trigger(availableNow=True).start().awaitTermination()
        for _ in range(100):
            if counter.total_events == 3:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counter)
    assert (counter.total_events, counter.batch_count) == (3, 2)


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    table = ChangeLog(spark, str(tmp_path / "metrics"), ZONE_METRICS)

    def run():
        raw = read_text_files(spark, feed.path, max_files=1)
        start_metrics(zone_metrics_stream(raw, tariffs(spark)), table.writer("r1"), str(tmp_path / "checkpoint"),
                      "available").awaitTermination()
        return {(r.start, r.total_consumption_kwh, r.active_meters) for r in
                table.latest().withColumn("start", F.date_format("window_start", "HH:mm:ss")).collect()}

    feed.add(reading("00:00:40", 1.0))
    assert run() == {("00:00:00", 1.0, 1), ("00:00:30", 1.0, 1)}
    feed.add(reading("00:00:45", 2.0))
    assert run() == {("00:00:00", 3.0, 2), ("00:00:30", 3.0, 2)}
    assert run() == {("00:00:00", 3.0, 2), ("00:00:30", 3.0, 2)}


def test_failed_batch_is_run_again(spark, tmp_path):
    """The write succeeds, then the batch fails: the rerun adds nothing twice."""
    feed = Feed(tmp_path / "in")
    table = ChangeLog(spark, str(tmp_path / "metrics"), ZONE_METRICS)
    write, broken = table.writer("r1"), [True]

    def breaks_after_writing(df, batch_id):
        write(df, batch_id)
        if broken.pop():
            raise OSError("lost after the write")

    def run(writer):
        raw = read_text_files(spark, feed.path, max_files=1)
        start_metrics(zone_metrics_stream(raw, tariffs(spark)), writer, str(tmp_path / "checkpoint"),
                      "available").awaitTermination()

    feed.add(reading("00:00:40", 1.0), reading("00:00:41", 2.0, "S"))
    with pytest.raises(Exception, match="lost after the write"):
        run(breaks_after_writing)
    run(write)
    assert {(r.grid_zone, r.total_consumption_kwh) for r in table.latest().collect()} == {("N", 1.0), ("S", 2.0)}
    assert len(table.batches()) == 1


def test_console_and_triggers(spark, tmp_path):
    assert trigger_of("available") == {"availableNow": True}
    assert trigger_of("5 seconds") == {"processingTime": "5 seconds"}
    feed = Feed(tmp_path / "in")
    feed.add(reading("00:00:40"))
    raw = read_text_files(spark, feed.path)
    query = start_metrics(zone_metrics_stream(raw, tariffs(spark)), "console", None, "available")
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")


def test_job_on_good_and_bad_records(spark, tmp_path):
    """Stream and batch agree, and what does not parse is kept aside."""
    feed = Feed(tmp_path / "in")
    lines = [reading(f"00:{m:02d}:{s:02d}", (7 * m + s) / 100, zone, f"H{s % 5}", s / 10)
             for m in range(6) for s in range(0, 60, 7) for zone in ("N", "S")]
    for start in range(0, len(lines), 30):
        feed.add(*lines[start:start + 30], "not json")
    dimension = tariffs(spark, H1=0.2, H2=0.5)
    table, queries = run_zone_metrics(spark, read_text_files(spark, feed.path, max_files=1), dimension,
                                      str(tmp_path / "out"), str(tmp_path / "checkpoint"), "r1", "10 minutes",
                                      trigger="available")
    for query in queries:
        query.awaitTermination()
    history = good_readings(decode_telemetry(read_text_files(spark, feed.path, streaming=False), TELEMETRY))
    batch = zones.flatten_window(backfill_zone_metrics(history, dimension))
    names = ["window_start", "window_end", "grid_zone", *zones.METRICS]
    streamed = read_metrics(spark, str(tmp_path / "out")).select(*names)
    assert streamed.count() == batch.count() > 20
    assert streamed.exceptAll(batch.select(*names)).isEmpty()
    assert spark.read.parquet(str(tmp_path / "out/quarantine")).count() == feed.files
    assert table.compact() >= 1
    assert table.latest().select(*names).exceptAll(batch.select(*names)).isEmpty()


def test_refreshed_tariffs(spark, tmp_path):
    """A longer drop published while the query runs counts from the next batch on."""
    feed, root = Feed(tmp_path / "in"), str(tmp_path / "out")
    drops = str(tmp_path / "drops")

    def publish(label, **rates):
        rows = tariffs(spark, **rates)
        publish_drop(spark, stage_drop(rows, drops), drops, label)

    def rates():
        rows = spark.read.parquet(f"{root}/readings").select(
            "household_id", F.date_format("event_timestamp", "ss").alias("s"), F.col("tariff_rate").cast("double").alias("r"))
        return {(r.s, r.household_id): r.r for r in rows.collect()}

    publish("20260101_000000", H1=0.2, H2=0.3)
    query = start_enrichment(read_text_files(spark, feed.path, max_files=1), CurrentTariffs(spark, drops), root,
                             str(tmp_path / "checkpoint"), "0 seconds")
    try:
        feed.add(*[reading("00:00:01", household=h) for h in ("H1", "H2", "H3", "H4")])
        query.processAllAvailable()
        publish("20260102_000000", H1=1.1, H2=1.2, H3=1.3, H4=1.4)
        feed.add(*[reading("00:00:02", household=h) for h in ("H1", "H2", "H3", "H4")], "not json")
        query.processAllAvailable()
    finally:
        query.stop()
    assert rates() == {("01", "H1"): 0.2, ("01", "H2"): 0.3, ("01", "H3"): 0.15, ("01", "H4"): 0.15,
                       ("02", "H1"): 1.1, ("02", "H2"): 1.2, ("02", "H3"): 1.3, ("02", "H4"): 1.4}
    assert spark.read.parquet(f"{root}/quarantine").count() == 1

    # The second step: the enriched table as a stream of its own.
    out = []
    stored = enriched_readings(spark, root, spark.read.parquet(f"{root}/readings").drop("batch_id").schema)
    metrics = zones.zone_window_metrics(stored.withWatermark("event_timestamp", "10 seconds"), "1 minute")
    start_metrics(metrics, collector(out), str(tmp_path / "checkpoint2"), "available").awaitTermination()
    assert out[-1] == [("00:00:00", 8.0, 8)]


def order_lines(rows):
    return [json.dumps({k: v for k, v in zip(ORDER_EVENT.fieldNames(), r) if v is not None}) for r in rows]


def run_orders(spark, feed, tmp_path, outcomes):
    stream = read_order_json(spark, feed.path, streaming=True, max_files=1)
    start_orders(stream, outcomes, str(tmp_path / "checkpoint"), "available").awaitTermination()


def test_running_average_over_batches_and_a_restart(spark, tmp_path, monkeypatch):
    feed, rows = Feed(tmp_path / "in"), sorted(random_orders(11, 120))
    outcomes = OrderOutcomes(spark, str(tmp_path / "outcomes"), price_type="decimal(24,6)")
    for start in (0, 50, 51):
        feed.add(*order_lines(rows[start:{0: 50, 50: 51, 51: 90}[start]]))
    run_orders(spark, feed, tmp_path, outcomes)
    feed.add(*order_lines(rows[90:]))
    monkeypatch.setattr(storage, "child_names", None)            # nothing is listed
    run_orders(spark, feed, tmp_path, OrderOutcomes(spark, str(tmp_path / "outcomes"), price_type="decimal(24,6)"))
    found = {r.seq: (r.status, r.attempts, r.total_orders, r.running_avg) for r in outcomes.read().collect()}
    assert found == model(rows)
    letters = outcomes.rejected().orderBy("seq").collect()
    assert [r.dlq_id for r in letters] == [f"DLQ-{n:04d}" for n in range(1, len(letters) + 1)]
    assert outcomes.accepted().count() + len(letters) == len(rows)


def test_failed_order_batch_counts_once(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.add(*order_lines([(1, "A", "I", "10", 0, None), (2, None, "I", "20", 0, None)]))
    outcomes = OrderOutcomes(spark, str(tmp_path / "outcomes"))
    write, broken = outcomes.write, [True]

    def breaks_after_writing(df, batch_id):
        write(df, batch_id)
        if broken and broken.pop():
            raise OSError("lost after the write")

    outcomes.write = breaks_after_writing
    with pytest.raises(Exception, match="lost after the write"):
        run_orders(spark, feed, tmp_path, outcomes)
    feed.add(*order_lines([(3, "C", "I", "30", 2, None)]))
    run_orders(spark, feed, tmp_path, outcomes)
    rows = {r.seq: (r.total_orders, r.running_avg, r.error_reason) for r in outcomes.read().collect()}
    assert rows == {1: (1, 10.0, None), 2: (1, 10.0, MALFORMED), 3: (2, 20.0, None)}
