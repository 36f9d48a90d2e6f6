"""Zone metrics from a stream of telemetry records."""

from .. import fixed_values as V
from .. import storage
from ..operators.decode import decode_telemetry, good_readings, quarantined_readings, text_of_bad
from ..operators.enrich import enrich
from ..operators.zones import zone_window_metrics
from ..schemas import TELEMETRY
from ..sinks.files import write_once
from ..sinks.guards import skip_empty, with_retry
from ..sinks.manifest import Manifest
from .late import in_time, late

#: Batches between two looks for folders whose readings have been aggregated.
RETIRE_EVERY = 100


def trigger_of(trigger):
    """"available" runs over what is there and stops; anything else is a time between batches."""
    return {"availableNow": True} if trigger == "available" else {"processingTime": trigger}


def zone_metrics_stream(raw, tariffs, watermark=V.WATERMARK_DELAY, window=V.WINDOW_DURATION,
                        slide=V.SLIDE_DURATION, schema=TELEMETRY, **lookup_options):
    """Records to windowed zone metrics; readings older than the watermark are left out."""
    readings = good_readings(decode_telemetry(raw, schema)).withWatermark("event_timestamp", watermark)
    return zone_window_metrics(enrich(readings, tariffs, **lookup_options), window, slide)


def start_metrics(metrics, write_batch, checkpoint, trigger=V.TRIGGER_INTERVAL, mode="update", name=None):
    """Start a windowed query into a `foreachBatch` writer, or onto the console."""
    writer = metrics.writeStream.outputMode(mode).trigger(**trigger_of(trigger))
    if name:
        writer = writer.queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if write_batch == "console":
        return writer.format("console").option("truncate", "false").start()
    return writer.foreachBatch(write_batch).start()


def start_quarantine(raw, path, checkpoint, trigger=V.TRIGGER_INTERVAL, schema=TELEMETRY):
    """Keep the records that do not parse, with the reason."""
    return (
        quarantined_readings(decode_telemetry(raw, schema)).writeStream
        .format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**trigger_of(trigger)).start()
    )


def start_enrichment(raw, current_tariffs, root, checkpoint, trigger=V.TRIGGER_INTERVAL, schema=TELEMETRY,
                     late_rows=None, **lookup_options):
    """Enrich each micro-batch with the tariff drop in force when it runs.

    Good readings go to root/readings, the others to root/quarantine, one folder per
    batch; each is written up to three times. Aggregate with `enriched_readings` as the
    source of a second query. With `late_rows`, readings whose windows have all closed go
    to root/late instead, with their lag; that query's watermark is never ahead, so none
    is lost behind it.
    """
    manifest = Manifest(raw.sparkSession, f"{root}/readings")

    def publish(rows, batch_id, folder):
        with_retry(lambda df, n: write_once(df, f"{root}/{folder}", f"batch_id={n}"))(rows, batch_id)
        if folder == "readings" and storage.is_published(rows.sparkSession, f"{root}/{folder}/batch_id={batch_id}"):
            manifest.add(f"batch_id={batch_id}")

    def write_batch(batch_df, batch_id):
        if batch_id % RETIRE_EVERY == 0:
            retire_readings(batch_df.sparkSession, root, manifest)
        decoded = text_of_bad(decode_telemetry(batch_df, schema)).persist()
        try:
            tariffs = current_tariffs.frame()
            known = {"dim_bytes": current_tariffs.bytes, **lookup_options}
            good = good_readings(decoded)
            if late_rows:
                marked = late_rows.mark(good, batch_id)
                publish(late(marked), batch_id, "late")      # the whole batch is computed and kept by now
                good = in_time(marked)
            if not late_rows or not decoded.isEmpty():       # a batch that only moves the watermark meets no tariffs
                publish(enrich(good, tariffs, **known), batch_id, "readings")
                publish(quarantined_readings(decoded), batch_id, "quarantine")
            if late_rows:
                late_rows.advance(marked, batch_id)
        finally:
            decoded.unpersist()

    return (
        raw.writeStream.foreachBatch(write_batch if late_rows else skip_empty(write_batch))
        .option("checkpointLocation", checkpoint).trigger(**trigger_of(trigger)).start()
    )


def enriched_schema(spark, tariffs, schema=TELEMETRY):
    """The columns that `start_enrichment` writes."""
    raw = spark.createDataFrame([], "key binary, value binary, timestamp timestamp")
    return enrich(good_readings(decode_telemetry(raw, schema)), tariffs.limit(0), dim_bytes=0).schema


def enriched_readings(spark, root, schema, streaming=True):
    """What `start_enrichment` published, as a stream or a table.

    A stream moves the files that it has aggregated to root/archive, so the folder it looks into holds what is new; the
    table is both. One stream at a time may read a root.
    """
    folder, archive = f"{root}/readings", f"{root}/archive"
    storage.make_folder(spark, folder)
    if streaming:
        return (spark.readStream.schema(schema).option("cleanSource", "archive")
                .option("sourceArchiveDir", archive).parquet(folder))
    paths = [folder, archive] if storage.exists(spark, archive) else [folder]
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


def retire_readings(spark, root, manifest):
    """Delete the batch folders whose files have all been archived; asks for the committed ones that are left only."""
    done = [f for f in manifest.live() if not storage.child_names(spark, f"{root}/readings/{f}")]
    if done:
        manifest.remove(done)
        manifest.sweep(lambda f: f"{root}/readings/{f}")
    return done
