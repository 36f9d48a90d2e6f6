"""Records sent again, and what a batch of records keeps."""

import json
from collections import Counter

from gridflow.operators.decode import decode_telemetry, quarantined_readings, text_of_bad
from gridflow.sources.telemetry import first_deliveries

RECORD = json.dumps({"meter_id": "M", "household_id": "H", "power_consumption_kwh": 1.0, "solar_generation_kwh": 0.0,
                     "grid_zone": "N", "timestamp": "2026-01-01T00:00:00+00:00"})


def test_first_deliveries_keep_a_short_digest_of_key_and_value(spark, tmp_path):
    """Records told apart by null and empty, and by where the key ends; the state's keys are the digests' 32 bytes."""
    sent = [(None, b"v"), (b"", b"v"), (b"v", None), (b"v", b""), (b"ab", b"c"), (b"a", b"bc"), (None, None), (b"", b"")]
    schema = "key binary, value binary, timestamp timestamp"
    rows = spark.createDataFrame([(k, v, None) for k, v in sent * 3], schema)
    rows.write.parquet(f"{tmp_path}/in")
    found = []

    def run():
        raw = first_deliveries(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
        raw.writeStream.foreachBatch(lambda df, n: found.extend((r.key, r.value) for r in df.collect())).option(
            "checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    run()
    rows.write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert Counter((k if k is None else bytes(k), v if v is None else bytes(v)) for k, v in found) == Counter(sent)
    keys = spark.read.format("statestore").load(f"{tmp_path}/checkpoint").select("key._digest").collect()
    assert len(keys) == len(sent) and {(type(k[0]), len(k[0])) for k in keys} <= {(bytearray, 32), (bytes, 32)}


def test_a_batch_keeps_the_text_of_bad_records_only(spark):
    raw = spark.createDataFrame([(None, RECORD.encode(), None), (None, b"broken", None)],
                                "key binary, value binary, timestamp timestamp")
    kept = text_of_bad(decode_telemetry(raw))
    assert sorted((r.raw_value or "", r.error_reason is None) for r in kept.collect()) == [("", True), ("broken", False)]
    assert quarantined_readings(kept).collect() == quarantined_readings(decode_telemetry(raw)).collect()
