"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local cores, BENCH_RUNS the
runs per query, of which the fastest counts. Every run computes all result columns.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gridflow.plans import bench_queries, catalog  # noqa: E402
from gridflow.session import build_session  # noqa: E402

HEADLINE = (
    "zone_window_metrics", "zone_tumbling_metrics", "zone_batch_metrics", "backfill_batch", "enrich_left_join",
    "enrich_large_dimension", "grid_totals", "latest_per_zone", "sink_upsert_latest", "dq_tariff_gate",
    "dq_telemetry_violations", "order_retry_outcome", "order_audit_trail", "order_running_avg", "order_kpis",
    "sink_dlq", "dlq_replay_log", "stream_zone_metrics", "stream_running_avg",
)


def timed(run, runs):
    best = None
    for _ in range(runs):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return round(best, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("gridflow-bench", f"local[{cpus}]", shuffle_partitions=cpus, extra={
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    registered = {**catalog.queries(), **bench_queries.queries()}
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [*HEADLINE, *bench_queries.queries()]
    times = {name: timed(lambda: registered[name](spark, sf_dir), runs) for name in names}
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    line = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
            "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus, "runs": runs, "events": events}
    if "stream_zone_metrics" in times:
        line["stream_events_per_second"] = round(events / times["stream_zone_metrics"])
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
