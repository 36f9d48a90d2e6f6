"""Writers: batches once, latest-wins table, fan-out, retries, publishing, JDBC calls."""

import duckdb
import pytest
from pyspark.sql import functions as F

from gridflow import storage
from gridflow.operators.quality import GateFailed
from gridflow.operators.upsert import latest_wins
from gridflow.plans.jobs import run_daily_tariffs, run_orders
from gridflow.schemas import ZONE_METRICS
from gridflow.sinks import guards, jdbc
from gridflow.sinks.change_log import ChangeLog
from gridflow.sinks.files import write_once
from gridflow.sinks.tariffs import gated_publish
from gridflow.sources.tariffs import CurrentTariffs, drop_labels


def metric_rows(spark, *rows):
    """(day, zone, consumption) rows of the metrics table."""
    text = [(f"2026-01-{d:02d} 00:00:00", z, float(c)) for d, z, c in rows]
    frame = spark.createDataFrame(text, "window_start string, grid_zone string, total_consumption_kwh double")
    present = frame.withColumn("window_start", F.col("window_start").cast("timestamp")) \
        .withColumn("window_end", F.col("window_start") + F.expr("interval 1 hour"))
    missing = {f.name: F.lit(None).cast(f.dataType) for f in ZONE_METRICS.fields if f.name not in present.columns}
    return present.withColumns(missing).select(*ZONE_METRICS.fieldNames())


def contents(table):
    return sorted((r.window_start.day, r.grid_zone, r.total_consumption_kwh) for r in table.latest().collect())


def test_write_once(spark, tmp_path):
    root = str(tmp_path / "t")
    assert write_once(spark.range(3), root, "batch=1")
    assert not write_once(spark.range(9), root, "batch=1")       # a rerun changes nothing
    assert not write_once(spark.range(0), root, "batch=2")       # nothing to publish
    assert storage.child_names(spark, root) == ["batch=1"]
    assert spark.read.parquet(root).count() == 3
    assert list((tmp_path / "t" / "_staging").iterdir()) == []


def test_latest_wins(spark):
    log = spark.createDataFrame([("k", 1, 9, "a"), ("k", 2, 1, "b"), ("k", 2, 2, None), ("j", 1, 1, "d")],
                                "key string, run int, batch int, v string")
    found = {r.key: (r.run, r.batch, r.v) for r in latest_wins(log, ["key"], ["run", "batch"]).collect()}
    assert found == {"k": (2, 2, None), "j": (1, 1, "d")}        # a newer null counts too


def test_latest_wins_reduces_before_the_shuffle(spark, plan_of):
    log = spark.range(1000).selectExpr("id % 3 as key", "id as batch", "id * 2 as v")
    tree = plan_of(latest_wins(log, ["key"], ["batch"])).split("(1) Range")[0]
    assert "Window" not in tree and tree.index("Exchange") < tree.rindex("Aggregate")


def test_change_log(spark, tmp_path):
    table = ChangeLog(spark, str(tmp_path / "m"), ZONE_METRICS)
    assert contents(table) == []
    table.write(metric_rows(spark, (1, "N", 1), (2, "N", 5)), "r1", 0)
    table.write(metric_rows(spark, (1, "N", 2), (1, "S", 3)), "r1", 1)
    table.write(metric_rows(spark, (1, "N", 99)), "r1", 1)       # the same batch again
    assert contents(table) == [(1, "N", 2.0), (1, "S", 3.0), (2, "N", 5.0)]
    assert table.compact() == 2
    assert table.batches() == [] and contents(table) == [(1, "N", 2.0), (1, "S", 3.0), (2, "N", 5.0)]
    untouched = sorted((tmp_path / "m" / "table" / "_date=2026-01-02").glob("*.parquet"))
    table.write(metric_rows(spark, (1, "N", 7), (3, "N", 4)), "r2", 0)   # a new run starts at batch 0
    assert contents(table) == [(1, "N", 7.0), (1, "S", 3.0), (2, "N", 5.0), (3, "N", 4.0)]
    table.compact()
    assert contents(table) == [(1, "N", 7.0), (1, "S", 3.0), (2, "N", 5.0), (3, "N", 4.0)]
    assert sorted((tmp_path / "m" / "table" / "_date=2026-01-02").glob("*.parquet")) == untouched
    assert table.compact() == 0


def test_compaction_interrupted_before_the_log_is_removed(spark, tmp_path, monkeypatch):
    table = ChangeLog(spark, str(tmp_path / "m"), ZONE_METRICS)
    table.write(metric_rows(spark, (1, "N", 1), (2, "S", 5)), "r1", 0)

    def lost(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "remove", lost)
        with pytest.raises(OSError):
            table.compact()
    assert contents(table) == [(1, "N", 1.0), (2, "S", 5.0)]
    table.compact()
    assert table.batches() == [] and contents(table) == [(1, "N", 1.0), (2, "S", 5.0)]


def test_fan_out(spark):
    first, second, errors = [], [], []

    def fails_once(df, batch_id):
        if batch_id == 1:
            raise OSError("second store is down")
        second.append(df.count())

    both = guards.FanOut(lambda df, n: first.append(df.count()), fails_once)
    for batch in range(3):
        both(spark.range(batch + 1), batch)
    assert first == [1, 2, 3] and second == [1] and both.optional_errors == 1 and not both.optional_active
    with pytest.raises(OSError):
        guards.FanOut(fails_once, lambda df, n: errors.append(n))(spark.range(1), 1)
    assert errors == []


def test_skip_empty(spark):
    seen = []
    write = guards.skip_empty(lambda df, n: seen.append((n, df.count())))
    write(spark.range(0), 0)
    write(spark.range(2), 1)
    assert seen == [(1, 2)]


@pytest.mark.parametrize("wait, slept", [(guards.linear(0.1), [0.1, 0.2]), (guards.doubling(1.0), [1.0, 2.0])])
def test_retry(wait, slept):
    calls, waits = [], []

    def write(df, n):
        calls.append(n)
        if len(calls) < 3:
            raise OSError("busy")
        return "done"

    assert guards.with_retry(write, 3, wait, sleep=waits.append)(None, 7) == "done"
    assert calls == [7, 7, 7] and waits == pytest.approx(slept)


def test_retry_of_a_write_that_fails_in_spark(spark, tmp_path):
    calls = []

    def write(df, n):
        calls.append(n)
        value = F.raise_error(F.lit("disk full")).cast("long") if len(calls) == 1 else F.col("id")
        write_once(df.select(value.alias("id")), str(tmp_path), f"batch={n}")

    guards.with_retry(write, sleep=lambda s: None)(spark.range(5), 3)
    assert calls == [3, 3] and spark.read.parquet(str(tmp_path)).count() == 5

    def cannot_be_planned(df, n):
        calls.append(n)
        df.select("no_such_column").write.parquet(str(tmp_path / "never"))

    with pytest.raises(Exception, match="no_such_column"):
        guards.with_retry(cannot_be_planned, sleep=lambda s: None)(spark.range(5), 4)
    assert calls == [3, 3, 4]


def test_torn_folder_is_written_again(spark, tmp_path):
    """A crash in the middle of a rename that copies leaves some files and no marker."""
    root = tmp_path / "t"
    write_once(spark.range(10).repartition(4), str(root), "batch=1")
    (root / "batch=1" / storage.MARKER).unlink()
    next((root / "batch=1").glob("*.parquet")).unlink()
    assert spark.read.parquet(str(root)).count() < 10
    assert write_once(spark.range(10), str(root), "batch=1")
    assert spark.read.parquet(str(root)).count() == 10 and storage.is_published(spark, str(root / "batch=1"))


def test_only_touched_dates_are_read(spark, tmp_path, plan_of):
    table = ChangeLog(spark, str(tmp_path / "m"), ZONE_METRICS)
    table.write(metric_rows(spark, *[(d, "N", d) for d in range(1, 9)]), "r1", 0)
    table.compact()
    plan = plan_of(table._table([r._date for r in spark.sql("select date'2026-01-02' as _date").collect()]))
    assert "PartitionFilters: [" in plan and "2026-01-02" in plan
    bounded = table.latest(since="2026-01-03", until="2026-01-04")
    assert sorted(r.window_start.day for r in bounded.collect()) == [3, 4]
    assert "2026-01-03" in plan_of(bounded).split("PartitionFilters")[1].split("\n")[0]


def test_retry_gives_up(spark):
    def refuses(df, n):
        raise OSError("always")

    def is_wrong(df, n):
        raise ValueError("not worth a second try")

    waits = []
    with pytest.raises(OSError):
        guards.with_retry(refuses, 3, sleep=waits.append)(None, 1)
    assert len(waits) == 2
    with pytest.raises(ValueError):
        guards.with_retry(is_wrong, 3, sleep=waits.append)(None, 1)
    assert len(waits) == 2


def test_jdbc_writers_without_a_database(spark):
    """Which rows go where; no database is started, so the calls themselves are not made."""
    saved, statements = [], []

    def save(df, url, table, properties):
        saved.append((table, df.count(), sorted(df.columns)))

    def run(session, url, properties, statement):
        statements.append(statement)

    append = jdbc.jdbc_append("jdbc:x", "zone_metrics", {}, save)
    windowed = spark.sql("select window(timestamp'2026-01-01', '1 hour') as window, 'N' as grid_zone "
                         "from range(1)")
    append(windowed, 5)
    append(windowed.limit(0), 6)
    assert saved == [("zone_metrics", 1, ["batch_id", "grid_zone", "window_end", "window_start"])]
    upsert = jdbc.jdbc_upsert("jdbc:x", "zone_metrics", {}, ["window_start", "grid_zone"], save, run)
    upsert(windowed, 7)
    upsert(windowed.limit(0), 8)
    upsert(windowed, 7)
    names = [s[0] for s in saved[1:]]
    assert len(set(names)) == 2 and all(n.startswith("zone_metrics_staging_7_") for n in names)
    assert [s.split()[0] for s in statements] == ["MERGE", "DROP"] * 2 and names[0] in statements[0]

    def down(*_):
        raise OSError("connection refused")

    with pytest.raises(OSError):
        jdbc.jdbc_append("jdbc:x", "zone_metrics", {}, down)(windowed, 9)


def test_merge_statement():
    db = duckdb.connect()
    db.execute("create table t (k int, z varchar, v int); insert into t values (1, 'a', 10), (2, 'b', 20)")
    db.execute("create table s (k int, z varchar, v int); insert into s values (2, 'b', 21), (3, 'c', 30)")
    db.execute(jdbc.merge_statement("t", "s", ["k", "z"], ["k", "z", "v"]))
    assert db.execute("select * from t order by k").fetchall() == [(1, "a", 10), (2, "b", 21), (3, "c", 30)]


def tariff_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "household_id string, tariff_rate string, billing_tier string, subsidy_flag string")


def test_gate_stands_before_publishing(spark, tmp_path):
    root = str(tmp_path / "drops")
    good, bad = tariff_rows(spark, ("H1", "0.2", "T", "1")), tariff_rows(spark, ("H1", "7", "T", "1"))
    current = CurrentTariffs(spark, root)
    assert current.refresh() == 0 and current.frame().isEmpty()
    gated_publish(good, root, "20260101_000000")
    with pytest.raises(GateFailed):
        gated_publish(bad, root, "20260102_000000")
    assert drop_labels(spark, root) == ["20260101_000000"]
    assert current.refresh() == 1 and float(current.frame().first().tariff_rate) == 0.2
    gated_publish(good.withColumn("tariff_rate", F.lit("0.3")), root, "20260103_000000")
    assert float(current.frame().first().tariff_rate) == 0.3
    with pytest.raises(FileExistsError):
        gated_publish(good, root, "20260103_000000")


def test_one_row_per_household(spark, tmp_path):
    root = str(tmp_path / "drops")
    rows = tariff_rows(spark, ("H1", "0.123456", "T", "1"), ("H2", "0.3", "T", "0"), ("H1", "0.654321", "U", "0"))
    gated_publish(rows.coalesce(1), root, "20260101_000000")
    current = CurrentTariffs(spark, root)
    found = {r.household_id: (r.tariff_rate, r.billing_tier) for r in current.frame().collect()}
    assert found == {"H1": (0.654321, "U"), "H2": (0.3, "T")}
    assert (current.rows, current.duplicates) == (2, 1) and current.bytes > 0


def test_refused_drop_keeps_the_old_one(spark, tmp_path):
    from gridflow.sinks.tariffs import publish_drop, stage_drop
    root = str(tmp_path / "drops")
    gated_publish(tariff_rows(spark, ("H1", "0.2", "T", "1")), root, "20260101_000000")
    current = CurrentTariffs(spark, root)
    assert current.refresh() == 1
    publish_drop(spark, stage_drop(tariff_rows(spark, ("H1", "abc", "T", "1")), root), root, "20260102_000000")
    assert current.frame().first().tariff_rate == 0.2 and current.label == "20260101_000000"
    gated_publish(tariff_rows(spark, ("H1", "0.4", "T", "1")), root, "20260103_000000")
    assert current.frame().first().tariff_rate == 0.4


def test_unreadable_drop_keeps_the_old_one(spark, tmp_path):
    root = tmp_path / "drops"
    gated_publish(tariff_rows(spark, ("H1", "0.2", "T", "1")), str(root), "20260101_000000")
    current = CurrentTariffs(spark, str(root))
    assert current.refresh() == 1
    (root / "drop=20260102_000000").mkdir()                      # a drop without a file
    assert current.refresh() == 1 and current.label == "20260101_000000"
    assert current.frame().count() == 1


def test_daily_job(spark, tmp_path):
    metrics = metric_rows(spark, (1, "N", 1)).withColumn("updated_at", F.col("window_end"))
    result = run_daily_tariffs(tariff_rows(spark, ("H1", "0.2", "T", "1"), ("H2", "0.4", "T", "0")),
                               str(tmp_path / "drops"), "20260101_000000", lambda: metrics, str(tmp_path / "health"),
                               "2026-01-01 01:02:00")
    assert (result["status"], result["record_count"], result["freshness"]) == ("PASSED", 2, "HEALTHY")
    assert (result["avg_tariff"], result["subsidized_ratio"]) == (0.3, 0.5)
    assert spark.read.parquet(str(tmp_path / "health")).count() == 1


def test_stored_replay_counts_once(spark, tmp_path):
    from gridflow.plans.jobs import run_replay, stored_letters, stored_outcomes
    from test_deadletters import requests
    from test_orders import events
    root = str(tmp_path)
    run_orders(events(spark, (1, "A", "I", "10", 0, None), (2, "B", "I", "-20", 0, None), (3, None, "I", "5", 0, None)),
               root, "2026-01-01 00:00:00")
    asked = requests(spark, ("DLQ-0002", None), ("DLQ-0001", None), ("DLQ-9999", None))
    missing = run_replay(spark, root, asked, "2026-01-02 00:00:00", "a")
    assert [r.dlq_id for r in missing.collect()] == ["DLQ-9999"]
    for run in ("a", "b"):                                       # the same run again, and another asking the same
        run_replay(spark, root, asked, "2026-01-02 00:00:00", run)
        log = {r.seq: (r.status, r.total_orders, r.running_avg) for r in stored_outcomes(spark, root).collect()}
        assert log == {1: ("SUCCESS", 1, 10.0), 2: ("DLQ_QUARANTINED", 1, 10.0), 3: ("DLQ_QUARANTINED", 1, 10.0),
                       4: ("SUCCESS", 2, 15.0), 5: ("DLQ_QUARANTINED", 2, 15.0)}
        letters = {r.dlq_id: (r.seq, r.replayed) for r in stored_letters(spark, root).collect()}
        assert letters == {"DLQ-0001": (2, True), "DLQ-0002": (3, True), "DLQ-0003": (5, False)}


def test_order_job(spark, tmp_path):
    from test_orders import events
    frame = events(spark, (1, "A", "I", "10", 0, None), (2, "B", "I", "-1", 0, None), (3, "C", "I", "20", 1, None))
    run_orders(frame, str(tmp_path), "2026-01-01 00:00:00")
    outcomes = {r.seq: (r.status, r.running_avg) for r in spark.read.parquet(str(tmp_path / "outcomes")).collect()}
    assert outcomes == {1: ("SUCCESS", 10.0), 2: ("DLQ_QUARANTINED", 10.0), 3: ("RECOVERED_AFTER_RETRY", 15.0)}
    run_orders(frame, str(tmp_path), "2026-01-01 00:00:00")      # a rerun adds nothing
    assert spark.read.parquet(str(tmp_path / "outcomes")).count() == 3
    assert [r.dlq_id for r in spark.read.parquet(str(tmp_path / "dead_letters")).collect()] == ["DLQ-0001"]
