"""The manifest: claims, lost writers, checkpoints, readers on their way, retention; and the tables that use it."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from gridflow import storage
from gridflow.schemas import ZONE_METRICS
from gridflow.sinks import change_log
from gridflow.sinks.change_log import ChangeLog, CompactionRunning
from gridflow.sinks.manifest import Manifest
from gridflow.streaming.zones import enriched_readings, retire_readings, start_metrics
from test_sinks import contents, metric_rows


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/a/one"
    assert storage.create_once(spark, path, "ä") and not storage.create_once(spark, path, "b")
    assert storage.read_file(spark, path) == "ä" and storage.read_file(spark, f"{tmp_path}/a/two") is None
    storage.replace_file(spark, path, "c")
    assert storage.read_file(spark, path) == "c"
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")] == ["one"]


def test_a_file_is_whole_while_it_is_replaced(spark, tmp_path):
    path, found, done = f"{tmp_path}/newest", [], threading.Event()
    storage.replace_file(spark, path, "0")

    def look():
        while not done.is_set():
            try:
                found.append(storage.read_file(spark, path))
            except Exception as error:
                found.append(error)

    reader = threading.Thread(target=look)
    reader.start()
    for n in range(300):
        storage.replace_file(spark, path, str(n) * (1 + n % 7))
    done.set()
    reader.join()
    assert found and not [f for f in found if not isinstance(f, str)]


def test_a_file_is_created_by_one_of_many(spark, tmp_path):
    made, together = [], threading.Barrier(6)

    def work(own):
        for n in range(60):
            together.wait()
            if storage.create_once(spark, f"{tmp_path}/{n}", str(own)):
                made.append((str(n), str(own)))

    threads = [threading.Thread(target=work, args=(own,)) for own in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(made) == sorted((str(n), storage.read_file(spark, f"{tmp_path}/{n}")) for n in range(60))


def test_folders_come_and_go(spark, tmp_path):
    one, other = (Manifest(spark, str(tmp_path), every=3) for _ in range(2))
    assert one.live() == []
    for n in range(10):
        assert (one, other)[n % 2].add(f"b{n}")
    assert not one.add("b3") and one.live() == other.live() == [f"b{n}" for n in range(10)]
    assert one.remove(["b0", "b4"]) and not other.remove(["b4"]) and not other.add("b4")
    assert other.live() == ["b1", "b2", "b3", *[f"b{n}" for n in range(5, 10)]]
    assert Manifest(spark, str(tmp_path), every=3).state() == one.state() == other.state()


def test_a_reader_that_fell_behind_goes_on_from_a_checkpoint(spark, tmp_path):
    slow, writer = (Manifest(spark, str(tmp_path), every=4) for _ in range(2))
    writer.add("b0")
    assert slow.live() == ["b0"]
    for n in range(1, 30):
        writer.add(f"b{n}")
    names = [p.name for p in (tmp_path / "_manifest").iterdir() if p.name.endswith(".json") and p.name[0] != "."]
    assert len(names) <= 4 + 4 + 3                                 # versions and checkpoints are removed
    assert slow.state() == writer.state() and len(slow.live()) == 30


def test_versions_are_claimed_by_one_writer(spark, tmp_path):
    made = []

    def work(own):
        manifest = Manifest(spark, str(tmp_path), every=5)
        for n in range(8):
            made.append(manifest.add(f"{own}-{n}"))
            made.append(manifest.add(f"shared-{n}"))

    threads = [threading.Thread(target=work, args=(own,)) for own in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = Manifest(spark, str(tmp_path), every=5)
    assert sum(made) == 4 * 8 + 8 and found.state()["version"] == 40
    assert set(found.live()) == {f"{own}-{n}" for own in (*range(4), "shared") for n in range(8)}


def test_removed_folders_wait_for_their_readers(spark, tmp_path):
    manifest, swept = Manifest(spark, str(tmp_path)), lambda: manifest.sweep(lambda f: f"{tmp_path}/{f}")
    (tmp_path / "b0").mkdir()
    manifest.add("b0")
    manifest.passed("reader", manifest.state()["version"])
    manifest.remove(["b0"])
    assert swept() == [] and (tmp_path / "b0").exists()
    assert not manifest.passed("reader", 0)                         # a reader never goes back
    manifest.passed("reader", manifest.state()["version"])
    assert swept() == ["b0"] and not (tmp_path / "b0").exists() and manifest.state()["gone"] == {}
    manifest.forget("reader")
    assert manifest.state()["readers"] == {}


def test_a_killed_writer_is_made_good(spark, tmp_path, monkeypatch):
    """The driver dies after the folder was published and before it was committed: the batch does not count until its rerun."""
    table = ChangeLog(spark, str(tmp_path), ZONE_METRICS)
    table.write(metric_rows(spark, (1, "N", 1)), "r1", 0)
    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "add", lambda *_: (_ for _ in ()).throw(SystemExit))
        with pytest.raises(SystemExit):
            table.write(metric_rows(spark, (1, "N", 2)), "r1", 1)
    again = ChangeLog(spark, str(tmp_path), ZONE_METRICS)
    assert contents(again) == [(1, "N", 1.0)]
    assert not again.write(metric_rows(spark, (1, "N", 2)), "r1", 1)
    assert contents(again) == [(1, "N", 2.0)] and again.batches() == ["run=r1/batch=0", "run=r1/batch=1"]


def test_nothing_is_listed(spark, tmp_path, monkeypatch):
    def listed(*_):
        raise AssertionError("listed")

    monkeypatch.setattr(storage, "child_names", listed)
    table = ChangeLog(spark, str(tmp_path), ZONE_METRICS)
    for n in range(3):
        table.write(metric_rows(spark, (n + 1, "N", n)), "r1", n)
    assert table.compact() == 3
    table.write(metric_rows(spark, (1, "N", 9)), "r1", 3)
    assert contents(table) == [(1, "N", 9.0), (2, "N", 1.0), (3, "N", 2.0)] and table.batches() == ["run=r1/batch=3"]


def test_one_compaction_at_a_time(spark, tmp_path, monkeypatch):
    table = ChangeLog(spark, str(tmp_path), ZONE_METRICS)
    table.write(metric_rows(spark, (1, "N", 1)), "r1", 0)
    table.manifest.begin("compaction", "a driver that died")
    with pytest.raises(CompactionRunning, match="a driver that died"):
        table.compact()
    assert table.compact("a driver that died") == 1 and table.compact() == 0
    assert contents(table) == [(1, "N", 1.0)]


def test_a_frame_made_before_a_compaction_still_reads(spark, tmp_path):
    table = ChangeLog(spark, str(tmp_path), ZONE_METRICS)
    table.write(metric_rows(spark, (1, "N", 1)), "r1", 0)
    before = table.latest()
    table.passed("dashboard")
    table.compact()
    assert before.count() == 1 and (tmp_path / "log/run=r1/batch=0").exists()
    table.sweep()
    assert (tmp_path / "log/run=r1/batch=0").exists()               # the dashboard still may read it
    table.passed("dashboard")
    assert table.sweep() == ["run=r1/batch=0"] and not (tmp_path / "log/run=r1/batch=0").exists()


def test_an_older_log_is_adopted(spark, tmp_path):
    table = ChangeLog(spark, str(tmp_path), ZONE_METRICS)
    for n in range(2):
        change_log.write_once(metric_rows(spark, (1, "N", n)), f"{tmp_path}/log", f"run=r1/batch={n}")
    assert contents(table) == []
    table.adopt()
    assert contents(table) == [(1, "N", 1.0)] and len(table.batches()) == 2


def test_an_idle_week_loses_nothing_and_read_folders_are_retired(spark, tmp_path):
    """The reader lies idle for ten days while one file a day arrives, more than the age at which Spark forgets files."""
    root, out = str(tmp_path / "t"), []
    manifest = Manifest(spark, f"{root}/readings")
    schema = spark.createDataFrame([], "event_timestamp timestamp, n long").schema
    start = time.time() - 20 * 86400

    def add(batch):
        rows = spark.range(1).select(F.timestamp_seconds(F.lit(batch * 60)).alias("event_timestamp"), F.lit(batch).cast("long").alias("n"))
        change_log.write_once(rows, f"{root}/readings", f"batch_id={batch}")
        manifest.add(f"batch_id={batch}")
        for file in (tmp_path / "t/readings" / f"batch_id={batch}").iterdir():
            os.utime(file, (start + batch * 86400,) * 2)

    def run():
        stream = enriched_readings(spark, root, schema)
        start_metrics(stream, lambda df, n: out.extend(r.n for r in df.collect()), f"{root}/checkpoint", "available",
                      mode="append").awaitTermination()

    add(0)
    run()
    for batch in range(1, 12):
        add(batch)
    run()
    assert sorted(out) == list(range(12))
    add(12)
    run()                                                            # the files of the second run are archived with the third
    for _ in range(50):
        retire_readings(spark, root, manifest)
        if len(manifest.live()) <= 2:
            break
        time.sleep(0.2)
    assert len(manifest.live()) <= 2 and not (tmp_path / "t/readings/batch_id=3").exists()
    table = enriched_readings(spark, root, schema, streaming=False)
    assert sorted(r.n for r in table.collect()) == list(range(13)) and sorted(out) == list(range(13))
    assert json.loads(json.dumps(manifest.state()))["version"] > 13
