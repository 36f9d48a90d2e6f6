"""The newest rows across batches against a sort of everything that holds."""

import random

import pytest

from gridflow.streaming.recent import RecentRows

SCHEMA = "seq long, zone string, value int, retracted boolean"


@pytest.mark.parametrize("keys, count, spare", [((), 4, 1), (("zone",), 2, 1), (("zone",), 3, 50)])
def test_corrections_and_retractions(spark, tmp_path, keys, count, spare):
    rng, held = random.Random(count + spare), {}
    log = lambda: spark.createDataFrame([(n, *v, False) for n, v in held.items()], SCHEMA).drop("retracted")
    recent = RecentRows(spark, str(tmp_path), count, "seq", keys, spare=spare, log=log)
    for batch in range(7):
        rows = {}
        for _ in range(rng.choice([0, 3, 12])):
            rows[rng.randrange(60)] = (rng.choice(["a", "b", None]), rng.randrange(99), rng.random() < 0.2)
        if batch in (3, 6):                                              # takes back the newest
            rows |= {n: (*held[n], True) for n in sorted(held)[-8:]}
        for n, (zone, value, gone) in rows.items():
            held.pop(n, None)
            if not gone:
                held[n] = (zone, value)
        frame = spark.createDataFrame([(n, *v) for n, v in rows.items()], SCHEMA)
        recent.write(frame, batch)
        recent.write(frame.limit(0), batch)                              # the batch runs again: nothing changes
        wanted = []
        for zone in {v[0] for v in held.values()} if keys else [...]:
            own = sorted((n for n, v in held.items() if zone is ... or v[0] == zone), reverse=True)[:count]
            wanted += [(n, *held[n]) for n in own]
        assert sorted(map(tuple, recent.read().collect()), key=str) == sorted(wanted, key=str)
        stored = spark.read.parquet(f"{tmp_path}/merged/batch={batch}").groupBy("_key").count().collect()
        assert all(r["count"] <= count + spare for r in stored)
    assert (recent.refills > 0) == (spare < 50)
    assert len(list((tmp_path / "merged").glob("batch=*"))) <= 2


def test_without_a_log_what_was_pushed_out_is_gone(spark, tmp_path):
    recent = RecentRows(spark, str(tmp_path), 2, "seq", spare=0)
    recent.write(spark.createDataFrame([(n, "a", 0, False) for n in range(5)], SCHEMA), 0)
    recent.write(spark.createDataFrame([(4, "a", 0, True)], SCHEMA), 1)
    assert [r.seq for r in recent.read().collect()] == [3]
