"""The as-of join and tariff intervals against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridflow.operators.asof import as_of, hot_keys
from gridflow.operators.enrich import enrich_as_of
from gridflow.operators.tariffs import latest_tariffs, tariff_intervals
from gridflow.fixed_values import DEFAULT_RATE

DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else DAY + dt.timedelta(minutes=minutes)


def made_up(seed, facts=600, changes=120):
    """A third of the facts on one key, some of them all at one time, some without a key or a time."""
    rng = random.Random(seed)
    keys = ["hot"] * 4 + ["a", "b", "c", "d", "unchanged", None]
    rows = []
    for n in range(facts):
        when = None if n % 50 == 7 else rng.choice([500, rng.randrange(1000), rng.randrange(1000)])
        rows.append((n, rng.choice(keys), at(when), "extra"))
    log = {}
    for n in range(changes):
        key = rng.choice(["hot", "hot", "a", "b", "c", "d", "never asked", None])
        log[key, at(rng.randrange(1000) if n % 20 else None)] = n
    return rows, [(k, t, n, n * 2) for (k, t), n in log.items()]


def by_hand(rows, changes):
    out = {}
    for n, key, when, _ in rows:
        own = [(t, v, w) for k, t, v, w in changes if None not in (k, t, when) and k == key and t <= when]
        out[n] = max(own) if own else (None, None, None)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("share, least", [(1 / 4096, 100_000), (0.05, 10), (0.0001, 3)])
def test_as_of(spark, seed, share, least):
    rows, changes = made_up(seed)
    facts = spark.createDataFrame(rows, "n int, household_id string, event_timestamp timestamp, _time string").repartition(3)
    log = spark.createDataFrame(changes, "household_id string, since timestamp, v int, w int").repartition(2)
    found = as_of(facts, log, "household_id", "event_timestamp", "since", ["v", "w"], share, least)
    assert found.columns == [*facts.columns, "since", "v", "w"]
    got = found.collect()
    assert len(got) == len(rows)
    assert {r.n: (r.since, r.v, r.w) for r in got} == by_hand(rows, changes)


def test_a_hot_household_is_cut_into_slots(spark):
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        (F.lit(DAY) + F.make_dt_interval(secs=F.col("id"))).alias("at"))
    hot = hot_keys(facts, "key", "at", share=0.01, least=10).collect()
    assert [(r._key, r._slots) for r in hot] == [("hot", 34)]
    assert hot[0]._width * 34 >= 9000 * 10 ** 6 - 3 * 10 ** 6


def test_facts_are_shuffled_once(spark, plan_of):
    rows, changes = made_up(4)
    facts = spark.createDataFrame(rows, "n int, household_id string, event_timestamp timestamp, x string")
    log = spark.createDataFrame(changes, "household_id string, since timestamp, v int, w int")
    plan = plan_of(as_of(facts, log, "household_id", "event_timestamp", "since", ["v"]))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan


def test_columns_on_both_sides_are_refused(spark):
    facts = spark.createDataFrame([], "k string, at timestamp, v int")
    with pytest.raises(ValueError, match="'v'"):
        as_of(facts, spark.createDataFrame([], "k string, since timestamp, v int"), "k", "at", "since", ["v"])


def history(spark, rows):
    return spark.createDataFrame(
        [(h, at(t), r, "T", f, o) for h, t, r, f, o in rows],
        "household_id string, effective_timestamp timestamp, tariff_rate double, billing_tier string, subsidy_flag int, "
        "row_order int")


def test_intervals(spark):
    rows = [("a", 0, 0.1, 0, 1), ("a", 10, 0.1, 0, 1), ("a", 20, 0.2, 0, 1), ("a", 30, 0.1, 0, 1),   # goes back
            ("b", 0, 0.1, 0, 1), ("b", 20, 0.1, 0, 1), ("b", 30, 0.1, 0, 1),                          # left out at 10
            ("c", 10, None, 1, 1), ("c", 20, None, 1, 1),                                             # unreadable rate, ends
            ("d", 30, 0.5, 0, 1), ("d", 30, 0.6, 0, 3), ("d", 30, 0.7, 0, 2),                         # three rows in one drop
            (None, 40, 0.1, 0, 1), ("e", None, 0.1, 0, 1)]
    found = {tuple(r) for r in tariff_intervals(history(spark, rows)).select(
        "household_id", "valid_from", "valid_to", "tariff_rate", "drops").collect()}
    assert found == {
        ("a", at(0), at(20), 0.1, 2), ("a", at(20), at(30), 0.2, 1), ("a", at(30), None, 0.1, 1),
        ("b", at(0), at(10), 0.1, 1), ("b", at(20), None, 0.1, 2), ("c", at(10), at(30), None, 2), ("d", at(30), None, 0.6, 1)}
    assert {r.household_id: r.tariff_rate for r in latest_tariffs(history(spark, rows[:-2])).collect()} == {
        "a": 0.1, "b": 0.1, "c": None, "d": 0.6}
    assert tariff_intervals(history(spark, [])).isEmpty()


def test_a_reading_takes_the_price_of_its_time(spark):
    intervals = tariff_intervals(history(spark, [("a", 10, 0.1, 0, 1), ("a", 20, 0.3, 1, 1), ("b", 30, 0.2, 0, 1)]))
    times = (5, 10, 19, 20, 29, 30, 31)
    readings = spark.createDataFrame([(h, at(t), 10.0, 4.0) for h in ("a", "b", "z") for t in times],
                                     "household_id string, event_timestamp timestamp, power_consumption_kwh double, "
                                     "solar_generation_kwh double")
    found = {(r.household_id, r.event_timestamp): (r.tariff_rate, round(r.estimated_cost, 6))
             for r in enrich_as_of(readings, intervals).collect()}
    default = (float(DEFAULT_RATE), round(10 * float(DEFAULT_RATE), 6))
    assert [found["a", at(t)] for t in times] == [default, (0.1, 1.0), (0.1, 1.0), (0.3, 2.55), (0.3, 2.55), default, default]
    assert [found["b", at(t)] for t in times] == [default] * 5 + [(0.2, 2.0)] * 2
    assert {found["z", at(t)] for t in times} == {default}
