"""Keyed state: totals by product across restarts, and messages that wait for their retry, against the batch forms."""

import itertools

import pytest
from pyspark.sql import functions as F

from gridflow.operators.orders import resolve, with_audit_trail
from gridflow.schemas import ORDER_EVENT
from gridflow.streaming import keyed as K

PRICE = "decimal(12,2)"


def orders(spark, rows):
    return spark.createDataFrame([dict(zip(ORDER_EVENT.fieldNames(), r)) for r in rows], ORDER_EVENT)


def some_orders(count, start=0):
    """Most of them of one product, some without any, some refused, some failing for a time."""
    for n in range(start, start + count):
        product = "hot" if n % 3 else (None if n % 5 == 0 else f"p{n % 4}")
        yield n, f"ORD-{n}", product, None if n % 17 == 3 else str((n * 37 % 1000) / 100), n % 5 if n % 7 == 0 else 0, \
            "disk" if n % 31 == 4 else None


class Files:
    """Orders as Parquet files that a stream finds; each call adds one."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def add(self, rows):
        orders(self.spark, rows).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(ORDER_EVENT).parquet(self.folder)


def by_product(resolved):
    good = F.col("status") != "DLQ_QUARANTINED"
    rows = resolved.groupBy(F.coalesce("product", F.lit("Unknown")).alias("product")).agg(
        F.count_if(good).alias("orders"), F.count_if(~good).alias("rejects"),
        F.coalesce(F.sum(F.when(good, F.col("price_value"))), F.lit(0)).alias("total"))
    return {r.product: (r.orders, r.rejects, r.total) for r in rows.collect()}


def test_totals_go_on_from_history_and_over_a_restart(spark, tmp_path):
    files, rows = Files(spark, tmp_path / "in"), list(some_orders(900))
    history = K.history_totals(orders(spark, rows[:300]), price_type=PRICE)
    table = K.TotalsTable(spark, str(tmp_path / "totals"), history)
    for part in (rows[300:500], rows[500:]):
        files.add(part)
        totals = K.product_totals(files.stream(), history, price_type=PRICE)
        K.start_totals(totals, table, str(tmp_path / "checkpoint"), "available").awaitTermination()
    found = {r.product: (r.orders, r.rejects, r.total) for r in table.by_product().collect()}
    assert found == by_product(resolve(orders(spark, rows), price_type=PRICE))
    keys = spark.read.parquet(str(tmp_path / "totals")).where("product = 'hot'").select("salt").distinct().count()
    assert keys == K.SALTS                                          # the hot product is no single key


def test_totals_without_history(spark, tmp_path):
    files, rows = Files(spark, tmp_path / "in"), list(some_orders(60))
    files.add(rows)
    table = K.TotalsTable(spark, str(tmp_path / "totals"))
    K.start_totals(K.product_totals(files.stream()), table, str(tmp_path / "checkpoint"), "available").awaitTermination()
    wanted = by_product(resolve(orders(spark, rows)))
    assert {r.product: (r.orders, r.rejects, pytest.approx(r.total)) for r in table.by_product().collect()} == wanted


def run_until(query, table, count, seconds=120):
    for _ in range(seconds * 5):
        if table.stored >= count or not query.isActive:
            break
        query.awaitTermination(0.2)
    assert query.exception() is None and table.stored >= count
    query.stop()


@pytest.mark.parametrize("most", [1, 3])
def test_waiting_messages_end_as_in_a_batch(spark, tmp_path, most):
    """For each number of failures, with and without a permanent error; a restart while some wait, and one message sent twice."""
    rows = [(n, f"ORD-{n}", "p", price, failures, error) for n, (failures, price, error) in enumerate(itertools.product(
        (0, 1, 2, 3, 4, -1, None), ("5.00", "-1", None), (None, "disk")))]
    files, table = Files(spark, tmp_path / "in"), K.OutcomeTable(spark, str(tmp_path / "outcomes"))
    half = rows[:21]
    files.add(half)
    now = resolve(orders(spark, half), most, PRICE).where("retries = 0 or attempts = 1").count()

    def start(backoff):
        outcomes = K.parked_retries(files.stream(), most, backoff, PRICE)
        return K.start_parked(outcomes, table, str(tmp_path / "checkpoint"))

    run_until(start(30.0), table, now)
    assert table.stored == now                                      # the others wait half a minute, longer than this run
    first = {r.seq for r in table.outcomes().collect()}
    waiting = [r for r in half if r[0] not in first]
    assert (most == 1) == (waiting == [])
    files.add(rows[21:] + waiting[:1])
    run_until(start(0.05), table, len(rows))
    found = with_audit_trail(resolve(orders(spark, rows), most, PRICE)).select(
        "seq", "status", "attempts", "retries", "error_reason", "audit_trail")
    key = lambda r: r.seq
    assert sorted(table.outcomes().select(*found.columns).collect(), key=key) == sorted(found.collect(), key=key)


def test_both_run_in_a_session_with_another_state_store(spark, tmp_path):
    """The session's own setting is left as it was; messages that need not wait never come to the state."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before, other = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    files, rows = Files(spark, tmp_path / "in"), list(some_orders(60))
    files.add(rows)
    totals, outcomes = K.TotalsTable(spark, str(tmp_path / "totals")), K.OutcomeTable(spark, str(tmp_path / "outcomes"))
    spark.conf.set(name, other)
    try:
        K.start_totals(K.product_totals(files.stream(), price_type=PRICE), totals, str(tmp_path / "c1"), "available").awaitTermination()
        query = K.start_parked(K.parked_retries(files.stream(), backoff_s=0.05, price_type=PRICE), outcomes, str(tmp_path / "c2"))
        run_until(query, outcomes, 60)
        assert spark.conf.get(name) == other
    finally:
        spark.conf.set(name, before)
    assert outcomes.outcomes().count() == 60
    states = [p.stateOperators[0].customMetrics for p in query.recentProgress if p.stateOperators]
    wait = sum(1 for r in rows if r[3] is not None and r[4] and r[5] is None)
    assert sum(m.get("numRegisteredTimers", 0) for m in states) >= wait > 0
    found = {r.product: (r.orders, r.rejects, r.total) for r in totals.by_product().collect()}
    assert found == by_product(resolve(orders(spark, rows), price_type=PRICE))


def test_many_waiting_messages_share_state_and_timers(spark, tmp_path, monkeypatch):
    """Timers and state grow with the keys that messages are dealt over, not with the messages; some come twice in a batch, one
    comes again while it waits, and those without a number are one."""
    monkeypatch.setattr(K, "BUCKETS", 5, raising=False)
    rows = [(None if n < 3 else n, f"ORD-{n}", None if n % 4 else "p", "5.00", 1 + n % 4, None) for n in range(1500)]
    files, table = Files(spark, tmp_path / "in"), K.OutcomeTable(spark, str(tmp_path / "outcomes"))
    files.add(rows + rows[100:200])

    def start(backoff):
        return K.start_parked(K.parked_retries(files.stream(), 3, backoff, PRICE), table, str(tmp_path / "checkpoint"))

    def timers(query):
        return [p.stateOperators[0].customMetrics.get("numRegisteredTimers", 0) for p in query.recentProgress if p.stateOperators]

    query = start(60.0)
    for _ in range(600):
        if sum(timers(query)) or not query.isActive:
            break
        query.awaitTermination(0.2)
    query.stop()
    assert query.exception() is None and 0 < sum(timers(query)) <= 6
    files.add(rows[700:701])
    query = start(0.05)
    spark.range(1).count()
    run_until(query, table, 1498)
    assert sum(timers(query)) <= 4 * 6
    seqs, found = {n for n in range(3, 1500)}, table.outcomes().collect()
    wanted = {r.seq: r for r in with_audit_trail(resolve(orders(spark, rows[3:]), 3, PRICE)).collect()}
    assert sorted(r.seq for r in found if r.seq is not None) == sorted(seqs) and sum(r.seq is None for r in found) == 1
    for r in found:
        if r.seq is not None:
            columns = ("orderId", "product", "price", "status", "attempts", "retries", "error_reason", "audit_trail")
            assert [r[c] for c in columns] == [wanted[r.seq][c] for c in columns] and r.parked_ms > 0
