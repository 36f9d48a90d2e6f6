"""The order flow against golden cases and a plain model."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from gridflow.operators import orders as O
from gridflow.schemas import ORDER_EVENT
from gridflow.sources.orders import as_order_messages

MALFORMED = "Malformed schema: missing required Avro fields ('orderId', 'price')"


def events(spark, *rows):
    return spark.createDataFrame([dict(zip(ORDER_EVENT.fieldNames(), r)) for r in rows], ORDER_EVENT)


def one(spark, price="10.0", failures=0, permanent=None, order_id="ORD-1", product="Item1", retries=3):
    frame = O.with_audit_trail(O.resolve(events(spark, (1, order_id, product, price, failures, permanent)), retries))
    return frame.first()


def trail(row):
    return [(s.attempt, s.status) for s in row.audit_trail]


def test_valid_order(spark):
    row = one(spark)
    assert (row.status, row.attempts, row.error_reason, trail(row)) == ("SUCCESS", 1, None, [(1, "SUCCESS")])
    assert row.audit_trail[0].note == "Avro message validated and processed on attempt 1"


def test_recovered_order(spark):
    row = one(spark, failures=2)
    assert (row.status, row.attempts) == ("RECOVERED_AFTER_RETRY", 3)
    assert trail(row) == [(1, "RETRY"), (2, "RETRY"), (3, "SUCCESS")]
    assert [s.backoff_sec for s in row.audit_trail] == [0.15, 0.3, None]


@pytest.mark.parametrize("failures", [3, 4, 100])
def test_exhausted_order(spark, failures):
    row = one(spark, failures=failures)
    assert (row.status, row.attempts, row.error_reason) == ("DLQ_QUARANTINED", 3, "Max retries (3) exceeded")
    assert trail(row) == [(1, "RETRY"), (2, "RETRY"), (3, "RETRY"), (3, "EXHAUSTED")]


@pytest.mark.parametrize("price, order_id, permanent, reason", [
    ("-99.99", "ORD-1", None, "Poison pill detected: negative price ($-99.99)"),
    (None, "ORD-1", None, MALFORMED),
    ("5", None, None, MALFORMED),
    ("abc", "ORD-1", None, "could not convert string to float: 'abc'"),
    ("NaN", "ORD-1", None, "non-finite price"),
    ("Infinity", "ORD-1", None, "non-finite price"),
    ("5", "ORD-1", "disk", "Forced poison pill: disk"),
    ("-1", "ORD-1", "disk", "Poison pill detected: negative price ($-1.00)"),
])
def test_permanent_errors_win_at_the_first_attempt(spark, price, order_id, permanent, reason):
    row = one(spark, price, 2, permanent, order_id)
    assert (row.status, row.attempts, row.error_reason) == ("DLQ_QUARANTINED", 1, reason)
    assert trail(row) == [(1, "FATAL")]


@pytest.mark.parametrize("price, value", [("1e12", 1e12), ("2500000000000", 2.5e12), ("0.005", 0.005), (" 7.125 ", 7.125), ("0", 0.0)])
def test_prices_count_as_they_stand(spark, price, value):
    row = one(spark, price)
    assert (row.status, row.price_value) == ("SUCCESS", value)


@pytest.mark.parametrize("price", ["-0.001", "-0.004", "-1e-9", "-1e300"])
def test_any_negative_price_is_refused(spark, price):
    assert one(spark, price).error_reason.startswith("Poison pill detected: negative price")


def test_exact_prices(spark):
    def reason(price):
        return O.classify(events(spark, (1, "A", "I", price, 0, None)), "decimal(6,2)").first()
    assert float(reason("9999.99").price_value) == 9999.99 and reason("9999.99").error_reason is None
    assert reason("10000").error_reason == "price does not fit decimal(6,2)"
    assert reason("-0.001").error_reason == "Poison pill detected: negative price ($-0.00)"


def test_trail_is_made_after_the_shuffle(spark, plan_of):
    plan = plan_of(O.process_orders(events(spark, (1, "A", "I", "1", 0, None)).repartition(2)))
    exchanges = [block for block in plan.split("\n\n") if ") Exchange" in block]
    assert exchanges and not any("audit_trail" in block for block in exchanges)


def test_other_retry_limits(spark):
    assert one(spark, failures=4, retries=5).attempts == 5
    row = one(spark, failures=1, retries=1)
    assert (row.status, row.error_reason) == ("DLQ_QUARANTINED", "Max retries (1) exceeded")


def test_running_average_and_placeholders(spark):
    frame = events(spark, (1, "A", "Item1", "10", 0, None), (2, "B", None, "20", 0, None),
                   (3, None, "Item2", "-50", 0, None), (4, "D", "Item1", "60", 0, None))
    rows = O.process_orders(frame).orderBy("seq").collect()
    assert [r.running_avg for r in rows] == [10.0, 15.0, 15.0, 30.0]
    assert [r.total_orders for r in rows] == [1, 2, 2, 3]
    assert rows[1].product == "Unknown" and rows[1].status == "SUCCESS"
    assert rows[2].orderId == "UNKNOWN" and rows[2].status == "DLQ_QUARANTINED"
    assert O.process_orders(events(spark, (1, "A", "I", None, 0, None))).first().price == "0"


def test_no_accepted_order(spark):
    frame = O.resolve(events(spark, (1, "A", "Item1", "-1", 0, None)))
    assert O.with_running_average(frame).first().running_avg == 0.0
    assert O.average_price(frame).first().avg_price == 0.0
    assert O.average_price(frame.limit(0)).first().avg_price == 0.0
    assert O.order_kpis(frame.limit(0)).first().asDict() == {
        "total_orders": 0, "success_count": 0, "retries_count": 0, "dlq_count": 0}


def random_orders(seed, count=400):
    rng = random.Random(seed)
    rows = []
    for seq in range(count):
        price = rng.choice([f"{rng.randrange(1, 30000) / 100:.2f}"] * 8 + ["-3.10", "oops", None, "NaN"])
        rows.append((seq * rng.choice([1, 1, 3]) + 1000 * seq, rng.choice(["A", "B", None, "C", "D", "E"]),
                     rng.choice(["Item1", None]), price, rng.choice([0] * 6 + [1, 2, 3, 4]),
                     rng.choice([None] * 20 + ["x"])))
    return rows


def model(rows, limit=3):
    """Message by message, with a counter and a sum."""
    count, total, out = 0, Decimal(0), {}
    for seq, order_id, _, price, failures, permanent in sorted(rows, key=lambda r: r[0]):
        try:
            number = Decimal(price)
            bad = order_id is None or not number.is_finite() or number < 0 or permanent
        except Exception:
            bad = True
        if bad:
            status, attempts = "DLQ_QUARANTINED", 1
        elif failures >= limit:
            status, attempts = "DLQ_QUARANTINED", limit
        else:
            status, attempts = ("RECOVERED_AFTER_RETRY" if failures else "SUCCESS"), failures + 1
            count, total = count + 1, total + number
        mean = (total / count).quantize(Decimal("0.01"), ROUND_HALF_UP) if count else Decimal(0)
        out[seq] = (status, attempts, count, float(mean))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_the_model(spark, seed):
    rows = random_orders(seed)
    resolved = O.resolve(events(spark, *rows).repartition(6), price_type="decimal(24,6)")
    found = O.with_running_average(resolved, bits=6).collect()
    assert {r.seq: (r.status, r.attempts, r.total_orders, r.running_avg) for r in found} == model(rows)
    last = model(rows)[max(r[0] for r in rows)]
    assert O.average_price(resolved).first().avg_price == last[3]
    assert O.order_kpis(resolved).first().total_orders == last[2]
    assert O.accepted(resolved).count() + O.rejected(resolved).count() == len(rows)


def test_newest(spark):
    frame = spark.range(100).withColumnRenamed("id", "seq")
    assert [r.seq for r in O.newest(frame, 3).collect()] == [99, 98, 97]
    assert [r.seq for r in O.newest_oldest_first(frame, 3).collect()] == [97, 98, 99]


def test_message_schema(spark):
    message = as_order_messages(events(spark, (1, "A", "Item1", "10.5", 0, None)))
    assert message.schema.simpleString() == "struct<orderId:string,product:string,price:float>"
    assert message.first().price == 10.5


def test_trail_stays_in_generated_code(spark, plan_of):
    plan = plan_of(O.process_orders(events(spark, (1, "A", "Item1", "10", 0, None)).where(F.col("seq") > 0)))
    assert "EvalPython" not in plan and "MapInPandas" not in plan
