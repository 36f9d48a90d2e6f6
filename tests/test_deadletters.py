"""Dead letters and their replay."""

import json

from gridflow.operators import deadletters as D
from gridflow.operators.orders import resolve, with_running_average
from test_orders import events

AT = "2026-01-01 00:00:00"


def letters(spark):
    frame = events(spark, (1, "A", "Item1", "10", 0, None), (2, "B", "Item2", "-99.99", 0, None),
                   (3, None, "Item3", "7", 0, None), (4, "D", None, "20", 3, None), (5, "E", "Item1", "bad", 0, None))
    return D.dead_letters(resolve(frame), AT)


def requests(spark, *rows):
    return spark.createDataFrame([(i, d, p) for i, (d, p) in enumerate(rows)],
                                 "request_seq bigint, dlq_id string, corrected_price double")


def test_numbered_in_arrival_order(spark):
    rows = letters(spark).orderBy("seq").collect()
    assert [(r.seq, r.dlq_id) for r in rows] == [(2, "DLQ-0001"), (3, "DLQ-0002"), (4, "DLQ-0003"), (5, "DLQ-0004")]
    assert rows[0].error_reason == "Poison pill detected: negative price ($-99.99)"
    assert rows[0].failed_message.price == "-99.99" and not rows[0].replayed
    assert json.loads(rows[0].raw)["orderId"] == "B"
    assert [s.status for s in rows[2].audit_trail] == ["RETRY"] * 3 + ["EXHAUSTED"]
    assert D.dead_letters(resolve(events(spark, (9, "X", "I", "-1", 0, None))), AT, prior_count=41).first().dlq_id == "DLQ-0042"


def test_replay(spark):
    asked = requests(spark, ("DLQ-0001", 45.0), ("DLQ-0003", None), ("DLQ-0002", 45.0), ("DLQ-0004", None),
                     ("DLQ-0001", 99.0), ("DLQ-7777", None))
    outcomes, updated, missing = D.replay(letters(spark), asked, last_seq=5)
    found = {r.dlq_id: (r.seq, r.status, r.price_value and float(r.price_value)) for r in outcomes.collect()}
    assert found == {
        "DLQ-0001": (6, "SUCCESS", 45.0),              # the first of two requests counts
        "DLQ-0002": (7, "DLQ_QUARANTINED", 45.0),      # the order id is still missing
        "DLQ-0003": (8, "SUCCESS", 20.0),              # the transient failures are over
        "DLQ-0004": (9, "DLQ_QUARANTINED", None),      # no price was given
    }
    assert all(r.replayed for r in updated.collect())
    assert [r.dlq_id for r in missing.collect()] == ["DLQ-7777"]


def test_a_letter_is_replayed_once(spark):
    asked = requests(spark, ("DLQ-0001", None))
    outcomes, updated, _ = D.replay(letters(spark), asked, last_seq=5)
    assert [float(r.price_value) for r in outcomes.collect()] == [99.99]
    again, still, missing = D.replay(updated, asked, last_seq=100)
    assert again.isEmpty() and missing.isEmpty()
    assert still.where("replayed").count() == 1


def test_replayed_orders_join_the_average(spark):
    log = resolve(events(spark, (1, "A", "I", "10", 0, None), (2, "B", "I", "-20", 0, None)))
    outcomes, _, _ = D.replay(D.dead_letters(log, AT), requests(spark, ("DLQ-0001", None)), last_seq=2)
    both = with_running_average(log.unionByName(outcomes.drop("dlq_id"))).orderBy("seq").collect()
    assert [r.running_avg for r in both] == [10.0, 10.0, 15.0]


def test_letters_and_requests_are_matched_once(spark, plan_of):
    outcomes, _, _ = D.replay(letters(spark), requests(spark, ("DLQ-0001", 45.0)), last_seq=5)
    assert "min_by" not in plan_of(outcomes).lower()
