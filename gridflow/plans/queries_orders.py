"""Registered queries on the order flow and its dead letters."""

from pyspark.sql import functions as F

from ..operators import deadletters, orders
from ..sources.orders import as_order_messages, read_order_json
from ..session import run_dir
from ..sinks.files import append_rows
from ..sinks.prefix_log import PrefixLog
from . import inputs as I
from .jobs import run_orders, run_replay, status_snapshot, stored_letters, stored_outcomes
from .oracle_parts import LETTERS, METRICS, ORDERS, RESOLVED, RUNNING, half_up_average, price_double
from .queries_readings import as_double, plain_time
from .queries_tariffs import dq_tariff_gate
from .queries_zones import metrics

AT = "2024-02-01 00:00:00"


def _resolved(spark, sf):
    return orders.resolve(I.orders(spark, sf), price_type=I.PRICE)


def _running(spark, sf):
    return orders.with_running_average(_resolved(spark, sf))


def _letters(spark, sf):
    """The dead letters, appended to their table and read back from there."""
    folder = run_dir(spark, "dead-letters")
    append_rows(deadletters.dead_letters(_resolved(spark, sf), AT), folder)
    return spark.read.parquet(folder)


def _requests(spark, sf):
    return deadletters.first_requests(I.replay_requests(spark, sf), "request_seq")


def src_orders(spark, sf):
    """Order messages written as JSON lines and read back."""
    folder = run_dir(spark, "orders")
    I.orders(spark, sf).write.json(folder)
    return read_order_json(spark, folder).select(
        "seq", "orderId", "product", F.col("price").cast("double").alias("price"),
        "transient_failures", "permanent_error")


def order_message(spark, sf):
    """Orders in the message schema, whose price is a 32-bit float."""
    return as_order_messages(I.orders(spark, sf)).select("orderId", "product", *as_double("price"))


def order_classify(spark, sf):
    return orders.classify(I.orders(spark, sf), I.PRICE).select("seq", "orderId", *as_double("price_value"), "error_reason")


OUTCOME = ["seq", "orderId", "status", "attempts", "error_reason"]


def order_retry_outcome(spark, sf):
    return _resolved(spark, sf).select(*OUTCOME, "retries")


def order_audit_trail(spark, sf):
    return orders.audit_steps(_resolved(spark, sf))


def order_split_accepted(spark, sf):
    return orders.accepted(_resolved(spark, sf)).select(*OUTCOME, *as_double("price_value"))


def order_split_rejected(spark, sf):
    return orders.rejected(_resolved(spark, sf)).select(*OUTCOME, *as_double("price_value"))


def order_avg_price(spark, sf):
    return orders.average_price(_resolved(spark, sf))


def order_kpis(spark, sf):
    return orders.order_kpis(_resolved(spark, sf))


def order_running_avg(spark, sf):
    return _running(spark, sf).select("seq", "status", "total_orders", "running_avg")


def order_outcomes(spark, sf):
    """The full outcome of every order, its audit trail as text."""
    rows = orders.process_orders(I.orders(spark, sf), price_type=I.PRICE)
    steps = F.transform("audit_trail", lambda s: F.concat(s["attempt"].cast("string"), F.lit(":"), s["status"]))
    return rows.select("seq", "orderId", "product", "price", "status", "attempts", "running_avg", "total_orders",
                       F.array_join(steps, " ").alias("trail"))


def running_avg_tail(spark, sf):
    return orders.newest(_running(spark, sf), 40).select("seq", "running_avg")


def recent_orders(spark, sf):
    return orders.newest(_resolved(spark, sf), 50).select(*OUTCOME)


def recent_dlq(spark, sf):
    return orders.newest_oldest_first(_letters(spark, sf), 20).select("seq", "dlq_id", "error_reason")


def _letter_columns(letters):
    message = F.col("failed_message")
    return letters.select("seq", "dlq_id", message["orderId"].alias("orderId"), message["product"].alias("product"),
                          message["price"].alias("price"), "error_reason", plain_time("timestamp"), "replayed")


def sink_dlq(spark, sf):
    return _letter_columns(_letters(spark, sf))


def dlq_sequence(spark, sf):
    return deadletters.dead_letters(_resolved(spark, sf), AT).select("seq", "dlq_id")


def dlq_replay_match(spark, sf):
    return deadletters.match_requests(_letters(spark, sf), _requests(spark, sf)).select(
        "dlq_id", "seq", "corrected_price")


def dlq_replay_missing(spark, sf):
    return deadletters.missing_requests(_letters(spark, sf), _requests(spark, sf)).select("dlq_id", "corrected_price")


def dlq_repair(spark, sf):
    repaired = deadletters.repair(deadletters.match_requests(_letters(spark, sf), _requests(spark, sf)))
    return repaired.select("dlq_id", "orderId", F.col("price").cast("double").alias("price"))


def _replayed(spark, sf):
    last = I.orders(spark, sf).agg(F.max("seq")).first()[0]
    return deadletters.replay(_letters(spark, sf), I.replay_requests(spark, sf), last, price_type=I.PRICE)


def dlq_replay(spark, sf):
    outcomes, _, _ = _replayed(spark, sf)
    return outcomes.select("dlq_id", "orderId", "seq", "status", "attempts", "error_reason", *as_double("price_value"))


def dlq_replay_marks(spark, sf):
    _, letters, _ = _replayed(spark, sf)
    return letters.select("dlq_id", "replayed")


def dlq_replay_log(spark, sf):
    """The order log with the replayed messages put back at its end, averaged anew."""
    outcomes, _, _ = _replayed(spark, sf)
    both = _resolved(spark, sf).unionByName(outcomes.drop("dlq_id"))
    return orders.with_running_average(both).select("seq", "status", "total_orders", "running_avg")


def order_job(spark, sf):
    """The job run twice under one name: outcomes and letters are there once."""
    root = run_dir(spark, "order-job")
    for _ in range(2):
        log = run_orders(I.orders(spark, sf), root, AT, price_type=I.PRICE, run="day1")
    letters = stored_letters(spark, root).select("seq", "dlq_id")
    return log.join(letters, "seq", "left").select("seq", "status", "attempts", "total_orders", "running_avg", "dlq_id")


def order_log_insert(spark, sf):
    """A log whose orders come in three parts, each between those before, and some once more with another price; small buckets, so
    that the tree has several levels."""
    log, resolved = PrefixLog(spark, run_dir(spark, "order-log"), bits=9, fan=2), _resolved(spark, sf)
    other = F.col("price_value") + F.lit(1).cast(I.PRICE)
    wrong = resolved.where("seq % 3 = 0").withColumn("price_value", F.when(F.col("seq") % 9 == 0, other).otherwise(
        F.col("price_value")).cast(I.PRICE))
    for rows in (wrong, resolved.where("seq % 3 = 2"), resolved.where("seq % 3 = 1 or seq % 9 = 0")):
        log.write(rows)
    return log.read().select("seq", "status", "total_orders", "total_rejects", "running_avg")


def dlq_replay_stored(spark, sf):
    """Letters replayed into the stored log; asking again for the same ones changes nothing."""
    root = run_dir(spark, "order-replay")
    run_orders(I.orders(spark, sf), root, AT, price_type=I.PRICE)
    for run in ("one", "two"):
        run_replay(spark, root, I.replay_requests(spark, sf), AT, run, price_type=I.PRICE)
    return stored_outcomes(spark, root).select("seq", "status", "total_orders", "running_avg")


def system_status(spark, sf):
    snapshot = status_snapshot(_resolved(spark, sf), I.batches_by_day(spark, sf), metrics(spark, sf),
                               dq_tariff_gate(spark, sf))
    zone = F.transform("latest_zones", lambda z: F.concat(z["grid_zone"], F.lit("="), z["net_load_kwh"].cast("string")))
    return snapshot.withColumn("latest_zones", F.array_join(zone, " "))


def queries():
    found = [src_orders, order_message, order_classify, order_retry_outcome, order_audit_trail, order_split_accepted,
             order_split_rejected, order_avg_price, order_kpis, order_running_avg, order_outcomes, running_avg_tail,
             recent_orders, recent_dlq, sink_dlq, dlq_sequence, dlq_replay_match, dlq_replay_missing, dlq_repair,
             dlq_replay, dlq_replay_marks, dlq_replay_log, order_job, order_log_insert, dlq_replay_stored, system_status]
    return {f.__name__: f for f in found}


OUTCOME_SQL = "seq, orderId, status, attempts, error_reason"
ASKED = LETTERS + ", asked AS (SELECT * FROM letters JOIN requests USING (dlq_id))"
REPAIRED_PRICE = "CASE WHEN corrected_price IS NOT NULL THEN CAST(abs(corrected_price) AS DECIMAL(24,3)) ELSE abs(price_value) END"
REPLAYED = ASKED + f""", replayed AS (
  SELECT dlq_id, seq, orderId, product, {REPAIRED_PRICE} AS price_value,
         (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY seq) AS new_seq FROM asked)"""
AVERAGE_SQL = half_up_average("mills", "CAST(n AS HUGEINT)")

REPLAY_LOG = f"""WITH {REPLAYED}, log AS (
            SELECT seq, status, price_value FROM resolved UNION ALL
            SELECT new_seq, 'SUCCESS', price_value FROM replayed),
            sums AS (SELECT seq, status,
              CAST(count(*) FILTER (status <> 'DLQ_QUARANTINED') OVER w AS BIGINT) AS n,
              coalesce(sum(CAST(price_value * 1000 AS HUGEINT)) FILTER (status <> 'DLQ_QUARANTINED') OVER w, 0) AS mills
              FROM log WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING))
            SELECT seq, status, n AS total_orders, {AVERAGE_SQL} AS running_avg FROM sums"""


def oracles():
    kpis = """count(*) FILTER (status <> 'DLQ_QUARANTINED') AS total_orders,
        count(*) FILTER (status <> 'DLQ_QUARANTINED') AS success_count,
        CAST(sum(retries) AS BIGINT) AS retries_count, count(*) FILTER (status = 'DLQ_QUARANTINED') AS dlq_count"""
    total = """SELECT sum(CAST(price_value * 1000 AS HUGEINT)) AS mills, count(*) AS n
        FROM resolved WHERE status <> 'DLQ_QUARANTINED'"""
    return {
        "src_orders": f"""WITH {ORDERS} SELECT seq, orderId, product, {price_double()} AS price,
            f AS transient_failures, permanent_error FROM orders_in""",
        "order_message": f"""WITH {ORDERS} SELECT orderId, product,
            CAST(CAST(CAST(price_value AS VARCHAR) AS FLOAT) AS DOUBLE) AS price FROM orders_in""",
        "order_classify": f"""WITH {ORDERS} SELECT seq, orderId, {price_double()} AS price_value,
            problem AS error_reason FROM checked""",
        "order_retry_outcome": f"WITH {RESOLVED} SELECT {OUTCOME_SQL}, retries FROM resolved",
        "order_audit_trail": f"""WITH {RESOLVED}
            SELECT seq, orderId, CAST(n AS INTEGER) AS attempt, 'RETRY' AS status, CAST(NULL AS VARCHAR) AS note,
              'Simulated transient socket timeout (Kafka broker ack timeout)' AS error,
              round(n * 0.15, 2)::DOUBLE AS backoff_sec
            FROM resolved, (VALUES (1), (2), (3)) AS r(n) WHERE n <= retries
            UNION ALL
            SELECT seq, orderId, attempts, CASE WHEN status <> 'DLQ_QUARANTINED' THEN 'SUCCESS'
                WHEN problem IS NOT NULL THEN 'FATAL' ELSE 'EXHAUSTED' END,
              CASE WHEN status <> 'DLQ_QUARANTINED'
                THEN 'Avro message validated and processed on attempt ' || CAST(attempts AS VARCHAR) END,
              error_reason, NULL FROM resolved""",
        "order_split_accepted": f"""WITH {RESOLVED} SELECT {OUTCOME_SQL}, {price_double()} AS price_value
            FROM resolved WHERE status <> 'DLQ_QUARANTINED'""",
        "order_split_rejected": f"""WITH {RESOLVED} SELECT {OUTCOME_SQL}, {price_double()} AS price_value
            FROM resolved WHERE status = 'DLQ_QUARANTINED'""",
        "order_avg_price": f"WITH {RESOLVED} SELECT {AVERAGE_SQL} AS avg_price FROM ({total})",
        "order_kpis": f"WITH {RESOLVED} SELECT {kpis} FROM resolved",
        "order_log_insert": f"WITH {RUNNING} SELECT seq, status, total_orders, total_rejects, running_avg FROM running",
        "order_running_avg": f"WITH {RUNNING} SELECT seq, status, total_orders, running_avg FROM running",
        "order_outcomes": f"""WITH {RUNNING} SELECT seq, orderId, coalesce(product, 'Unknown') AS product,
            CAST(price_value AS VARCHAR) AS price, status, attempts, running_avg, total_orders,
            CASE WHEN retries >= 1 THEN '1:RETRY ' ELSE '' END || CASE WHEN retries >= 2 THEN '2:RETRY ' ELSE '' END ||
            CASE WHEN retries >= 3 THEN '3:RETRY ' ELSE '' END || CAST(attempts AS VARCHAR) ||
            CASE WHEN status <> 'DLQ_QUARANTINED' THEN ':SUCCESS' WHEN problem IS NOT NULL THEN ':FATAL'
              ELSE ':EXHAUSTED' END AS trail FROM running""",
        "running_avg_tail": f"WITH {RUNNING} SELECT seq, running_avg FROM running ORDER BY seq DESC LIMIT 40",
        "recent_orders": f"WITH {RESOLVED} SELECT {OUTCOME_SQL} FROM resolved ORDER BY seq DESC LIMIT 50",
        "recent_dlq": f"WITH {LETTERS} SELECT seq, dlq_id, error_reason FROM letters ORDER BY seq DESC LIMIT 20",
        "sink_dlq": f"""WITH {LETTERS} SELECT seq, dlq_id, orderId, product, CAST(price_value AS VARCHAR) AS price,
            error_reason, TIMESTAMP '{AT}' AS timestamp, false AS replayed FROM letters""",
        "dlq_sequence": f"WITH {LETTERS} SELECT seq, dlq_id FROM letters",
        "dlq_replay_match": f"WITH {ASKED} SELECT dlq_id, seq, corrected_price FROM asked",
        "dlq_replay_missing": f"""WITH {LETTERS} SELECT dlq_id, corrected_price FROM requests
            WHERE dlq_id NOT IN (SELECT dlq_id FROM letters)""",
        "dlq_repair": f"WITH {ASKED} SELECT dlq_id, orderId, {price_double(REPAIRED_PRICE)} AS price FROM asked",
        "dlq_replay": f"""WITH {REPLAYED} SELECT dlq_id, orderId, new_seq AS seq, 'SUCCESS' AS status,
            CAST(1 AS INTEGER) AS attempts, CAST(NULL AS VARCHAR) AS error_reason,
            {price_double()} AS price_value FROM replayed""",
        "dlq_replay_marks": f"""WITH {LETTERS} SELECT dlq_id, dlq_id IN (SELECT dlq_id FROM requests) AS replayed
            FROM letters""",
        "dlq_replay_log": REPLAY_LOG,
        "dlq_replay_stored": REPLAY_LOG,
        "order_job": f"""WITH {LETTERS} SELECT r.seq, r.status, r.attempts, r.total_orders, r.running_avg, l.dlq_id
            FROM running r LEFT JOIN letters l USING (seq)""",
        "system_status": f"""WITH {RESOLVED}, {METRICS}, last_zone AS (
            SELECT grid_zone, net_load_kwh FROM metrics
            QUALIFY row_number() OVER (PARTITION BY grid_zone ORDER BY window_start DESC) = 1)
            SELECT {kpis}, (SELECT {AVERAGE_SQL} FROM ({total})) AS avg_price,
              (SELECT count(*) FROM events) AS total_events,
              (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS batch_count,
              'PASSED' AS gate_status, (SELECT count(*) FROM customer) AS gate_records,
              (SELECT string_agg(grid_zone || '=' || CAST(net_load_kwh AS VARCHAR), ' ' ORDER BY grid_zone) FROM last_zone)
                AS latest_zones
            FROM resolved""",
    }
