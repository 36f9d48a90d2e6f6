"""SQL for the inputs, shared by the oracle queries: the same mapping as `inputs`."""

READINGS = """readings AS (
  SELECT event_id, format('MTR-{:04d}', user_id) AS meter_id, format('HH-{:04d}', user_id) AS household_id,
         CAST(value AS DECIMAL(12,2)) AS cons, CAST(json_extract_string(props, '$.k') AS DECIMAL(12,2)) AS solar,
         event_type AS grid_zone, ts, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS batch_id
  FROM events)"""


def tariffs(name="tariffs", revision=0):
    return f"""{name} AS (
  SELECT CASE WHEN c_acctbal < 0 THEN 'CLOSED-' ELSE 'HH-' END || format('{{:04d}}', c_custkey) AS household_id,
         CAST(0.120004 + 0.01 * (c_nationkey + {revision}) AS DECIMAL(10,6)) AS rate, c_mktsegment AS tier,
         CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS flag
  FROM customer)"""


ENRICHED = READINGS + ", " + tariffs() + """, enriched AS (
  SELECT r.*, coalesce(t.rate, 0.15) AS rate, coalesce(t.tier, 'Standard') AS tier, coalesce(t.flag, 0) AS flag,
         r.cons - r.solar AS net,
         CAST(r.cons * coalesce(t.rate, 0.15) AS DECIMAL(30,8)) * CAST(1 - coalesce(t.flag, 0) * 0.15 AS DECIMAL(4,2)) AS cost
  FROM readings r LEFT JOIN tariffs t USING (household_id))"""

METRIC_SUMS = """CAST(round(sum(cons), 4) AS DOUBLE) AS total_consumption_kwh,
  CAST(round(sum(solar), 4) AS DOUBLE) AS total_solar_generation_kwh,
  CAST(round(sum(net), 4) AS DOUBLE) AS net_load_kwh,
  CASE WHEN sum(cons) > 0 THEN round(CAST(sum(solar) AS DOUBLE) / CAST(sum(cons) AS DOUBLE) * 100.0, 2) ELSE 0.0 END
    AS renewable_contribution_pct,
  CAST(round(sum(cost), 4) AS DOUBLE) AS total_cost_estimate,
  CAST(count(meter_id) AS BIGINT) AS active_meters"""

METRICS = ENRICHED + f""", windowed AS (
  SELECT e.*, time_bucket(INTERVAL 30 MINUTES, ts) - o.o * INTERVAL 30 MINUTES AS window_start
  FROM enriched e, (VALUES (0), (1)) AS o(o)),
metrics AS (
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, grid_zone, {METRIC_SUMS}
  FROM windowed GROUP BY window_start, grid_zone)"""

METRIC_NAMES = """window_start, window_end, grid_zone, total_consumption_kwh, total_solar_generation_kwh,
  net_load_kwh, renewable_contribution_pct, total_cost_estimate, active_meters"""

ORDERS = """orders_in AS (
  SELECT o_orderkey AS seq, format('ORD-{:04d}', o_orderkey) AS orderId,
         CASE WHEN o_orderkey % 40 <> 7 THEN o_orderpriority END AS product,
         CASE WHEN o_orderkey % 200 = 17 THEN CAST(-0.001 AS DECIMAL(24,3))
              WHEN o_orderkey % 50 = 5 THEN CAST(-CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(24,3))
              WHEN o_orderkey % 200 = 13 THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 100 AS HUGEINT) * 10000000
                AS DECIMAL(24,3))
              WHEN o_orderkey % 200 = 19 THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(24,3)) + 0.005::DECIMAL(24,3)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(24,3)) END AS price_value,
         CAST(CASE WHEN o_orderkey % 20 = 0 THEN 1 + o_orderkey % 3 ELSE 0 END AS INTEGER) AS f,
         CASE WHEN o_orderkey % 400 = 11 THEN 'injected' END AS permanent_error
  FROM orders),
checked AS (
  SELECT *, CASE WHEN price_value < 0
                 THEN 'Poison pill detected: negative price ($' || printf('%.2f', CAST(price_value AS DOUBLE)) || ')'
                 WHEN permanent_error IS NOT NULL THEN 'Forced poison pill: ' || permanent_error END AS problem
  FROM orders_in)"""

RESOLVED = ORDERS + """, resolved AS (
  SELECT seq, orderId, product, price_value, f, permanent_error, problem,
         CASE WHEN problem IS NOT NULL OR f >= 3 THEN 'DLQ_QUARANTINED'
              WHEN f > 0 THEN 'RECOVERED_AFTER_RETRY' ELSE 'SUCCESS' END AS status,
         CAST(CASE WHEN problem IS NOT NULL THEN 1 WHEN f >= 3 THEN 3 ELSE f + 1 END AS INTEGER) AS attempts,
         CAST(CASE WHEN problem IS NOT NULL THEN 0 ELSE least(f, 3) END AS INTEGER) AS retries,
         coalesce(problem, CASE WHEN f >= 3 THEN 'Max retries (3) exceeded' END) AS error_reason
  FROM checked)"""


def half_up_average(mills, count):
    """mills / count, in thousandths, to two places, ties up, in whole numbers; 0.0 where count is 0."""
    return (f"CASE WHEN {count} = 0 THEN 0.0 ELSE "
            f"CAST(({mills} * 2 + {count} * 10) // ({count} * 20) AS DOUBLE) / 100.0 END")


def price_double(column="price_value"):
    """A decimal as the nearest double, by way of its digits."""
    return f"CAST(CAST({column} AS VARCHAR) AS DOUBLE)"


RUNNING = RESOLVED + f""", cumulated AS (
  SELECT *, CAST(count(*) FILTER (status <> 'DLQ_QUARANTINED') OVER w AS BIGINT) AS total_orders,
         CAST(count(*) FILTER (status = 'DLQ_QUARANTINED') OVER w AS BIGINT) AS total_rejects,
         coalesce(sum(CAST(price_value * 1000 AS HUGEINT)) FILTER (status <> 'DLQ_QUARANTINED') OVER w, 0) AS mills
  FROM resolved WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING)),
running AS (SELECT *, {half_up_average('mills', 'CAST(total_orders AS HUGEINT)')} AS running_avg FROM cumulated)"""

LETTERS = RUNNING + """, letters AS (
  SELECT seq, format('DLQ-{:04d}', total_rejects) AS dlq_id, orderId, product, price_value, error_reason
  FROM running WHERE status = 'DLQ_QUARANTINED'),
requests AS (
  SELECT o_orderkey AS request_seq, format('DLQ-{:04d}', o_orderkey) AS dlq_id,
         CASE WHEN o_orderkey % 2 = 0 THEN 45.0::DOUBLE END AS corrected_price
  FROM orders)"""
