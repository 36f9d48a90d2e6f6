"""Schemas of the frames that cross module borders."""

from pyspark.sql import types as T

TELEMETRY = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("household_id", T.StringType()),
    T.StructField("power_consumption_kwh", T.DoubleType()),
    T.StructField("solar_generation_kwh", T.DoubleType()),
    T.StructField("grid_zone", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# The same readings with exact numbers, for sums that must not depend on row order: two
# decimals, below 10^10. Opt-in; a number that does not fit is unreadable or rounded.
TELEMETRY_EXACT = T.StructType([
    T.StructField(f.name, T.DecimalType(12, 2), True) if isinstance(f.dataType, T.DoubleType) else f
    for f in TELEMETRY.fields
])

TARIFF = T.StructType([
    T.StructField("household_id", T.StringType()),
    T.StructField("tariff_rate", T.DoubleType()),
    T.StructField("billing_tier", T.StringType()),
    T.StructField("subsidy_flag", T.IntegerType()),
])

# Exact rates: up to six decimals, below ten thousand. A rate that does not fit is unreadable.
TARIFF_EXACT = T.StructType([
    T.StructField(f.name, T.DecimalType(10, 6), True) if isinstance(f.dataType, T.DoubleType) else f
    for f in TARIFF.fields
])

ZONE_METRICS = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("grid_zone", T.StringType()),
    T.StructField("total_consumption_kwh", T.DoubleType()),
    T.StructField("total_solar_generation_kwh", T.DoubleType()),
    T.StructField("net_load_kwh", T.DoubleType()),
    T.StructField("renewable_contribution_pct", T.DoubleType()),
    T.StructField("total_cost_estimate", T.DoubleType()),
    T.StructField("active_meters", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])

HEALTH_LOG = T.StructType([
    T.StructField("component", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("latency_ms", T.DecimalType(10, 2)),
    T.StructField("details", T.StringType()),
    T.StructField("checked_at", T.TimestampType()),
])

ORDER = T.StructType([
    T.StructField("orderId", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("price", T.FloatType()),
])

# What the order flow works on: the message, its place in the arrival order, and the
# faults met on the way. `price` stays text until it has been checked.
ORDER_EVENT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("orderId", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("transient_failures", T.IntegerType()),
    T.StructField("permanent_error", T.StringType()),
])

AUDIT_STEP = T.StructType([
    T.StructField("attempt", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("note", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("backoff_sec", T.DoubleType()),
])
