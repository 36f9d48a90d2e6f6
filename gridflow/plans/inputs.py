"""How the given tables map to readings, tariffs and orders.

Readings come from `events`, tariffs from `customer`, orders from `orders`. Values with two
decimals are read as decimals, so sums are exact and do not depend on partitioning.
"""

from pyspark.sql import functions as F

from ..functions import padded_key
from ..operators.enrich import enrich

ZONES = ("click", "error", "purchase", "signup", "view")
WINDOW, SLIDE = "1 hour", "30 minutes"
#: Prices as exact numbers, so that sums do not depend on the order of rows.
PRICE = "decimal(24,6)"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_readings(events):
    """Readings from rows of `events`; one micro-batch per day."""
    return events.select(
        "event_id",
        padded_key(F.lit("MTR-"), F.col("user_id")).alias("meter_id"),
        padded_key(F.lit("HH-"), F.col("user_id")).alias("household_id"),
        F.col("value").cast("decimal(12,2)").alias("power_consumption_kwh"),
        F.get_json_object("props", "$.k").cast("decimal(12,2)").alias("solar_generation_kwh"),
        F.col("event_type").alias("grid_zone"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.to_date("ts").alias("batch_id"),
    )


def readings(spark, sf_dir):
    return as_readings(table(spark, sf_dir, "events"))


def as_records(events, damaged=False):
    """The readings as JSON records of a topic.

    With `damaged`, some carry faults, by their id: text that is not JSON, no zone, a
    negative consumption, an unreadable time, a consumption that is no number or infinite.
    """
    fault = F.pmod(F.col("event_id"), F.lit(100)) if damaged else F.lit(-1)
    fields = as_readings(events).withColumns({
        "power_consumption_kwh": F.when(fault == 5, -F.col("power_consumption_kwh"))
                                  .when(fault == 7, F.lit("NaN").cast("double"))
                                  .when(fault == 8, F.lit("Infinity").cast("double"))
                                  .otherwise(F.col("power_consumption_kwh")).cast("double"),
        "solar_generation_kwh": F.col("solar_generation_kwh").cast("double"),
        "grid_zone": F.when(fault != 4, F.col("grid_zone")),
        "timestamp": F.when(fault == 6, "not a time").otherwise(F.date_format("event_timestamp", ISO)),
    })
    reading = F.to_json(F.struct("meter_id", "household_id", "power_consumption_kwh",
                                 "solar_generation_kwh", "grid_zone", "timestamp"))
    broken = F.concat(F.lit("broken "), F.col("event_id").cast("string"))
    return fields.select(
        F.col("household_id").cast("binary").alias("key"),
        F.when(fault == 3, broken).otherwise(reading).cast("binary").alias("value"),
        F.col("event_timestamp").alias("timestamp"),
    )


def records(spark, sf_dir, damaged=False):
    return as_records(table(spark, sf_dir, "events"), damaged)


def tariffs(spark, sf_dir, revision=0):
    """One tariff row per customer; a revision raises every rate by 0.01 times its number.

    Customers in debt are kept under another name, so their households find no tariff.
    """
    household = padded_key(F.when(F.col("c_acctbal") < 0, "CLOSED-").otherwise("HH-"), F.col("c_custkey"))
    rate = F.lit(0.120004).cast("decimal(10,6)") + F.lit(0.01).cast("decimal(10,6)") * (F.col("c_nationkey") + revision)
    return table(spark, sf_dir, "customer").select(
        household.alias("household_id"),
        rate.cast("decimal(10,6)").alias("tariff_rate"),
        F.col("c_mktsegment").alias("billing_tier"),
        (F.col("c_custkey") % 3 == 0).cast("int").alias("subsidy_flag"),
    )


def tariff_drop(spark, sf_dir, day):
    """Drop number `day` of a changing tariff: a household's rate rises in one of three drops, some households are left out of
    the third drop, and every fifth one has two rows, of which the second holds."""
    key = F.col("c_custkey")
    rise = F.floor((F.lit(day) + key % 3) / 3).cast("int")
    base = table(spark, sf_dir, "customer").where((key % 7 != 3) | F.lit(day != 2))
    rate = F.lit(0.120004).cast("decimal(10,6)") + F.lit(0.01).cast("decimal(10,6)") * (F.col("c_nationkey") + rise)
    rows = base.select(
        padded_key(F.lit("HH-"), key).alias("household_id"), rate.cast("decimal(10,6)").alias("tariff_rate"),
        F.col("c_mktsegment").alias("billing_tier"), (key % 3 == 0).cast("int").alias("subsidy_flag"), (key % 5 == 0).alias("twice"))
    first = rows.where("twice").withColumn("tariff_rate", (F.col("tariff_rate") + 1).cast("decimal(10,6)"))
    return first.unionByName(rows).drop("twice")


def tariffs_with_revisions(spark, sf_dir):
    """Every household twice: its first rate and a later one, numbered in file order."""
    first = tariffs(spark, sf_dir).withColumn("row_order", F.lit(1))
    return first.unionByName(tariffs(spark, sf_dir, revision=1).withColumn("row_order", F.lit(2)))


def tariff_text(spark, sf_dir, damaged=False):
    """A drop as text in row order; with `damaged`, some rates and flags are wrong."""
    rows = table(spark, sf_dir, "customer")
    rate = F.lit(0.12).cast("decimal(8,4)") + F.lit(0.01).cast("decimal(8,4)") * F.col("c_nationkey")
    flag = (F.col("c_custkey") % 3 == 0).cast("int")
    if damaged:
        rate = F.when(F.col("c_custkey") % 50 == 1, rate * 10).otherwise(rate)
        flag = F.when(F.col("c_custkey") % 50 == 2, 2).otherwise(flag)
    return rows.select(
        padded_key(F.lit("HH-"), F.col("c_custkey")).alias("household_id"),
        rate.cast("decimal(8,4)").cast("string").alias("tariff_rate"),
        F.col("c_mktsegment").alias("billing_tier"),
        flag.cast("string").alias("subsidy_flag"),
        F.col("c_custkey").alias("row_order"),
    )


def as_orders(rows):
    """Order events from rows of `orders`, with faults by their key.

    Every fiftieth price is negative, every twentieth order meets one to three transient
    failures, a few carry a permanent error, and some lack a product. A few prices are
    beyond 10^12, a few are a tenth of a cent below zero, and a few have three decimals.
    """
    key = F.col("o_orderkey")
    plain = F.col("o_totalprice").cast("decimal(14,2)")
    price = (F.when(key % 200 == 17, F.lit(-0.001).cast("decimal(24,3)"))
             .when(key % 50 == 5, -plain.cast("decimal(24,3)"))
             .when(key % 200 == 13, (plain * 1_000_000_000).cast("decimal(24,3)"))
             .when(key % 200 == 19, (plain + F.lit(0.005).cast("decimal(4,3)")).cast("decimal(24,3)"))
             .otherwise(plain.cast("decimal(24,3)")))
    return rows.select(
        key.alias("seq"),
        padded_key(F.lit("ORD-"), key).alias("orderId"),
        F.when(key % 40 != 7, F.col("o_orderpriority")).alias("product"),
        price.cast("string").alias("price"),
        F.when(key % 20 == 0, 1 + key % 3).otherwise(0).cast("int").alias("transient_failures"),
        F.when(key % 400 == 11, "injected").alias("permanent_error"),
    )


def orders(spark, sf_dir):
    return as_orders(table(spark, sf_dir, "orders"))


def replay_requests(spark, sf_dir):
    """A request for as many dead letters as there are orders: some exist, most do not.
    Every second request gives a price, every other leaves the repair to the flow."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("request_seq"),
        padded_key(F.lit("DLQ-"), key).alias("dlq_id"),
        F.when(key % 2 == 0, F.lit(45.0)).alias("corrected_price"),
    )


def enriched(spark, sf_dir):
    return enrich(readings(spark, sf_dir), tariffs(spark, sf_dir))


def batches_by_day(spark, sf_dir):
    """Readings with a whole-number batch id: days since the epoch."""
    return readings(spark, sf_dir).withColumn("batch_id", F.unix_date("batch_id").cast("long"))
