"""Decoding, quarantine and the expressions on one reading."""

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridflow import functions as X
from gridflow.operators import decode, enrich

GOOD = ('{"meter_id":"M1","household_id":"H1","power_consumption_kwh":3.5,"solar_generation_kwh":1.0,'
        '"grid_zone":"Zone-North","timestamp":"2026-09-10T00:00:40+00:00"}')


def raw(spark, *values):
    rows = [(None, bytearray(v, "utf-8"), None) for v in values]
    return spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp")


def value_of(spark, column, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


def test_good_and_bad_records(spark):
    no_zone = GOOD.replace('"grid_zone":"Zone-North",', "")
    bad_fields = GOOD.replace("3.5", '"x"').replace("2026-09-10T00:00:40+00:00", "bad")
    decoded = decode.decode_telemetry(raw(spark, GOOD, "not json", bad_fields, no_zone))
    good = decode.good_readings(decoded).collect()
    assert [(r.meter_id, r.power_consumption_kwh) for r in good] == [("M1", 3.5)]
    assert good[0].event_timestamp.astimezone(timezone.utc).replace(tzinfo=None) == datetime(2026, 9, 10, 0, 0, 40)
    bad = {r.raw_value: r.error_reason for r in decode.quarantined_readings(decoded).collect()}
    assert bad == {"not json": "not a JSON reading", bad_fields: "unreadable timestamp", no_zone: "missing grid_zone"}


def test_one_bad_field_leaves_the_others(spark):
    row = decode.parse_json(raw(spark, GOOD.replace("3.5", '"x"'))).first()
    assert row.power_consumption_kwh is None and row.household_id == "H1" and row.solar_generation_kwh == 1.0


def test_record_without_a_value(spark):
    rows = spark.createDataFrame([(None, None, None)], "key binary, value binary, timestamp timestamp")
    assert decode.decode_telemetry(rows).first().error_reason == "not a JSON reading"


def test_records_are_parsed_once(spark, plan_of):
    decoded = decode.decode_telemetry(raw(spark, GOOD))
    for rows in (decode.good_readings(decoded), decode.quarantined_readings(decoded)):
        tree = plan_of(rows)
        assert sum(line.count("from_json(") for line in tree.splitlines() if not line.startswith("Input")) == 1


def test_encode_decode_round_trip(spark):
    parsed = decode.parse_json(raw(spark, GOOD)).drop("raw_value")
    sent = decode.encode_keyed_json(parsed)
    assert bytes(sent.first()["key"]) == b"H1"
    again = decode.parse_json(sent.withColumn("value", F.col("value").cast("binary"))).drop("raw_value")
    assert again.first() == parsed.first()


@pytest.mark.parametrize("used, solar, net, label", [
    (3.5, 1.0, 2.5, "+002.50 (DRAW)"),
    (1.2, 4.5, -3.3, "-03.30 (FEED)"),
    (0.0, 0.0, 0.0, "+000.00 (DRAW)"),
    (0.0, 0.01, -0.01, "-00.01 (FEED)"),
])
def test_net_load(spark, used, solar, net, label):
    df = spark.createDataFrame([(used, solar)], "power_consumption_kwh double, solar_generation_kwh double")
    row = df.select(X.net_load().alias("net"), X.load_label(X.net_load()).alias("label")).first()
    assert row.net == pytest.approx(net) and row.label == label


@pytest.mark.parametrize("flag, cost", [(0, 2.00), (1, 1.70)])
def test_cost_in_doubles_and_decimals(spark, flag, cost):
    row = spark.createDataFrame([(10.0, 0.20, flag)], "power_consumption_kwh double, tariff_rate double, subsidy_flag int")
    assert row.select(X.cost_estimate().alias("c")).first().c == pytest.approx(cost)
    exact = row.withColumn("power_consumption_kwh", F.col("power_consumption_kwh").cast("decimal(12,2)")) \
        .withColumn("tariff_rate", F.col("tariff_rate").cast("decimal(8,4)"))
    assert exact.select(X.cost_estimate().alias("c")).first().c == Decimal(str(cost))


@pytest.mark.parametrize("solar, used, pct", [(35.0, 100.0, 35.0), (5.0, 0.0, 0.0), (None, None, 0.0), (3.0, 2.0, 150.0)])
def test_renewable_pct(spark, solar, used, pct):
    df = spark.createDataFrame([(solar, used)], "s double, u double")
    row = df.select(X.renewable_pct(F.col("s"), F.col("u")).alias("p")).select("p", X.pct_capped(F.col("p")).alias("c")).first()
    assert row.p == pct and row.c == min(100.0, pct)


@pytest.mark.parametrize("text, number", [(" 6.5 ", 6.5), ("x", None), ("1_0", None), ("", None), ("inf", float("inf"))])
def test_try_number(spark, text, number):
    assert value_of(spark, X.try_number(F.col("x")), "x string", (text,)) == number


@pytest.mark.parametrize("n, key", [(7, "HH-0007"), (9999, "HH-9999"), (123456, "HH-123456"), (-5, "HH--005"), (None, None)])
def test_padded_key_keeps_long_numbers(spark, n, key):
    assert value_of(spark, X.padded_key(F.lit("HH-"), F.col("x")), "x bigint", (n,)) == key


def test_label_time(spark):
    df = spark.createDataFrame([("20260910_035129",), ("latest",)], "x string")
    rows = df.select(X.label_time(F.col("x")).cast("string").alias("t")).collect()
    assert [r.t for r in rows] == ["2026-09-10 03:51:29", None]


def test_defaults_for_unmatched_and_unreadable(spark):
    readings = spark.createDataFrame([("H1",), ("H2",), ("H3",)], "household_id string")
    tariffs = spark.createDataFrame([("H1", Decimal("0.2"), "T", 1), ("H2", None, None, None)],
                                    "household_id string, tariff_rate decimal(8,4), billing_tier string, subsidy_flag int")
    rows = {r.household_id: (float(r.tariff_rate), r.billing_tier, r.subsidy_flag)
            for r in enrich.lookup_tariffs(readings, tariffs).collect()}
    assert rows == {"H1": (0.2, "T", 1), "H2": (0.15, "Standard", 0), "H3": (0.15, "Standard", 0)}


def test_last_tariff_row_wins(spark):
    rows = [("H1", 1, "first"), ("H1", 3, "last"), ("H1", 2, "middle"), ("H2", 1, "only")]
    tariffs = spark.createDataFrame(rows, "household_id string, row_order int, billing_tier string")
    found = enrich.one_row_per_household(tariffs, ["row_order"]).collect()
    assert sorted((r.household_id, r.billing_tier) for r in found) == [("H1", "last"), ("H2", "only")]
