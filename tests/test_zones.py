"""Window and zone metrics."""

from decimal import Decimal

from pyspark.sql import functions as F

from gridflow.operators import zones
from gridflow.operators.enrich import enrich, known_zones
from gridflow.plans import inputs as I

SF = "/root/testdata/sf0.001"
SCHEMA = "household_id string, meter_id string, power_consumption_kwh double, solar_generation_kwh double, " \
         "grid_zone string, event_timestamp timestamp"


def readings(spark, *rows):
    frame = spark.createDataFrame([(h, m, c, s, z, t) for h, m, c, s, z, t in rows], SCHEMA.replace(
        "event_timestamp timestamp", "event_timestamp string"))
    return frame.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def no_tariffs(spark):
    return spark.createDataFrame([], "household_id string, tariff_rate double, billing_tier string, subsidy_flag int")


def small(spark):
    rows = readings(
        spark,
        ("H1", "M1", 10.0, 1.0, "Zone-North", "2026-01-01 00:00:40"),
        ("H2", "M1", 20.0, 2.0, "Zone-North", "2026-01-01 00:00:59"),
        ("H3", "M3", 0.0, 5.0, "Zone-South", "2026-01-01 00:01:10"),
    )
    return enrich(rows, no_tariffs(spark))


def keyed(windowed):
    flat = zones.flatten_window(windowed)
    return {(str(r.window_start), r.grid_zone): r for r in
            flat.withColumn("window_start", F.date_format("window_start", "HH:mm:ss")).collect()}


def test_each_reading_is_in_two_windows(spark):
    found = keyed(zones.sliding_zone_metrics(small(spark)))
    assert sorted(found) == [("00:00:00", "Zone-North"), ("00:00:30", "Zone-North"), ("00:00:30", "Zone-South"),
                             ("00:01:00", "Zone-South")]
    row = found[("00:00:00", "Zone-North")]
    assert (row.total_consumption_kwh, row.total_solar_generation_kwh, row.net_load_kwh) == (30.0, 3.0, 27.0)
    assert (row.renewable_contribution_pct, row.total_cost_estimate) == (10.0, 4.5)
    assert row.active_meters == 2  # readings, although both are of one meter
    assert found[("00:01:00", "Zone-South")].renewable_contribution_pct == 0.0


def test_panes_equal_the_plain_sliding_window(spark):
    rows = I.enriched(spark, SF)
    for duration, slide in [("1 hour", "30 minutes"), ("6 hours", "1 hour"), ("50 minutes", "20 minutes")]:
        ours = zones.flatten_window(zones.zone_window_metrics(rows, duration, slide))
        plain = zones.flatten_window(
            rows.groupBy(F.window("event_timestamp", duration, slide), "grid_zone").agg(*zones._raw_metrics()))
        assert ours.count() == plain.count() > 0
        assert ours.exceptAll(plain).isEmpty()


def test_panes_need_whole_slides():
    assert zones._panes_fit("1 minute", "30 seconds")
    assert not zones._panes_fit("50 seconds", "20 seconds")
    assert not zones._panes_fit("1 month", "1 month")


def test_readings_are_aggregated_before_they_are_copied(spark, plan_of):
    plan = plan_of(zones.sliding_zone_metrics(I.enriched(spark, SF), "6 hours", "1 hour"))
    tree = plan.split("(1) Scan")[0]
    lines = [line.strip(" :+-") for line in tree.splitlines()]
    names = [line.split(" ")[0] for line in lines]
    # Top down: the copying step stands above the first aggregation and its shuffle.
    assert names.index("Expand") < len(names) - 1 - names[::-1].index("Exchange")
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    assert "PushedFilters: [IsNotNull(ts)]" in plan
    assert "event_id" not in plan.split("ReadSchema")[1].splitlines()[0]


def test_unknown_zones(spark):
    rows = small(spark)
    assert known_zones(rows, ["Zone-South"]).count() == 1
    kept = zones.zone_batch_metrics(rows).collect()
    assert {r.grid_zone for r in kept} == {"Zone-North", "Zone-South"}


def test_silent_zones_get_zeros(spark):
    dense = {r.grid_zone: r for r in zones.zone_batch_metrics(small(spark), zones=("Zone-North", "Zone-West")).collect()}
    assert set(dense) == {"Zone-North", "Zone-West"}
    assert dense["Zone-West"].total_consumption_kwh == 0.0 and dense["Zone-West"].active_meters == 0
    assert dense["Zone-North"].active_meters == 2


def test_grid_totals(spark):
    totals = zones.grid_totals(zones.flatten_window(zones.zone_window_metrics(small(spark), "1 hour")))
    found = {r.grid_zone: r for r in totals.collect()}
    row = found["GRID TOTALS"]
    assert (row.total_consumption_kwh, row.total_solar_generation_kwh, row.net_load_kwh) == (30.0, 8.0, 22.0)
    assert row.renewable_contribution_pct == 26.67 and row.active_meters == 3


def test_latest_per_zone_and_volumes(spark):
    flat = zones.flatten_window(zones.sliding_zone_metrics(small(spark)), batch_id=4)
    latest = {r.grid_zone: str(r.t) for r in zones.latest_per_zone(flat).select(
        "grid_zone", F.date_format("window_start", "HH:mm:ss").alias("t")).collect()}
    assert latest == {"Zone-North": "00:00:30", "Zone-South": "00:01:00"}
    assert zones.volume_counters(flat).first().asDict() == {"total_events": 4, "batch_count": 1}


def test_decimal_sums_do_not_depend_on_partitioning(spark):
    rows = I.enriched(spark, SF)
    one = zones.zone_batch_metrics(rows.coalesce(1))
    many = zones.zone_batch_metrics(rows.repartition(7))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    assert rows.schema["power_consumption_kwh"].dataType.simpleString() == "decimal(12,2)"
    assert rows.agg(F.sum("estimated_cost")).first()[0] > Decimal(0)
