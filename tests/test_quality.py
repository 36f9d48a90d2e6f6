"""Row rules and the tariff gate."""

import pytest
from pyspark.sql import functions as F

from gridflow.operators import quality as Q
from gridflow.operators.tariffs import drop_statistics, latest_tariffs
from gridflow.sources.tariffs import read_drop, read_drop_text, read_history

HEADER = "household_id,tariff_rate,billing_tier,subsidy_flag"


def drop(spark, tmp_path, *lines, header=HEADER, name="tariffs_20260101_000000.csv"):
    path = tmp_path / name
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def report(spark, path):
    return Q.gate_report(read_drop_text(spark, path)).first()


def test_bounds_are_inclusive(spark, tmp_path):
    row = report(spark, drop(spark, tmp_path, "H1,0.05,T,0", "H2,1.50,T,1"))
    assert (row.status, row.record_count, row.message) == ("PASSED", 2, None)


@pytest.mark.parametrize("line, problem", [
    ("H2,0.0499,T,0", "Tariff rate 0.0499 out of valid bounds [0.05, 1.50]"),
    ("H2,1.5001,T,0", "Tariff rate 1.5001 out of valid bounds [0.05, 1.50]"),
    ("H2,NaN,T,0", "Tariff rate NaN out of valid bounds [0.05, 1.50]"),
    ("H2,0.2,T,2", "Invalid subsidy flag 2"),
    ("H2,dear,T,0", "could not convert string to float: 'dear'"),
    ("H2,9,T,2", "Tariff rate 9.0 out of valid bounds [0.05, 1.50]"),
])
def test_first_bad_row_is_named(spark, tmp_path, line, problem):
    row = report(spark, drop(spark, tmp_path, "H1,0.2,T,0", line, "H3,99,T,0"))
    assert (row.status, row.first_bad_row, row.message) == ("FAILED", 2, f"DQ Failure at row 2: {problem}")
    with pytest.raises(Q.GateFailed, match="row 2"):
        Q.require_passed(Q.gate_report(read_drop_text(spark, str(tmp_path))))


def test_missing_drop(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="does not exist"):
        read_drop_text(spark, str(tmp_path / "nowhere.csv"))


def test_empty_and_incomplete_drops(spark, tmp_path):
    assert report(spark, drop(spark, tmp_path)).message == "DQ Failure: Tariff dataset is empty (0 records)."
    path = drop(spark, tmp_path, "H1,T", header="household_id,billing_tier", name="short.csv")
    assert report(spark, path).message == "DQ Failure: Missing mandatory columns: {'subsidy_flag', 'tariff_rate'}"


def test_row_violations_and_duplicates(spark):
    rows = spark.createDataFrame(
        [("H1", "0.2", "T", "0"), ("H2", "9", "T", "x"), ("H2", None, "T", "1")],
        "household_id string, tariff_rate string, billing_tier string, subsidy_flag string")
    found = Q.failing(Q.violations(rows, Q.tariff_rules())).collect()
    assert [(r.household_id, r.violations) for r in found] == [
        ("H2", ["tariff_rate", "subsidy_flag"]), ("H2", ["tariff_rate"])]
    assert [(r.household_id, r.rows) for r in Q.duplicate_households(rows).collect()] == [("H2", 2)]


def test_telemetry_rules(spark):
    rows = spark.createDataFrame(
        [("H", "M", "2026-01-01", 1.0, 0.0, "Zone-East"), ("H", "M", "2026-01-01", 0.0, -1.0, "Zone-Moon"),
         (None, None, None, None, None, None)],
        "household_id string, meter_id string, event_timestamp string, power_consumption_kwh double, "
        "solar_generation_kwh double, grid_zone string")
    found = [r.violations for r in Q.violations(rows, Q.telemetry_rules()).collect()]
    assert found[:2] == [[], ["power_consumption_kwh", "solar_generation_kwh", "grid_zone"]]
    assert len(found[2]) == 6


def test_columns_are_read_by_name(spark, tmp_path):
    path = drop(spark, tmp_path, "1,T,0.3,H1", "x,T,cheap,H2", header="subsidy_flag,billing_tier,tariff_rate,household_id")
    rows = {r.household_id: (r.tariff_rate and float(r.tariff_rate), r.subsidy_flag) for r in read_drop(spark, path).collect()}
    assert rows == {"H1": (0.3, 1), "H2": (None, None)}


def test_history_and_latest(spark, tmp_path):
    drop(spark, tmp_path, "H1,0.1,T,0", "H2,0.2,T,0", name="tariffs_20260101_000000.csv")
    drop(spark, tmp_path, "H1,0.5,T,1", name="tariffs_20260102_120000.csv")
    drop(spark, tmp_path, "H1,0.9,T,1", name="tariffs_latest.csv")  # a copy, not a drop of its own
    history = read_history(spark, str(tmp_path))
    days = history.select(F.col("simulated_day_date").cast("string").alias("d")).groupBy("d").count().collect()
    assert {r["d"]: r["count"] for r in days} == {"2026-01-01": 2, "2026-01-02": 1}
    newest = {r.household_id: float(r.tariff_rate) for r in latest_tariffs(history).collect()}
    assert newest == {"H1": 0.5, "H2": 0.2}
    assert drop_statistics(history).first().asDict() == {
        "records_count": 3, "avg_tariff": 0.2667, "subsidized_ratio": 0.3333}
    assert drop_statistics(history.limit(0)).first().asDict() == {
        "records_count": 0, "avg_tariff": 0.0, "subsidized_ratio": 0.0}
