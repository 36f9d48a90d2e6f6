"""Rules on rows, and the gate a tariff drop has to pass."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions import try_number
from .decode import finite


def violations(df, rules):
    """Adds `violations`, the names of the rules (name -> column true when broken) a row breaks."""
    none = F.array().cast("array<string>")
    names = [F.when(F.coalesce(broken, F.lit(True)), F.array(F.lit(name))).otherwise(none)
             for name, broken in rules.items()]
    return df.withColumn("violations", F.concat(*names))


def failing(checked):
    return checked.where(F.size("violations") > 0)


def tariff_rules(low=V.RATE_LOW, high=V.RATE_HIGH):
    """A rate or flag that is missing or unreadable breaks its rule too."""
    rate = try_number(F.col("tariff_rate"))
    return {
        "tariff_rate": ~rate.between(float(low), float(high)),
        "subsidy_flag": ~F.col("subsidy_flag").isin(*V.SUBSIDY_FLAGS),
    }


def telemetry_rules(zones=V.GRID_ZONES):
    return {
        "household_id": F.col("household_id").isNull(),
        "meter_id": F.col("meter_id").isNull(),
        "event_timestamp": F.col("event_timestamp").isNull(),
        "power_consumption_kwh": ~((F.col("power_consumption_kwh") > 0) & finite("power_consumption_kwh")),
        "solar_generation_kwh": ~((F.col("solar_generation_kwh") >= 0) & finite("solar_generation_kwh")),
        "grid_zone": ~F.col("grid_zone").isin(*zones),
    }


def duplicate_households(tariffs):
    return tariffs.groupBy("household_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def _first_problem(low, high):
    """The first broken rule of a row in words; null for a good row."""
    rate_text = F.col("tariff_rate")
    rate = try_number(rate_text)
    return (
        F.when(rate.isNull(), F.format_string(V.REASON_NOT_NUMERIC, F.coalesce(rate_text, F.lit(""))))
        .when(~rate.between(float(low), float(high)),
              F.format_string(V.GATE_BAD_RATE, rate.cast("string"), F.lit(str(low)), F.lit(str(high))))
        .when(~F.coalesce(F.col("subsidy_flag").isin(*V.SUBSIDY_FLAGS), F.lit(False)),
              F.format_string(V.GATE_BAD_FLAG, F.coalesce("subsidy_flag", F.lit(""))))
    )


def missing_columns(tariffs):
    return sorted(set(V.TARIFF_COLUMNS) - set(tariffs.columns))


REPORT = "status string, record_count long, first_bad_row long, message string"


def gate_report(tariffs, order="row_order", low=V.RATE_LOW, high=V.RATE_HIGH):
    """One row: status, record_count (good rows), first_bad_row (1-based) and message.

    Takes the drop as text. One aggregate gives the counts and the first problem in
    `order`; only a drop that fails is read again, to number the row it fails at.
    """
    missing = missing_columns(tariffs)
    if missing:
        names = "{" + ", ".join(f"'{c}'" for c in missing) + "}"
        return _report(tariffs, "FAILED", 0, None, V.GATE_MISSING_COLUMNS % names)
    checked = tariffs.select(F.col(order).alias("_order"), _first_problem(low, high).alias("_problem"))
    bad_order = F.when(F.col("_problem").isNotNull(), F.col("_order"))
    found = checked.agg(
        F.count_if(F.col("_problem").isNull()).alias("good"),
        F.min(bad_order).alias("at"),
        F.min_by("_problem", bad_order).alias("problem"),
    ).first()
    if found["at"] is not None:
        row = checked.where(F.col("_order") <= _literal(found["at"])).count()
        return _report(tariffs, "FAILED", found["good"], row, V.GATE_BAD_ROW % (row, found["problem"]))
    if found["good"] == 0:
        return _report(tariffs, "FAILED", 0, None, V.GATE_EMPTY)
    return _report(tariffs, V.GATE_PASSED, found["good"], None, None)


def _literal(value):
    if isinstance(value, Row):
        return F.struct(*[F.lit(v).alias(n) for n, v in value.asDict().items()])
    return F.lit(value)


def _report(tariffs, *row):
    return tariffs.sparkSession.createDataFrame([row], REPORT)


class GateFailed(ValueError):
    """A drop did not pass the gate."""


def require_passed(report):
    """The gate's one row, or GateFailed with its message."""
    row = report.first()
    if row["status"] != V.GATE_PASSED:
        raise GateFailed(row["message"])
    return row.asDict()
