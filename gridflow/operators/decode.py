"""JSON telemetry in and out, and the quarantine for what does not parse."""

from pyspark.sql import functions as F

from ..functions import event_time
from ..schemas import TELEMETRY


def encode_keyed_json(df, key="household_id"):
    """(key, value) records for a topic. One key goes to one topic partition, so each
    household's readings stay in order."""
    return df.select(F.col(key).cast("binary").alias("key"), F.to_json(F.struct("*")).alias("value"))


def parse_json(raw, schema=TELEMETRY):
    """(key, value, ...) records to `raw_value` plus the fields of `schema`.

    Text that is not JSON gives null fields; one bad field is null by itself.

    The fields come out of `inline`, through which the optimizer moves no filter. As plain
    columns it would copy the parser into each condition on each field, and every record
    would be parsed a dozen times.
    """
    text = F.col("value").cast("string")
    return raw.select(text.alias("raw_value"),
                      F.inline(F.array(F.from_json(text, schema, {"mode": "PERMISSIVE"}))))


def with_event_time(parsed, column="timestamp"):
    return parsed.withColumn("event_timestamp", event_time(F.col(column)))


def finite(name):
    """Whether a number is one that can be added up; null for a missing one."""
    return F.abs(F.col(name).cast("double")) < float("inf")


def reading_error(schema=TELEMETRY):
    """Why a parsed record cannot be used; null for a good one."""
    fields = [F.col(n).isNull() for n in schema.fieldNames()]
    nothing = fields[0]
    for missing in fields[1:]:
        nothing = nothing & missing
    return (
        F.when(nothing, "not a JSON reading")
        .when(F.col("event_timestamp").isNull(), "unreadable timestamp")
        .when(F.col("household_id").isNull(), "missing household_id")
        .when(F.col("grid_zone").isNull(), "missing grid_zone")
        .when(F.col("power_consumption_kwh").isNull(), "unreadable power_consumption_kwh")
        .when(F.col("solar_generation_kwh").isNull(), "unreadable solar_generation_kwh")
        .when(~finite("power_consumption_kwh"), "non-finite power_consumption_kwh")
        .when(~finite("solar_generation_kwh"), "non-finite solar_generation_kwh")
    )


def decode_telemetry(raw, schema=TELEMETRY):
    """Parse, add event time and `error_reason`. Every input record gives one row."""
    return with_event_time(parse_json(raw, schema)).withColumn("error_reason", reading_error(schema))


def good_readings(decoded):
    return decoded.where("error_reason IS NULL").drop("raw_value", "error_reason", "timestamp")


def text_of_bad(decoded):
    """The same rows with the text of those only that go to quarantine, for a batch that is kept while it is written."""
    return decoded.withColumn("raw_value", F.when(F.col("error_reason").isNotNull(), F.col("raw_value")))


def quarantined_readings(decoded):
    return decoded.where("error_reason IS NOT NULL").select("raw_value", "error_reason")
