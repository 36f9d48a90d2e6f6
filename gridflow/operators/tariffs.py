"""Summaries of tariff drops and of their history."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .upsert import latest_wins


def _statistics():
    return [
        F.count(F.lit(1)).alias("records_count"),
        F.coalesce(F.round(F.avg("tariff_rate"), 4).cast("double"), F.lit(0.0)).alias("avg_tariff"),
        F.coalesce(F.round(F.avg("subsidy_flag"), 4), F.lit(0.0)).alias("subsidized_ratio"),
    ]


def drop_statistics(tariffs):
    """Rows, mean rate and subsidised share of a drop; zeros for an empty one."""
    return tariffs.agg(*_statistics())


def history_statistics(history):
    return history.groupBy("effective_timestamp", "billing_tier").agg(*_statistics())


def _places(history):
    """What orders the rows of a history: the drop, and within it the place in its files, where that was read."""
    return [c for c in ("effective_timestamp", "row_order") if c in history.columns]


def latest_tariffs(history):
    """The newest tariff row of each household; of several in one drop the last in its files."""
    return latest_wins(history, ["household_id"], _places(history)).drop("row_order")


def tariff_intervals(history):
    """When each tariff was in force: (household_id, valid_from, valid_to, tariff_rate, billing_tier, subsidy_flag, drops).

    A drop holds until the next one, for all households: one that the next drop leaves out has no tariff from then on.
    Drops in a row that do not change a household's tariff are one interval, `drops` of them; valid_to is excluded, and null for the
    drop in force. So intervals of a household never overlap. Of several rows in one drop the last in its files counts.
    Rows without a household or time are left out.
    """
    rows = history.where("household_id is not null and effective_timestamp is not null")
    times = rows.select("effective_timestamp").distinct()  # one per drop, so few enough for one task
    following = F.lead("effective_timestamp").over(Window.orderBy("effective_timestamp"))
    times = times.withColumn("_next", following)
    tariff = F.struct("tariff_rate", "billing_tier", "subsidy_flag")
    keys = ["household_id", "effective_timestamp"]
    newest = F.max_by(tariff, F.struct(*_places(rows))).alias("_tariff")
    one = rows.groupBy(*keys).agg(newest).join(times, "effective_timestamp")
    by_time = Window.partitionBy("household_id").orderBy("effective_timestamp")
    goes_on = (F.lag("_next").over(by_time) == F.col("effective_timestamp")) & F.lag("_tariff").over(by_time).eqNullSafe(
        F.col("_tariff"))
    begins = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    islands = one.withColumn("_begins", begins).withColumn("_island", F.sum("_begins").over(by_time))
    found = islands.groupBy("household_id", "_island").agg(
        F.min("effective_timestamp").alias("valid_from"), F.max_by("_next", "effective_timestamp").alias("valid_to"),
        F.min_by("_tariff", "effective_timestamp").alias("_tariff"), F.count(F.lit(1)).alias("drops"))
    return found.select("household_id", "valid_from", "valid_to", "_tariff.*", "drops")
