"""Tariff enrichment of readings."""

from pyspark.sql import functions as F

from ..fixed_values import DEFAULT_RATE, DEFAULT_SUBSIDY, DEFAULT_TIER
from ..functions import cost_estimate, net_load
from .asof import as_of
from .lookup import lookup
from .upsert import latest_wins


def one_row_per_household(tariffs, order):
    """Of several rows for a household the last one counts."""
    return latest_wins(tariffs, ["household_id"], order).drop(*order)


def fill_tariff_defaults(df):
    """Defaults for households without a tariff, and for tariff cells that were unreadable."""
    return df.withColumns({
        "tariff_rate": F.coalesce("tariff_rate", F.lit(DEFAULT_RATE)),
        "billing_tier": F.coalesce("billing_tier", F.lit(DEFAULT_TIER)),
        "subsidy_flag": F.coalesce("subsidy_flag", F.lit(DEFAULT_SUBSIDY)),
    })


def lookup_tariffs(readings, tariffs, **lookup_options):
    """Readings with their household's tariff or the default one.

    `tariffs` has one row per household, as `CurrentTariffs` and `one_row_per_household`
    give it; two would bill a reading twice.
    """
    return fill_tariff_defaults(lookup(readings, tariffs, "household_id", **lookup_options))


def enrich(readings, tariffs, **lookup_options):
    """Readings with tariff, net load and estimated cost."""
    return with_cost(lookup_tariffs(readings, tariffs, **lookup_options))


def with_cost(readings):
    """Readings that have their tariff, with net load and estimated cost."""
    return readings.withColumns({"net_grid_load_kwh": net_load(), "estimated_cost": cost_estimate()})


def enrich_as_of(readings, intervals, **as_of_options):
    """The same with the tariff in force at the time of each reading, from `tariff_intervals`.

    Readings before a household's first interval, in a gap or without a time get the default tariff.
    """
    tariff = ("tariff_rate", "billing_tier", "subsidy_flag")
    joined = as_of(readings, intervals, "household_id", "event_timestamp", "valid_from", ["valid_to", *tariff],
                   **as_of_options)
    ended = F.col("valid_to") <= F.col("event_timestamp")
    in_force = joined.withColumns({c: F.when(ended, None).otherwise(F.col(c)) for c in tariff})
    return with_cost(fill_tariff_defaults(in_force.drop("valid_from", "valid_to")))


def known_zones(df, zones):
    """Only rows of the configured zones, a short list."""
    return df.where(F.col("grid_zone").isin(*zones))
