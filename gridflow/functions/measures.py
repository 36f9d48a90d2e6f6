"""Energy, cost and ratio expressions.

Given decimals they compute in decimals, so a sum does not depend on the order in which
partitions arrive; given doubles they compute in doubles.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import SUBSIDY_DISCOUNT


def net_load(consumption="power_consumption_kwh", solar="solar_generation_kwh") -> Column:
    """Positive draws from the grid, negative feeds into it."""
    return F.col(consumption) - F.col(solar)


def cost_estimate(consumption="power_consumption_kwh", rate="tariff_rate", subsidy="subsidy_flag") -> Column:
    discount = F.lit(1) - F.col(subsidy) * F.lit(SUBSIDY_DISCOUNT)
    return F.col(consumption) * F.col(rate) * discount


def renewable_pct(solar: Column, consumption: Column) -> Column:
    """Solar share of consumption in percent, 0.0 where nothing was consumed."""
    share = solar.cast("double") / consumption.cast("double") * 100.0
    return F.when(consumption > 0, F.round(share, 2)).otherwise(F.lit(0.0))


def average(total: Column, count: Column, places: int = 2) -> Column:
    """total / count rounded half up, 0.0 for a count of zero.

    Decimal totals are narrowed to 24 digits before the point first: more leave Spark only
    six fraction digits for the quotient, and rounding that again can go the wrong way.
    """
    return F.coalesce(F.round(F.try_divide(total, count), places).cast("double"), F.lit(0.0))


def load_direction(net: Column) -> Column:
    return F.when(net >= 0, "DRAW").otherwise("FEED")


def load_label(net: Column) -> Column:
    """`+002.50 (DRAW)` / `-03.30 (FEED)`: the number is zero-padded to six characters."""
    sign = F.when(net >= 0, "+").otherwise("")
    return F.concat(sign, F.format_string("%06.2f", net.cast("double")), F.lit(" ("), load_direction(net), F.lit(")"))


def pct_capped(pct: Column) -> Column:
    return F.least(F.lit(100.0), pct)
