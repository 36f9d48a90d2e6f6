"""Text in and out: numbers, times, padded keys, JSON details."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_number(value: Column, to: str = "double") -> Column:
    """Text to number; null, not an error, where it does not parse. Blanks around it are fine."""
    return F.trim(value.cast("string")).try_cast(to)


def event_time(value: Column) -> Column:
    """ISO-8601 text to a timestamp; null where it does not parse."""
    return F.try_to_timestamp(value)


def label_time(label: Column) -> Column:
    """`20260910_035129` to a timestamp; null where it does not parse."""
    return F.try_to_timestamp(label, F.lit("yyyyMMdd_HHmmss"))


def padded_key(prefix: Column, number: Column, width: int = 4) -> Column:
    """prefix + number padded with zeros to `width`; longer numbers keep all their digits.

    `lpad` would cut those, and the formatter takes twice as long per row, so it is left to
    the numbers `lpad` cannot take.
    """
    text = (
        F.when(number.between(0, 10 ** width - 1), F.lpad(number.cast("string"), width, "0"))
        .when(number.isNotNull(), F.format_string(f"%0{width}d", number))
    )
    return F.concat(prefix, text)


def detail_json(**fields: Column) -> Column:
    """A JSON document that keeps null fields."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})
