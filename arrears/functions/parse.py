"""Column helpers that turn raw text into typed values; text that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Decimal notation. Keeps out the names of NaN and infinity and Java literals such as ``1.5d``, which a plain cast would
# accept. One small expression per column keeps the generated code of a wide projection below the size up to which the
# JVM compiles a method.
_DECIMAL = r"^\s*[+-]?[\d.]+([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """Text to double; what exceeds the range of a double is NULL."""
    value = text.try_cast("double")
    return F.when(text.rlike(_DECIMAL) & (F.abs(value) < F.lit(float("inf"))), value)


def first_integer(text: Column) -> Column:
    """First run of digits in the text, as a long."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("bigint")


def month(text: Column) -> Column:
    """``Dec-2017`` to the first day of that month."""
    return F.try_to_date(text, "MMM-yyyy")


def month_key(day: Column) -> Column:
    """Date to its ``yyyy-MM`` key."""
    return F.date_format(day, "yyyy-MM")


def month_start(key: Column) -> Column:
    """``yyyy-MM`` key back to the first day of the month."""
    return F.to_date(key, "yyyy-MM")
