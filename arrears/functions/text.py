"""Numbers in sentences. A NULL number gives a NULL text, never the word for it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int) -> Column:
    """Fixed decimals, ties to the even digit."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", F.bround(value, digits)))


def percent(share: Column, digits: int) -> Column:
    """Share as a percentage, ``0.125`` to ``12.5%``."""
    return F.concat(fixed(share * 100, digits), F.lit("%"))


def sentence(*parts: Column | str) -> Column:
    """Join text and columns; NULL when any column is NULL."""
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])
