"""Typing of raw strings and doubles. Bad input becomes NULL also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapemill.specs import PRICE


def parse_timestamp(col: str) -> Column:
    """ISO text, with or without fractions and zone, to an instant; the session zone is the default."""
    return F.try_to_timestamp(F.col(col))


def parse_date(col: str) -> Column:
    """`yyyy-MM-dd` text to a date."""
    return F.try_to_date(F.col(col), "yyyy-MM-dd")


def to_price(col: str) -> Column:
    """Double to decimal(18,6), rounding half up; overflow becomes NULL."""
    return F.col(col).try_cast(PRICE)
