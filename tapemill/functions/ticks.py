"""Arithmetic on quotes and prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minute(ts: str) -> Column:
    return F.date_trunc("minute", F.col(ts))


def mid_price(bid: Column, ask: Column) -> Column:
    return (ask + bid) / 2


def spread_bps(bid: Column, ask: Column) -> Column:
    """Spread over mid in basis points; NULL where the mid is zero."""
    return F.try_divide(ask - bid, mid_price(bid, ask)) * 10000


def log_return(price: Column, previous: Column) -> Column:
    """Natural log of the price ratio; NULL where the ratio is undefined or not positive."""
    return F.log(F.try_divide(price, previous))
