"""Silver slices of one day to the rows of each gold table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.operators.bars import bid_ask_spread_1m, ohlcv_1m, vwap_daily
from tapemill.operators.event_window import (
    calendar_events,
    distinct_windows,
    event_windowed_volume,
    windows_fit_broadcast,
)


def on_day(df: DataFrame, column: str, day: date) -> DataFrame:
    return df.where(F.col(column) == F.lit(day.isoformat()).cast("date"))


def around_day(df: DataFrame, column: str, day: date) -> DataFrame:
    """The day and both neighbours, since event windows may cross midnight."""
    middle = F.lit(day.isoformat()).cast("date")
    return df.where(F.col(column).between(F.date_sub(middle, 1), F.date_add(middle, 1)))


def _events(day: date, trades: DataFrame, events: DataFrame) -> DataFrame:
    of_day = on_day(events, "event_date", day)
    small = windows_fit_broadcast(distinct_windows(calendar_events(of_day)))
    return event_windowed_volume(around_day(trades, "trade_date", day), of_day, small)


@dataclass(frozen=True)
class GoldMode:
    """Target table, the silver tables it reads (with days of reach) and the computation."""

    target: str
    inputs: tuple[tuple[str, int], ...]
    compute: Callable[..., DataFrame]


# The mode names of the gold job.
MODES: dict[str, GoldMode] = {
    "ohlcv": GoldMode(
        "gold.ohlcv_1m", (("silver.trades", 0),), lambda day, trades: ohlcv_1m(on_day(trades, "trade_date", day))
    ),
    "vwap": GoldMode(
        "gold.vwap_daily", (("silver.trades", 0),), lambda day, trades: vwap_daily(on_day(trades, "trade_date", day))
    ),
    "spread": GoldMode(
        "gold.bid_ask_spread_1m",
        (("silver.quotes", 0),),
        lambda day, quotes: bid_ask_spread_1m(on_day(quotes, "quote_date", day)),
    ),
    "event_windowed": GoldMode(
        "gold.event_windowed_volume", (("silver.trades", 1), ("silver.events", 0)), _events
    ),
}
