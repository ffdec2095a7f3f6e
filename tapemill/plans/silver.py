"""Bronze rows to typed, deduplicated, enriched silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.functions.parsing import parse_date, parse_timestamp, to_price
from tapemill.operators.dedup import QUOTE_ORDER, TRADE_ORDER, event_order, first_event_per_symbol_day, keep_first
from tapemill.operators.joins import enrich_with_event
from tapemill.specs import TABLES

TRADES, QUOTES, EVENTS = TABLES["silver.trades"], TABLES["silver.quotes"], TABLES["silver.events"]


def typed_trades(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns({"exchange_ts": parse_timestamp("exchange_ts"), "price": to_price("price")})


def typed_quotes(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {"exchange_ts": parse_timestamp("exchange_ts"), "bid": to_price("bid"), "ask": to_price("ask")}
    )


def typed_events(bronze: DataFrame) -> DataFrame:
    return bronze.withColumns(
        {
            "event_date": parse_date("event_date"),
            "event_start": parse_timestamp("event_start"),
            "event_end": parse_timestamp("event_end"),
        }
    )


def deduplicated_trades(bronze: DataFrame) -> DataFrame:
    """The earliest delivery of a key wins."""
    return keep_first(typed_trades(bronze), TRADES.keys, TRADE_ORDER).withColumn("trade_date", F.to_date("exchange_ts"))


def deduplicated_quotes(bronze: DataFrame) -> DataFrame:
    """The earliest delivery of a key wins."""
    return keep_first(typed_quotes(bronze), QUOTES.keys, QUOTE_ORDER).withColumn("quote_date", F.to_date("exchange_ts"))


def silver_trades(bronze: DataFrame, silver_events: DataFrame, small_events: bool) -> DataFrame:
    calendar = first_event_per_symbol_day(
        silver_events.select("event_id", "symbol", "event_type", "event_date", "event_start")
    )
    return enrich_with_event(deduplicated_trades(bronze), calendar, small_events).select(*TRADES.columns)


def silver_quotes(bronze: DataFrame) -> DataFrame:
    return deduplicated_quotes(bronze).select(*QUOTES.columns)


def silver_events(bronze: DataFrame) -> DataFrame:
    """The latest delivery of an event wins."""
    return keep_first(typed_events(bronze), EVENTS.keys, event_order()).select(*EVENTS.columns)
