"""The slices and the daily figures as SQL table functions: `SELECT * FROM vwap(DATE '2024-01-15')`.

Each is a temporary SQL function over the silver tables, registered as views. Spark inlines its body into the
query, so a day given as an argument reaches the scan as a partition filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names under which the functions look for their tables.
TRADES, QUOTES, EVENTS = "tapemill_trades", "tapemill_quotes", "tapemill_events"

_FUNCTIONS = {
    # One day of trades, quotes, events with a start.
    "trades_on(day DATE)": (
        "exchange STRING, symbol STRING, exchange_ts TIMESTAMP, sequence_num BIGINT, price DECIMAL(18,6), size BIGINT",
        f"SELECT exchange, symbol, exchange_ts, sequence_num, price, size FROM {TRADES} WHERE trade_date = trades_on.day",
    ),
    "quotes_on(day DATE)": (
        "exchange STRING, symbol STRING, exchange_ts TIMESTAMP, sequence_num BIGINT, bid DECIMAL(18,6), ask DECIMAL(18,6)",
        f"SELECT exchange, symbol, exchange_ts, sequence_num, bid, ask FROM {QUOTES} WHERE quote_date = quotes_on.day",
    ),
    "events_on(day DATE)": (
        "event_id STRING, symbol STRING, event_type STRING, event_ts TIMESTAMP",
        f"SELECT event_id, symbol, event_type, event_start FROM {EVENTS} "
        "WHERE event_date = events_on.day AND event_start IS NOT NULL",
    ),
    # The day and `reach` days on both sides.
    "trades_around(day DATE, reach INT)": (
        "exchange STRING, symbol STRING, exchange_ts TIMESTAMP, trade_date DATE, price DECIMAL(18,6), size BIGINT",
        f"SELECT exchange, symbol, exchange_ts, trade_date, price, size FROM {TRADES} WHERE trade_date BETWEEN "
        "date_sub(trades_around.day, trades_around.reach) AND date_add(trades_around.day, trades_around.reach)",
    ),
    "vwap(day DATE)": (
        "trade_date DATE, exchange STRING, symbol STRING, vwap DOUBLE, volume BIGINT, n_trades BIGINT",
        "SELECT trade_date, exchange, symbol, try_divide(CAST(sum(price * size) AS DOUBLE), CAST(sum(size) AS DOUBLE)), "
        f"CAST(sum(size) AS BIGINT), count(*) FROM {TRADES} WHERE trade_date = vwap.day "
        "GROUP BY trade_date, exchange, symbol",
    ),
}


def register(spark: SparkSession, trades: DataFrame, quotes: DataFrame, events: DataFrame) -> list[str]:
    """Define the functions over these frames for the session; returns their names. Defining again replaces them."""
    for name, rows in ((TRADES, trades), (QUOTES, quotes), (EVENTS, events)):
        rows.createOrReplaceTempView(name)
    for head, (columns, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE ({columns}) RETURN {body}")
    return [head.split("(")[0] for head in _FUNCTIONS]
