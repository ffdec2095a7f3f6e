"""Joins of ticks with the much smaller calendar of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.session import MIB

# A build side within both limits takes well under 100 MB per executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * MIB

# What event windows read of a trade; its own event columns belong to enrichment.
TICK_COLUMNS = ("exchange", "symbol", "exchange_ts", "sequence_num", "price", "size")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure `df` with one small aggregate. Estimates are no proof: they miss explodes and compression."""
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    width = sum(text, F.lit(16 * len(df.columns)))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def sized(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side measured as small; otherwise ask for a merge join."""
    return F.broadcast(df) if small else df.hint("merge")


def enrich_with_event(trades: DataFrame, first_events: DataFrame, small: bool) -> DataFrame:
    """Left join on symbol and day. `first_events` holds at most one row per symbol and day."""
    calendar = first_events.select(
        F.col("symbol").alias("_ev_symbol"),
        F.col("event_date").alias("_ev_date"),
        "event_id",
        "event_type",
    )
    same_day = (F.col("symbol") == F.col("_ev_symbol")) & (F.col("trade_date") == F.col("_ev_date"))
    return trades.join(sized(calendar, small), same_day, "left").drop("_ev_symbol", "_ev_date")


def windows_by_hour(windows: DataFrame) -> DataFrame:
    """Each window under every hour it touches. This is the side that a join broadcasts, so measure it."""
    hours = F.sequence(
        F.date_trunc("hour", "window_start"), F.date_trunc("hour", "window_end"), F.expr("INTERVAL 1 HOUR")
    )
    return windows.withColumn("_hour", F.explode(hours))


def join_event_windows(trades: DataFrame, listed: DataFrame, small: bool) -> DataFrame:
    """Every trade with every window of its symbol that holds it, both bounds closed.

    Windows come from `windows_by_hour` and trades look up their own hour, so the join stays an
    equi-join on (symbol, hour) and the range is only checked within one hour. A trade has one
    hour, hence no pair appears twice.
    """
    inside = (F.col("exchange_ts") >= F.col("window_start")) & (F.col("exchange_ts") <= F.col("window_end"))
    ticks = trades.select(*TICK_COLUMNS, F.date_trunc("hour", "exchange_ts").alias("_hour"))
    return ticks.join(sized(listed, small), ["symbol", "_hour"]).where(inside).drop("_hour")
