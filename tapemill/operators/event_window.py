"""Volume and realised volatility in the hour before and after each corporate event.

Joining trades with events directly emits every pair. Here trades are first summed into
segments: the minutes that some window covers, cut further at the window bounds. All trades of a
segment lie in the same windows, on the same side of each event, so windows only read segments:
one per minute and cut, however many trades there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapemill.functions.ticks import log_return, minute
from tapemill.operators.joins import BROADCAST_ROWS, TICK_COLUMNS, sized

# A window of two hours touches at most 121 minutes and adds three cuts.
_SEGMENTS_PER_WINDOW = 124

# Above every offset, in microseconds, within a segment, and above every sequence number of either sign.
_SEQUENCE_SHIFT = "1" + "0" * 19
_OFFSET_UNIT = "1" + "0" * 20


def calendar_events(silver_events: DataFrame) -> DataFrame:
    """Events that have a start, under the names the windows use."""
    return silver_events.where(F.col("event_start").isNotNull()).select(
        "event_id", "symbol", "event_type", F.col("event_start").alias("event_ts")
    )


def with_bounds(events: DataFrame) -> DataFrame:
    """Adds window_start and window_end around event_ts, both inclusive."""
    reach = F.expr("INTERVAL 1 HOUR")
    return events.withColumn("window_start", F.col("event_ts") - reach).withColumn(
        "window_end", F.col("event_ts") + reach
    )


def distinct_windows(events: DataFrame) -> DataFrame:
    """Windows depend on symbol and instant only; events sharing both share one window."""
    return with_bounds(events.select("symbol", "event_ts").distinct())


def windows_fit_broadcast(windows: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the segments of `windows` stay within `max_rows`, by counting the windows."""
    return windows.count() * _SEGMENTS_PER_WINDOW <= max_rows


def _minutes_covered() -> Column:
    return F.sequence(minute("window_start"), minute("window_end"), F.expr("INTERVAL 1 MINUTE"))


def window_segments(windows: DataFrame) -> DataFrame:
    """Half-open segments [seg_start, seg_end) of every covered minute of a symbol, without overlap."""
    after_end = F.col("window_end") + F.expr("INTERVAL 1 MICROSECOND")
    starts = F.concat(_minutes_covered(), F.array("window_start", "event_ts", after_end))
    points = windows.select("symbol", F.explode(starts).alias("seg_start")).distinct()
    points = points.withColumn("bar_start", minute("seg_start"))
    following = F.lead("seg_start").over(Window.partitionBy("bar_start", "symbol").orderBy("seg_start"))
    return points.withColumn("seg_end", F.coalesce(following, F.col("bar_start") + F.expr("INTERVAL 1 MINUTE")))


def _whole(digits: str) -> Column:
    return F.lit(digits).cast(f"decimal({len(digits)},0)")


def _latest() -> Column:
    """(instant within the segment, sequence number) as one number: its maximum is a hash aggregate, a struct's sorts."""
    offset = (F.unix_micros("exchange_ts") - F.unix_micros("seg_start")).cast("decimal(8,0)")
    sequence = F.coalesce(F.col("sequence_num").cast("decimal(19,0)") + _whole(_SEQUENCE_SHIFT), F.lit(0).cast("decimal(21,0)"))
    return offset * _whole(_OFFSET_UNIT) + sequence


def segment_bars(trades: DataFrame, segments: DataFrame, small: bool) -> DataFrame:
    """Size and last price of each segment, pooled over exchanges.

    Trades are unique by exchange, symbol, instant and sequence number. Ties for last go to the highest
    sequence number, then exchange. Trades are summed per exchange first, then the few rows of a segment.
    """
    within = (F.col("exchange_ts") >= F.col("seg_start")) & (F.col("exchange_ts") < F.col("seg_end"))
    ticks = trades.select(*TICK_COLUMNS, minute("exchange_ts").alias("bar_start"))
    per_exchange = (
        ticks.join(sized(segments, small), ["bar_start", "symbol"])
        .where(within)
        .withColumn("latest", _latest())
        .groupBy("seg_start", "bar_start", "symbol", "exchange")
        .agg(
            F.sum("size").alias("size"),
            F.max("latest").alias("latest"),
            F.max_by("price", "latest").alias("price"),
        )
    )
    return per_exchange.groupBy("seg_start", "bar_start", "symbol").agg(
        F.sum("size").alias("size"),
        F.max(F.struct("latest", "exchange", "price"))["price"].alias("last_price"),
    )


def window_minutes(windows: DataFrame, bars: DataFrame, small: bool) -> DataFrame:
    """Per window and minute: size before and from the event on, and the minute's last price."""
    listed = windows.withColumn("bar_start", F.explode(_minutes_covered()))
    inside = (F.col("seg_start") >= F.col("window_start")) & (F.col("seg_start") <= F.col("window_end"))
    before = F.col("seg_start") < F.col("event_ts")
    return (
        bars.join(sized(listed, small), ["bar_start", "symbol"])
        .where(inside)
        .groupBy("event_ts", "bar_start", "symbol")
        .agg(
            F.sum(F.when(before, F.col("size")).otherwise(0)).alias("pre_size"),
            F.sum(F.when(before, 0).otherwise(F.col("size"))).alias("post_size"),
            F.max_by("last_price", "seg_start").alias("price"),
        )
    )


def with_log_returns(minutes: DataFrame) -> DataFrame:
    """Adds log_ret against the previous minute that has trades; a window has at most 121 minutes."""
    previous = F.lag("price").over(Window.partitionBy("event_ts", "symbol").orderBy("bar_start"))
    return minutes.withColumn("log_ret", log_return(F.col("price"), previous))


def realized_volatility(returns: DataFrame) -> DataFrame:
    """Sample standard deviation of the log returns per window that has any return."""
    return (
        returns.where(F.col("log_ret").isNotNull())
        .groupBy("event_ts", "symbol")
        .agg(F.stddev("log_ret").alias("realized_vol"))
    )


def event_windowed_volume(trades: DataFrame, silver_events: DataFrame, small: bool) -> DataFrame:
    """One row per event with trades in its window; events without any have no row."""
    events = calendar_events(silver_events)
    windows = distinct_windows(events)
    bars = segment_bars(trades, window_segments(windows), small)
    stats = (
        with_log_returns(window_minutes(windows, bars, small))
        .groupBy("event_ts", "symbol")
        .agg(
            F.sum("pre_size").cast("long").alias("pre_volume"),
            F.sum("post_size").cast("long").alias("post_volume"),
            F.coalesce(F.stddev("log_ret"), F.lit(0.0)).alias("realized_vol"),
        )
    )
    return (
        with_bounds(events)
        .join(stats, ["symbol", "event_ts"])
        .select(
            "event_ts", "event_id", "event_type", "symbol", "window_start", "window_end",
            "pre_volume", "post_volume", "realized_vol",
        )
    )
