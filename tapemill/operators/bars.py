"""One-minute bars, daily VWAP and quoted spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.functions.ticks import mid_price, minute, spread_bps

BAR_KEY = ["bar_start", "exchange", "symbol"]

# A trade of a bar is ordered by (microsecond within the minute, price). As one number this keeps
# the aggregate a hash aggregate; min or max of a struct would make Spark sort all trades first.
# A long holds 26 bits of time above 37 bits of price in millionths, which covers prices from 0 up
# to 137,438. All other decimal(18,6) prices, and NULL, go into a decimal(38): time above 19 digits
# of price, shifted to be positive, with 0 for NULL, which sorts lowest.
_PRICE_BITS = 37
_MILLION = 1_000_000
_LONG_PRICE_LIMIT = (1 << _PRICE_BITS) // _MILLION
_SHIFT = "1" + "0" * 18
_WIDE_UNIT = "1" + "0" * 19


def _whole(digits: str) -> Column:
    return F.lit(digits).cast(f"decimal({len(digits)},0)")


def _as_long(offset: Column, price: Column) -> Column:
    return F.shiftleft(offset, _PRICE_BITS) + F.rint(price.cast("double") * _MILLION).cast("long")


def _from_long(packed: Column) -> Column:
    millionths = packed.bitwiseAND(F.lit((1 << _PRICE_BITS) - 1))
    return F.when(
        packed.isNotNull(),
        F.struct(F.shiftright(packed, _PRICE_BITS).alias("offset"), (millionths.cast("double") / _MILLION).alias("price")),
    )


def _as_decimal(offset: Column, price: Column) -> Column:
    shifted = (price * _MILLION).cast("decimal(18,0)") + _whole(_SHIFT)
    return offset.cast("decimal(8,0)") * _whole(_WIDE_UNIT) + F.coalesce(shifted, F.lit(0).cast("decimal(19,0)"))


def _from_decimal(packed: Column) -> Column:
    shifted = (packed % _whole(_WIDE_UNIT)).cast("decimal(19,0)")
    millionths = (F.nullif(shifted, F.lit(0).cast("decimal(19,0)")) - _whole(_SHIFT)).cast("decimal(18,0)")
    offset = ((packed - shifted) / _whole(_WIDE_UNIT)).cast("long")
    price = (millionths * F.lit("0.000001").cast("decimal(6,6)")).cast("double")
    return F.when(packed.isNotNull(), F.struct(offset.alias("offset"), price.alias("price")))


def bar_states() -> list[Column]:
    """Aggregates of a bar's trades (bar_start, exchange_ts, price decimal(18,6), size), in a form that merges further."""
    offset = F.coalesce(F.unix_micros("exchange_ts") - F.unix_micros("bar_start"), F.lit(0).cast("long"))
    price = F.col("price")
    fits_long = F.coalesce((price >= 0) & (price < _LONG_PRICE_LIMIT), F.lit(False))
    as_long, as_wide = F.when(fits_long, _as_long(offset, price)), F.when(~fits_long, _as_decimal(offset, price))
    return [
        F.min(as_long).alias("_long_first"),
        F.max(as_long).alias("_long_last"),
        F.min(as_wide).alias("_wide_first"),
        F.max(as_wide).alias("_wide_last"),
        F.max(price.cast("double")).alias("high"),
        F.min(price.cast("double")).alias("low"),
        F.sum("size").cast("long").alias("volume"),
        F.count("*").alias("n_trades"),
    ]


def merged_bar_states() -> list[Column]:
    """Aggregates of states of one bar: again a state."""
    ways = {
        "_long_first": F.min, "_long_last": F.max, "_wide_first": F.min, "_wide_last": F.max,
        "high": F.max, "low": F.min, "volume": F.sum, "n_trades": F.sum,
    }
    return [way(name).alias(name) for name, way in ways.items()]


def bar_columns() -> list[Column]:
    """Columns of a bar from its state, without the key."""
    first = F.least(_from_long(F.col("_long_first")), _from_decimal(F.col("_wide_first")))
    last = F.greatest(_from_long(F.col("_long_last")), _from_decimal(F.col("_wide_last")))
    opened, closed = first["price"].alias("open"), last["price"].alias("close")
    return [opened, F.col("high"), F.col("low"), closed, F.col("volume"), F.col("n_trades")]


def ohlcv_1m(trades: DataFrame) -> DataFrame:
    """Minute bars of each exchange and symbol from trades with decimal(18,6) prices.

    At a tied first (last) instant the lowest (highest) price opens (closes) the bar.
    """
    bars = trades.withColumn("bar_start", minute("exchange_ts")).groupBy(*BAR_KEY).agg(*bar_states())
    return bars.select(*BAR_KEY, *bar_columns())


def vwap_daily(trades: DataFrame) -> DataFrame:
    """Volume-weighted price per day; NULL where the day's volume is zero.

    Decimals are summed exactly and divided once, so the result does not depend on the order of trades.
    """
    traded = F.sum(F.col("price") * F.col("size")).cast("double")
    return trades.groupBy("trade_date", "exchange", "symbol").agg(
        F.try_divide(traded, F.sum("size").cast("double")).alias("vwap"),
        F.sum("size").cast("long").alias("volume"),
        F.count("*").alias("n_trades"),
    )


def quote_spreads(quotes: DataFrame) -> DataFrame:
    """Spread in basis points and mid price of every quote."""
    bid, ask = F.col("bid").cast("double"), F.col("ask").cast("double")
    return quotes.select(
        minute("exchange_ts").alias("bar_start"),
        "exchange",
        "symbol",
        spread_bps(bid, ask).alias("spread_bps"),
        mid_price(bid, ask).alias("mid_price"),
    )


def bid_ask_spread_1m(quotes: DataFrame) -> DataFrame:
    """Median spread (lower middle of an even count), mean mid price and ticks per minute.

    The mean is that of exact sums of bid and ask, whatever the order of quotes.
    """
    bid, ask = F.col("bid").cast("double"), F.col("ask").cast("double")
    ticks = quotes.select(
        minute("exchange_ts").alias("bar_start"),
        "exchange",
        "symbol",
        spread_bps(bid, ask).alias("spread_bps"),
        (F.col("bid") + F.col("ask")).alias("both_sides"),
    )
    return ticks.groupBy(*BAR_KEY).agg(
        F.percentile_approx("spread_bps", 0.5).alias("median_spread"),
        F.try_divide(F.sum("both_sides").cast("double"), F.count("both_sides") * 2).alias("mid_price"),
        F.count("*").alias("n_ticks"),
    )
