"""Bars, VWAP and spreads on hand-written rows."""

from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F

from tapemill.operators import bars
from tapemill.specs import TABLES

TRADES, QUOTES = TABLES["silver.trades"].schema, TABLES["silver.quotes"].schema


def trade(ts, price, size=10, exchange="NYSE", symbol="AAPL", seq=1):
    return {
        "exchange": exchange, "symbol": symbol, "exchange_ts": ts and at(ts), "sequence_num": seq,
        "trade_date": ts and at(ts).date(), "price": None if price is None else Decimal(str(price)), "size": size,
    }


def quote(ts, bid, ask):
    return {
        "exchange": "NYSE", "symbol": "AAPL", "exchange_ts": at(ts), "sequence_num": 1,
        "bid": None if bid is None else Decimal(str(bid)), "ask": None if ask is None else Decimal(str(ask)),
    }


def one_bar(frame, *rows):
    out = bars.ohlcv_1m(frame(TRADES, *rows)).collect()
    assert len(out) == 1
    return out[0]


def test_tied_instants_open_low_and_close_high(frame):
    first, last = "2024-01-15T09:30:00.000001", "2024-01-15T09:30:59.999999"
    bar = one_bar(frame, trade(first, 12, seq=1), trade(first, 11, seq=2), trade("2024-01-15T09:30:30", 50),
                  trade(last, 13, seq=9), trade(last, 14, seq=8))
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume, bar.n_trades) == (11.0, 50.0, 11.0, 14.0, 50, 5)


def test_null_price_sorts_lowest_within_its_instant(frame):
    first, last = "2024-01-15T09:30:00", "2024-01-15T09:30:10"
    bar = one_bar(frame, trade(first, None), trade(first, 5), trade(last, None), trade(last, 7))
    assert (bar.open, bar.close, bar.low, bar.high) == (None, 7.0, 5.0, 7.0)
    bar = one_bar(frame, trade(first, 5), trade(last, None))
    assert (bar.open, bar.close) == (5.0, None)


@pytest.mark.parametrize("price", ["999999999999.999999", "-0.000001", "137438.953472", "137437.999999", "-5", "0"])
def test_prices_of_any_size_and_sign_are_exact(frame, price):
    bar = one_bar(frame, trade("2024-01-15T09:30:10", price), trade("2024-01-15T09:30:20", "3"),
                  trade("2024-01-15T09:30:30", price))
    assert (bar.open, bar.close) == (float(price), float(price))


def test_packed_order_equals_struct_order_on_mixed_rows(spark, frame):
    """Wide, small, negative and NULL prices at few instants, against min and max of a struct."""
    prices = F.expr(
        "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN -(id % 97) / 8 WHEN 2 THEN 137438 + id % 3 "
        "WHEN 3 THEN id % 1000 / 16 ELSE 900000000000 + id END"
    )
    rows = spark.range(5000).select(
        F.concat(F.lit("X"), F.col("id") % 3).alias("exchange"), F.lit("AAPL").alias("symbol"),
        F.expr("timestamp_micros(1705311000000000 + (id * 7919 % 400) * 1000000)").alias("exchange_ts"),
        prices.cast("decimal(18,6)").alias("price"), F.col("id").alias("size"),
    )
    expected = (
        rows.withColumn("price", F.col("price").cast("double"))
        .groupBy(F.date_trunc("minute", "exchange_ts").alias("bar_start"), "exchange", "symbol")
        .agg(F.min(F.struct("exchange_ts", "price"))["price"].alias("open"),
             F.max(F.struct("exchange_ts", "price"))["price"].alias("close"))
    )
    actual = bars.ohlcv_1m(rows).select(*expected.columns)
    assert expected.count() > 10
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


def test_bars_need_no_sort(spark, frame):
    plan = bars.ohlcv_1m(frame(TRADES, trade("2024-01-15T09:30:10", 1)))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_vwap_ignores_null_price_in_the_numerator_only_and_zero_volume_is_null(frame):
    ts = "2024-01-15T10:00:00"
    rows = frame(TRADES, trade(ts, 10, 1), trade(ts, 20, 3), trade(ts, None, 4), trade(ts, 5, 0, exchange="ARCA"))
    out = {r.exchange: r for r in bars.vwap_daily(rows).collect()}
    assert (out["NYSE"].vwap, out["NYSE"].volume, out["NYSE"].n_trades) == (70 / 8, 8, 3)
    assert out["ARCA"].vwap is None


def test_even_number_of_spreads_takes_the_lower_middle(frame):
    rows = [quote(f"2024-01-15T10:00:{i:02d}", 100, 100 + i) for i in (1, 2, 3, 4)]
    spreads = sorted(i / ((200 + i) / 2) * 10000 for i in (1, 2, 3, 4))
    out = bars.bid_ask_spread_1m(frame(QUOTES, *rows)).first()
    assert out.median_spread == pytest.approx(spreads[1])
    assert out.mid_price == pytest.approx(101.25) and out.n_ticks == 4


def test_zero_mid_has_no_spread(frame):
    out = bars.bid_ask_spread_1m(frame(QUOTES, quote("2024-01-15T10:00:00", 0, 0))).first()
    assert out.median_spread is None and out.n_ticks == 1
