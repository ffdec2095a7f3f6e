"""Event windows: bounds, ties, gaps, and the segment method against all pairs."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from conftest import DATA, at
from pyspark.sql import functions as F

from tapemill import catalog
from tapemill.operators import event_window as ew
from tapemill.operators import joins
from tapemill.specs import TABLES

TRADES, EVENTS = TABLES["silver.trades"].schema, TABLES["silver.events"].schema
NOON = "2024-01-15T12:00:00"
MICRO = dt.timedelta(microseconds=1)
HOUR = dt.timedelta(hours=1)


def trade(ts, size=1, price=10, symbol="AAPL", exchange="NYSE", seq=1):
    ts = at(ts) if isinstance(ts, str) else ts
    return {"exchange": exchange, "symbol": symbol, "exchange_ts": ts, "sequence_num": seq,
            "price": Decimal(str(price)), "size": size}


def event(start=NOON, name="E1", symbol="AAPL"):
    return {"event_id": name, "symbol": symbol, "event_type": "SPLIT", "event_start": start and at(start)}


@pytest.fixture(params=[True, False], ids=["broadcast", "merge"])
def run(frame, request):
    def rows(trades, events):
        out = ew.event_windowed_volume(frame(TRADES, *trades), frame(EVENTS, *events), request.param)
        return sorted(out.collect(), key=lambda r: r.event_id)

    return rows


def test_bounds_are_closed_and_the_event_instant_is_post(run):
    t = at(NOON)
    (row,) = run(
        [trade(t - HOUR - MICRO, 1), trade(t - HOUR, 2), trade(t - MICRO, 4), trade(t, 8), trade(t + HOUR, 16),
         trade(t + HOUR + MICRO, 32)],
        [event()],
    )
    assert (row.pre_volume, row.post_volume) == (6, 24)
    assert row.window_end - row.window_start == 2 * HOUR


def test_bounds_inside_a_minute(run):
    start = "2024-01-15T12:00:30.5"
    t = at(start)
    (row,) = run(
        [trade(t - HOUR - MICRO, 1), trade(t - HOUR, 2), trade(t - MICRO, 4), trade(t, 8), trade(t + HOUR, 16),
         trade(t + HOUR + MICRO, 32)],
        [event(start)],
    )
    assert (row.pre_volume, row.post_volume) == (6, 24)


def test_event_without_trades_or_start_has_no_row(run):
    rows = run([trade(NOON), trade("2024-01-15T20:00:00", symbol="MSFT")],
               [event(name="A"), event(name="B", symbol="MSFT"), event(None, "C")])
    assert [r.event_id for r in rows] == ["A"]


def test_fewer_than_two_returns_give_zero_volatility(run):
    (row,) = run([trade("2024-01-15T11:30:00"), trade("2024-01-15T11:31:00", price=12)], [event()])
    assert row.realized_vol == 0.0


def test_gaps_compare_with_the_previous_minute_that_traded(run):
    (row,) = run([trade("2024-01-15T11:30:00", price=10), trade("2024-01-15T11:40:10", price=1),
                  trade("2024-01-15T11:40:50", price=20), trade("2024-01-15T12:10:00", price=10)], [event()])
    assert row.realized_vol == pytest.approx(math.log(2) * math.sqrt(2))


def test_last_price_pools_exchanges_and_breaks_ties(frame):
    rows = [trade(NOON, price=1, seq=5), trade(NOON, price=2, seq=6), trade(NOON, price=3, seq=6, exchange="ARCA")]
    windows = ew.distinct_windows(ew.calendar_events(frame(EVENTS, event())))
    bars = ew.segment_bars(frame(TRADES, *rows), ew.window_segments(windows), True)
    assert bars.first().last_price == 2


def test_zero_previous_price_is_no_return_and_no_error(run):
    (row,) = run([trade("2024-01-15T11:30:00", price=0), trade("2024-01-15T11:31:00", price=5)], [event()])
    assert row.realized_vol == 0.0


def test_events_at_one_instant_share_their_window(run):
    trades = [trade(f"2024-01-15T12:0{i}:00", price=10 + i * i) for i in range(4)]
    a, b = run(trades, [event(name="A"), event(name="B")])
    assert a.realized_vol == b.realized_vol > 0
    assert (a.pre_volume, a.post_volume) == (b.pre_volume, b.post_volume) == (0, 4)


def test_window_crosses_midnight(run):
    (row,) = run([trade("2024-01-15T23:30:00", 1), trade("2024-01-16T00:59:00", 2), trade("2024-01-16T01:11:00", 4)],
                 [event("2024-01-16T00:10:00")])
    assert (row.pre_volume, row.post_volume) == (1, 2)


def test_null_sizes_follow_sum_with_else_zero(run):
    (row,) = run([trade("2024-01-15T11:30:00", None)], [event()])
    assert (row.pre_volume, row.post_volume) == (None, 0)


def test_segments_equal_all_pairs_with_close_cuts(spark, frame):
    """Many windows with cuts inside the same minutes, against a plain pair join."""
    trades = spark.range(4000).select(
        F.concat(F.lit("X"), F.col("id") % 2).alias("exchange"), F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.expr("timestamp_micros(1705311000000000 + id * 7919 * 131071 % 9000000000)").alias("exchange_ts"),
        F.col("id").alias("sequence_num"), (F.col("id") % 50 + 1).cast("decimal(18,6)").alias("price"),
        (F.col("id") % 9).alias("size"),
    )
    events = spark.range(60).select(
        F.concat(F.lit("E"), "id").alias("event_id"), F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        F.lit("SPLIT").alias("event_type"),
        F.expr("timestamp_micros(1705311000000000 + id * 17000001)").alias("event_start"),
    )
    pairs = joins.join_event_windows(trades, joins.windows_by_hour(ew.with_bounds(ew.calendar_events(events))), True)
    pre = F.col("exchange_ts") < F.col("event_ts")
    expected = pairs.groupBy("event_id").agg(
        F.sum(F.when(pre, F.col("size")).otherwise(0)).alias("pre_volume"),
        F.sum(F.when(pre, 0).otherwise(F.col("size"))).alias("post_volume"),
    )
    actual = ew.event_windowed_volume(trades, events, True).select("event_id", "pre_volume", "post_volume")
    assert expected.count() == 60
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


@pytest.mark.parametrize("small", [True, False])
def test_pair_join_counts_a_trade_once_per_window(frame, small):
    windows = ew.with_bounds(ew.calendar_events(frame(EVENTS, event(name="A"), event("2024-01-15T12:30:00", "B"))))
    out = joins.join_event_windows(
        frame(TRADES, trade("2024-01-15T12:10:00"), trade("2024-01-15T11:10:00")), joins.windows_by_hour(windows), small
    )
    assert sorted((r.event_id, r.exchange_ts.minute) for r in out.collect()) == [("A", 10), ("A", 10), ("B", 10)]


def test_broadcast_only_when_measured_small(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) AS text")
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=999)
    assert not joins.fits_broadcast(df, max_bytes=50_000)
    plan = joins.sized(df, False).join(spark.range(10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_large_calendar_gives_the_same_windows(spark, monkeypatch):
    path = f"{DATA}/sf0.001"
    expected = catalog.QUERIES["event_window"](spark, path)
    monkeypatch.setattr(ew, "windows_fit_broadcast", lambda windows: False)
    actual = catalog.QUERIES["event_window"](spark, path)
    assert actual.exceptAll(expected).isEmpty() and actual.count() == expected.count()
