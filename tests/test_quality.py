"""Checks and gates."""

from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F

from tapemill.operators import quality
from tapemill.specs import TABLES

TRADES, QUOTES, EVENTS = (TABLES[f"silver.{t}"].schema for t in ("trades", "quotes", "events"))


def statuses(df, suite):
    return {r.rule: r.status for r in quality.run_checks(df, suite).collect()}


def failures(df, suite):
    return {rule for rule, status in statuses(df, suite).items() if status != "Success"}


def trade(seq=1, **changes):
    return {"exchange": "NYSE", "symbol": "AAPL", "exchange_ts": at("2024-01-15T10:00:00"), "sequence_num": seq,
            "price": Decimal(1), "size": 1, "side": "BUY", **changes}


def quote(seq=1, **changes):
    return {"exchange": "NYSE", "symbol": "AAPL", "exchange_ts": at("2024-01-15T10:00:00"), "sequence_num": seq,
            "bid": Decimal(1), "ask": Decimal(2), "bid_size": 1, "ask_size": 1, **changes}


def event(**changes):
    return {"event_id": "E", "symbol": "AAPL", "event_type": "SPLIT", "event_date": at("2024-01-15").date(),
            "event_start": at("2024-01-15T10:00:00"), "event_end": at("2024-01-15T11:00:00"), **changes}


def test_suites_have_every_rule():
    assert {name: len(rules) for name, rules in quality.SUITES.items()} == {
        "silver_trades_quality": 8, "silver_quotes_quality": 12, "silver_events_quality": 8,
    }


def test_null_side_size_and_price_pass(frame):
    assert failures(frame(TRADES, trade(side=None, size=None, price=None)), "silver_trades_quality") == set()


def test_bad_domain_and_sign_fail(frame):
    rows = frame(TRADES, trade(side="HOLD"), trade(2, size=-1), trade(3, price=Decimal(-1)), trade(4, symbol=None))
    assert failures(rows, "silver_trades_quality") == {
        "contained_in(side)", "non_negative(size)", "non_negative(price)", "complete(symbol)",
    }


def test_null_bid_fails_completeness_and_counts_as_crossed(frame):
    assert failures(frame(QUOTES, quote(bid=None)), "silver_quotes_quality") == {"complete(bid)", "satisfies(ask > bid)"}


@pytest.mark.parametrize("crossed, expected", [(9, set()), (11, {"satisfies(ask > bid)"})])
def test_crossed_quotes_are_tolerated_up_to_one_percent(spark, crossed, expected):
    rows = spark.range(1000).select(
        F.lit("NYSE").alias("exchange"), F.lit("AAPL").alias("symbol"),
        F.expr("TIMESTAMP '2024-01-15 10:00:00'").alias("exchange_ts"), F.col("id").alias("sequence_num"),
        F.lit(10).alias("bid"), F.when(F.col("id") < crossed, 9).otherwise(11).alias("ask"),
        F.lit(1).alias("bid_size"), F.lit(1).alias("ask_size"),
    )
    assert failures(rows, "silver_quotes_quality") == expected


def test_uniqueness_counts_rows_alone_under_their_key(frame):
    rows = frame(TRADES, trade(1), trade(1), trade(2), trade(3))
    metric = {r.rule: r.metric for r in quality.run_checks(rows, "silver_trades_quality").collect()}
    assert metric["unique(exchange, symbol, exchange_ts, sequence_num)"] == 0.5


def test_events(frame):
    assert failures(frame(EVENTS, event()), "silver_events_quality") == set()
    bad = frame(EVENTS, event(event_type="OTHER"), event(event_end=at("2024-01-15T10:00:00")))
    assert failures(bad, "silver_events_quality") == {
        "contained_in(event_type)", "satisfies(event_end > event_start)", "unique(event_id, event_date)",
    }


def test_empty_input_fails_every_rule(frame):
    assert set(statuses(frame(EVENTS), "silver_events_quality").values()) == {"Failure"}


def test_required_fields_count_rows_not_columns(frame):
    rows = frame(EVENTS, event(), event(event_id=None, symbol=None), event(event_date=None))
    assert tuple(quality.missing_required(rows, TABLES["silver.events"].not_null).first()) == (3, 2)


def test_row_count_gate_shows_days_without_rows(spark):
    days = spark.sql("SELECT explode(array(DATE '2024-01-15', DATE '2024-01-16')) AS day")
    rows = spark.sql("SELECT TIMESTAMP '2024-01-15 10:00:00' AS bar_start")
    for least, expected in ((1, ["Success", "Failure"]), (0, ["Success", "Success"])):
        out = quality.row_count_gate(rows, F.to_date("bar_start"), days, "g", least).orderBy("day").collect()
        assert [r.status for r in out] == expected and [r.n_rows for r in out] == [1, 0]
