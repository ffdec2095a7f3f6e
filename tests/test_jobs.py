"""Raw files through bronze, silver and gold."""

import datetime as dt
import gzip
import json
from pathlib import Path

import pytest
from conftest import at

from tapemill import jobs
from tapemill.sources import raw
from tapemill.specs import RAW_EVENTS, TABLES
from tapemill.storage.publish import QualityError
from tapemill.streaming import slots

DAY = dt.date(2024, 1, 15)
HEADER = "event_id,symbol,event_type,event_date,event_start,event_end,description"


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lake(spark, str(tmp_path / "lake"), str(tmp_path))


def drop_ticks(lake, feed, hour, lines, name="part"):
    folder = raw.hour_paths(lake.raw_root, feed, DAY, [hour])[0]
    Path(folder).mkdir(parents=True, exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    (Path(folder) / f"{name}.jsonl.gz").write_bytes(gzip.compress(text.encode()))


def drop_events(lake, *lines, header=HEADER, day=DAY):
    path = Path(raw.events_path(lake.raw_root, day))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")


def tick(seq, ts="2024-01-15T10:00:00.5", price=10.0, **changes):
    return {"exchange": "NYSE", "symbol": "AAPL", "exchange_ts": ts, "price": price, "size": 5, "sequence_num": seq,
            "side": "BUY", "trade_id": f"T{seq}", **changes}


def quote(seq, ts="2024-01-15T10:00:00.5", bid=10.0, ask=10.2):
    return {"exchange": "NYSE", "symbol": "AAPL", "exchange_ts": ts, "bid": bid, "bid_size": 1, "ask": ask,
            "ask_size": 1, "sequence_num": seq}


def event_line(event_id="E1", event_type="SPLIT", day="2024-01-15", start="T10:30:00", end="T11:00:00"):
    return f"{event_id},AAPL,{event_type},{day},{day}{start},{day}{end},text"


def test_tables_are_created_once(lake):
    assert jobs.create_tables(lake) == list(TABLES) and len(TABLES) == 10
    assert jobs.create_tables(lake) == []
    assert lake.table("gold.vwap_daily").read().isEmpty()


def test_permissive_json(lake):
    drop_ticks(lake, "trades", 10, [tick(1, extra="x"), tick(2, price="cheap"), "{broken", {"symbol": "MSFT"}])
    out = sorted((tuple(r) for r in raw.read_trades(lake.spark, lake.raw_root, DAY, [9, 10]).collect()), key=repr)
    ts = "2024-01-15T10:00:00.5"
    assert out == sorted(
        [("NYSE", "AAPL", ts, 10.0, 5, 1, "BUY", "T1"), ("NYSE", "AAPL", ts, None, 5, 2, "BUY", "T2"), (None,) * 8,
         (None, "MSFT", None, None, None, None, None, None)], key=repr)


def test_nothing_to_do(lake):
    drop_events(lake)
    assert jobs.ingest_events(lake, DAY, "r").pointer is None
    assert jobs.ingest_trades(lake, DAY, [9], "r").pointer is None
    assert jobs.ingest_events(lake, dt.date(2024, 2, 1), "r").pointer is None
    assert jobs.promote_trades(lake, DAY, "r") is None
    assert jobs.promote_quotes(lake, DAY, "r") is None
    assert jobs.promote_events(lake, DAY, "r") is None
    drop_events(lake, event_line(event_id=""))
    assert jobs.ingest_events(lake, DAY, "r").pointer is None


def test_lineage_comes_from_the_run(lake):
    drop_ticks(lake, "trades", 10, [tick(1, ts="2024-01-14T23:59:59")])
    jobs.ingest_trades(lake, DAY, [10], "r", at("2024-01-15T16:00:00"))
    row = lake.day("bronze.trades_raw", DAY).first()
    assert row._trade_date == DAY
    stamp = lake.day("bronze.trades_raw", DAY).selectExpr("string(_ingest_ts)").first()[0]
    assert stamp == "2024-01-15 16:00:00"


def test_redelivery_replaces_and_repeats_are_harmless(lake):
    drop_ticks(lake, "trades", 10, [tick(1), tick(1), tick(2)])
    for run in ("r1", "r2"):
        jobs.ingest_trades(lake, DAY, [10], run)
    drop_ticks(lake, "trades", 10, [tick(1, price=11.0)])
    jobs.ingest_trades(lake, DAY, [10], "r3")
    out = lake.table("bronze.trades_raw").read().collect()
    assert sorted((r.sequence_num, r.price) for r in out) == [(1, 11.0), (2, 10.0)]


def test_columns_of_a_reordered_csv_are_taken_by_position_and_caught(lake):
    drop_events(lake, "AAPL,E1,SPLIT,2024-01-15,2024-01-15T10:30:00,2024-01-15T11:00:00,x",
                "MSFT,E2,text,SPLIT,2024-01-15T10:30:00,2024-01-15T11:00:00,x",
                header="symbol,event_id,description,event_type,event_start,event_end,event_date")
    rows = raw.read_events_csv(lake.spark, [raw.events_path(lake.raw_root, DAY)])
    assert rows.columns == RAW_EVENTS.fieldNames() and rows.first().event_id == "AAPL"
    jobs.ingest_events(lake, DAY, "r")
    with pytest.raises(ValueError, match="1 row"):
        jobs.promote_events(lake, DAY, "r")


def test_bad_event_type_is_not_published(lake):
    drop_events(lake, event_line(event_type="PARTY"))
    jobs.ingest_events(lake, DAY, "r")
    with pytest.raises(QualityError, match="contained_in"):
        jobs.promote_events(lake, DAY, "r")
    assert lake.table("silver.events").pointer() is None


def test_unparseable_timestamp_blocks_the_promotion(lake):
    drop_ticks(lake, "trades", 10, [tick(1), tick(2, ts="bad-ts")])
    jobs.ingest_trades(lake, DAY, [10], "r")
    with pytest.raises(QualityError, match=r"complete\(exchange_ts\)"):
        jobs.promote_trades(lake, DAY, "r")
    assert lake.table("silver.trades").read().isEmpty()


def test_modes_are_validated(lake):
    with pytest.raises(ValueError, match="mode"):
        jobs.compute_gold(lake, DAY, "ticks", "r")
    with pytest.raises(ValueError, match="day"):
        jobs.compute_gold(lake, "2024-01-15", "ohlcv", "r")
    with pytest.raises(QualityError):
        jobs.check_gold_rows(lake, DAY, "ohlcv")
    assert jobs.check_gold_rows(lake, DAY, "event_windowed") == 0


def test_a_trading_day(lake):
    """Calendar, two slots with a late correction, close."""
    jobs.create_tables(lake)
    drop_events(lake, event_line("E1"), event_line("E1", "GUIDANCE").replace("text", "later"), event_line("E2", start="T12:00:00", end="T12:30:00"))
    slots.run_calendar(lake, DAY, "cal", at("2024-01-15T05:30:00"))

    drop_ticks(lake, "trades", 10, [tick(1), tick(2, "2024-01-15T10:30:00", 12.0), tick(3, "2024-01-15T10:31:00", 9.0)])
    drop_ticks(lake, "quotes", 10, [quote(1), quote(2, ask=10.4)])
    assert slots.run_slot(lake, DAY, [10], "1015", at("2024-01-15T10:15:00")) == {"ohlcv": 3, "spread": 1}

    # A late file: one new tick, one changed tick, one tick under a new trade id that must not win.
    drop_ticks(lake, "trades", 10, [tick(4, "2024-01-15T11:20:00", 10.0), tick(1, price=11.0), tick(2, "2024-01-15T10:30:00", 99.0, trade_id="R2")], "late")
    counts = slots.run_slot(lake, DAY, [10, 11], "1030", at("2024-01-15T10:30:00"))
    assert counts["ohlcv"] == 4

    silver = {r.sequence_num: r for r in lake.day("silver.trades", DAY).collect()}
    assert sorted(silver) == [1, 2, 3, 4]
    assert {float(silver[1].price)} <= {10.0, 11.0} and silver[1].event_id == "E1"
    assert silver[2].trade_id in {"T2", "R2"}

    assert slots.run_close(lake, DAY, "close") == {"vwap": 1, "event_windowed": 2}
    window = {r.event_id: r for r in lake.day("gold.event_windowed_volume", DAY).collect()}
    assert (window["E1"].pre_volume, window["E1"].post_volume) == (5, 15)
    assert window["E2"].pre_volume == 5

    before = {n: sorted(map(repr, lake.table(n).read().collect())) for n in TABLES}
    slots.run_close(lake, DAY, "close-again")
    assert {n: sorted(map(repr, lake.table(n).read().collect())) for n in TABLES} == before


def test_same_key_with_later_trade_id_keeps_the_earlier_run(lake):
    drop_ticks(lake, "trades", 10, [tick(1)])
    jobs.ingest_trades(lake, DAY, [10], "a", at("2024-01-15T10:15:00"))
    drop_ticks(lake, "trades", 11, [tick(1, price=50.0, trade_id="A-earlier-name")])
    jobs.ingest_trades(lake, DAY, [11], "b", at("2024-01-15T11:15:00"))
    jobs.promote_trades(lake, DAY, "b")
    out = lake.table("silver.trades").read().collect()
    assert [(r.trade_id, float(r.price)) for r in out] == [("T1", 10.0)]
