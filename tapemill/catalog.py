"""Every registered query: a Spark plan over the fixture feeds."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill import arrivals, fixtures, session
from tapemill.functions.parsing import parse_timestamp
from tapemill.operators import bars, dedup, event_window, joins, quality
from tapemill.operators.upsert import drop_null_keys, upsert
from tapemill.plans import bronze, gold, silver
from tapemill.sources import raw
from tapemill.specs import RAW_QUOTES, RAW_TRADES, TABLES
from tapemill.storage.publish import QualityError, write_audit_publish
from tapemill.storage.table import Table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = date.fromisoformat(fixtures.FIRST_DAY)
RUN_AT = datetime(2024, 1, 15, 16, 0)


def _edge(df: DataFrame) -> DataFrame:
    """Plain driver types: instants without a zone (they are UTC), decimals as doubles."""
    kinds = {T.TimestampType: "timestamp_ntz", T.DecimalType: "double"}
    return df.select(
        *[F.col(f.name).cast(kinds[type(f.dataType)]) if type(f.dataType) in kinds else f.name for f in df.schema]
    )


def _query(fn: Query, name: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.configure_ticks(spark, fixtures.input_bytes(spark, sf_dir))
        return _edge(fn(spark, sf_dir))

    QUERIES[name or fn.__name__] = run
    return fn


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Sums of doubles depend on their order in the last bits; outputs are rounded."""
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


# Shared inputs -----------------------------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_events(drop_null_keys(fixtures.bronze_events(spark, sf), ["event_id"]))


def _table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Written to the scratch folder and read back: several uses of a table must not recompute it."""
    path = f"{session.scratch_dir(spark, name)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _events_table(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, _events(spark, sf), "silver-events")


def _trades(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated trades that pass the NOT NULL gate; gold needs no event columns."""
    rows = silver.deduplicated_trades(fixtures.bronze_trades(spark, sf))
    return rows.where(F.col("exchange_ts").isNotNull())


def _quotes(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_quotes(fixtures.bronze_quotes(spark, sf))


def _windows(events: DataFrame) -> tuple[DataFrame, bool]:
    windows = event_window.distinct_windows(event_window.calendar_events(events))
    return windows, event_window.windows_fit_broadcast(windows)


def _window_minutes(spark: SparkSession, sf: str) -> DataFrame:
    windows, small = _windows(_events_table(spark, sf))
    per_segment = event_window.segment_bars(_trades(spark, sf), event_window.window_segments(windows), small)
    return event_window.window_minutes(windows, per_segment, small)


# Bronze ------------------------------------------------------------------------------------------


@_query
def bronze_lineage(spark: SparkSession, sf: str) -> DataFrame:
    raw = fixtures.bronze_trades(spark, sf).select(*RAW_TRADES.fieldNames())
    return bronze.with_lineage(raw, "_trade_date", DAY, RUN_AT)


@_query
def bronze_day_slice(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.day_slice(fixtures.bronze_trades(spark, sf), "_trade_date", DAY)


@_query
def null_key_guard(spark: SparkSession, sf: str) -> DataFrame:
    return drop_null_keys(fixtures.bronze_events(spark, sf), ["event_id"])


@_query
def upsert_trades(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.bronze_trades(spark, sf)
    target = rows.where("side <> 'SELL'")
    source = rows.where("side <> 'BUY'").withColumn("price", F.col("price") + 1)
    name = "bronze.trades_raw"
    return upsert(bronze.merge_source(target, name, True), bronze.merge_source(source, name, True), TABLES[name].keys)


@_query
def upsert_quotes(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.bronze_quotes(spark, sf)
    target = rows.where("exchange <> 'NYSE'")
    source = rows.where("exchange <> 'ARCA'").withColumn("bid_size", F.col("bid_size") + 1)
    name = "bronze.quotes_raw"
    return upsert(bronze.merge_source(target, name, True), bronze.merge_source(source, name, True), TABLES[name].keys)


@_query
def upsert_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.bronze_events(spark, sf)
    target = rows.where("event_type <> 'SPLIT'")
    source = rows.where("event_type <> 'DIVIDEND'").withColumn("description", F.upper("description"))
    keys = TABLES["bronze.events_raw"].keys
    return upsert(bronze.event_merge_source(target), bronze.event_merge_source(source), keys)


def _with_hour(rows: DataFrame, day_column: str) -> DataFrame:
    """Adds the folder columns of an hourly drop; garbled timestamps land in the opening hour."""
    hour = F.coalesce(F.hour(F.try_to_timestamp("exchange_ts")), F.lit(9))
    return rows.withColumns({"dt": F.col(day_column), "hh": F.lpad(hour.cast("string"), 2, "0")})


@_query
def ingest_trades_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly gzip drops of all trades, written by Spark and read back through the source."""
    root = f"{session.scratch_dir(spark, 'raw-trades')}/raw/trades"
    rows = _with_hour(fixtures.bronze_trades(spark, sf), "_trade_date").drop("_ingest_ts", "_trade_date")
    raw.by_day(rows).write.partitionBy("dt", "hh").option("compression", "gzip").json(root)
    return raw.read_json_lines(spark, RAW_TRADES, [root])


@_query
def ingest_quotes_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    root = f"{session.scratch_dir(spark, 'raw-quotes')}/raw/quotes"
    rows = _with_hour(fixtures.bronze_quotes(spark, sf), "_quote_date").drop("_ingest_ts", "_quote_date")
    raw.by_day(rows).write.partitionBy("dt", "hh").option("compression", "gzip").json(root)
    return raw.read_json_lines(spark, RAW_QUOTES, [root])


@_query
def ingest_events_csv(spark: SparkSession, sf: str) -> DataFrame:
    root = f"{session.scratch_dir(spark, 'raw-events')}/raw/events"
    rows = fixtures.bronze_events(spark, sf).withColumn("dt", F.col("_event_load_date"))
    rows = rows.drop("_ingest_ts", "_event_load_date").hint("rebalance", "dt")
    rows.write.partitionBy("dt").option("header", True).csv(root)
    return raw.read_events_csv(spark, [root])


# Silver ------------------------------------------------------------------------------------------


@_query
def parse_exchange_ts(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.bronze_trades(spark, sf).withColumn("raw_ts", F.col("exchange_ts"))
    return silver.typed_trades(rows).select("trade_id", "raw_ts", "exchange_ts")


@_query
def parse_event_date(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.bronze_events(spark, sf).withColumn("raw_date", F.col("event_date"))
    return silver.typed_events(rows).select("event_id", "raw_date", "event_date", "event_start", "event_end")


@_query
def cast_price_decimal(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.bronze_quotes(spark, sf)
    return silver.typed_quotes(rows).select("exchange", "symbol", "sequence_num", "bid", "ask")


@_query
def dedup_trades(spark: SparkSession, sf: str) -> DataFrame:
    return silver.deduplicated_trades(fixtures.bronze_trades(spark, sf)).drop("_trade_date")


@_query
def dedup_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return silver.deduplicated_quotes(fixtures.bronze_quotes(spark, sf)).drop("_quote_date")


@_query
def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    """Without the NULL guard: nameless events of a day form one group."""
    return silver.silver_events(fixtures.bronze_events(spark, sf))


@_query
def dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    feeds = {
        "trades": (silver.typed_trades(fixtures.bronze_trades(spark, sf)), silver.TRADES.keys),
        "quotes": (silver.typed_quotes(fixtures.bronze_quotes(spark, sf)), silver.QUOTES.keys),
        "events": (silver.typed_events(fixtures.bronze_events(spark, sf)), silver.EVENTS.keys),
    }
    reports = [dedup.dedup_report(df, keys).withColumn("feed", F.lit(feed)) for feed, (df, keys) in feeds.items()]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@_query
def first_event_per_symbol_day(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf).select("event_id", "symbol", "event_type", "event_date", "event_start")
    return dedup.first_event_per_symbol_day(events)


@_query
def trade_event_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Enrichment alone, on all deliveries, before any dedup of trades."""
    events = _events_table(spark, sf)
    ticks = silver.typed_trades(fixtures.bronze_trades(spark, sf)).withColumn("trade_date", F.to_date("exchange_ts"))
    calendar = dedup.first_event_per_symbol_day(events)
    return joins.enrich_with_event(ticks, calendar, joins.fits_broadcast(events)).select(
        "trade_id", "symbol", "trade_date", "event_id", "event_type"
    )


@_query
def silver_trades(spark: SparkSession, sf: str) -> DataFrame:
    events = _events_table(spark, sf)
    return silver.silver_trades(fixtures.bronze_trades(spark, sf), events, joins.fits_broadcast(events))


@_query
def silver_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return _quotes(spark, sf)


@_query
def silver_events(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf)


@_query
def wap_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs: first deliveries, everything, then readable rows again on top of them.

    The second run has rows whose timestamp cannot be read; its audit fails and changes nothing, which `unchanged` says
    of the published rows. Those rows are returned as not published.
    """
    events = _events_table(spark, sf)
    small = joins.fits_broadcast(events)
    table = Table(spark, session.scratch_dir(spark, "wap-trades"), silver.TRADES)
    deliveries = fixtures.bronze_trades(spark, sf)
    readable = parse_timestamp("exchange_ts").isNotNull()
    rows = deliveries.where(readable)

    def publish(delivered: DataFrame, run_id: str) -> None:
        write_audit_publish(table, silver.silver_trades(delivered, events, small), run_id, "silver_trades_quality")

    publish(rows.where(F.col("trade_id").startswith("T-")), "slot1")
    before, failed = table.pointer(), False
    try:
        publish(deliveries, "slot2")
    except QualityError:
        failed = True
    unchanged = failed and table.pointer() == before
    publish(rows, "slot3")
    rejected = silver.silver_trades(deliveries.where(~readable), events, small)
    return (
        table.read().withColumn("published", F.lit(True))
        .unionByName(rejected.withColumn("published", F.lit(False)))
        .withColumn("unchanged", F.lit(unchanged))
    )


@_query
def wap_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """One exchange published first, then all of them."""
    table = Table(spark, session.scratch_dir(spark, "wap-quotes"), silver.QUOTES)
    rows = fixtures.bronze_quotes(spark, sf)
    for run_id, delivered in (("slot1", rows.where("exchange = 'NYSE'")), ("slot2", rows)):
        write_audit_publish(table, silver.silver_quotes(delivered), run_id, "silver_quotes_quality")
    return table.read()


# Quality -----------------------------------------------------------------------------------------


@_query
def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    typed = silver.typed_events(fixtures.bronze_events(spark, sf))
    return quality.missing_required(typed, silver.EVENTS.not_null)


@_query
def not_null_gate(spark: SparkSession, sf: str) -> DataFrame:
    frames = {
        "silver.trades": silver.typed_trades(fixtures.bronze_trades(spark, sf)),
        "silver.quotes": silver.typed_quotes(fixtures.bronze_quotes(spark, sf)),
        "silver.events": silver.typed_events(fixtures.bronze_events(spark, sf)),
    }
    gates = [
        quality.null_counts(df, TABLES[name].not_null).withColumn("table_name", F.lit(name))
        for name, df in frames.items()
    ]
    return gates[0].unionByName(gates[1]).unionByName(gates[2])


def _checked(df: DataFrame, suite: str) -> DataFrame:
    return _rounded(quality.run_checks(df, suite), metric=9)


@_query
def dq_trades(spark: SparkSession, sf: str) -> DataFrame:
    """All deliveries before dedup and the NOT NULL gate, so that rules fail as well as pass."""
    return _checked(silver.typed_trades(fixtures.bronze_trades(spark, sf)), "silver_trades_quality")


@_query
def dq_quotes(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(_quotes(spark, sf), "silver_quotes_quality")


@_query
def dq_events(spark: SparkSession, sf: str) -> DataFrame:
    return _checked(silver.typed_events(fixtures.bronze_events(spark, sf)), "silver_events_quality")


@_query
def row_count_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The four gold gates for every day on which any trade was delivered."""
    days = fixtures.bronze_trades(spark, sf).select(F.col("_trade_date").alias("day")).distinct()
    days = _table(spark, days, "days")
    trades, events = _table(spark, _trades(spark, sf), "silver-trades"), _events_table(spark, sf)
    _, small = _windows(events)
    gates = [
        ("ohlcv_1m", bars.ohlcv_1m(trades), F.to_date("bar_start"), 1),
        ("bid_ask_spread_1m", bars.bid_ask_spread_1m(_quotes(spark, sf)), F.to_date("bar_start"), 1),
        ("vwap_daily", bars.vwap_daily(trades), F.col("trade_date"), 1),
        ("event_windowed_volume", event_window.event_windowed_volume(trades, events, small), F.to_date("event_ts"), 0),
    ]
    results = [quality.row_count_gate(df, day, days, gate, least) for gate, df, day, least in gates]
    return results[0].unionByName(results[1]).unionByName(results[2]).unionByName(results[3])


# Gold --------------------------------------------------------------------------------------------


@_query
def ohlcv_1m(spark: SparkSession, sf: str) -> DataFrame:
    return bars.ohlcv_1m(_trades(spark, sf))


@_query
def vwap_daily(spark: SparkSession, sf: str) -> DataFrame:
    return bars.vwap_daily(_trades(spark, sf))


@_query
def spread_bps(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(bars.quote_spreads(_quotes(spark, sf)), spread_bps=6, mid_price=6)


@_query
def spread_1m(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(bars.bid_ask_spread_1m(_quotes(spark, sf)), median_spread=6)


@_query
def three_day_slice(spark: SparkSession, sf: str) -> DataFrame:
    return gold.around_day(_trades(spark, sf), "trade_date", DAY).select(
        "exchange", "symbol", "exchange_ts", "trade_date", "price", "size"
    )


@_query
def event_window_join(spark: SparkSession, sf: str) -> DataFrame:
    windows = event_window.with_bounds(event_window.calendar_events(_events_table(spark, sf)))
    listed = joins.windows_by_hour(windows)
    return joins.join_event_windows(_trades(spark, sf), listed, joins.fits_broadcast(listed)).select(
        "symbol", "exchange", "exchange_ts", "sequence_num", "price", "size",
        "event_id", "event_type", "event_ts", "window_start", "window_end",
    )


@_query
def event_minute_close(spark: SparkSession, sf: str) -> DataFrame:
    return _window_minutes(spark, sf).select("symbol", "event_ts", "bar_start", "price")


@_query
def realized_vol(spark: SparkSession, sf: str) -> DataFrame:
    returns = event_window.with_log_returns(_window_minutes(spark, sf))
    return _rounded(event_window.realized_volatility(returns), realized_vol=6)


def _event_window(spark: SparkSession, sf: str) -> DataFrame:
    events = _events_table(spark, sf)
    rows = event_window.event_windowed_volume(_trades(spark, sf), events, _windows(events)[1])
    return _rounded(rows, realized_vol=6)


_query(_event_window, "event_window")


@_query
def upsert_gold(spark: SparkSession, sf: str) -> DataFrame:
    trades = _trades(spark, sf)
    corrected = trades.where("exchange <> 'ARCA'").withColumn("price", (F.col("price") + 1).cast("decimal(18,6)"))
    target = bars.ohlcv_1m(trades.where("exchange <> 'NYSE'"))
    return upsert(target, bars.ohlcv_1m(corrected), TABLES["gold.ohlcv_1m"].keys)


for _name, _fn in arrivals.QUERIES.items():
    _query(_fn, _name)
