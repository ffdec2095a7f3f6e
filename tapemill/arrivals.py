"""Registered queries over raw drops and arriving files: what a landing zone does to well-formed feeds.

Feeds are the fixture's, put on disk as text with damaged lines, in the hours and slots in which they arrive.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapemill import fixtures, session
from tapemill.operators import bars, dedup, partial_bars, salted
from tapemill.operators.upsert import latest_of
from tapemill.plans import bronze, silver, sql_face
from tapemill.plans.loading import load
from tapemill.sources import checked, raw
from tapemill.specs import RAW_EVENTS, RAW_TRADES, TABLES
from tapemill.storage.bucketed import BucketedTable, buckets_for
from tapemill.storage.files import Files
from tapemill.storage.footers import partition_counts
from tapemill.storage.table import Table
from tapemill.streaming import event_time
from tapemill.streaming.feeds import STATE_CONF, parquet_stream, run_available, with_folder_lineage
from tapemill.streaming.ingest import ingest_arrived

TRADES_RAW = "bronze.trades_raw"
# Slots in which a stream's rows arrive; a redelivered or late row comes one slot after its own.
SLOTS = 4
# How far the watermark of minute bars lags, and which trades come a slot too late.
BAR_DELAY = "10 minutes"
LATE_EVERY = 97
# Rows per salt of the query, far below what a task can take, so that the test tables have hot days.
QUERY_ROWS_PER_SALT = 2_000


def _lines(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """dt, hh, line of trades as a feed writes them, some damaged."""
    return spark.sql(fixtures.RAW_TRADE_LINES, bronze_trades=rows).select("dt", "hh", F.col("line").alias("value"))


def _drop(lines: DataFrame, root: str) -> None:
    with session.shuffles_released(lines.sparkSession):
        raw.by_day(lines).write.mode("append").partitionBy("dt", "hh").option("compression", "gzip").text(root)


def _dropped_trades(spark: SparkSession, sf: str) -> tuple[str, checked.Delivery]:
    root = f"{session.scratch_dir(spark, 'lines-trades')}/raw/trades"
    _drop(_lines(spark, fixtures.bronze_trades(spark, sf)), root)
    return root, checked.json_lines(spark, RAW_TRADES, [root])


def rejected_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Every line that cannot be taken in, with the hour of its file and the reason."""
    rejected = _dropped_trades(spark, sf)[1].rejected()
    parts = [F.regexp_extract("file", rf"/{name}=([^/]+)/", 1).alias(name) for name in ("dt", "hh")]
    return rejected.select(*parts, "reason", "line")


def accepted_trades(spark: SparkSession, sf: str) -> DataFrame:
    return _dropped_trades(spark, sf)[1].accepted()


def ingest_report(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds loaded through the job's own path; one row per feed with its counts."""
    warehouse = session.scratch_dir(spark, "ingest-report")
    _, trades = _dropped_trades(spark, sf)
    events_root = f"{session.scratch_dir(spark, 'lines-events')}/raw/events"
    events = fixtures.bronze_events(spark, sf).withColumn("dt", F.col("_event_load_date"))
    events.select(*RAW_EVENTS.fieldNames(), "dt").hint("rebalance", "dt").write.partitionBy("dt").option("header", True).csv(
        events_root
    )
    of_folder = F.regexp_extract(checked.FILE, r"/dt=([^/]+)/", 1).cast("date")
    feeds = {
        "trades": (TRADES_RAW, trades, lambda rows: with_folder_lineage(rows, "_trade_date"), ()),
        "events": (
            "bronze.events_raw", checked.events_csv(spark, [events_root]),
            lambda rows: rows.withColumns({"_event_load_date": of_folder, "_ingest_ts": of_folder.cast("timestamp")}),
            ("event_id",),
        ),
    }
    report = []
    for feed, (name, delivery, lineage, required) in feeds.items():
        done = load(
            Table(spark, warehouse, TABLES[name]), delivery, lineage,
            lambda rows, name=name: latest_of(rows, TABLES[name].keys), "run", required, f"{warehouse}/rejected/{name}",
        )
        report.append((feed, done.read, done.rejected, done.nameless, done.repeated, done.loaded))
    return spark.createDataFrame(
        report, "feed string, n_read long, n_rejected long, n_nameless long, n_repeated long, n_loaded long"
    )


def hour_slice(spark: SparkSession, sf: str) -> DataFrame:
    """One day's morning out of all hour folders, each row with its folder."""
    root = session.scratch_dir(spark, "hours")
    _drop(_lines(spark, fixtures.bronze_trades(spark, sf)), f"{root}/raw/trades")
    rows = raw.read_hours(spark, "trades", root, RAW_TRADES)
    chosen = rows.where(f"dt = DATE '{fixtures.FIRST_DAY}' AND hh BETWEEN 9 AND 11 AND trade_id IS NOT NULL")
    folder = F.regexp_extract("file", r"/(dt=[^/]+/hh=[^/]+)/", 1)
    return chosen.select("trade_id", "exchange_ts", "dt", "hh", folder.alias("folder"))


# Streams -----------------------------------------------------------------------------------------


def stream_upsert_trades(spark: SparkSession, sf: str) -> DataFrame:
    """All drops merged by a stream: first deliveries in three batches, then, after a restart, corrections."""
    base = session.scratch_dir(spark, "stream-upsert")
    root, table = f"{base}/raw/trades", Table(spark, f"{base}/lake", TABLES[TRADES_RAW])
    trades = fixtures.bronze_trades(spark, sf)
    _drop(_lines(spark, trades), root)
    files = spark.read.text(root).select("_metadata.file_path").distinct().count()
    ingest_arrived(spark, table, root, f"{base}/checkpoint", -(-files // 3))
    corrected = trades.where("sequence_num % 5 = 0").withColumn("size", F.col("size") + 1)
    _drop(_lines(spark, corrected).withColumn("hh", F.lit(fixtures.CORRECTED_HOUR)), root)
    ingest_arrived(spark, table, root, f"{base}/checkpoint")
    return table.read()


def _days(trades: DataFrame) -> list[date]:
    return [r.trade_date for r in trades.select("trade_date").distinct().collect()]


def _in_slots(trades: DataFrame, days: list[date], behind: Column) -> DataFrame:
    """Trades with the slot in which they arrive: days in order dealt to SLOTS, some rows a slot behind."""
    listed = trades.sparkSession.range(1).select(F.explode(F.lit(days).cast("array<date>")).alias("trade_date"))
    slots = listed.selectExpr("trade_date", f"ntile({SLOTS}) OVER (ORDER BY trade_date) AS slot")
    dealt = trades.join(F.broadcast(slots), "trade_date").select(*trades.columns, "slot")
    return dealt.withColumn("arrival", F.col("slot") + F.when(behind, 1).otherwise(0))


def _landed(spark: SparkSession, arrivals: DataFrame, purpose: str, folder: str) -> Iterator[None]:
    """Arrivals in a folder of a stream, slot by slot: all are written once, then moved there one slot at a time."""
    path, files = session.scratch_dir(spark, purpose), Files(spark, folder)
    arrivals.write.partitionBy("arrival").parquet(path)
    slots = [name for name in files.folder_names(path) if name.startswith("arrival=")]
    for slot in sorted(slots, key=lambda name: int(name.split("=")[1])):
        files.move(f"{path}/{slot}", f"{folder}/{slot}")
        yield


def _bar_stream(spark: SparkSession, sf: str) -> event_time.BarStream:
    deliveries = fixtures.bronze_trades(spark, sf)
    trades = silver.deduplicated_trades(deliveries).where("exchange_ts IS NOT NULL")
    trades = trades.select("exchange", "symbol", "exchange_ts", "sequence_num", "price", "size", "trade_date")
    # The instant is part of the key, so deduplication leaves every day.
    days = _days(silver.typed_trades(deliveries).selectExpr("to_date(exchange_ts) AS trade_date").where("trade_date IS NOT NULL"))
    arrivals = _in_slots(trades, days, F.col("sequence_num") % LATE_EVERY == 0)
    base = session.scratch_dir(spark, "bar-stream")
    source = parquet_stream(spark, trades.schema, f"{base}/in")
    stream = event_time.BarStream(spark, source, f"{base}/bars", f"{base}/checkpoint", BAR_DELAY)
    for _ in _landed(spark, arrivals.drop("slot"), "bar-arrivals", f"{base}/in"):
        stream.advance()
    return stream


def stream_minute_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars that closed behind the watermark, of trades that came before their minute closed."""
    return _bar_stream(spark, sf).closed_bars()


def stream_late_trades(spark: SparkSession, sf: str) -> DataFrame:
    """What became of the stream's trades: in closed bars, in bars still open, or too late for theirs."""
    closed = _bar_stream(spark, sf).closed()
    return spark.createDataFrame(
        [(closed.read, closed.in_bars, closed.open, closed.late)],
        "n_read long, n_in_bars long, n_open long, n_late long",
    )


def stream_dedup_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries deduplicated as they arrive, redeliveries a batch after the first; state spans two slots."""
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    typed = silver.typed_trades(fixtures.bronze_trades(spark, sf)).where("exchange_ts IS NOT NULL")
    typed = typed.withColumn("trade_date", F.to_date("exchange_ts")).drop("_trade_date")
    nth = F.row_number().over(Window.partitionBy(*silver.TRADES.keys).orderBy(*dedup.TRADE_ORDER))
    days = _days(typed)
    arrivals = _in_slots(typed, days, F.lit(False))
    arrivals = arrivals.withColumn("arrival", 2 * F.col("slot") + F.when(nth > 1, 1).otherwise(0)).drop("slot")
    days_of_slot = -(-((max(days) - min(days)).days + 1) // SLOTS)
    base = session.scratch_dir(spark, "dedup-stream")
    source = parquet_stream(spark, typed.schema, f"{base}/in")
    kept = event_time.deduplicated(source, list(silver.TRADES.keys), f"{2 * days_of_slot + 1} days")
    for _ in _landed(spark, arrivals, "dedup-arrivals", f"{base}/in"):
        run_available(kept.writeStream.format("parquet").option("path", f"{base}/out").outputMode("append"), f"{base}/checkpoint")
    return spark.read.schema(kept.schema).parquet(f"{base}/out")


# Partial states, buckets, salts, footers, SQL ----------------------------------------------------


def _by_slot(rows: DataFrame) -> list[DataFrame]:
    """Rows in three slots that cut through minutes: a late file may touch any minute."""
    return [rows.where(F.col("sequence_num") % 3 == k) for k in range(3)]


def incremental_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Partial bars of three slots, merged one after the other."""
    trades = silver.deduplicated_trades(fixtures.bronze_trades(spark, sf)).where("exchange_ts IS NOT NULL")
    states = [partial_bars.trade_states(slot) for slot in _by_slot(trades)]
    merged = partial_bars.merge_trade_states(partial_bars.merge_trade_states(states[0], states[1]), states[2])
    return partial_bars.bars_of(merged)


def incremental_spreads(spark: SparkSession, sf: str) -> DataFrame:
    """Spread bars from merged sketches, exact where a minute has fewer quotes than a sketch holds."""
    states = [partial_bars.spread_states(slot) for slot in _by_slot(silver.silver_quotes(fixtures.bronze_quotes(spark, sf)))]
    merged = partial_bars.merge_spread_states(partial_bars.merge_spread_states(states[2], states[0]), states[1])
    return partial_bars.spread_bars_of(merged).withColumn("median_spread", F.round("median_spread", 6))


def upsert_trades_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The upsert of `upsert_trades` on a target in buckets of its key, which stays where it lies."""
    rows = fixtures.bronze_trades(spark, sf)
    keys = TABLES[TRADES_RAW].keys
    path = session.scratch_dir(spark, "bucketed-trades")
    buckets, partitions = buckets_for(fixtures.input_bytes(spark, sf)), session.shuffle_partitions(spark)
    table = BucketedTable(spark, f"trades_{path[-12:]}", path, keys, max(buckets, partitions))
    table.write(bronze.merge_source(rows.where("side <> 'SELL'"), TRADES_RAW), dealt=buckets <= partitions)
    source = rows.where("side <> 'BUY'").withColumn("price", F.col("price") + 1)
    return table.upserted(bronze.merge_source(source, TRADES_RAW, True))


def trade_event_enrich_salted(spark: SparkSession, sf: str) -> DataFrame:
    """Enrichment by merge join with heavy symbol-days dealt over several tasks."""
    ticks = silver.typed_trades(fixtures.bronze_trades(spark, sf)).withColumn("trade_date", F.to_date("exchange_ts"))
    events = silver.silver_events(fixtures.bronze_events(spark, sf).where("event_id IS NOT NULL"))
    calendar = dedup.first_event_per_symbol_day(events)
    hot = salted.hot_days(ticks, QUERY_ROWS_PER_SALT)
    joined = salted.enrich_salted(ticks, calendar, hot, ["trade_id", "sequence_num"])
    return joined.select("trade_id", "symbol", "trade_date", "event_id", "event_type")


def bar_gate_from_footers(spark: SparkSession, sf: str) -> DataFrame:
    """The gate of the minute bars over the written table: its counts come from file footers."""
    path = session.scratch_dir(spark, "gold-bars")
    trades = silver.deduplicated_trades(fixtures.bronze_trades(spark, sf)).where("exchange_ts IS NOT NULL")
    made = bars.ohlcv_1m(trades).withColumn("bar_date", F.to_date("bar_start"))
    made.hint("rebalance", "bar_date", "exchange").write.partitionBy("bar_date", "exchange").parquet(path)
    spec = TABLES["gold.ohlcv_1m"]
    counts = partition_counts(spark, path, [path], list(spec.partition_by), spec.stored_schema)
    return counts.groupBy(F.col("bar_date").alias("day")).agg(F.sum("n").alias("n_rows")).select(
        "day", "n_rows", F.when(F.col("n_rows") >= 1, "Success").otherwise("Failure").alias("status")
    )


def sql_vwap(spark: SparkSession, sf: str) -> DataFrame:
    """Daily VWAP through its SQL table function, over silver tables in day folders."""
    path = session.scratch_dir(spark, "sql-face")
    feeds = {
        "trades": (silver.deduplicated_trades(fixtures.bronze_trades(spark, sf)).where("exchange_ts IS NOT NULL"), "trade_date"),
        "quotes": (silver.silver_quotes(fixtures.bronze_quotes(spark, sf)), "quote_date"),
        "events": (silver.silver_events(fixtures.bronze_events(spark, sf).where("event_id IS NOT NULL")), "event_date"),
    }
    for name, (rows, day) in feeds.items():
        rows.hint("rebalance", day).write.partitionBy(day).parquet(f"{path}/{name}")
    sql_face.register(spark, *[spark.read.parquet(f"{path}/{name}") for name in feeds])
    return spark.sql(f"SELECT * FROM vwap(DATE '{fixtures.FIRST_DAY}')")


QUERIES = {
    f.__name__: f
    for f in (
        rejected_trades, accepted_trades, ingest_report, hour_slice, stream_upsert_trades, stream_minute_bars,
        stream_late_trades, stream_dedup_trades, incremental_bars, incremental_spreads, upsert_trades_bucketed,
        trade_event_enrich_salted, bar_gate_from_footers, sql_vwap,
    )
}
