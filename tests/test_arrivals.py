"""Drops with damaged lines, streams of files, mergeable states, salts, buckets, footers and SQL functions."""

import datetime as dt
import gzip
import json
import time
from collections import Counter
from pathlib import Path

import pytest
from conftest import at
from pyspark.sql import functions as F

from tapemill import arrivals, fixtures, jobs, session
from tapemill.catalog import QUERIES
from tapemill.operators import bars, joins, partial_bars, salted
from tapemill.plans import bronze, sql_face
from tapemill.sources import checked, raw
from tapemill.specs import RAW_TRADES, TABLES
from tapemill.storage.bucketed import BucketedTable
from tapemill.storage.footers import partition_counts
from tapemill.storage.table import Table
from tapemill.streaming import event_time
from tapemill.streaming.feeds import parquet_stream
from tapemill.streaming.ingest import ingest_arrived

DAY = dt.date(2024, 1, 15)
KEYS = TABLES["bronze.trades_raw"].keys


def tick(seq, ts="2024-01-15T10:00:00.5", price=10.0, **changes):
    return {"exchange": "NYSE", "symbol": "AAPL", "exchange_ts": ts, "price": price, "size": 5, "sequence_num": seq,
            "side": "BUY", "trade_id": f"T{seq}", **changes}


def drop(root, hour, *lines, name="part", day=DAY):
    folder = Path(raw.hour_paths(str(root), "trades", day, [hour])[0])
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    (folder / f"{name}.jsonl.gz").write_bytes(gzip.compress(text.encode()))


# Corrupt lines and counts ------------------------------------------------------------------------


def test_every_line_is_accepted_or_rejected(spark, tmp_path):
    whole = json.dumps(tick(9))
    drop(tmp_path, 10, tick(1), tick(2, extra={"x": 1}), "", "   ", whole[:-15], "%" + whole, tick(3, size="many"),
         tick(4, price="n/a", size=1.5), "[]", "7", tick(5, side=None), {"symbol": "X"})
    delivery = checked.json_lines(spark, RAW_TRADES, raw.hour_paths(str(tmp_path), "trades", DAY, [10, 11]))
    accepted, rejected = delivery.accepted().collect(), delivery.rejected().collect()
    assert {(r.sequence_num, r.symbol) for r in accepted} >= {(1, "AAPL"), (2, "AAPL"), (5, "AAPL"), (None, "X")}
    assert len(accepted) + len(rejected) == 10
    reasons = {r.line: r.reason for r in rejected}
    assert reasons[whole[:-15]] == reasons["%" + whole] == checked.UNREADABLE
    assert reasons[json.dumps(tick(3, size="many"))] == "mistyped: size"
    assert reasons[json.dumps(tick(4, price="n/a", size=1.5))] == "mistyped: price, size"
    assert all(r.file.endswith("part.jsonl.gz") for r in rejected)
    # What is rejected does not depend on the columns asked for.
    assert delivery.accepted().select("symbol").count() == len(accepted)


def test_lines_are_parsed_once(spark, tmp_path):
    drop(tmp_path, 9, tick(1), '{"size": "many"}', '[{"size": 1}]', "null", "{}", "%", " ")
    delivery = checked.json_lines(spark, RAW_TRADES, raw.hour_paths(str(tmp_path), "trades", DAY, [9]))
    for rows in (delivery.accepted(), delivery.accepted().select("trade_id"), delivery.rejected()):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
    assert sorted(r.trade_id or "" for r in delivery.accepted().select("trade_id").collect()) == ["", "T1"]
    assert Counter(r.line for r in delivery.rejected().collect()) == Counter(['{"size": "many"}', '[{"size": 1}]', "null", "%"])


def test_events_with_other_numbers_of_columns(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text("event_id,symbol,event_type,event_date,event_start,event_end,description\nE1,A,SPLIT,2024-01-15,x,y,z\nE2,A\nE3,A,SPLIT,2024-01-15,x,y,z,more\n")
    delivery = checked.events_csv(spark, [str(path), str(tmp_path / "none.csv")])
    assert [r.event_id for r in delivery.accepted().collect()] == ["E1"]
    assert sorted((r.line, r.reason) for r in delivery.rejected().collect()) == [
        ("E2,A", checked.FEWER), ("E3,A,SPLIT,2024-01-15,x,y,z,more", checked.MORE)]
    assert checked.events_csv(spark, [str(tmp_path / "none.csv")]).empty


def test_job_counts_in_one_read_of_the_drop(spark, tmp_path, monkeypatch):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), str(tmp_path))
    drop(tmp_path, 10, tick(1), tick(1), tick(2), tick(3))
    reads = spark.sparkContext.accumulator(0)
    original = checked.parsed_json_lines

    def counting(lines, schema, file):
        @F.udf("string")
        def seen(value):
            reads.add(1)
            return value

        return original(lines.withColumn("value", seen.asNondeterministic()("value")), schema, file)

    monkeypatch.setattr(checked, "parsed_json_lines", counting)
    done = jobs.ingest_trades(lake, DAY, [10], "r", at("2024-01-15T10:15:00"))
    assert (done.read, done.rejected, done.nameless, done.repeated, done.loaded) == (4, 0, 0, 1, 3)
    assert reads.value == 4
    assert lake.table("bronze.trades_raw").read().count() == 3 and not Path(lake.rejects("bronze.trades_raw")).exists()


def test_job_keeps_rejected_lines(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"), str(tmp_path))
    drop(tmp_path, 10, tick(1), "{broken", tick(2, size="x"))
    done = jobs.ingest_trades(lake, DAY, [10], "r1")
    assert (done.read, done.rejected, done.loaded) == (3, 2, 1)
    kept = spark.read.parquet(lake.rejects("bronze.trades_raw"))
    assert sorted(r.reason for r in kept.where("run = 'r1'").collect()) == ["mistyped: size", "unreadable"]
    drop(tmp_path, 11, "{broken")
    only_bad = jobs.ingest_trades(lake, DAY, [11], "r2")
    assert (only_bad.rejected, only_bad.loaded, only_bad.pointer) == (1, 0, None)


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}


def test_a_stream_and_a_drop_keep_no_shuffle_files(spark, tmp_path):
    """What each step shuffled goes when the step ends, not when the driver collects its garbage."""
    before, setting = _shuffle_files(spark), spark.conf.get(session.RELEASE_SHUFFLES)
    table = Table(spark, str(tmp_path / "lake"), TABLES["bronze.trades_raw"])
    root = f"{tmp_path}/raw/trades"
    for hour in (9, 10):
        rows = spark.range(200).selectExpr(
            "'2024-01-15' AS dt", f"'{hour:02d}' AS hh", "concat('{\"trade_id\":\"T', id % 150, '\",\"exchange\":\"A\",\"symbol\":\"B\",'"
            " '\"exchange_ts\":\"x\",\"sequence_num\":', id % 150, '}') AS value")
        arrivals._drop(rows, root)
        ingest_arrived(spark, table, root, f"{tmp_path}/checkpoint")
    assert table.read().count() == 150 and spark.conf.get(session.RELEASE_SHUFFLES) == setting
    # The count above is the caller's own and keeps what it shuffled; other files are removed in the background.
    for _ in range(50):
        left = {f.split("_")[1] for f in _shuffle_files(spark) - before}
        if len(left) <= 1:
            break
        time.sleep(0.1)
    assert len(left) <= 1


def test_hours_are_pruned(spark, tmp_path):
    for hour in (9, 10, 11):
        drop(tmp_path, hour, tick(hour))
    rows = raw.read_hours(spark, "trades", str(tmp_path), RAW_TRADES).where("dt = DATE '2024-01-15' AND hh >= 10")
    assert sorted((r.sequence_num, r.hh) for r in rows.collect()) == [(10, 10), (11, 11)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(hh#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert len(rows.inputFiles()) == 3 and all("hh=" in r.file for r in rows.collect())


def line_items(*keys):
    return [(k, 7 * k, k, 1, 5.0, 10.5, 0.0, 0.0, "N", "O", None) for k in keys]


LINE_ITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)


@pytest.mark.parametrize("writer", ["ingest_trades_jsonl", "ingest_quotes_jsonl", "_drop"])
def test_a_day_of_drops_is_written_by_one_task(spark, tmp_path, monkeypatch, writer):
    """Hours of one file each, whole days in a task, also where shuffle partitions are not merged."""
    monkeypatch.setitem(session.RUNTIME_CONF, "spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.configure(spark)
    # 40 orders of each of six days.
    keys = [5000 * day + 3 * k for day in range(6) for k in range(40)]
    sf = str(tmp_path)
    spark.createDataFrame(line_items(*keys), LINE_ITEM).write.parquet(f"{sf}/lineitem.parquet")
    if writer == "_drop":
        arrivals._drop(arrivals._lines(spark, fixtures.bronze_trades(spark, sf)), f"{sf}/raw")
        rows = spark.read.text(f"{sf}/raw")
    else:
        rows = QUERIES[writer](spark, sf)
    assert rows.count() == len(keys)
    files = [Path(f) for f in rows.inputFiles()]
    hours = {f.parent for f in files}
    days = {(f.parent.parent.name, f.name.split("-")[1]) for f in files}
    monkeypatch.undo()
    session.configure(spark)
    assert len(files) == len(hours) > 24 and len(days) == len({day for day, _ in days}) == 6
    assert len({task for _, task in days}) > 1


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    """What outgrows a task's share is split, and no row is lost."""
    own = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        lines = spark.range(0, 40_000, 1, 8).select(
            F.lit("2024-01-15").alias("dt"), F.format_string("%02d", F.col("id") % 2 + 9).alias("hh"),
            F.sha2(F.col("id").cast("string"), 256).alias("value"),
        )
        arrivals._drop(lines, str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", own)
    rows = spark.read.text(str(tmp_path / "raw"))
    assert rows.select("value").distinct().count() == rows.count() == 40_000
    assert len({Path(f).name.split("-")[1] for f in rows.inputFiles()}) > 4


# Streams -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("files_per_batch", [None, 1, 3])
def test_stream_gives_the_same_table_for_any_batches(spark, tmp_path, files_per_batch):
    root, table = f"{tmp_path}/raw/trades", Table(spark, str(tmp_path / "lake"), TABLES["bronze.trades_raw"])
    run = lambda: ingest_arrived(spark, table, root, str(tmp_path / "checkpoint"), files_per_batch)
    # Hours arrive out of order; the latest hour's delivery of a key stays.
    drop(tmp_path, 12, tick(1, price=12.0), tick(2, price=12.0))
    drop(tmp_path, 10, tick(1, price=10.0), tick(3), "{broken")
    drop(tmp_path, 9, tick(4), tick(4), day=dt.date(2024, 1, 16))
    run()
    wanted = {(1, 12.0, 13), (2, 12.0, 13), (3, 10.0, 11), (4, 10.0, 10)}
    rows = lambda: sorted((r.sequence_num, r.price, r._ingest_ts.hour) for r in table.read().collect())
    assert rows() == sorted(wanted)
    # A restart takes in only what is new, an older hour changes nothing, and no news change nothing.
    drop(tmp_path, 11, tick(2, price=1.0), tick(5, price=5.0))
    drop(tmp_path, 13, tick(3, price=13.0))
    run()
    wanted = wanted - {(3, 10.0, 11)} | {(3, 13.0, 14), (5, 5.0, 12)}
    assert rows() == sorted(wanted)
    version = table.pointer().version
    run()
    assert table.pointer().version == version


TYPED = "exchange string, symbol string, exchange_ts timestamp, sequence_num long, price decimal(18,6), size long"


def typed(spark, *rows):
    """Rows of (minute, second, sequence number, price)."""
    return spark.createDataFrame(
        [("NYSE", "A", at(f"2024-01-15T10:{m:02d}:{s:02d}"), n, p, 1) for m, s, n, p in rows],
        "exchange string, symbol string, exchange_ts timestamp, sequence_num long, price double, size long",
    ).withColumn("price", F.col("price").cast("decimal(18,6)"))


def test_bars_close_behind_the_watermark_and_late_trades_are_counted(spark, tmp_path):
    schema = typed(spark, (0, 0, 1, 1.0)).schema
    made = lambda: event_time.BarStream(
        spark, parquet_stream(spark, schema, f"{tmp_path}/in"), f"{tmp_path}/bars", f"{tmp_path}/checkpoint", "5 minutes"
    )
    stream = made()
    arrive = lambda *rows: typed(spark, *rows).write.mode("append").parquet(f"{tmp_path}/in")
    closed = lambda: sorted((r.bar_start.minute, r.open, r.close, r.n_trades) for r in stream.closed_bars().collect())
    arrive((0, 10, 1, 1.0), (0, 20, 2, 2.0), (8, 0, 3, 3.0))
    stream.advance()
    # The watermark is 10:03: the first minute is closed, the ninth open.
    assert closed() == [(0, 1.0, 2.0, 2)]
    assert stream.closed() == event_time.Closed(3, 2, 1) and stream.closed().late == 0
    # One trade for a closed minute, one out of order but in time, one that moves the watermark on to 10:25.
    arrive((0, 30, 4, 9.0), (8, 30, 5, 4.0), (30, 0, 6, 5.0))
    stream.advance()
    assert closed() == [(0, 1.0, 2.0, 2), (8, 3.0, 4.0, 2)]
    assert stream.closed().late == 1 and stream.closed().open == 1
    # A new object over the same folders goes on from the checkpoint.
    stream = made()
    arrive((50, 0, 7, 6.0))
    stream.advance()
    assert closed()[-1] == (30, 5.0, 5.0, 1)


# Partial states ----------------------------------------------------------------------------------


def test_a_run_starts_from_stored_state_without_replaying_changes(spark, tmp_path):
    schema = typed(spark, (0, 0, 1, 1.0)).schema
    source = parquet_stream(spark, schema, f"{tmp_path}/in")
    stream = event_time.BarStream(spark, source, f"{tmp_path}/bars", f"{tmp_path}/checkpoint", "5 minutes")
    for n in range(3):
        typed(spark, (10 * n, 0, n, 1.0)).write.mode("append").parquet(f"{tmp_path}/in")
        stream.advance()
    kinds = {path.suffix for path in Path(tmp_path, "checkpoint/state").rglob("[0-9]*.*")}
    assert ".zip" in kinds and ".changelog" not in kinds
    assert stream.closed() == event_time.Closed(3, 2, 1)


def test_arrivals_reach_the_stream_slot_by_slot(spark, tmp_path):
    rows = typed(spark, *((m, 0, m, 1.0) for m in range(6))).withColumn("arrival", F.col("sequence_num") % 3 * 10)
    inbox = f"{tmp_path}/in"
    source = parquet_stream(spark, rows.drop("arrival").schema, inbox)
    seen = []
    for _ in arrivals._landed(spark, rows, "slots", inbox):
        files = spark.read.option("recursiveFileLookup", True).schema(source.schema).parquet(inbox)
        seen.append(sorted(r.sequence_num for r in files.collect()))
    assert seen == [[0, 3], [0, 1, 3, 4], [0, 1, 2, 3, 4, 5]]


def test_days_are_dealt_to_slots_in_order(spark):
    days = [DAY + dt.timedelta(days=n) for n in (5, 0, 9, 1)]
    trades = spark.createDataFrame([(day, n) for n, day in enumerate(days)], "trade_date date, n long")
    dealt = arrivals._in_slots(trades, days, F.col("n") == 2).collect()
    assert {r.n: (r.slot, r.arrival) for r in dealt} == {1: (1, 1), 3: (2, 2), 0: (3, 3), 2: (4, 5)}
    assert arrivals._in_slots(trades.limit(0), [], F.lit(False)).count() == 0


def test_partial_states_merge_in_any_order(spark):
    trades = typed(spark, *((n % 3, n % 60, n, float(n % 17)) for n in range(200)))
    parts = [partial_bars.trade_states(trades.where(F.col("sequence_num") % 4 == k)) for k in range(4)]
    whole = Counter(map(tuple, bars.ohlcv_1m(trades).collect()))
    one = partial_bars.merge_trade_states(*parts)
    other = partial_bars.merge_trade_states(parts[3], partial_bars.merge_trade_states(parts[1], parts[0]), parts[2])
    assert Counter(map(tuple, partial_bars.bars_of(one).collect())) == whole
    assert Counter(map(tuple, partial_bars.bars_of(other).collect())) == whole


def test_merged_median_is_within_its_bound(spark):
    quotes = spark.range(20_000).selectExpr(
        "'NYSE' AS exchange", "'A' AS symbol", "TIMESTAMP '2024-01-15 10:00:01' AS exchange_ts", "id",
        "CAST(100 - (id * 7919) % 20000 / 10000 AS DECIMAL(18,6)) AS bid", "CAST(100 AS DECIMAL(18,6)) AS ask",
    )
    states = [partial_bars.spread_states(quotes.where(f"id % 5 = {k}")) for k in range(5)]
    row = partial_bars.spread_bars_of(partial_bars.merge_spread_states(*states)).first()
    spreads = sorted(r.spread_bps for r in bars.quote_spreads(quotes).collect())
    rank = sum(s <= row.median_spread for s in spreads) / len(spreads)
    assert abs(rank - 0.5) <= partial_bars.RANK_ERROR and row.n_ticks == 20_000


# Hot keys, buckets, footers, SQL -----------------------------------------------------------------


def test_hot_symbol_day_is_dealt_evenly(spark):
    trades = spark.range(40_000).selectExpr(
        "id", "CASE WHEN id % 10 < 9 THEN 'HOT' ELSE concat('S', id % 500) END AS symbol",
        "DATE '2024-01-15' AS trade_date", "CASE WHEN id = 7 THEN CAST(NULL AS DATE) END AS other",
    ).withColumn("symbol", F.when(F.col("id") != 5, F.col("symbol")))
    events = spark.createDataFrame([("E1", "HOT", DAY, "SPLIT"), ("E2", "S10", DAY, "SPLIT")], "event_id string, symbol string, event_date date, event_type string")
    hot = salted.hot_days(trades, 500)
    assert [(r._ev_symbol, r.salts) for r in hot.collect()] == [("HOT", 72)]
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.skewJoin.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = salted.enrich_salted(trades, events, hot, ["id"])
        assert "SortMergeJoin" in joined._jdf.queryExecution().toString()
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    plain = joins.enrich_with_event(trades, events, True)
    assert Counter(map(tuple, joined.select(plain.columns).collect())) == Counter(map(tuple, plain.collect()))


def test_bucketed_target_is_not_moved(spark, tmp_path):
    rows = spark.range(5_000).selectExpr("concat('X', id % 3) AS exchange", "concat('S', id % 9) AS symbol", "CAST(id AS STRING) AS exchange_ts",
                                         "id AS sequence_num", "concat('T', id) AS trade_id", "id AS price")
    table = BucketedTable(spark, "bucketed_test", str(tmp_path / "t"), KEYS, 8)
    table.write(rows)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        source = rows.where("sequence_num % 2 = 0").withColumn("price", F.col("price") + 1)
        merged = table.upserted(source)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        table_side = plan[plan.index("SortMergeJoin"):plan.index("bucketed_test")]
        assert "Bucketed: true" in plan and "Exchange" not in table_side
        assert sorted(r.price for r in merged.collect()) == sorted(n + (n % 2 == 0) for n in range(5_000))
        table.write(merged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert table.read().count() == 5_000 and table.read().where("price = sequence_num + 1").count() == 2_500
    spark.sql("DROP TABLE bucketed_test")


def test_reduced_rows_and_bucketed_target_are_not_moved_again(spark, tmp_path):
    name, initial = "bronze.trades_raw", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    rows = spark.range(6_000).selectExpr(
        "concat('X', id % 3) AS exchange", "concat('S', id % 2) AS symbol", "CAST(id % 3000 AS STRING) AS exchange_ts", "CAST(id AS DOUBLE) AS price",
        "id AS size", "id % 3000 AS sequence_num", "'BUY' AS side", "if(id % 3000 < 5, NULL, concat('T', id % 3000)) AS trade_id",
        "TIMESTAMP '2024-01-15 16:00:00' AS _ingest_ts", "DATE '2024-01-15' AS _trade_date")
    own, threshold = spark.conf.get(initial, None), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(initial, "12")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        table = BucketedTable(spark, "bucketed_reduced", str(tmp_path / "t"), KEYS, session.shuffle_partitions(spark))
        table.write(bronze.merge_source(rows, name), dealt=True)
        whole = table.read().where("trade_id IS NOT NULL").select(F.input_file_name().alias("f")).distinct()
        assert whole.count() <= 12 and table.read().count() == 2_995 + 10
        source = rows.where("sequence_num % 2 = 0").withColumn("price", F.col("price") + 0.5)
        merged = table.upserted(bronze.merge_source(source, name, True))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[plan.index("SortMergeJoin"):plan.index("bucketed_reduced")]
        # The source's reduction for the join and for the rows that are added.
        assert plan.count("Exchange hashpartitioning") == 2
        kept = Counter((r.sequence_num, r.price % 1) for r in merged.collect())
        assert all(kept[n, 0.5] == 1 - n % 2 and kept[n, 0.0] == n % 2 for n in range(5, 3_000))
        # Without a whole key nothing is merged: both deliveries of the target stay, those of the source are added.
        assert all(kept[n, 0.0] == 2 and kept[n, 0.5] == 2 * (1 - n % 2) for n in range(5))
    finally:
        spark.conf.unset(initial) if own is None else spark.conf.set(initial, own)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.sql("DROP TABLE bucketed_reduced")


def test_counts_come_from_footers(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "id % 3 AS part")
    rows.write.partitionBy("part").parquet(str(tmp_path / "t"))
    counts = partition_counts(spark, str(tmp_path / "t"), [str(tmp_path / "t")], ["part"], rows.schema)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [part]" in plan
    assert {r.part: r.n for r in counts.collect()} == {0: 34, 1: 33, 2: 33}


def test_sql_functions_prune_partitions(spark, tmp_path):
    trades = spark.range(40).selectExpr(
        "'NYSE' AS exchange", "'A' AS symbol", "timestamp_seconds(1705312800 + id * 7200) AS exchange_ts", "id AS sequence_num",
        "CAST(id AS DECIMAL(18,6)) AS price", "id AS size",
    ).withColumn("trade_date", F.to_date("exchange_ts"))
    trades.write.partitionBy("trade_date").parquet(str(tmp_path / "t"))
    quotes = trades.selectExpr("exchange", "symbol", "exchange_ts", "sequence_num", "price AS bid", "price AS ask", "trade_date AS quote_date")
    events = trades.selectExpr("'E' AS event_id", "symbol", "'SPLIT' AS event_type", "exchange_ts AS event_start", "trade_date AS event_date")
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert "vwap" in sql_face.register(spark, stored, quotes, events)
    rows = spark.sql("SELECT * FROM vwap(DATE '2024-01-16')")
    assert [tuple(r) for r in rows.collect()] == [tuple(r) for r in bars.vwap_daily(trades.where("trade_date = '2024-01-16'")).collect()]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "trade_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert spark.sql("SELECT * FROM trades_around(DATE '2024-01-16', 1)").count() == trades.where("trade_date <= '2024-01-17'").count()
    for name, n in (("trades_on", 12), ("quotes_on", 12), ("events_on", 12)):
        assert spark.sql(f"SELECT * FROM {name}(DATE '2024-01-16')").count() == n
    assert spark.sql("SELECT d.day, v.volume FROM VALUES (DATE '2024-01-16') AS d(day), LATERAL vwap(d.day) v").count() == 1
