"""What the physical plans must show."""

import datetime as dt

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tapemill import catalog, fixtures, session
from tapemill.operators import bars
from tapemill.plans import bronze, gold, silver
from tapemill.specs import TABLES

PATH = f"{DATA}/sf0.001"
DAY = dt.date(2024, 1, 15)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver trades as a plain partitioned Parquet folder."""
    path = str(tmp_path_factory.mktemp("silver") / "trades")
    rows = catalog.QUERIES["silver_trades"](spark, PATH).where("exchange_ts IS NOT NULL")
    rows.withColumn("price", F.col("price").cast("decimal(18,6)")).write.partitionBy("trade_date", "exchange").parquet(path)
    schema = TABLES["silver.trades"].schema
    return spark.read.schema(schema).parquet(path)


def test_day_slices_prune_partitions(stored):
    for df in (gold.on_day(stored, "trade_date", DAY), gold.around_day(stored, "trade_date", DAY)):
        assert "PartitionFilters: [isnotnull(trade_date" in plan(df)


def test_gold_reads_only_the_columns_it_needs(stored):
    text = plan(bars.vwap_daily(gold.on_day(stored, "trade_date", DAY)))
    assert "ReadSchema: struct<symbol:string,price:decimal(18,6),size:bigint>" in text


def test_bars_combine_before_the_shuffle(stored):
    for df in (bars.ohlcv_1m(stored), bars.vwap_daily(stored)):
        text = plan(df)
        assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1 and "Sort" not in text
    assert plan(bars.bid_ask_spread_1m(catalog._quotes(stored.sparkSession, PATH))).count("partial_percentile") >= 1


def test_enrichment_broadcasts_only_a_measured_calendar(spark):
    rows, events = fixtures.bronze_trades(spark, PATH), catalog._events(spark, PATH)
    small, large = (plan(silver.silver_trades(rows, events, fits)) for fits in (True, False))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_no_plan_has_a_cross_join_or_python(spark):
    for name in ("silver_trades", "silver_quotes", "ohlcv_1m", "spread_1m", "event_window", "event_window_join",
                 "upsert_trades", "upsert_gold", "dq_trades", "row_count_gate"):
        text = plan(catalog.QUERIES[name](spark, PATH))
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit"):
            assert banned not in text, (name, banned)


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        session.size_shuffles(spark, 10 * session.MIB)
        assert spark.conf.get(key, None) == before
        session.size_shuffles(spark, 64 * 1024 * session.MIB)
        assert spark.conf.get(key) == "2048"
        session.size_shuffles(spark, 100 * 1024 * 1024 * session.MIB)
        assert spark.conf.get(key) == str(100 * 1024 * 1024 // 32)
    finally:
        spark.conf.unset(key)


def test_scratch_is_the_shared_folder(spark):
    first, second = (session.scratch_dir(spark, "x") for _ in range(2))
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_lineage_is_utc_whatever_the_zone(spark):
    zone = dt.timezone(dt.timedelta(hours=5))
    rows = spark.range(1)
    for instant in (dt.datetime(2024, 1, 15, 16), dt.datetime(2024, 1, 15, 21, tzinfo=zone)):
        out = bronze.with_lineage(rows, "_trade_date", DAY, instant)
        assert out.selectExpr("string(_ingest_ts)").first()[0] == "2024-01-15 16:00:00"


def test_one_large_input_does_not_size_later_ones(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.size_shuffles(spark, 0)
    own = spark.conf.get(initial)
    session.size_shuffles(spark, 1 << 40)
    assert int(spark.conf.get(initial)) == 1 << 15
    session.size_shuffles(spark, 0)
    assert spark.conf.get(initial) == own


def test_tasks_on_ticks_are_bounded_and_other_work_keeps_its_own_size(spark):
    initial, split = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    session.configure(spark)
    own = spark.conf.get(split)
    catalog.QUERIES["ohlcv_1m"](spark, PATH)
    assert (spark.conf.get(advisory), spark.conf.get(split)) == ("32m", "32m")
    session.configure_ticks(spark, 6 << 30)
    assert int(spark.conf.get(initial)) == (6 << 30) // session.TICK_BYTES == 768
    session.configure(spark)
    session.size_shuffles(spark, 0)
    assert (spark.conf.get(advisory), spark.conf.get(split)) == ("256m", own)
