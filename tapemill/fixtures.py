"""Tick-shaped inputs derived from the whole `lineitem` and `orders` tables.

Each text runs unchanged in Spark (UTC session) and in any ANSI engine with the same functions,
once `{lineitem}` or `{orders}` names the table. Prices come from integer cents, so that engines
agree on every digit. 5,000 orders make one trading day of a calendar of 2,500 days, which starts
over as often as the orders need; an event's id ends with the round, so events grow with orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapemill.specs import EVENT_TYPES
from tapemill.storage.files import Files

# Exchanges and symbols of the feeds.
EXCHANGES = ("NYSE", "NASDAQ", "ARCA")
SYMBOLS = (
    "AAPL", "MSFT", "AMZN", "GOOGL", "TSLA", "NVDA", "META", "JPM", "BAC", "GS",
    "ORCL", "CRM", "AMD", "INTC", "NFLX", "DIS", "WMT", "XOM", "CVX", "PFE",
)
FIRST_DAY = "2024-01-15"

_OPEN = f"CAST('{FIRST_DAY} 09:30:00' AS TIMESTAMP)"


def _day(order_key: str) -> str:
    return f"CAST(floor({order_key} / 5000) % 2500 AS INT)"


def _pick(values: tuple[str, ...], index: str) -> str:
    """SQL for the value at a zero-based index, cut from one padded text."""
    width = max(map(len, values))
    padded = "".join(v.ljust(width) for v in values)
    return f"trim(substring('{padded}', CAST(({index}) * {width} + 1 AS INT), {width}))"


_TICK = f"""
         {_pick(EXCHANGES, 'l_suppkey % 3')} AS exchange,
         {_pick(SYMBOLS, 'l_partkey % 20')} AS symbol,
         {_OPEN} + ({_day('l_orderkey')} * 86400
           + (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 23400) * INTERVAL '1' SECOND AS ts,
         l_orderkey * 8 + l_linenumber AS sequence_num"""

# Every line item is a trade; returned items are delivered once more, later, under a new trade id
# and at another price. One order in 997 has a timestamp that cannot be parsed.
BRONZE_TRADES = f"""
WITH ticks AS (
  SELECT {_TICK},
         CASE WHEN l_orderkey % 997 = 5 THEN 1 ELSE 0 END AS garbled,
         CAST(CAST(l_extendedprice AS DECIMAL(18,6)) AS DOUBLE) AS price, CAST(l_quantity AS BIGINT) AS size,
         CASE l_returnflag WHEN 'A' THEN 'BUY' WHEN 'N' THEN 'SELL' ELSE 'MID' END AS side,
         CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(20)) || '-' || CAST(l_partkey AS VARCHAR(20)) AS tail,
         l_returnflag
  FROM {{lineitem}}),
deliveries AS (
  SELECT *, 'T-' || tail AS trade_id, 0 AS late FROM ticks
  UNION ALL
  SELECT *, 'R-' || tail AS trade_id, 1 AS late FROM ticks WHERE l_returnflag = 'R')
SELECT exchange, symbol,
       CASE WHEN garbled = 1 THEN 'bad-ts' ELSE replace(CAST(ts AS VARCHAR(30)), ' ', 'T') END AS exchange_ts,
       price + late AS price, size, sequence_num, side, trade_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + (16 + late) * INTERVAL '1' HOUR AS _ingest_ts,
       CAST(ts AS DATE) AS _trade_date
FROM deliveries"""

# Spreads of 2 to 18 basis points; one order in 500 is crossed, within the tolerance of the checks.
BRONZE_QUOTES = f"""
WITH ticks AS (
  SELECT {_TICK},
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         CASE WHEN l_orderkey % 500 = 7 THEN -1 ELSE 1 END * (1 + CAST(round(l_tax * 100) AS BIGINT)) AS half,
         100 + CAST(l_quantity AS BIGINT) * 10 AS bid_size, 100 + l_partkey % 4900 AS ask_size
  FROM {{lineitem}})
SELECT exchange, symbol, replace(CAST(ts AS VARCHAR(30)), ' ', 'T') AS exchange_ts,
       CAST(CAST(CAST(cents * 10000 - cents * half AS DECIMAL(18,6)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6)) AS DOUBLE) AS bid,
       bid_size,
       CAST(CAST(CAST(cents * 10000 + cents * half AS DECIMAL(18,6)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6)) AS DOUBLE) AS ask,
       ask_size, sequence_num,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '16' HOUR AS _ingest_ts,
       CAST(ts AS DATE) AS _quote_date
FROM ticks"""

# Every order is one delivery of the event of its day, symbol, type and round of the calendar; later
# deliveries move its start. Seven of the twenty symbols have no events. One customer in 97 sends no event id.
BRONZE_EVENTS = f"""
WITH deliveries AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 97 = 5 THEN 1 ELSE 0 END AS nameless,
         {_pick(SYMBOLS, 'o_custkey % 13')} AS symbol,
         {_pick(EVENT_TYPES, 'CAST(substring(o_orderpriority, 1, 1) AS INT) - 1')} AS event_type,
         CAST('{FIRST_DAY} 10:30:00' AS TIMESTAMP)
           + ({_day('o_orderkey')} * 1440 + (o_orderkey * 37) % 271) * INTERVAL '1' MINUTE AS starts
  FROM {{orders}})
SELECT CASE WHEN nameless = 1 THEN NULL ELSE
         'EVT-' || CAST(CAST(starts AS DATE) AS VARCHAR(10)) || '-' || symbol || '-' || event_type
           || '-' || CAST(CAST(floor(o_orderkey / 12500000) AS BIGINT) AS VARCHAR(20)) END AS event_id,
       symbol, event_type, CAST(CAST(starts AS DATE) AS VARCHAR(10)) AS event_date,
       replace(CAST(starts AS VARCHAR(30)), ' ', 'T') AS event_start,
       replace(CAST(starts + (15 + o_orderkey % 46) * INTERVAL '1' MINUTE AS VARCHAR(30)), ' ', 'T') AS event_end,
       symbol || ': ' || event_type AS description,
       CAST(CAST(starts AS DATE) AS TIMESTAMP) + (o_orderkey % 5000) * INTERVAL '1' SECOND AS _ingest_ts,
       CAST(starts AS DATE) AS _event_load_date
FROM deliveries"""


# Hour of the folder in which corrected trades arrive.
CORRECTED_HOUR = "20"

# Trades as lines of a feed, by folder. One in 1009 each is cut short, has text for its size, is garbled, has text for
# its price, or lacks its side; unknown fields come along. `{bronze_trades}` names the trades.
RAW_TRADE_LINES = """
WITH whole AS (
  SELECT *, CAST(_trade_date AS VARCHAR(10)) AS dt,
         CASE WHEN exchange_ts = 'bad-ts' THEN '09' ELSE substring(exchange_ts, 12, 2) END AS hh,
         sequence_num % 1009 AS damage,
         '{{"exchange":"' || exchange || '","symbol":"' || symbol || '","exchange_ts":"' || exchange_ts
           || '","price":' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR(30)) || ',"size":' || CAST(size AS VARCHAR(20))
           || ',"sequence_num":' || CAST(sequence_num AS VARCHAR(20)) || ',"side":"' || side
           || '","trade_id":"' || trade_id || '"}}' AS text
  FROM {bronze_trades})
SELECT *, CASE damage WHEN 1 THEN substring(text, 1, length(text) - 20)
                      WHEN 2 THEN replace(text, '"size":', '"size":"many","was":')
                      WHEN 3 THEN '%' || text
                      WHEN 4 THEN replace(text, '"price":', '"price":"n/a","was":')
                      WHEN 5 THEN replace(text, '"side":', '"flank":')
                      ELSE text END AS line
FROM whole"""


def _table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table spread over the cores. Only a file with fewer splits than cores is shuffled for it."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the larger input, a file or a folder of files."""
    files = Files(spark, sf_dir)
    return sum(e.size for e in files.listing(f"{sf_dir}/lineitem.parquet"))


def bronze_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_TRADES, lineitem=_table(spark, sf_dir, "lineitem", "l_orderkey"))


def bronze_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_QUOTES, lineitem=_table(spark, sf_dir, "lineitem", "l_orderkey"))


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BRONZE_EVENTS, orders=_table(spark, sf_dir, "orders", "o_orderkey"))
