"""Schemas, keys and partitioning of the raw feeds and the ten tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Domain codes of the feeds.
SIDES = ("BUY", "SELL", "MID")
EVENT_TYPES = ("EARNINGS", "DIVIDEND", "SPLIT", "GUIDANCE", "BUYBACK")

PRICE = T.DecimalType(18, 6)

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "price": PRICE,
}


def _schema(columns: str) -> T.StructType:
    """Schema from "name type, ..." text; needs no session, unlike a DDL string."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the feeds.
RAW_TRADES = _schema(
    "exchange string, symbol string, exchange_ts string, price double, size bigint, "
    "sequence_num bigint, side string, trade_id string"
)
RAW_QUOTES = _schema(
    "exchange string, symbol string, exchange_ts string, bid double, bid_size bigint, "
    "ask double, ask_size bigint, sequence_num bigint"
)
RAW_EVENTS = _schema(
    "event_id string, symbol string, event_type string, event_date string, "
    "event_start string, event_end string, description string"
)


@dataclass(frozen=True)
class TableSpec:
    """One keyed table.

    `partition_by` names the directory columns. A name that is not part of `schema` is a day
    derived from the timestamp column given in `day_of`; it exists on disk only.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    day_of: dict[str, str] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> T.StructType:
        days = [T.StructField(day, T.DateType()) for day in self.day_of]
        return T.StructType([*self.schema.fields, *days])

    @property
    def partition_follows_key(self) -> bool:
        """True if equal keys always share a partition, so an upsert cannot move a row."""
        return all(self.day_of.get(col, col) in self.keys or col in _KEY_DAYS.get(self.name, ())
                   for col in self.partition_by)


# Day columns that the promotion derives from a key column.
_KEY_DAYS = {"silver.trades": ("trade_date",), "silver.quotes": ("quote_date",)}

_TICK_KEY = ("exchange", "symbol", "exchange_ts", "sequence_num")
_BAR_KEY = ("bar_start", "exchange", "symbol")

# Names, columns, keys and partitions of the tables.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "bronze.trades_raw",
            T.StructType([*RAW_TRADES.fields, *_schema("_ingest_ts timestamp, _trade_date date").fields]),
            keys=(*_TICK_KEY, "trade_id"),
            partition_by=("_trade_date",),
        ),
        TableSpec(
            "bronze.quotes_raw",
            T.StructType([*RAW_QUOTES.fields, *_schema("_ingest_ts timestamp, _quote_date date").fields]),
            keys=_TICK_KEY,
            partition_by=("_quote_date",),
        ),
        TableSpec(
            "bronze.events_raw",
            T.StructType([*RAW_EVENTS.fields, *_schema("_ingest_ts timestamp, _event_load_date date").fields]),
            keys=("event_id",),
            partition_by=("_event_load_date",),
        ),
        TableSpec(
            "silver.trades",
            _schema(
                "exchange string, symbol string, exchange_ts timestamp, sequence_num bigint, "
                "trade_date date, price price, size bigint, side string, trade_id string, "
                "event_id string, event_type string, _ingest_ts timestamp"
            ),
            keys=_TICK_KEY,
            partition_by=("trade_date", "exchange"),
            not_null=_TICK_KEY,
        ),
        TableSpec(
            "silver.quotes",
            _schema(
                "exchange string, symbol string, exchange_ts timestamp, sequence_num bigint, "
                "quote_date date, bid price, bid_size bigint, ask price, "
                "ask_size bigint, _ingest_ts timestamp"
            ),
            keys=_TICK_KEY,
            partition_by=("quote_date", "exchange"),
            not_null=_TICK_KEY,
        ),
        TableSpec(
            "silver.events",
            _schema(
                "event_id string, symbol string, event_type string, event_date date, "
                "event_start timestamp, event_end timestamp, description string, _ingest_ts timestamp"
            ),
            keys=("event_id", "event_date"),
            partition_by=("event_date",),
            not_null=("event_id", "symbol", "event_type", "event_date"),
        ),
        TableSpec(
            "gold.ohlcv_1m",
            _schema(
                "bar_start timestamp, exchange string, symbol string, open double, high double, "
                "low double, close double, volume bigint, n_trades bigint"
            ),
            keys=_BAR_KEY,
            partition_by=("bar_date", "exchange"),
            day_of={"bar_date": "bar_start"},
        ),
        TableSpec(
            "gold.vwap_daily",
            _schema(
                "trade_date date, exchange string, symbol string, vwap double, volume bigint, n_trades bigint"
            ),
            keys=("trade_date", "exchange", "symbol"),
            partition_by=("trade_date",),
        ),
        TableSpec(
            "gold.bid_ask_spread_1m",
            _schema(
                "bar_start timestamp, exchange string, symbol string, median_spread double, "
                "mid_price double, n_ticks bigint"
            ),
            keys=_BAR_KEY,
            partition_by=("bar_date", "exchange"),
            day_of={"bar_date": "bar_start"},
        ),
        TableSpec(
            "gold.event_windowed_volume",
            _schema(
                "event_ts timestamp, event_id string, event_type string, symbol string, "
                "window_start timestamp, window_end timestamp, pre_volume bigint, post_volume bigint, "
                "realized_vol double"
            ),
            keys=("event_ts", "event_id", "symbol"),
            partition_by=("event_day",),
            day_of={"event_day": "event_ts"},
            not_null=("event_id",),
        ),
    )
}
