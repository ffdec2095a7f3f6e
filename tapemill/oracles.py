"""Independent SQL for every registered query, for any ANSI engine with the driver's tables.

The texts share nothing with the plans but the fixture feeds and the tie-breaking order.
"""

from __future__ import annotations

import re

from tapemill import fixtures

_FEEDS = {
    "bronze_trades": fixtures.BRONZE_TRADES,
    "bronze_quotes": fixtures.BRONZE_QUOTES,
    "bronze_events": fixtures.BRONZE_EVENTS,
}

# Views in order of dependence; a query is prefixed with those it mentions, directly or not.
_VIEWS: dict[str, str] = {
    **{name: text.format(lineitem="lineitem", orders="orders") for name, text in _FEEDS.items()},
    "o_lines": fixtures.RAW_TRADE_LINES.format(bronze_trades="bronze_trades"),
    "o_accepted": """
SELECT * REPLACE (CASE WHEN damage = 5 THEN NULL ELSE side END AS side) FROM o_lines WHERE damage NOT IN (1, 2, 3, 4)""",
    "o_typed_trades": """
SELECT exchange, symbol, TRY_CAST(exchange_ts AS TIMESTAMP) AS exchange_ts, CAST(price AS DECIMAL(18,6)) AS price,
       size, sequence_num, side, trade_id, _ingest_ts
FROM bronze_trades""",
    "o_typed_quotes": """
SELECT exchange, symbol, TRY_CAST(exchange_ts AS TIMESTAMP) AS exchange_ts, CAST(bid AS DECIMAL(18,6)) AS bid, bid_size,
       CAST(ask AS DECIMAL(18,6)) AS ask, ask_size, sequence_num, _ingest_ts
FROM bronze_quotes""",
    "o_typed_events": """
SELECT event_id, symbol, event_type, TRY_CAST(event_date AS DATE) AS event_date,
       TRY_CAST(event_start AS TIMESTAMP) AS event_start, TRY_CAST(event_end AS TIMESTAMP) AS event_end,
       description, _ingest_ts
FROM bronze_events""",
    "o_all_trades": """
SELECT * EXCLUDE (rn), CAST(exchange_ts AS DATE) AS trade_date FROM (
  SELECT *, row_number() OVER (PARTITION BY exchange, symbol, exchange_ts, sequence_num
                               ORDER BY _ingest_ts, trade_id, price, size, side) AS rn
  FROM o_typed_trades) x
WHERE rn = 1""",
    "o_trades": "SELECT * FROM o_all_trades WHERE exchange_ts IS NOT NULL",
    "o_quotes": """
SELECT * EXCLUDE (rn), CAST(exchange_ts AS DATE) AS quote_date FROM (
  SELECT *, row_number() OVER (PARTITION BY exchange, symbol, exchange_ts, sequence_num
                               ORDER BY _ingest_ts, bid, ask, bid_size, ask_size) AS rn
  FROM o_typed_quotes) x
WHERE rn = 1""",
    "o_all_events": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id, event_date
                               ORDER BY _ingest_ts DESC, event_start, event_type, symbol, event_end, description) AS rn
  FROM o_typed_events) x
WHERE rn = 1""",
    "o_events": "SELECT * FROM o_all_events WHERE event_id IS NOT NULL",
    "o_first_events": """
SELECT event_id, symbol, event_type, event_date, event_start FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, event_date ORDER BY event_start, event_id) AS rn FROM o_events) x
WHERE rn = 1""",
    "o_arrivals": """
SELECT t.*, date_trunc('minute', exchange_ts) + INTERVAL '1' MINUTE AS bar_end,
       d.slot + CASE WHEN sequence_num % 97 = 0 THEN 1 ELSE 0 END AS arrival
FROM o_trades t
JOIN (SELECT trade_date, ntile(4) OVER (ORDER BY trade_date) AS slot FROM (SELECT DISTINCT trade_date FROM o_trades) x) d
  ON t.trade_date = d.trade_date""",
    "o_watermarks": """
SELECT arrival, max(latest) OVER (ORDER BY arrival) - INTERVAL '10' MINUTE AS mark
FROM (SELECT arrival, max(exchange_ts) AS latest FROM o_arrivals GROUP BY arrival) x""",
    "o_in_time": """
SELECT a.*, a.bar_end <= (SELECT max(mark) FROM o_watermarks) AS closed
FROM o_arrivals a LEFT JOIN (SELECT arrival, lag(mark) OVER (ORDER BY arrival) AS mark FROM o_watermarks) w ON a.arrival = w.arrival
WHERE w.mark IS NULL OR a.bar_end > w.mark""",
    "o_bars": """
SELECT bar_start, exchange, symbol, CAST(f.p AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
       CAST(l.p AS DOUBLE) AS close, volume, n_trades
FROM (SELECT date_trunc('minute', exchange_ts) AS bar_start, exchange, symbol,
             min({'t': exchange_ts, 'p': price}) AS f, max({'t': exchange_ts, 'p': price}) AS l,
             max(price) AS high, min(price) AS low, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_trades
      FROM o_trades GROUP BY ALL) x""",
    "o_vwap": """
SELECT trade_date, exchange, symbol, CAST(sum(price * CAST(size AS DECIMAL(18,0))) AS DOUBLE) / CAST(sum(size) AS DOUBLE) AS vwap,
       CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_trades
FROM o_trades GROUP BY ALL""",
    "o_spreads": """
SELECT date_trunc('minute', exchange_ts) AS bar_start, exchange, symbol,
       (CAST(ask AS DOUBLE) - CAST(bid AS DOUBLE)) / ((CAST(ask AS DOUBLE) + CAST(bid AS DOUBLE)) / 2) * 10000 AS spread_bps,
       (CAST(ask AS DOUBLE) + CAST(bid AS DOUBLE)) / 2 AS mid_price, bid + ask AS both_sides
FROM o_quotes""",
    "o_spread_bars": """
SELECT bar_start, exchange, symbol, round(quantile_disc(spread_bps, 0.5), 6) AS median_spread,
       CAST(sum(both_sides) AS DOUBLE) / (2 * count(both_sides)) AS mid_price, count(*) AS n_ticks
FROM o_spreads GROUP BY ALL""",
    "o_pairs": """
SELECT t.symbol, t.exchange, t.exchange_ts, t.sequence_num, t.price, t.size, e.event_id, e.event_type,
       e.event_start AS event_ts, e.event_start - INTERVAL '1' HOUR AS window_start,
       e.event_start + INTERVAL '1' HOUR AS window_end
FROM o_trades t JOIN o_events e ON t.symbol = e.symbol
 AND t.exchange_ts >= e.event_start - INTERVAL '1' HOUR AND t.exchange_ts <= e.event_start + INTERVAL '1' HOUR""",
    "o_closes": """
SELECT symbol, event_ts, bar_start, price FROM (
  SELECT symbol, event_ts, date_trunc('minute', exchange_ts) AS bar_start, price,
         row_number() OVER (PARTITION BY symbol, event_ts, date_trunc('minute', exchange_ts)
                            ORDER BY exchange_ts DESC, sequence_num DESC, exchange DESC, price DESC) AS rn
  FROM o_pairs) x
WHERE rn = 1""",
    "o_vols": """
SELECT symbol, event_ts, stddev(lr) AS rv FROM (
  SELECT symbol, event_ts,
         ln(CAST(price AS DOUBLE) / lag(CAST(price AS DOUBLE)) OVER (PARTITION BY symbol, event_ts ORDER BY bar_start)) AS lr
  FROM o_closes) x
WHERE lr IS NOT NULL GROUP BY symbol, event_ts""",
    "o_event_windows": """
SELECT v.*, round(coalesce(r.rv, 0.0), 6) AS realized_vol
FROM (SELECT event_ts, event_id, event_type, symbol, window_start, window_end,
             CAST(sum(CASE WHEN exchange_ts < event_ts THEN size ELSE 0 END) AS BIGINT) AS pre_volume,
             CAST(sum(CASE WHEN exchange_ts < event_ts THEN 0 ELSE size END) AS BIGINT) AS post_volume
      FROM o_pairs GROUP BY ALL) v
LEFT JOIN o_vols r ON v.symbol = r.symbol AND v.event_ts = r.event_ts""",
}


def _with_views(query: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(_VIEWS[name])

    visit(query)
    ctes = ",\n".join(f"{name} AS ({text}\n)" for name, text in _VIEWS.items() if name in needed)
    return f"WITH {ctes}\n{query.strip()}" if ctes else query.strip()


def _upserted(target: str, source: str, keys: str, order: str, columns: str) -> str:
    """Both sides reduced to one row per key, then anti join and union."""

    def reduced(rows: str) -> str:
        return (
            f"(SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
            f"FROM ({rows}) a) b WHERE rn = 1)"
        )

    on = " AND ".join(f"t.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    return f"""
SELECT {columns} FROM {reduced(target)} t WHERE NOT EXISTS (SELECT 1 FROM {reduced(source)} s WHERE {on})
UNION ALL
SELECT {columns} FROM {reduced(source)} r"""


def _rules(suite: str, rows: str, predicates: list[tuple[str, str, float]], keys: str, least_unique: float) -> str:
    """One SELECT per rule; `predicates` are (rule, SQL condition, least share)."""
    parts = [
        f"SELECT '{rule}' AS rule, avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END) AS metric, {least} AS min_ratio FROM {rows}"
        for rule, cond, least in predicates
    ]
    parts.append(
        f"SELECT 'unique({keys})', CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(n), {least_unique} "
        f"FROM (SELECT count(*) AS n FROM {rows} GROUP BY {keys}) g"
    )
    union = "\nUNION ALL ".join(parts)
    return f"""
SELECT '{suite}' AS suite, rule, round(CAST(metric AS DOUBLE), 9) AS metric, CAST(min_ratio AS DOUBLE) AS min_ratio,
       CASE WHEN metric >= min_ratio THEN 'Success' ELSE 'Failure' END AS status
FROM ({union}) u"""


def _null_rows(table: str, rows: str, cols: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS n_null, "
        f"CASE WHEN count(*) = count({c}) THEN 'Success' ELSE 'Failure' END AS status FROM {rows}"
        for c in cols.split(", ")
    )


def _gate(gate: str, rows: str, day: str, least: int) -> str:
    return f"""
SELECT '{gate}' AS gate, d.day, coalesce(c.n, 0) AS n_rows, CAST({least} AS BIGINT) AS min_rows,
       CASE WHEN coalesce(c.n, 0) >= {least} THEN 'Success' ELSE 'Failure' END AS status
FROM (SELECT DISTINCT _trade_date AS day FROM bronze_trades) d
LEFT JOIN (SELECT {day} AS day, count(*) AS n FROM {rows} GROUP BY 1) c ON d.day = c.day"""


_KEY = "exchange, symbol, exchange_ts, sequence_num"
_RAW_TRADE = "exchange, symbol, exchange_ts, price, size, sequence_num, side, trade_id"
_RAW_QUOTE = "exchange, symbol, exchange_ts, bid, bid_size, ask, ask_size, sequence_num"
_RAW_EVENT = "event_id, symbol, event_type, event_date, event_start, event_end, description"
_TRADE = (
    "t.exchange, t.symbol, t.exchange_ts, t.sequence_num, t.trade_date, CAST(t.price AS DOUBLE) AS price, t.size, "
    "t.side, t.trade_id, e.event_id, e.event_type, t._ingest_ts"
)
_QUOTE = (
    "exchange, symbol, exchange_ts, sequence_num, quote_date, CAST(bid AS DOUBLE) AS bid, bid_size, "
    "CAST(ask AS DOUBLE) AS ask, ask_size, _ingest_ts"
)
_ENRICHED = "LEFT JOIN o_first_events e ON t.symbol = e.symbol AND t.trade_date = e.event_date"
_COMPLETE_TICK = [(f"complete({c})", f"{c} IS NOT NULL", 1.0) for c in _KEY.split(", ")]


def _signs(*cols: str) -> list[tuple[str, str, float]]:
    return [(f"non_negative({c})", f"{c} IS NULL OR {c} >= 0", 1.0) for c in cols]


_QUERIES: dict[str, str] = {
    "bronze_lineage": f"""
SELECT {_RAW_TRADE}, CAST('2024-01-15 16:00:00' AS TIMESTAMP) AS _ingest_ts, DATE '2024-01-15' AS _trade_date
FROM bronze_trades""",
    "bronze_day_slice": "SELECT * FROM bronze_trades WHERE _trade_date = DATE '2024-01-15'",
    "null_key_guard": "SELECT * FROM bronze_events WHERE event_id IS NOT NULL",
    "upsert_trades": _upserted(
        "SELECT * FROM bronze_trades WHERE side <> 'SELL'",
        "SELECT * REPLACE (price + 1 AS price) FROM bronze_trades WHERE side <> 'BUY'",
        f"{_KEY}, trade_id", "price, size, side, _ingest_ts, _trade_date", f"{_RAW_TRADE}, _ingest_ts, _trade_date",
    ),
    "upsert_quotes": _upserted(
        "SELECT * FROM bronze_quotes WHERE exchange <> 'NYSE'",
        "SELECT * REPLACE (bid_size + 1 AS bid_size) FROM bronze_quotes WHERE exchange <> 'ARCA'",
        _KEY, "bid, bid_size, ask, ask_size, _ingest_ts, _quote_date", f"{_RAW_QUOTE}, _ingest_ts, _quote_date",
    ),
    "upsert_events": _upserted(
        "SELECT * FROM bronze_events WHERE event_id IS NOT NULL AND event_type <> 'SPLIT'",
        "SELECT * REPLACE (upper(description) AS description) FROM bronze_events "
        "WHERE event_id IS NOT NULL AND event_type <> 'DIVIDEND'",
        "event_id",
        "symbol, event_type, event_date, event_start, event_end, description, _ingest_ts, _event_load_date",
        f"{_RAW_EVENT}, _ingest_ts, _event_load_date",
    ),
    "ingest_trades_jsonl": f"SELECT {_RAW_TRADE} FROM bronze_trades",
    "ingest_quotes_jsonl": f"SELECT {_RAW_QUOTE} FROM bronze_quotes",
    "ingest_events_csv": f"SELECT {_RAW_EVENT} FROM bronze_events",
    "parse_exchange_ts": """
SELECT trade_id, exchange_ts AS raw_ts, TRY_CAST(exchange_ts AS TIMESTAMP) AS exchange_ts FROM bronze_trades""",
    "parse_event_date": """
SELECT event_id, event_date AS raw_date, TRY_CAST(event_date AS DATE) AS event_date,
       TRY_CAST(event_start AS TIMESTAMP) AS event_start, TRY_CAST(event_end AS TIMESTAMP) AS event_end
FROM bronze_events""",
    "cast_price_decimal": """
SELECT exchange, symbol, sequence_num, CAST(bid AS DOUBLE) AS bid, CAST(ask AS DOUBLE) AS ask FROM o_typed_quotes""",
    "dedup_trades": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM o_all_trades",
    "dedup_quotes": "SELECT * REPLACE (CAST(bid AS DOUBLE) AS bid, CAST(ask AS DOUBLE) AS ask) FROM o_quotes",
    "dedup_events": "SELECT * FROM o_all_events",
    "dedup_report": "\nUNION ALL ".join(
        f"SELECT '{feed}' AS feed, CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_kept, "
        f"CAST(sum(n) - count(*) AS BIGINT) AS rows_dropped "
        f"FROM (SELECT count(*) AS n FROM o_typed_{feed} GROUP BY {keys}) g"
        for feed, keys in (("trades", _KEY), ("quotes", _KEY), ("events", "event_id, event_date"))
    ),
    "first_event_per_symbol_day": "SELECT * FROM o_first_events",
    "trade_event_enrich": f"""
SELECT t.trade_id, t.symbol, t.trade_date, e.event_id, e.event_type
FROM (SELECT *, CAST(exchange_ts AS DATE) AS trade_date FROM o_typed_trades) t {_ENRICHED}""",
    "silver_trades": f"SELECT {_TRADE} FROM o_all_trades t {_ENRICHED}",
    "silver_quotes": f"SELECT {_QUOTE} FROM o_quotes",
    "silver_events": "SELECT * FROM o_events",
    "wap_trades": f"SELECT {_TRADE}, t.exchange_ts IS NOT NULL AS published, true AS unchanged FROM o_all_trades t {_ENRICHED}",
    "wap_quotes": f"SELECT {_QUOTE} FROM o_quotes",
    "required_fields": """
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE event_id IS NULL OR symbol IS NULL OR event_type IS NULL OR event_date IS NULL) AS n_missing
FROM o_typed_events""",
    "not_null_gate": "\nUNION ALL ".join(
        [
            _null_rows("silver.trades", "o_typed_trades", _KEY),
            _null_rows("silver.quotes", "o_typed_quotes", _KEY),
            _null_rows("silver.events", "o_typed_events", "event_id, symbol, event_type, event_date"),
        ]
    ),
    "dq_trades": _rules(
        "silver_trades_quality",
        "o_typed_trades",
        [
            *_COMPLETE_TICK,
            ("contained_in(side)", "side IS NULL OR side IN ('BUY', 'SELL', 'MID')", 1.0),
            *_signs("size", "price"),
        ],
        _KEY,
        0.9999,
    ),
    "dq_quotes": _rules(
        "silver_quotes_quality",
        "o_quotes",
        [
            *_COMPLETE_TICK,
            ("complete(bid)", "bid IS NOT NULL", 1.0),
            ("complete(ask)", "ask IS NOT NULL", 1.0),
            *_signs("bid", "ask", "bid_size", "ask_size"),
            ("satisfies(ask > bid)", "ask > bid", 0.99),
        ],
        _KEY,
        0.9999,
    ),
    "dq_events": _rules(
        "silver_events_quality",
        "o_typed_events",
        [
            *((f"complete({c})", f"{c} IS NOT NULL", 1.0) for c in ("event_id", "symbol", "event_type", "event_date")),
            (
                "contained_in(event_type)",
                "event_type IS NULL OR event_type IN ('EARNINGS', 'DIVIDEND', 'SPLIT', 'GUIDANCE', 'BUYBACK')",
                1.0,
            ),
            ("complete(event_start)", "event_start IS NOT NULL", 1.0),
            ("satisfies(event_end > event_start)", "event_end > event_start", 1.0),
        ],
        "event_id, event_date",
        1.0,
    ),
    "row_count_gate": "\nUNION ALL ".join(
        [
            _gate("ohlcv_1m", "o_bars", "CAST(bar_start AS DATE)", 1),
            _gate("bid_ask_spread_1m", "o_spread_bars", "CAST(bar_start AS DATE)", 1),
            _gate("vwap_daily", "o_vwap", "trade_date", 1),
            _gate("event_windowed_volume", "o_event_windows", "CAST(event_ts AS DATE)", 0),
        ]
    ),
    "rejected_trades": """
SELECT dt, hh, line, CASE damage WHEN 2 THEN 'mistyped: size' WHEN 4 THEN 'mistyped: price' ELSE 'unreadable' END AS reason
FROM o_lines WHERE damage IN (1, 2, 3, 4)""",
    "accepted_trades": f"SELECT {_RAW_TRADE} FROM o_accepted",
    "ingest_report": f"""
SELECT 'trades' AS feed, (SELECT count(*) FROM o_lines) AS n_read,
       (SELECT count(*) FROM o_lines WHERE damage IN (1, 2, 3, 4)) AS n_rejected, CAST(0 AS BIGINT) AS n_nameless,
       count(*) - count(DISTINCT ({_KEY}, trade_id)) AS n_repeated, count(DISTINCT ({_KEY}, trade_id)) AS n_loaded
FROM o_accepted
UNION ALL
SELECT 'events', count(*), 0, count(*) - count(event_id), count(event_id) - count(DISTINCT event_id), count(DISTINCT event_id)
FROM bronze_events""",
    "hour_slice": """
SELECT trade_id, exchange_ts, CAST(dt AS DATE) AS dt, CAST(hh AS INTEGER) AS hh, 'dt=' || dt || '/hh=' || hh AS folder
FROM o_lines WHERE dt = '2024-01-15' AND hh BETWEEN '09' AND '11' AND damage NOT IN (1, 3)""",
    "stream_upsert_trades": f"""
SELECT {_RAW_TRADE}, _ingest_ts, _trade_date FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEY}, trade_id ORDER BY _ingest_ts DESC, price, size, side) AS rn FROM (
    SELECT {_RAW_TRADE}, CAST(dt AS TIMESTAMP) + (CAST(hh AS INTEGER) + 1) * INTERVAL '1' HOUR AS _ingest_ts,
           CAST(dt AS DATE) AS _trade_date FROM o_accepted
    UNION ALL
    SELECT exchange, symbol, exchange_ts, price, size + 1, sequence_num, side, trade_id,
           CAST(dt AS TIMESTAMP) + 21 * INTERVAL '1' HOUR, CAST(dt AS DATE) FROM o_accepted WHERE sequence_num % 5 = 0) d) r
WHERE rn = 1""",
    "stream_minute_bars": """
SELECT bar_start, exchange, symbol, CAST(f.p AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
       CAST(l.p AS DOUBLE) AS close, volume, n_trades
FROM (SELECT date_trunc('minute', exchange_ts) AS bar_start, exchange, symbol,
             min({'t': exchange_ts, 'p': price}) AS f, max({'t': exchange_ts, 'p': price}) AS l,
             max(price) AS high, min(price) AS low, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_trades
      FROM o_in_time WHERE closed GROUP BY ALL) x""",
    "stream_late_trades": """
SELECT (SELECT count(*) FROM o_arrivals) AS n_read, count(*) FILTER (WHERE closed) AS n_in_bars,
       count(*) FILTER (WHERE NOT closed) AS n_open, (SELECT count(*) FROM o_arrivals) - count(*) AS n_late
FROM o_in_time""",
    "stream_dedup_trades": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM o_trades",
    "incremental_bars": "SELECT * FROM o_bars",
    "incremental_spreads": "SELECT * FROM o_spread_bars",
    "bar_gate_from_footers": """
SELECT CAST(bar_start AS DATE) AS day, count(*) AS n_rows, 'Success' AS status FROM o_bars GROUP BY 1""",
    "sql_vwap": "SELECT * FROM o_vwap WHERE trade_date = DATE '2024-01-15'",
    "ohlcv_1m": "SELECT * FROM o_bars",
    "vwap_daily": "SELECT * FROM o_vwap",
    "spread_bps": """
SELECT bar_start, exchange, symbol, round(spread_bps, 6) AS spread_bps, round(mid_price, 6) AS mid_price FROM o_spreads""",
    "spread_1m": "SELECT * FROM o_spread_bars",
    "three_day_slice": """
SELECT exchange, symbol, exchange_ts, trade_date, CAST(price AS DOUBLE) AS price, size FROM o_trades
WHERE trade_date BETWEEN DATE '2024-01-14' AND DATE '2024-01-16'""",
    "event_window_join": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM o_pairs",
    "event_minute_close": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM o_closes",
    "realized_vol": "SELECT symbol, event_ts, round(rv, 6) AS realized_vol FROM o_vols",
    "event_window": "SELECT * FROM o_event_windows",
    "upsert_gold": """
SELECT * FROM o_bars b WHERE b.exchange = 'ARCA'
UNION ALL
SELECT bar_start, exchange, symbol, CAST(CAST(open AS DECIMAL(18,6)) + 1 AS DOUBLE), CAST(CAST(high AS DECIMAL(18,6)) + 1 AS DOUBLE),
       CAST(CAST(low AS DECIMAL(18,6)) + 1 AS DOUBLE), CAST(CAST(close AS DECIMAL(18,6)) + 1 AS DOUBLE), volume, n_trades
FROM o_bars WHERE exchange <> 'ARCA'""",
}

_QUERIES["upsert_trades_bucketed"] = _QUERIES["upsert_trades"]
_QUERIES["trade_event_enrich_salted"] = _QUERIES["trade_event_enrich"]

ORACLES: dict[str, str] = {name: _with_views(query) for name, query in _QUERIES.items()}
