"""What a scheduler calls: one idempotent function per step, with its parameters as arguments.

Every step may be repeated with the same or a new `run_id`; a repeat upserts the same rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill import session
from tapemill.operators import joins, quality
from tapemill.plans import bronze, silver
from tapemill.plans.gold import MODES
from tapemill.plans.loading import Loaded, load
from tapemill.sources import checked, raw
from tapemill.specs import RAW_QUOTES, RAW_TRADES, TABLES
from tapemill.storage.footers import partition_counts
from tapemill.storage.publish import QualityError, failed_checks, write_audit_publish
from tapemill.storage.table import Pointer, Table, on_days

log = logging.getLogger(__name__)

# Least rows per day of each gold mode.
GATES = {"ohlcv": 1, "spread": 1, "vwap": 1, "event_windowed": 0}


@dataclass(frozen=True)
class Lake:
    """A session, the folder of the tables and the folder that holds `raw/`."""

    spark: SparkSession
    warehouse: str
    raw_root: str

    def table(self, name: str) -> Table:
        return Table(session.configure(self.spark), self.warehouse, TABLES[name])

    def day(self, name: str, day: date, reach: int = 0) -> DataFrame:
        """Published rows of a day and `reach` days around it, read from those partitions only."""
        table = self.table(name)
        days = [day + timedelta(days=n) for n in range(-reach, reach + 1)]
        chosen = table.partitions(on_days(table.spec.partition_by[0], days))
        session.configure_ticks(self.spark, table.bytes_of(chosen))
        return table.read_partitions(chosen)

    def rejects(self, name: str) -> str:
        """Folder of a table's rejected lines, one folder in it per run that had any."""
        return f"{self.warehouse.rstrip('/')}/rejected/{name}"


def create_tables(lake: Lake) -> list[str]:
    """Define the ten tables; returns the names of those that were new."""
    return [name for name in TABLES if lake.table(name).create_if_absent()]


# Bronze ------------------------------------------------------------------------------------------


def _instant(ingest_ts: datetime | None) -> datetime:
    return ingest_ts or datetime.now(timezone.utc)


def _ingest(
    lake: Lake, name: str, delivery: checked.Delivery, day_column: str, day: date, run_id: str, ingest_ts: datetime | None,
    required: tuple[str, ...] = (),
) -> Loaded:
    return load(
        lake.table(name),
        delivery,
        lambda rows: bronze.with_lineage(rows, day_column, day, _instant(ingest_ts)),
        lambda rows: bronze.load_source(rows, name),
        run_id,
        required,
        lake.rejects(name),
    )


def ingest_trades(
    lake: Lake, day: date, hours: Iterable[int], run_id: str, ingest_ts: datetime | None = None
) -> Loaded:
    """Several hours may be named, so that a run can look back for late files."""
    delivery = checked.json_lines(lake.spark, RAW_TRADES, raw.hour_paths(lake.raw_root, "trades", day, hours))
    return _ingest(lake, "bronze.trades_raw", delivery, "_trade_date", day, run_id, ingest_ts)


def ingest_quotes(
    lake: Lake, day: date, hours: Iterable[int], run_id: str, ingest_ts: datetime | None = None
) -> Loaded:
    delivery = checked.json_lines(lake.spark, RAW_QUOTES, raw.hour_paths(lake.raw_root, "quotes", day, hours))
    return _ingest(lake, "bronze.quotes_raw", delivery, "_quote_date", day, run_id, ingest_ts)


def ingest_events(lake: Lake, day: date, run_id: str, ingest_ts: datetime | None = None) -> Loaded:
    """Events without an id can never be merged; they are counted and left out."""
    delivery = checked.events_csv(lake.spark, [raw.events_path(lake.raw_root, day)])
    return _ingest(
        lake, "bronze.events_raw", delivery, "_event_load_date", day, run_id, ingest_ts, required=("event_id",)
    )


# Silver ------------------------------------------------------------------------------------------


def _promote(
    lake: Lake,
    source: str,
    target: str,
    day: date,
    run_id: str,
    transform: Callable[[DataFrame], DataFrame],
    suite: str | None,
    check_source: Callable[[DataFrame], None] | None = None,
) -> Pointer | None:
    """The whole day is read again on every run, so that late rows reach silver too."""
    rows = lake.day(source, day)
    if rows.isEmpty():
        log.info("%s run %s: no bronze rows for %s", target, run_id, day)
        return None
    return write_audit_publish(lake.table(target), transform(rows), run_id, suite, check_source)


def promote_trades(lake: Lake, day: date, run_id: str) -> Pointer | None:
    events = lake.day("silver.events", day)
    small = joins.fits_broadcast(events.select("event_id", "symbol", "event_type", "event_date", "event_start"))
    return _promote(
        lake, "bronze.trades_raw", "silver.trades", day, run_id,
        lambda rows: silver.silver_trades(rows, events, small), "silver_trades_quality",
    )


def promote_quotes(lake: Lake, day: date, run_id: str) -> Pointer | None:
    return _promote(
        lake, "bronze.quotes_raw", "silver.quotes", day, run_id, silver.silver_quotes, "silver_quotes_quality"
    )


def _check_events(rows: DataFrame) -> None:
    """Required fields first, then the suite, both before anything is merged."""
    required = TABLES["silver.events"].not_null
    missing = quality.missing_required(rows, required).first().n_missing
    if missing:
        raise ValueError(f"silver.events: {missing} row(s) have NULL in one of {', '.join(required)}")
    failed = failed_checks(rows, "silver_events_quality")
    if failed:
        raise QualityError(f"silver.events: {', '.join(failed)}")


def promote_events(lake: Lake, day: date, run_id: str) -> Pointer | None:
    return _promote(
        lake, "bronze.events_raw", "silver.events", day, run_id, silver.silver_events, None, _check_events
    )


# Gold --------------------------------------------------------------------------------------------


def _mode(mode: str):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    return MODES[mode]


def compute_gold(lake: Lake, day: date, mode: str, run_id: str) -> Pointer | None:
    """Compute one gold table for a day from silver and upsert it. A day without rows changes nothing."""
    chosen = _mode(mode)
    if not isinstance(day, date):
        raise ValueError(f"day must be a date, not {day!r}")
    inputs = [lake.day(name, day, reach) for name, reach in chosen.inputs]
    rows = chosen.compute(day, *inputs)
    return write_audit_publish(lake.table(chosen.target), rows, run_id)


def check_gold_rows(lake: Lake, day: date, mode: str) -> int:
    """Row-count gate of a day, from the files' footers; returns the count or raises."""
    table = lake.table(_mode(mode).target)
    spec = table.spec
    chosen = table.partitions(on_days(spec.partition_by[0], [day]))
    rows = 0
    if chosen:
        by = ["version", *spec.partition_by]
        schema = T.StructType([*spec.stored_schema.fields, T.StructField("version", T.StringType())])
        counts = partition_counts(lake.spark, f"{table.root}/data", table.paths(chosen), by, schema)
        rows = counts.agg(F.sum("n")).first()[0] or 0
    if rows < GATES[mode]:
        raise QualityError(f"{spec.name}: {rows} row(s) on {day}, expected at least {GATES[mode]}")
    return rows
