"""Raw frames to bronze rows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.operators.dedup import keep_first, one_per_key, one_per_merge_key
from tapemill.operators.upsert import drop_null_keys
from tapemill.specs import TABLES


def with_lineage(raw: DataFrame, day_column: str, day: date, ingest_ts: datetime) -> DataFrame:
    """Adds the run's instant and date. Both come from the run, never from the rows.

    `ingest_ts` must carry its zone; it is read as UTC if it does not.
    """
    return raw.withColumn("_ingest_ts", F.lit(_utc_text(ingest_ts)).cast("timestamp")).withColumn(
        day_column, F.lit(day.isoformat()).cast("date")
    )


def _utc_text(instant: datetime) -> str:
    text = instant.isoformat()
    return text if instant.tzinfo else f"{text}+00:00"


def merge_source(rows: DataFrame, table: str, marked: bool = False) -> DataFrame:
    """Bronze rows reduced to one per key, so that a repeated delivery can be merged again and again."""
    spec = TABLES[table]
    others = [c for c in spec.columns if c not in spec.keys]
    return one_per_merge_key(rows, spec.keys, others, marked)


def load_source(rows: DataFrame, table: str) -> DataFrame:
    """The same rows as `merge_source` in one pass over raw files."""
    spec = TABLES[table]
    return one_per_key(rows, spec.keys, [c for c in spec.columns if c not in spec.keys])


def event_merge_source(rows: DataFrame) -> DataFrame:
    """Events without an id can never be merged and are dropped first."""
    spec = TABLES["bronze.events_raw"]
    others = [c for c in spec.columns if c not in spec.keys]
    return keep_first(drop_null_keys(rows, spec.keys), spec.keys, others)


def day_slice(bronze: DataFrame, day_column: str, day: date) -> DataFrame:
    return bronze.where(F.col(day_column) == F.lit(day.isoformat()).cast("date"))
