"""Continuous ingest: a stream of hourly drops merged into a bronze table batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tapemill import session
from tapemill.operators.upsert import latest_of
from tapemill.specs import RAW_QUOTES, RAW_TRADES
from tapemill.storage.publish import write_audit_publish
from tapemill.storage.table import Table
from tapemill.streaming.feeds import accepted, run_available, stream_lines, with_folder_lineage

FEEDS = {"bronze.trades_raw": (RAW_TRADES, "_trade_date"), "bronze.quotes_raw": (RAW_QUOTES, "_quote_date")}


def merge_batches(rows: DataFrame, table: Table):
    """Writer that merges each batch into the table; the latest delivery of a key stays.

    Which delivery stays depends on the rows alone and merging twice changes nothing, so the table is the same for
    any division into batches, in any order, and when a batch is repeated after a failure.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        write_audit_publish(table, latest_of(batch, table.spec.keys), f"batch{batch_id}", merge=_merge_latest)

    return rows.writeStream.foreachBatch(merge)


def _merge_latest(target: DataFrame, source: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return latest_of(target.unionByName(source.select(*target.columns)), keys)


def ingest_arrived(
    spark: SparkSession, table: Table, root: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Merge all files under `root/dt=/hh=` that the checkpoint has not seen yet, then stop."""
    schema, day_column = FEEDS[table.spec.name]
    lines = accepted_with_lineage(stream_lines(spark, schema, root, files_per_batch), day_column)
    with session.shuffles_released(spark):
        return run_available(merge_batches(lines, table), checkpoint)


def accepted_with_lineage(lines: DataFrame, day_column: str) -> DataFrame:
    """Lines that could be read, with the day and instant of their folder."""
    return accepted(with_folder_lineage(lines, day_column))
