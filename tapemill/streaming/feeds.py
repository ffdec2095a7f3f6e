"""Hourly drops as a stream of files, and the lineage that each file's folder gives its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tapemill.sources import checked
from tapemill.storage.files import Files

# Keyed state lives beside the heap and is checkpointed by its new files, so it may outgrow an executor's memory. A run
# that takes in what has arrived and stops would replay every change since the first run if changes were logged instead.
# Counting a store's rows takes a look-up more for every row that goes in or out.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def _part(name: str) -> Column:
    return F.regexp_extract(checked.FILE, rf"/{name}=([^/]+)/", 1)


def stream_lines(spark: SparkSession, schema: T.StructType, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Every line under `root/dt=/hh=` as it arrives: the schema's columns, CORRUPT and FILE.

    Listing is incremental by the checkpoint's log of files, so a restart reads only what is new.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return checked.parsed_json_lines(reader.load(root), schema, F.col("_metadata.file_path"))


def with_folder_lineage(rows: DataFrame, day_column: str) -> DataFrame:
    """Day and instant of ingest from the folder's day and hour: a batch that is repeated writes the same rows."""
    hour_end = F.to_timestamp(F.concat_ws(" ", _part("dt"), _part("hh")), "yyyy-MM-dd HH") + F.expr("INTERVAL 1 HOUR")
    return rows.withColumns({"_ingest_ts": hour_end, day_column: _part("dt").cast("date")})


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(checked.CORRUPT).isNull()).drop(checked.CORRUPT, checked.FILE)


def parquet_stream(spark: SparkSession, schema: T.StructType, folder: str) -> DataFrame:
    """Rows of Parquet files as they arrive in a folder, which is made if it is not there yet."""
    Files(spark, folder).make_folder(folder)
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def run_available(query_writer, checkpoint: str) -> StreamingQuery:
    """Take in all that has arrived, in the batches the source makes of it, and stop."""
    query = query_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query
