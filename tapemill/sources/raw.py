"""Raw drops: gzip JSON lines per hour for ticks, one CSV per day for events.

Schemas are declared. A missing or mistyped field becomes NULL, a malformed line a row of NULLs,
an unknown field is dropped. A folder or file that is not there yet reads as no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill import session
from tapemill.specs import RAW_EVENTS, RAW_QUOTES, RAW_TRADES
from tapemill.storage.files import Files

# Shuffle partitions of lines for each one of other ticks.
LINE_PARTITIONS = 4


def hour_paths(root: str, feed: str, day: date, hours: Iterable[int]) -> list[str]:
    """Leaf folders of some hours, so that `dt` and `hh` do not become columns."""
    return [f"{root}/raw/{feed}/dt={day.isoformat()}/hh={hour:02d}" for hour in hours]


def events_path(root: str, day: date) -> str:
    return f"{root}/raw/events/events_{day.isoformat()}.csv"


def by_day(rows: DataFrame) -> DataFrame:
    """Rows with `dt` and `hh` gathered for an hourly drop: a task writes whole days, an hour is one file.

    A task then makes a day's folder once and the commit moves whole days, where hours dealt singly cost a folder and
    a move each. Lines are wide, so there are more partitions than of other ticks: packed ones stay below the size from which
    they are split, and only a day larger than a task's share is written by several tasks.
    """
    return rows.hint("rebalance", LINE_PARTITIONS * session.shuffle_partitions(rows.sparkSession), "dt")


def read_json_lines(spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
    """The codec follows from the file suffix."""
    return _read_present(spark, spark.read.schema(schema).format("json"), schema, paths)


def read_events_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The header is skipped and columns are taken by position."""
    reader = spark.read.schema(RAW_EVENTS).format("csv").option("header", True)
    return _read_present(spark, reader, RAW_EVENTS, paths)


def read_trades(spark: SparkSession, root: str, day: date, hours: Iterable[int]) -> DataFrame:
    return read_json_lines(spark, RAW_TRADES, hour_paths(root, "trades", day, hours))


def read_quotes(spark: SparkSession, root: str, day: date, hours: Iterable[int]) -> DataFrame:
    return read_json_lines(spark, RAW_QUOTES, hour_paths(root, "quotes", day, hours))


def _read_present(spark: SparkSession, reader: DataFrameReader, schema: T.StructType, paths: list[str]) -> DataFrame:
    found = present(spark, paths)
    if not found:
        return spark.createDataFrame([], schema)
    return reader.load(found).select(*schema.fieldNames())


def present(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the paths that exist."""
    return [path for path in paths if Files(spark, path).exists(path)]


def read_hours(spark: SparkSession, feed: str, root: str, schema: T.StructType) -> DataFrame:
    """All hours of a JSON feed with `dt`, `hh` and the file of each row.

    The folder columns come from the paths, so filters on them leave out folders before any file is opened.
    """
    columns = T.StructType([*schema.fields, T.StructField("dt", T.DateType()), T.StructField("hh", T.IntegerType())])
    base = f"{root}/raw/{feed}"
    rows = spark.read.schema(columns).option("basePath", base).json(base)
    return rows.select("*", F.col("_metadata.file_path").alias("file"))
