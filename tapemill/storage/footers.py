"""Row counts from Parquet footers: gates on written tables read no data page."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lets the planner answer counts by the readers' own statistics.
PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"
# Sources that keep their older reader, which cannot push aggregates down.
OLDER_READERS = "spark.sql.sources.useV1SourceList"


@contextmanager
def _newer_parquet_reader(spark: SparkSession) -> Iterator[None]:
    """The choice of reader is made when a frame is defined, so the setting is put back at once."""
    before = spark.conf.get(OLDER_READERS)
    spark.conf.set(OLDER_READERS, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(OLDER_READERS, before)


def partition_counts(spark: SparkSession, base: str, paths: list[str], by: list[str], schema: T.StructType) -> DataFrame:
    """Rows per partition (columns `by`, n) of a partitioned Parquet table, from file footers alone.

    `by` must be all partition columns of the paths; counts over fewer of them are sums of these few rows.
    """
    spark.conf.set(PUSH_DOWN, "true")
    with _newer_parquet_reader(spark):
        rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    return rows.groupBy(*by).agg(F.count("*").alias("n"))
