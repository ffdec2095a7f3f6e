"""Keyed tables in buckets of the key: an upsert reads the target where it lies and moves only the source."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tapemill.functions.keys import numbers_first
from tapemill.operators.upsert import upsert

# Parquet bytes that a bucket should hold; a task of the upsert reads one bucket.
BUCKET_BYTES = 128 * 1024 * 1024


def buckets_for(table_bytes: int, at_least: int = 8) -> int:
    return max(at_least, -(-table_bytes // BUCKET_BYTES))


class BucketedTable:
    """A catalogued table, bucketed and sorted by its key, at a path of its own."""

    def __init__(self, spark: SparkSession, name: str, path: str, keys: Sequence[str], buckets: int):
        self.spark, self.name, self.path, self.keys, self.buckets = spark, name, path.rstrip("/"), list(keys), buckets

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def write(self, rows: DataFrame, dealt: bool = False) -> None:
        """Write a new version beside the present one and point the catalogue at it.

        Rows are dealt by the key into as many tasks as buckets, so each bucket is one file. Rows that a reduction to
        one per key has `dealt` into that many shuffle partitions are not moved again; those without a whole key, which
        it leaves where they are, add files of their own. The old version's files stay for readers that have planned on
        them.
        """
        on = numbers_first(rows, self.keys)
        version = f"{self.path}/{uuid.uuid4().hex}"
        staged = f"{self.name}_{uuid.uuid4().hex[:8]}"
        rows = rows if dealt else rows.repartition(self.buckets, *on)
        writer = rows.write.bucketBy(self.buckets, *on).sortBy(*on).option("path", version)
        writer.option("compression", "zstd").format("parquet").saveAsTable(staged)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"ALTER TABLE {staged} RENAME TO {self.name}")

    def upserted(self, source: DataFrame) -> DataFrame:
        """The table with `source` upserted, not yet written: a plan with no exchange on the table's side, given that it
        has at least as many buckets as the session has shuffle partitions."""
        return upsert(self.read(), source, self.keys)
