"""A keyed table: Parquet folders written by Spark and one small file that says which folder holds each partition.

    <root>/data/version=<v>/<partition dirs>/*.parquet   written once, never changed
    <root>/current.json                                  which version holds each partition
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill.specs import TableSpec
from tapemill.storage.files import Files

# Directory value that stands for NULL in a partition column.
NULL_DIR = "__HIVE_DEFAULT_PARTITION__"

# Values of a partition's columns as text, None for NULL.
Values = tuple[str | None, ...]


@dataclass(frozen=True)
class Pointer:
    """Which version folder holds each partition of the table."""

    version: str
    partitions: dict[str, str] = field(default_factory=dict)


def partition_values(partition: str) -> dict[str, str | None]:
    """Column values of a partition folder such as `trade_date=2024-01-15/exchange=NYSE`."""
    pairs = (part.split("=", 1) for part in partition.split("/"))
    return {name: None if value == NULL_DIR else unquote(value) for name, value in pairs}


def on_days(column: str, days: Iterable[date]) -> Callable[[dict], bool]:
    """Partition filter: the day column has one of these values."""
    wanted = {day.isoformat() for day in days}
    return lambda values: values[column] in wanted


class Table:
    def __init__(self, spark: SparkSession, warehouse: str, spec: TableSpec):
        self.spark, self.spec = spark, spec
        self.root = f"{warehouse.rstrip('/')}/{spec.name.replace('.', '/')}"
        self.files = Files(spark, self.root)

    def create_if_absent(self) -> bool:
        """Record the definition; the table has no rows until the first publish."""
        path = f"{self.root}/table.json"
        if self.files.exists(path):
            return False
        spec = self.spec
        self.files.write_json(
            path,
            {"name": spec.name, "schema": spec.schema.jsonValue(), "keys": spec.keys,
             "partition_by": spec.partition_by, "day_of": spec.day_of, "not_null": spec.not_null},
        )
        return True

    def pointer(self) -> Pointer | None:
        """The published version, or None if nothing has been published."""
        content = self.files.read_json(f"{self.root}/current.json")
        return Pointer(**content) if content else None

    def set_pointer(self, pointer: Pointer) -> None:
        """One rename: readers see the old version or the new one."""
        self.files.write_json(f"{self.root}/current.json", asdict(pointer))

    def version_path(self, version: str) -> str:
        return f"{self.root}/data/version={version}"

    def partition_folders(self, version: str) -> list[str]:
        """Names of the partition folders of a version, by listing folders only."""
        found = [""]
        for _ in self.spec.partition_by:
            found = [
                f"{name}/{folder}".lstrip("/")
                for name in found
                for folder in self.files.folder_names(f"{self.version_path(version)}/{name}".rstrip("/"))
                if "=" in folder
            ]
        return found

    def values_in(self, rows: DataFrame) -> set[Values]:
        """Partition values that occur in rows, in the form of `partition_values`."""
        return set(self.rows_by_values(rows))

    def rows_by_values(self, rows: DataFrame) -> dict[Values, int]:
        """How many rows each partition of them has."""
        by, counts = self.spec.partition_by, Counter()
        counted = self.with_partition_columns(rows).groupBy(*by).agg(F.count("*").alias("_n"))
        for *values, n in counted.select(*[F.col(c).cast("string") for c in by], "_n").collect():
            # A folder name cannot tell an empty text from NULL.
            counts[tuple(value or None for value in values)] += n
        return dict(counts)

    def rows_in(self, rows: DataFrame, values: Iterable[Values]) -> DataFrame:
        """The rows of some partitions, chosen by their values."""
        by, schema = self.spec.partition_by, self.spec.stored_schema
        # A literal, for which no Python worker has to start.
        listed = F.lit(json.dumps([dict(zip(by, v)) for v in values]))
        texts = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in by]))
        wanted = self.spark.range(1).select(F.inline(F.from_json(listed, texts)))
        wanted = wanted.select(*[F.col(c).cast(schema[c].dataType).alias(f"_{c}") for c in by])
        columns = {c: F.nullif(c, F.lit("")) if isinstance(schema[c].dataType, T.StringType) else F.col(c) for c in by}
        same = [columns[c].eqNullSafe(F.col(f"_{c}")) for c in by]
        return self.with_partition_columns(rows).join(F.broadcast(wanted), same, "left_semi").select(*rows.columns)

    def partitions(self, only: Callable[[dict], bool] | None = None) -> dict[str, str]:
        """Published partitions, chosen by their values before any file is listed."""
        pointer = self.pointer()
        found = pointer.partitions if pointer else {}
        return {p: v for p, v in found.items() if only is None or only(partition_values(p))}

    def read(self, only: Callable[[dict], bool] | None = None) -> DataFrame:
        return self.read_partitions(self.partitions(only))

    def paths(self, partitions: dict[str, str]) -> list[str]:
        return [f"{self.version_path(version)}/{partition}" for partition, version in partitions.items()]

    def read_partitions(self, partitions: dict[str, str]) -> DataFrame:
        if not partitions:
            return self.spark.createDataFrame([], self.spec.schema)
        reader = self.spark.read.schema(self.spec.stored_schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*self.paths(partitions)).select(*self.spec.columns)

    def bytes_of(self, partitions: dict[str, str]) -> int:
        """Size of the Parquet files of some partitions."""
        return sum(e.size for path in self.paths(partitions) for e in self.files.listing(path))

    def with_partition_columns(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({day: F.to_date(ts) for day, ts in self.spec.day_of.items()})

    def write_version(self, rows: DataFrame, version: str) -> dict[str, str]:
        """Write rows as a new version, or add partitions to one that no reader sees yet; returns its partitions.

        The rebalance splits a large partition over many tasks and packs small ones together.
        Sorting by partition and key replaces the sort a partitioned write needs anyway, and
        gives row groups narrow key ranges.
        """
        by, keys = self.spec.partition_by, self.spec.keys
        order = [*by, *(k for k in keys if k not in by)]
        (
            self.with_partition_columns(rows.select(*self.spec.columns))
            .hint("rebalance", *by)
            .sortWithinPartitions(*order)
            .write.mode("append")
            .partitionBy(*by)
            .option("compression", "zstd")
            .parquet(self.version_path(version))
        )
        return dict.fromkeys(self.partition_folders(version), version)

    def write_rows(self, rows: DataFrame, version: str) -> DataFrame:
        """Write rows as they come, without partition folders, and read them back."""
        path = self.version_path(version)
        rows.select(*self.spec.columns).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(self.spec.schema).parquet(path)
