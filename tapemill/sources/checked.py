"""Raw drops with nothing lost: a line is either accepted or rejected, with its file and a reason.

`raw` reads what it can and leaves the rest NULL. Here a line that is no record, or has a value that its column
cannot hold, keeps its text. All columns are parsed whichever are asked for, so what counts as rejected never
depends on the query.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill.sources.raw import present
from tapemill.specs import RAW_EVENTS

CORRUPT = "_corrupt"
FILE = "_file"
UNREADABLE = "unreadable"
FEWER, MORE = "fewer columns", "more columns"


@dataclass(frozen=True)
class Delivery:
    """Every line of a drop: the schema's columns, the text of a line that did not fit them, and its file.

    `empty` says that no file has arrived at all.
    """

    rows: DataFrame
    schema: T.StructType
    reason: Column
    empty: bool = False

    @property
    def is_rejected(self) -> Column:
        return F.col(CORRUPT).isNotNull()

    def accepted(self) -> DataFrame:
        return self.rows.where(~self.is_rejected).select(*self.schema.fieldNames())

    def rejected(self) -> DataFrame:
        """file, reason, line of each rejected line."""
        return self.rows.where(self.is_rejected).select(
            F.col(FILE).alias("file"), self.reason.alias("reason"), F.col(CORRUPT).alias("line")
        )


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _nothing(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], T.StructType([*_with_corrupt(schema).fields, T.StructField(FILE, T.StringType())]))


def _json_reason(schema: T.StructType) -> Column:
    """Columns whose value is there but not of the column's type, for a line that is JSON at all."""
    mistyped = [
        F.when(F.get_json_object(CORRUPT, f"$.{f.name}").isNotNull() & F.col(f.name).isNull(), F.lit(f.name))
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    names = F.array_join(F.array_compact(F.array(*mistyped)), ", ")
    readable = F.try_parse_json(CORRUPT).isNotNull() & (names != "")
    return F.when(readable, F.concat(F.lit("mistyped: "), names)).otherwise(UNREADABLE)


def _csv_reason() -> Column:
    return F.when(F.col(RAW_EVENTS.fieldNames()[-1]).isNull(), FEWER).otherwise(MORE)


def parsed_json_lines(lines: DataFrame, schema: T.StructType, file: Column) -> DataFrame:
    """Lines (column `value`, batch or stream) as the schema's columns, CORRUPT and FILE; blank lines are none."""
    record = F.from_json(
        "value", _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    # A generator's rows are made once. Of a plain column, a filter on CORRUPT would parse every line a second time.
    return lines.where(F.trim("value") != "").select(F.inline(F.array(record)), file.alias(FILE))


def json_lines(spark: SparkSession, schema: T.StructType, paths: Iterable[str]) -> Delivery:
    """JSON lines, compressed or not; folders and files that are not there yet hold no lines."""
    found = present(spark, paths)
    if not found:
        return Delivery(_nothing(spark, schema), schema, _json_reason(schema), True)
    rows = parsed_json_lines(spark.read.text(found), schema, F.col("_metadata.file_path"))
    return Delivery(rows, schema, _json_reason(schema))


def events_csv(spark: SparkSession, paths: Iterable[str]) -> Delivery:
    """CSV with a header, columns by position; a line with more or fewer columns is rejected."""
    found = present(spark, paths)
    if not found:
        return Delivery(_nothing(spark, RAW_EVENTS), RAW_EVENTS, _csv_reason(), True)
    reader = spark.read.schema(_with_corrupt(RAW_EVENTS)).option("header", True).option("columnPruning", False)
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(found)
    return Delivery(rows.select("*", F.col("_metadata.file_path").alias(FILE)), RAW_EVENTS, _csv_reason())
