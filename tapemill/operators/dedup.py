"""One row per key, chosen by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapemill.functions.keys import all_present, any_missing, numbers_first

# Later columns only break ties, so that a re-run picks the same row.
TRADE_ORDER = ("_ingest_ts", "trade_id", "price", "size", "side")
QUOTE_ORDER = ("_ingest_ts", "bid", "ask", "bid_size", "ask_size")

# Whether a row has no NULL in its key. A constant in either part of a union: a filter on it leaves one part alone, which
# keeps its partitioning, where the planner cannot tell that "key present" and "key missing" exclude each other.
WHOLE_KEY = "_whole_key"


def event_order() -> list[Column]:
    return [F.col("_ingest_ts").desc(), F.col("event_start"), F.col("event_type"),
            F.col("symbol"), F.col("event_end"), F.col("description")]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key; NULL keys form groups of their own.

    The rank filter lets Spark cut every group to one row before the shuffle as well
    (`WindowGroupLimit`), so a hot key costs one row per map task, not one huge task.
    """
    ranked = F.row_number().over(Window.partitionBy(*numbers_first(df, keys)).orderBy(*order))
    return df.withColumn("_rn", ranked).where(F.col("_rn") == 1).drop("_rn")


def one_per_merge_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], marked: bool = False
) -> DataFrame:
    """Like `keep_first`, but rows with a NULL in the key all stay, since no merge matches them.

    They stay where they are; the others are partitioned by the key alone, as a join on it wants them. `marked` adds
    WHOLE_KEY, by which `upsert` tells the two parts without losing that.
    """
    whole, others = keep_first(df.where(all_present(keys)), keys, order), df.where(any_missing(keys))
    if marked:
        whole, others = (part.withColumn(WHOLE_KEY, F.lit(n == 0)) for n, part in enumerate((whole, others)))
    return whole.unionByName(others)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Like `one_per_merge_key` in one pass over the input, for sources that are dear to read.

    A row with a NULL in the key is a group of its own, so such rows meet in no task.
    """
    alone = F.when(any_missing(keys), F.monotonically_increasing_id())
    marked = df.withColumn("_alone", alone)
    return keep_first(marked, ["_alone", *keys], order).drop("_alone")


def first_event_per_symbol_day(events: DataFrame) -> DataFrame:
    """Earliest event of each symbol and day, so that enrichment never multiplies trades."""
    return keep_first(events, ["symbol", "event_date"], ["event_start", "event_id"])


def dedup_report(before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in, rows kept and rows dropped by a dedup on `keys`, from one aggregate per key."""
    per_key = before.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.count("*").alias("rows_kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_dropped"),
    )
