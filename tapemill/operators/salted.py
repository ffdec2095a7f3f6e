"""Enrichment by merge join without hot keys: heavy symbol-days are dealt over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.operators.joins import sized

# Rows of one symbol-day that a task takes; heavier days get as many salts as it takes to stay below.
ROWS_PER_SALT = 4_000_000


def hot_days(trades: DataFrame, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """_ev_symbol, _ev_date, salts of symbol-days with more rows than one task should take.

    Counts are combined before the shuffle. There are at most as many of these as rows over `rows_per_salt`.
    """
    counts = trades.groupBy(F.col("symbol").alias("_ev_symbol"), F.col("trade_date").alias("_ev_date")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > rows_per_salt).select(
        "_ev_symbol", "_ev_date", F.ceil(F.col("n") / rows_per_salt).cast("int").alias("salts")
    )


def enrich_salted(trades: DataFrame, first_events: DataFrame, hot: DataFrame, spread_by: list[str]) -> DataFrame:
    """Left join on symbol and day by merge join; rows of a hot day are spread by a hash of `spread_by`.

    `hot` comes from `hot_days` and is broadcast: its size is bounded by its least count. The calendar's row of a hot
    day is repeated once per salt, all others once.
    """
    hot = F.broadcast(hot)
    calendar = first_events.select(
        F.col("symbol").alias("_ev_symbol"), F.col("event_date").alias("_ev_date"), "event_id", "event_type"
    )
    numbered = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))
    copies = calendar.join(hot, ["_ev_symbol", "_ev_date"], "left").withColumn("_salt", numbered).drop("salts")
    same = (F.col("symbol") == F.col("_ev_symbol")) & (F.col("trade_date") == F.col("_ev_date"))
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col("salts"), F.lit(1))).cast("int")
    dealt = trades.join(hot, same, "left").withColumn("_dealt", salt).drop("_ev_symbol", "_ev_date", "salts")
    joined = dealt.join(sized(copies, False), same & (F.col("_dealt") == F.col("_salt")), "left")
    return joined.drop("_ev_symbol", "_ev_date", "_salt", "_dealt")
