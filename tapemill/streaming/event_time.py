"""Event-time operators on streams: minute bars that close behind a watermark, deduplication with bounded state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapemill.functions.ticks import minute
from tapemill.operators.bars import BAR_KEY, bar_columns, bar_states
from tapemill.streaming.feeds import STATE_CONF, run_available

OBSERVED = "ticks_in"


def minute_bars(ticks: DataFrame, delay: str) -> DataFrame:
    """Minute bars of a stream of typed trades, each given out once: when the watermark has passed its end.

    A trade that arrives after its minute has closed changes nothing; `late_trades` counts those.
    """
    timed = ticks.where(F.col("exchange_ts").isNotNull()).observe(OBSERVED, F.count("*").alias("n"))
    timed = timed.withColumn("bar_start", minute("exchange_ts")).withWatermark("exchange_ts", delay)
    keyed = timed.groupBy(F.window("exchange_ts", "1 minute").alias("w"), "exchange", "symbol").agg(*bar_states())
    return keyed.withColumn("bar_start", F.col("w.start")).select(*BAR_KEY, *bar_columns())


def deduplicated(rows: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """The first delivery of each key to arrive; a key is forgotten once the watermark passes its instant by `delay`."""
    return rows.withWatermark("exchange_ts", delay).dropDuplicatesWithinWatermark(list(keys))


@dataclass(frozen=True)
class Closed:
    """What a stream of bars has given out so far, and what became of the trades it read."""

    read: int
    in_bars: int
    open: int

    @property
    def late(self) -> int:
        return self.read - self.in_bars - self.open


class BarStream:
    """Minute bars of a folder of typed trades, advanced by `advance` whenever files have arrived.

    The checkpoint holds watermark, open bars and the files taken in; a new object over the same folders goes on
    where the last one ended.
    """

    def __init__(self, spark: SparkSession, trades: DataFrame, sink: str, checkpoint: str, delay: str):
        self.spark, self.sink, self.checkpoint = spark, sink, checkpoint
        self.bars = minute_bars(trades, delay)
        self.read = 0
        for key, value in STATE_CONF.items():
            spark.conf.set(key, value)

    def advance(self) -> StreamingQuery:
        query = run_available(self.bars.writeStream.format("parquet").option("path", self.sink).outputMode("append"), self.checkpoint)
        self.read += sum(p.observedMetrics[OBSERVED]["n"] for p in query.recentProgress if OBSERVED in p.observedMetrics)
        return query

    def closed_bars(self) -> DataFrame:
        return self.spark.read.schema(self.bars.schema).parquet(self.sink)

    def closed(self) -> Closed:
        """Counts of trades read by this object, in closed bars and in bars still open in the state store."""
        # The count of trades is the last of the aggregates that an open bar holds.
        state = self.spark.read.format("statestore").load(self.checkpoint).select("value.*")
        is_open = state.agg(F.sum(state.columns[-1])).first()[0]
        in_bars = self.closed_bars().agg(F.sum("n_trades")).first()[0]
        return Closed(self.read, in_bars or 0, is_open or 0)
