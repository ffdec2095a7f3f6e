"""Session settings that every job and query relies on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# UTC decides what a day is; the rest are the adaptive features the plans count on. Rebalanced writes
# aim at 256 MiB of shuffle per file, roughly 128 MiB of Parquet.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A table's partitions are listed by this many tasks; Spark's own setting makes a task of every folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

# Ticks are sorted and aggregated by wide keys, where rows take about ten times their compressed size: a task
# of theirs reads at most 32 MiB of shuffle or of files, however large the input.
TICK_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
# Parquet bytes of ticks whose rows make one shuffle partition of that size.
TICK_BYTES = 8 * MIB

# Deletes an execution's shuffle files when it ends.
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key in TICK_CONF.keys() - RUNTIME_CONF.keys():
        if (own := spark.conf.get(_own(key), None)) is not None:
            spark.conf.set(key, own)
    return spark


def configure_ticks(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Apply the runtime settings with those of tick tables, for an input of this many Parquet bytes; `configure`
    puts the session's own back."""
    configure(spark)
    for key, value in TICK_CONF.items():
        if key not in RUNTIME_CONF and spark.conf.get(_own(key), None) is None:
            spark.conf.set(_own(key), spark.conf.get(key))
        spark.conf.set(key, value)
    size_shuffles(spark, input_bytes, TICK_BYTES)
    return spark


def _own(key: str) -> str:
    return key.replace("spark.", "spark.tapemill.own.", 1)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each write and count when it ends; Spark alone keeps them until the driver happens to
    collect its garbage, and a run of many steps piles them up. Streams started meanwhile do so too.

    A frame that is executed again would shuffle again, so results given to a caller are not to be executed in here.
    """
    before = spark.conf.get(RELEASE_SHUFFLES, None)
    spark.conf.set(RELEASE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE_SHUFFLES) if before is None else spark.conf.set(RELEASE_SHUFFLES, before)


def build(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Start a session. Sizing (executors, memory, shuffle partitions) belongs to the submitter."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int, per_partition: int = 32 * MIB) -> None:
    """Set the initial number of shuffle partitions to suit an input of this many Parquet bytes.

    Rows take about four times their Parquet size in a shuffle, so `per_partition` of 32 MiB makes partitions of
    128 MiB. Adaptive execution merges what turns out small; it cannot split what was planned
    too coarse. Never goes below the session's own setting, and back to it for small inputs. There is no upper limit: at a petabyte raise
    `spark.sql.files.maxPartitionBytes` too, so that maps times reducers stays bearable.
    """
    wanted = -(-input_bytes // per_partition)
    initial, own = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.tapemill.ownPartitionNum"
    # The session's own number is noted at the first call, so that one large input does not size later ones.
    if spark.conf.get(own, None) is None:
        spark.conf.set(own, spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(initial, str(max(wanted, int(spark.conf.get(own)))))


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts from. A join moves a bucketed side with fewer buckets."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables that a query writes and reads back, deleted when the session's JVM ends.

    It lies in the shared folder named by `spark.checkpoint.dir`, or where the session names none, in a
    folder of its warehouse, which executors share as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4()}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path
