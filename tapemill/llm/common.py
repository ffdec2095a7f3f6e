"""What the document operators share: stored tables, text bytes, row marks and connected components.

Rows travel as one struct column `row`, so that columns of the input never clash with columns of an
operator. A row's `mark` is given when the rows are written to the shared folder and is stable from
then on; it tells rows apart that agree in every column, whatever their doc_id is.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapemill.session import MIB, configure, scratch_dir

# Folders of the tables stored since the innermost `noting_stored` began; None outside of one.
_NOTED: ContextVar[list[str] | None] = ContextVar("stored folders", default=None)

# A Python task holds one Arrow batch of whole texts at a time.
ARROW_ROWS = 256
ARROW_BYTES = "8m"

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
# Bytes of UTF-8 text with A-Z lower-cased and every other ASCII character but a-z and 0-9 as a space.
WORD_BYTES = bytes.maketrans(
    bytes(range(65, 91)) + _SEPARATORS, bytes(range(97, 123)) + b" " * len(_SEPARATORS)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and bytes: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a frame reads, as Spark knows them; rows from elsewhere have no known size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)


@contextmanager
def shuffles_sized_for(df: DataFrame) -> Iterator[None]:
    """Shuffles planned inside the block start with a partition per 32 MiB that the frame reads, if that is more than
    the session's own number; adaptive execution merges what turns out small. The setting is put back afterwards."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = conf.get(name, None)
    wanted = -(-input_bytes(df) // (32 * MIB))
    if wanted <= int(before or conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    conf.set(name, str(wanted))
    try:
        yield
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here, and the size is known."""
    path = scratch_dir(df.sparkSession, purpose)
    if (noted := _NOTED.get()) is not None:
        noted.append(path)
    with shuffles_sized_for(df):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def noting_stored() -> Iterator[list[str]]:
    """The folders that `stored` writes inside the block, for `drop_stored` once nobody reads them any more."""
    token = _NOTED.set([])
    try:
        yield _NOTED.get()
    finally:
        _NOTED.reset(token)


def drop_stored(spark: SparkSession, folders: list[str]) -> None:
    """Delete stored tables. A folder that is gone already is no fault."""
    for path in folders:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stored_rows(docs: DataFrame, columns: dict[str, Column], purpose: str) -> DataFrame:
    """Store every row as `row`, with a unique `mark` and the given columns."""
    bound_batches(docs.sparkSession)
    return stored(
        docs.select(
            F.struct("*").alias("row"),
            F.monotonically_increasing_id().alias("mark"),
            *[c.alias(name) for name, c in columns.items()],
        ),
        purpose,
    )


def text_of(docs: DataFrame) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def labelled_sample(docs: DataFrame, known: DataFrame, label: str, rows: int, chars: int) -> DataFrame:
    """At most `rows` (text, label) of known (doc_id, label), texts of at most `chars` characters, in one partition.

    Labels of lowest hash go first; three times as many as rows are asked for are looked up, which bounds
    what is broadcast, because some are of long, NULL or unknown texts. The order is the same for any layout.
    """
    lowest = known.orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(3 * rows)
    texts = docs.where(f"text IS NOT NULL AND length(text) <= {chars}").select("doc_id", "text")
    order = [F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), label]
    return texts.join(F.broadcast(lowest), "doc_id").orderBy(*order).limit(rows).select("text", label)


def fitted(sample: DataFrame, fit: Callable[[list[str], list], Any]) -> Any:
    """What `fit` makes of the texts and labels of a labelled sample, in its order.

    The sample's one task does the work and is done again if its executor is lost; only the model reaches the driver.
    """
    bound_batches(sample.sparkSession)
    text, label = sample.columns

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, labels = [], []
        for batch in batches:
            texts.extend(batch[text])
            labels.extend(batch[label])
        yield pd.DataFrame({"model": [pickle.dumps(fit(texts, labels))]})

    models = sample.mapInPandas(work, "model binary").collect()
    return pickle.loads(bytes(models[0]["model"])) if models else fit([], [])


def crc_mod(column: Column, divisor: int) -> Column:
    """crc32 of an id written as text, modulo a number; NULL counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b), as (node, root) for every linked node.

    Each round points every node to its neighbour that is lowest in the round's random order, or to
    itself, and renames links by these pointers. A fixed share of the nodes vanishes in each round,
    so the rounds grow with the logarithm of the largest component. All sums are combined before
    the shuffle, so a node with very many links costs one row per task.
    """
    links = stored(
        links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(), "links"
    )
    members = None
    turn = 0
    while not links.isEmpty():
        lowest = links.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(turn))).alias("b"))
        pointers = stored(
            lowest.select(
                "a",
                F.when(F.xxhash64("b", F.lit(turn)) < F.xxhash64("a", F.lit(turn)), F.col("b"))
                .otherwise(F.col("a"))
                .alias("to"),
            ),
            "pointers",
        )
        if members is None:
            members = pointers.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            renamed = members.join(pointers, members["root"] == pointers["a"], "left")
            members = stored(renamed.select("node", F.coalesce("to", "root").alias("root")), "members")
        to_a = pointers.select("a", F.col("to").alias("to_a"))
        to_b = pointers.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        links = stored(
            links.join(to_a, "a")
            .join(to_b, "b")
            .where("to_a <> to_b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
            .distinct(),
            "links",
        )
        turn += 1
    if members is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members
