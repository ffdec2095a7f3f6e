"""Shards from a weighted hash tree: draws at region, rack and shard level decide by the key alone.

At each level every child draws -ln(u) / weight, u being a hash of the key and the child's path, and the
smallest draw wins; a child's weight is the sum of its shards' weights. A draw depends on nothing but
key, path and weight, so a weight that rises moves keys only into that child, and one that falls only out
of it: movement is confined to the subtrees whose weights change. A new shard that is a region of its own
therefore takes keys only into itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapemill.llm.common import shuffles_sized_for, stored, text_of

# region -> rack -> shard number -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

EIGHT: Tree = {
    "east": {"e1": {0: 1.0, 1: 1.0}, "e2": {2: 1.0, 3: 1.0}},
    "west": {"w1": {4: 1.0, 5: 1.0}, "w2": {6: 1.0, 7: 1.0}},
}
ROWS_PER_SLOT_BUCKET = 100_000


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    new = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"region-{new}": {f"rack-{new}": {new: weight}}}


def _total(node) -> float:
    return sum(map(_total, node.values())) if isinstance(node, Mapping) else float(node)


def _draw(key: Column, path: str, weight: float) -> Column:
    """A weighted draw; the smallest of several wins each with probability in proportion to its weight."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(weight)


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key. A NULL key is a key like any other; nodes without weight take nothing."""

    def descend(node, path: str) -> Column:
        children = sorted((name, child) for name, child in node.items() if _total(child) > 0)
        if not children:
            raise ValueError(f"no weight below {path or 'the root'}")
        below = [
            descend(child, f"{path}/{name}") if isinstance(child, Mapping) else F.lit(int(name)).cast("int")
            for name, child in children
        ]
        if len(children) == 1:
            return below[0]
        draws = [_draw(key, f"{path}/{name}", _total(child)) for name, child in children]
        best = F.least(*draws)
        return reduce(lambda rest, i: F.when(draws[i] == best, below[i]).otherwise(rest), reversed(range(len(children) - 1)), below[-1])

    return descend(tree, "")


def assign(docs: DataFrame, tree: Tree = EIGHT, kept_columns: list[str] | None = None) -> DataFrame:
    """Every row (as `row`) with size, text_crc32, law, shard, slot and grown_shard.

    size is the text's UTF-8 bytes plus one; a NULL text has none. Slots number a shard's rows from 0
    without gaps: rows are dealt to buckets by a hash, counted per bucket, and numbered within each, so no
    task holds a whole shard. Repeated rows each get a slot; an empty input gives an empty result.
    """
    text = text_of(docs)
    key = docs["doc_id"]
    rows = stored(
        docs.select(
            F.struct(*(kept_columns or ["*"])).alias("row"),
            F.monotonically_increasing_id().alias("mark"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            shard_of(key, tree).alias("shard"),
            shard_of(key, grown(tree)).alias("grown_shard"),
        ),
        "sharded",
    )
    buckets = max(1, rows.count() // ROWS_PER_SLOT_BUCKET)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("mark"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    starts = stored(starts, "slots")
    within = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("mark"))
    return (
        rows.withColumn("within", within)
        .join(starts, ["shard", "bucket"])
        .select(
            "row",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("within") - 1).cast("long").alias("slot"),
            "grown_shard",
        )
    )


def write_shards(docs: DataFrame, path: str, tree: Tree = EIGHT) -> DataFrame:
    """Write whole documents as Parquet, one folder per shard; returns the manifest, read from what was written.

    Files hold the documents' columns with size, text_crc32 and grown_shard (of clashing names these win), the folder
    tells the shard. Texts move once, dealt by shard, where a hot shard is split over several files. A row's slot is its
    place in its shard, files in order of their names, so nothing is sorted and no text is read again. NULL and
    repeated doc_ids are rows like any others; an empty input writes no folder and gives an empty manifest.
    """
    text, key = text_of(docs), docs["doc_id"]
    kept = [docs[c] for c in docs.columns if c.lower() not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    placed = docs.select(
        *kept,
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, grown(tree)).alias("grown_shard"),
        shard_of(key, tree).alias("shard"),
    )
    with shuffles_sized_for(docs):
        placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return written_manifest(docs.sparkSession, path, docs.schema["doc_id"].dataType.simpleString())


def written_manifest(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row that write_shards wrote to a folder."""
    schema = f"doc_id {id_type}, size bigint, text_crc32 bigint, grown_shard int, shard int"
    rows = spark.read.schema(schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
    )
    files = rows.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("rows"))
    before = W.partitionBy("shard").orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    starts = files.select(F.col("file").alias("of"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, F.col("file") == F.col("of")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("place")).alias("slot"), "grown_shard"
    )


def sharded(docs: DataFrame, tree: Tree = EIGHT) -> DataFrame:
    """The documents with size, text_crc32, law, shard, slot, grown_shard; of clashing names these win."""
    made = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    names = [c for c in docs.columns if c.lower() not in made]
    return assign(docs, tree).select(*[F.col("row")[c].alias(c) for c in names], *made)


def shard_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    return assign(docs, EIGHT, ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
