"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

A text whose length no other text has is unique, and so is one whose prefix hash nobody of its length
has; only the rest is hashed in full. Which lengths and prefixes are shared comes from counts over all
rows. They travel as a bitmap of fixed size, so texts are never shuffled: a bit set by chance costs a
full hash that was not needed and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import stored, text_of

PREFIX_CHARS = 64
# 2^24 bits are at most 2^18 rows (about 4 MiB) of the broadcast bitmap, whatever the input.
BITMAP_BITS = 1 << 24


def shared_keys(keys: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """Bitmap rows (word, mask) of the values of column `key` that several rows have."""
    slot = F.pmod(F.xxhash64("key"), F.lit(bits))
    shared = keys.where("key IS NOT NULL").groupBy("key").count().where("count > 1")
    return shared.groupBy(F.floor(slot / 64).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(key), {bits}) % 64 AS INT))")).alias("mask")
    )


def mark_shared(rows: DataFrame, key: Column, bitmap: DataFrame, name: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Add a boolean: may several rows have this key? Never false for a shared one."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    keyed = rows.withColumns({"_word": F.floor(slot / 64), "_bit": (slot % 64).cast("int")})
    looked_up = keyed.join(F.broadcast(bitmap.select(F.col("word").alias("_word"), "mask")), "_word", "left")
    hit = F.coalesce(F.expr("getbit(mask, _bit)") == 1, F.lit(False))
    return looked_up.withColumn(name, hit & key.isNotNull()).drop("_word", "_bit", "mask")


def refine(docs: DataFrame, kept_columns: list[str], digest: bool) -> DataFrame:
    """Every row as stored (row, mark, doc_id, size, full_hash); the hash is NULL where a text is surely unique.

    `row` holds the named columns only; with `digest`, column `digest` has the hash of unique texts too.
    """
    base = docs.select(F.struct(*kept_columns).alias("row"), F.col("doc_id"), text_of(docs).alias("body"))
    size = F.octet_length("body").cast("long")
    lengths = stored(shared_keys(base.select(size.alias("key"))), "lengths")
    by_length = mark_shared(base, size, lengths, "crowded")
    prefix = F.when(F.col("crowded"), F.xxhash64(size, F.substring("body", 1, PREFIX_CHARS)))
    prefixes = stored(shared_keys(by_length.select(prefix.alias("key"))), "prefixes")
    by_prefix = mark_shared(by_length.withColumn("prefix", prefix), F.col("prefix"), prefixes, "suspect")
    return stored(
        by_prefix.select(
            "row",
            "doc_id",
            F.monotonically_increasing_id().alias("mark"),
            size.alias("size"),
            F.when(F.col("suspect"), F.sha2(F.col("body"), 256)).alias("full_hash"),
            *([F.sha2(F.col("body"), 256).alias("digest")] if digest else []),
        ),
        "refined",
    )


def dedup(docs: DataFrame, kept_columns: list[str] | None = None, digest: bool = False) -> DataFrame:
    """Add keep_id, group_size and kept to every row (columns `row` with the input's, `mark` and these).

    Equal texts form a group; NULL equals the empty text. The row with the largest doc_id stays
    (NULL ids are lowest), and of rows that agree in it too exactly one. keep_id is that doc_id.
    """
    rows = refine(docs, kept_columns or ["*"], digest)
    suspects = rows.where("full_hash IS NOT NULL")
    counted = suspects.groupBy("full_hash", "size").agg(
        F.count(F.lit(1)).alias("members"), F.max("doc_id").alias("top_id")
    )
    # Of rows with the largest id (all, where every id is NULL) the first by mark stays.
    groups = stored(counted.where("members > 1"), "groups")
    tops = suspects.join(groups, ["full_hash", "size"]).where("doc_id <=> top_id")
    chosen = tops.groupBy("full_hash", "size").agg(
        F.first("members").alias("members"), F.first("top_id").alias("top_id"), F.min("mark").alias("kept_mark")
    )
    chosen = stored(chosen, "chosen")
    joined = rows.join(chosen, ["full_hash", "size"], "left")
    alone = F.col("kept_mark").isNull()
    return joined.select(
        "row",
        "mark",
        *(["digest"] if digest else []),
        F.when(alone, F.col("doc_id")).otherwise(F.col("top_id")).alias("keep_id"),
        F.coalesce("members", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("mark") == F.col("kept_mark"))).alias("kept"),
    )


def unique_documents(docs: DataFrame) -> DataFrame:
    """One document of each group, with the columns of the input."""
    return dedup(docs).where("kept").select("row.*")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    return dedup(docs, ["doc_id"], digest=True).select(
        F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )
