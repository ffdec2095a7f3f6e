"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a nonzero vector of radius+1 bits, and every nonzero vector v of that length makes
one table: its mask holds the positions whose vector has odd overlap with v. Two fingerprints that differ in
at most `radius` positions agree under at least one mask, because `radius` vectors never span the whole
space: some v is orthogonal to all of them. So no pair within the radius is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill.llm.common import bound_batches, components, stored, stored_rows

BITS = 64
RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
# Up to this many fingerprints of a bucket are compared directly; larger buckets go by midpoints.
DIRECT = 64

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LANES = np.uint64(0x0101010101010101)
# Hashes counted at a time: a byte lane counts to 255.
_LANE_ROWS = 255
_BLOCK = 257 * _LANE_ROWS


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first."""
    padded = np.zeros(-(-len(hashes) // _LANE_ROWS) * _LANE_ROWS, np.uint64)
    padded[: len(hashes)] = hashes
    rows = padded.reshape(-1, _LANE_ROWS)
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):
        lanes = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(64)


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text: a bit is set if over half the shingles' hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(SHINGLE_WORDS, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, total, _BLOCK):
        to = min(total, at + _BLOCK)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())
        counts += _bit_counts(np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, to - at))
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask for each nonzero vector of radius+1 bits, as signed 64-bit numbers."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(bits) if (v & (1 + i % vectors)).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in column `print`; their closure is exact.

    All linked pairs differ in 1 or 2 bits, and any such pair is linked directly or through a common
    neighbour. Buckets of up to DIRECT members list their close pairs. In larger ones every member is also
    filed under itself with one unmasked bit flipped: members at distance 2 meet at a midpoint, at most
    65 meet at any, and each is linked to the smallest. So a bucket of any size costs in proportion to it.
    """
    masks = covering_masks()
    entries = prints.select(
        F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(m)) for m in masks])).alias("table", "key"), "print"
    )
    counts = stored(entries.groupBy("table", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
    shared = stored(entries.join(counts, ["table", "key"]), "bucketed")
    direct = (
        shared.where(F.col("members") <= DIRECT)
        .groupBy("table", "key")
        .agg(F.collect_list("print").alias("p"))
        .select(
            F.explode(
                F.expr(
                    "flatten(transform(p, x -> transform(filter(p, y -> y > x AND bit_count(x ^ y) <= 2),"
                    " y -> struct(x AS a, y AS b))))"
                )
            ).alias("link")
        )
        .select("link.a", "link.b")
    )
    free = F.array(*[F.lit(m) for m in masks])[F.col("table")]
    midpoints = (
        shared.where(F.col("members") > DIRECT)
        .select("table", "key", "print", free.alias("mask"))
        .select(
            "table",
            "key",
            "print",
            F.explode(
                F.expr(
                    "concat(array(print), transform(filter(sequence(0, 63), i -> shiftleft(1L, i) & mask = 0),"
                    " i -> print ^ shiftleft(1L, i)))"
                )
            ).alias("midpoint"),
        )
        .groupBy("table", "key", "midpoint")
        .agg(F.collect_set("print").alias("p"))
        .where("size(p) > 1")
        .select(F.array_min("p").alias("a"), F.explode("p").alias("b"))
        .where("a <> b")
    )
    return direct.union(midpoints).distinct()


def classes(rows: DataFrame) -> DataFrame:
    """Stored rows (print, doc_id, ...) to (print, component_id, first_mark) for prints with company.

    Documents with equal fingerprints are one node, counted before the shuffle. component_id is the smallest
    doc_id reachable (NULL only if none has one), first_mark the mark of the one document that stands for it.
    Prints of a single document without near neighbours are left out: they are their own class.
    """
    nodes = stored(
        rows.groupBy("print").agg(
            F.min("doc_id").alias("low"), F.min_by("mark", "doc_id").alias("low_mark"),
            F.min("mark").alias("any_mark"), F.count(F.lit(1)).alias("members"),
        ),
        "prints",
    )
    roots = components(near_links(nodes.select("print")))
    rooted = stored(nodes.join(roots, nodes["print"] == roots["node"], "left").drop("node"), "rooted")
    linked = rooted.where("root IS NOT NULL")
    heads = stored(
        linked.groupBy("root").agg(
            F.min("low").alias("component_id"),
            F.coalesce(F.min_by("low_mark", "low"), F.min("any_mark")).alias("first_mark"),
        ),
        "components",
    )
    alone = rooted.where("root IS NULL AND members > 1").select(
        "print", F.col("low").alias("component_id"), F.coalesce("low_mark", "any_mark").alias("first_mark")
    )
    return stored(linked.join(heads, "root").select("print", "component_id", "first_mark").union(alone), "classes")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document; NULL text is empty."""
    bound_batches(docs.sparkSession)
    rows = stored(
        docs.select(
            "doc_id", fingerprint_of(docs["text"].cast("string")).alias("print"), F.monotonically_increasing_id().alias("mark")
        ),
        "fingerprints",
    )
    grouped = rows.join(classes(rows), "print", "left")
    own = F.when(F.col("first_mark").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return grouped.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), own.alias("component_id")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id; columns as they came.

    Of rows that share that doc_id exactly one stays; documents without words are one group.
    """
    rows = stored_rows(docs, {"doc_id": docs["doc_id"], "print": fingerprint_of(docs["text"].cast("string"))}, "fingerprints")
    slim = rows.select("mark", "doc_id", "print")
    dropped = stored(slim.join(classes(slim), "print").where("mark <> first_mark").select("mark"), "copies")
    return rows.join(dropped, "mark", "left_anti").select("row.*")
