"""Hard negatives for labelled vectors, scored by the method of the Four Russians.

Components become integers. For every eight dimensions of an anchor a table holds the sums over all 256 subsets of
its components; a candidate keeps, for each bit of its integers, one byte per eight dimensions. A byte looks up the
part of the inner product that this bit adds, and shifting and adding over the bits gives the whole, exact score.
Anchors go in blocks of bounded size, each against all rows; a task hands on only the best rows of each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapemill.llm.common import stored
from tapemill.session import scratch_dir

UNITS = 256
ANCHORS_EVERY, RELABELLED_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, OF = 30, 90, 100
# Vectors with a component beyond this take no part, like those that are not finite: no score leaves 64 bits.
LARGEST = 65_536
# Anchors of a block: their tables take at most this many bytes of a task, and a block is one broadcast.
TABLE_BYTES = 16 << 20
MOST_ANCHORS = 1024
# Pairs that a task scores, and candidates that it scores at a time.
PAIRS_PER_TASK = 1 << 23
ROWS_AT_A_TIME = 512
# Stands for a NULL vec_id, which comes last among ties.
NO_ID = (1 << 63) - 1


@dataclass
class Anchors:
    """A block of anchors: integers (rows x dimensions), labels, marks; bands of scores of their negatives, by slot."""

    units: np.ndarray
    labels: np.ndarray
    marks: np.ndarray
    bits: int
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def tables(self) -> np.ndarray:
        """(groups of eight dimensions, 256 subsets, anchors): the subset's sum of the anchor's components."""
        rows, dims = self.units.shape
        groups = self.units.reshape(rows, dims // 8, 8)
        subsets = (np.arange(256)[:, None] >> np.arange(8)) & 1
        # Sums of the whole score must fit too.
        small = dims * (1 << 2 * (self.bits - 1)) < 1 << 31
        return np.einsum("sk,agk->gsa", subsets, groups).astype(np.int32 if small else np.int64)


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of candidates, given as (rows, bits, groups) bytes from the sign bit down, with the anchors."""
    rows, bits, groups = planes.shape
    total = np.zeros((rows, tables.shape[2]), tables.dtype)
    part = np.empty_like(total)
    for bit in range(bits):
        total <<= 1
        for group in range(groups):
            np.take(tables[group], planes[:, bit, group], axis=0, out=part, mode="clip")
            total += part
        if bit == 0:
            # The highest bit of two's complement counts negatively.
            np.negative(total, out=total)
    return total


def pack(units: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes (rows, bits, dimensions / 8) of integers, the sign bit first."""
    planes = (units[:, None, :] >> np.arange(bits - 1, -1, -1)[:, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")


def unpack(planes: np.ndarray) -> np.ndarray:
    bits = planes.shape[1]
    values = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(bits - 1, -1, -1)
    weights[0] = -weights[0]
    return (values * weights[:, None]).sum(axis=1)


class _Best:
    """The first `k` rows of each key by score, then id, then mark."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.floor = np.full(keys, np.iinfo(np.int64).min)
        self.rows = tuple(np.zeros(0, np.int64) for _ in range(4))

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
        key, score, id_, mark = (np.concatenate(pair) for pair in zip(self.rows, (keys, scores, ids, marks)))
        order = np.lexsort((mark, id_, -score, key))
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        nth = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        kept = order[nth < self.k]
        full = nth == self.k - 1
        self.rows = tuple(column[kept] for column in (np.concatenate((self.rows[0], keys)), score, id_, mark))
        self.floor[key[full]] = score[order[full]]


def _topmost(values: np.ndarray, able: np.ndarray, k: int) -> np.ndarray:
    """`able` without rows that cannot be among the first `k` of their column."""
    if len(values) <= k or able.sum() <= 4 * k * values.shape[1]:
        return able
    least = np.iinfo(values.dtype).min
    reached = np.partition(np.where(able, values, least), len(values) - k, axis=0)[len(values) - k]
    return able & (values >= reached)


def vectors(embeddings: DataFrame) -> tuple[DataFrame, int, int]:
    """Stored rows that take part (mark, id, label, planes), the dimensions padded to eights, the bits of an integer.

    Missing dimensions of shorter vectors count as zero.
    """
    values = F.transform("embedding", lambda x: x.cast("double"))
    fit = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < LARGEST))
    units = F.transform(values, lambda x: F.floor(x * UNITS).cast("int"))
    label = F.col("label").cast("long")
    rows = embeddings.where(label.isNotNull() & F.col("embedding").isNotNull()).where(fit).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.when(F.col("vec_id") % RELABELLED_EVERY == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        units.alias("units"),
    )
    largest = F.array_max(F.transform("units", lambda x: F.greatest(x, -x - 1)))
    dims, most = rows.agg(F.max(F.size("units")), F.max(largest)).first()
    dims, bits = -(-(dims or 1) // 8) * 8, int(most or 0).bit_length() + 1

    @F.pandas_udf("binary")
    def planes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            whole = np.zeros((len(batch), dims), np.int64)
            for k, values in enumerate(batch):
                whole[k, : len(values)] = values
            yield pd.Series([row.tobytes() for row in pack(whole, bits)], dtype=object)

    packed = rows.select(F.monotonically_increasing_id().alias("mark"), "id", "label", planes("units").alias("planes"))
    return stored(packed, "vectors"), dims, bits


def _planes(column: pd.Series, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), bits, -1)


def _against(spark: SparkSession, candidates: DataFrame, block: Anchors, same_label: bool, keep: int) -> DataFrame:
    """The first `keep` rows of each anchor and slot over all candidates: anchor, slot, id, mark, score, rank.

    Slots are 0 for rows of the anchor's own label; for others there is one for each band of scores.
    """
    shared = spark.sparkContext.broadcast(block)

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = shared.value
        tables = block.tables()
        slots = 1 if same_label else block.low.shape[1]
        found = _Best(len(block.marks) * slots, keep)

        def look(rows: pd.DataFrame, anchors: np.ndarray) -> None:
            got = scores(tables[:, :, anchors], _planes(rows["planes"], block.bits))
            ids, marks = rows["id"].to_numpy(), rows["mark"].to_numpy()
            for slot in range(slots):
                if same_label:
                    able = marks[:, None] != block.marks[anchors]
                else:
                    able = (got >= block.low[anchors, slot]) & (got <= block.high[anchors, slot])
                    able &= rows["label"].to_numpy()[:, None] != block.labels[anchors]
                able &= got >= found.floor[anchors * slots + slot]
                row, column = np.nonzero(_topmost(got, able, keep))
                if len(row):
                    key = anchors[column] * slots + slot
                    found.add(key, got[row, column].astype(np.int64), ids[row], marks[row])

        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_A_TIME):
                rows = batch.iloc[at : at + ROWS_AT_A_TIME]
                if same_label:
                    for label, own in rows.groupby("label"):
                        if len(anchors := np.flatnonzero(block.labels == label)):
                            look(own, anchors)
                else:
                    look(rows, np.arange(len(block.marks)))
        key, score, id_, mark = found.rows
        yield pd.DataFrame(
            {"anchor": block.marks[key // slots], "slot": key % slots, "id": id_, "mark": mark, "score": score}
        )

    found = candidates.mapInPandas(best, "anchor long, slot long, id long, mark long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "mark")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; see the module.

    Rows whose vec_id is divisible by ANCHORS_EVERY are anchors, all rows are candidates. Repeated rows are rows of
    their own, anchors too; a NULL vec_id is never an anchor and comes last among ties. Rows with a NULL label or
    vector, or a component that is NULL, not finite or not within LARGEST, take no part; an empty vector scores 0.
    """
    spark = embeddings.sparkSession
    rows, dims, bits = vectors(embeddings)
    table_row = dims // 8 * 256 * 8
    per_block = max(16, min(MOST_ANCHORS, TABLE_BYTES // table_row))
    is_anchor = (F.col("id") % ANCHORS_EVERY == 0) & (F.col("id") != NO_ID)
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if(is_anchor)).first()
    blocks = -(-n_anchors // per_block)
    path = scratch_dir(spark, "hard-negatives")
    anchors_path = scratch_dir(spark, "anchors")
    by_block = rows.where(is_anchor).withColumn("block", F.pmod(F.xxhash64("mark"), F.lit(max(1, blocks))))
    by_block.write.partitionBy("block").parquet(anchors_path)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    tasks = max(1, -(-n_rows * min(per_block, n_anchors) // PAIRS_PER_TASK))
    schema = "mark long, id long, label long, planes binary, block long"
    for k in range(blocks):
        # At most about `per_block` rows: blocks are dealt by hash.
        own = spark.read.schema(schema).parquet(anchors_path).where(F.col("block") == k).toPandas()
        if own.empty:
            continue
        block = Anchors(unpack(_planes(own["planes"], bits)), own["label"].to_numpy(), own["mark"].to_numpy(), bits)
        candidates = rows.repartition(tasks, "mark")
        positives = _against(spark, candidates, block, True, POSITIVES).toPandas()
        # A slot without a positive has an empty band.
        block.low = np.full((len(own), POSITIVES), np.iinfo(np.int64).max)
        block.high = np.full((len(own), POSITIVES), np.iinfo(np.int64).min)
        place = {mark: n for n, mark in enumerate(block.marks)}
        at = positives["anchor"].map(place).to_numpy(np.int64), positives["rank"].to_numpy(np.int64) - 1
        of = positives["score"].to_numpy(np.int64)
        block.low[at], block.high[at] = -((-LOW * of) // OF), HIGH * of // OF
        ids = dict(zip(own["mark"], own["id"]))
        pairs = spark.createDataFrame(
            [
                (int(r.anchor), int(ids[r.anchor]), int(r.rank) - 1, int(r.id), int(r.score))
                for r in positives.itertuples()
            ],
            "anchor long, anchor_id long, slot long, positive_id long, positive_score long",
        )
        found = _against(spark, candidates, block, False, NEGATIVES)
        known = [F.nullif(c, F.lit(NO_ID)).alias(c) for c in ("positive_id",)]
        found.join(F.broadcast(pairs), ["anchor", "slot"]).select(
            "anchor_id", *known, F.col("rank").cast("int").alias("rank"),
            F.nullif("id", F.lit(NO_ID)).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    if not blocks:
        return spark.createDataFrame([], result)
    return spark.read.schema(result).parquet(path)
