"""Repeated passages from sparse suffixes at content-selected positions.

A position is kept if its 8-word hash is the least of 26 neighbours', so any passage of 50 words has a kept
position among its first 26 and equal passages keep equal ones: about one suffix in thirteen stays. Suffixes are
brought into the order of the hash of their first 25 words, where equal neighbours show themselves as counts,
summed per task before the shuffle; all others are dropped. Those left are extended to the left and right as far
as the kept position decides: the run of all 50-word windows that selected it. A run that occurs twice is repeated
as a whole. A run of which only a part may be, at a passage's ends, is settled window by window, word for word,
against one occurrence of every run. Windows that occur twice are joined to whole passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import bound_batches, stored, text_of

LEAST_WORDS = 50
GRAM = 8
REACH = 26
HEAD = LEAST_WORDS - REACH + 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 14


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


class Hasher:
    """Hashes of any run of words of a text in constant time each."""

    def __init__(self, text: str | None, cache: _Words):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        self.n = len(words)
        hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, self.n)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(hashes * _powers(_BASE, self.n))))
        self.shift = _powers(_INVERSE, self.n + 1)

    def runs(self, starts: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        value = (self.sums[starts + size] - self.sums[starts]) * self.shift[starts]
        value ^= value >> np.uint64(31)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(29))

    def selected(self) -> np.ndarray:
        """For every window of LEAST_WORDS words, in order, the position that it keeps; these never decrease."""
        if self.n < LEAST_WORDS:
            return np.zeros(0, np.int64)
        grams = self.runs(np.arange(self.n - GRAM + 1), GRAM)
        starts = self.n - LEAST_WORDS + 1
        best = []
        for at in range(0, starts, _CHUNK):
            to = min(starts, at + _CHUNK)
            views = np.lib.stride_tricks.sliding_window_view(grams[at : to + REACH - 1], REACH)
            best.append(views.argmin(axis=1) + np.arange(at, to))
        return np.concatenate(best)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per passage: doc_id, start_word, end_word, n_words (words between whitespace).

    A word is covered if it lies in any 50 words in a row that occur twice, in one or in several documents; a
    passage is a longest run of covered words, so its ends are exact. NULL and short texts have no passages;
    repeated rows are each other's copies, and an empty table has none.
    """
    bound_batches(docs.sparkSession)

    @F.pandas_udf("keys array<long>, positions array<int>")
    def suffixes(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = _Words()
        for batch in texts:
            keys, positions = [], []
            for text in batch:
                hasher = Hasher(text, cache)
                kept = np.unique(hasher.selected())
                keys.append(_signed(hasher.runs(kept, HEAD)))
                positions.append(kept.astype(np.int32))
            yield pd.DataFrame({"keys": keys, "positions": positions})

    base = docs.select("doc_id", text_of(docs).alias("body")).withColumn("copy", F.xxhash64("body", F.length("body")))
    array = stored(base.select("copy", suffixes("body").alias("s")).select("copy", "s.*").where("size(keys) > 0"), "suffixes")
    entries = array.select("copy", F.explode(F.arrays_zip("keys", "positions")).alias("e")).select(
        "copy", F.col("e.keys").alias("key"), F.col("e.positions").alias("position")
    )
    shared = stored(entries.groupBy("key").count().where("count > 1").select("key"), "shared-suffixes")
    left = entries.join(shared, "key", "left_semi").groupBy("copy").agg(F.collect_set("position").alias("kept"))
    left = stored(left, "kept-suffixes")

    @F.pandas_udf("runs array<long>, starts array<int>, sizes array<int>, offsets array<int>, hashes array<long>")
    def windows(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        cache = _Words()
        for texts, kepts in batches:
            out = []
            for text, kept in zip(texts, kepts):
                hasher = Hasher(text, cache)
                selected = hasher.selected()
                shared = np.isin(selected, np.asarray(kept, np.int64))
                starts = np.flatnonzero(shared & (np.diff(selected, prepend=-1) > 0))
                sizes = np.searchsorted(selected, selected[starts], "right") - starts
                out.append(
                    (
                        _signed(hasher.runs(starts, sizes + LEAST_WORDS - 1)),
                        starts.astype(np.int32),
                        sizes.astype(np.int32),
                        (np.cumsum(sizes) - sizes).astype(np.int32),
                        _signed(hasher.runs(np.flatnonzero(shared), LEAST_WORDS)),
                    )
                )
            yield pd.DataFrame(out, columns=["runs", "starts", "sizes", "offsets", "hashes"])

    extended = base.join(left, "copy").select(
        "doc_id", F.monotonically_increasing_id().alias("mark"), windows("body", "kept").alias("w")
    )
    extended = stored(extended.select("doc_id", "mark", "w.*"), "windows")
    again = extended.select("mark", F.explode("runs").alias("run")).groupBy("run")
    again = again.agg(F.count(F.lit(1)).alias("n"), F.min("mark").alias("one")).where("n > 1").select("run", "one")
    parts = F.transform(
        F.arrays_zip("runs", "starts", "sizes", "offsets"),
        lambda z: F.struct(
            z.runs.alias("run"), z.starts.alias("start"), z.sizes.alias("size"),
            F.slice("hashes", z.offsets + 1, z.sizes).alias("hashes"),
        ),
    )
    runs = extended.select("mark", F.explode(parts).alias("r")).select("mark", "r.*")
    # Of a run that occurs twice, one document's windows stand for all; a run that does not brings its own.
    runs = runs.join(stored(again, "repeated-runs"), "run", "left").select(
        "mark", "start", "size", F.col("one").isNotNull().alias("whole"),
        F.when(F.coalesce(F.col("one") == F.col("mark"), F.lit(True)), F.col("hashes")).alias("hashes"),
    )
    runs = stored(runs, "runs")
    places = runs.select("mark", "whole", "start", F.posexplode("hashes").alias("at", "hash"))
    twice = stored(places.groupBy("hash").count().where("count > 1").select("hash"), "repeated-windows")
    single = places.where("NOT whole").join(twice, "hash", "left_semi")
    single = single.select("mark", (F.col("start") + F.col("at")).alias("start"), F.lit(1).alias("size"))
    covered = runs.where("whole").select("mark", "start", "size").union(single)
    covered = covered.groupBy("mark").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))

    @F.pandas_udf("array<struct<start_word: int, end_word: int>>")
    def passages(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for starts, sizes in zip(*batch):
                starts, sizes = np.asarray(starts, np.int64), np.asarray(sizes, np.int64)
                order = np.argsort(starts, kind="stable")
                starts, ends = starts[order], (starts + sizes)[order] + LEAST_WORDS - 1
                first = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
                last = np.r_[first[1:], len(starts)] - 1
                out.append([{"start_word": int(starts[a]), "end_word": int(ends[b])} for a, b in zip(first, last)])
            yield pd.Series(out, dtype=object)

    found = covered.select("mark", F.explode(passages("starts", "sizes")).alias("p")).select("mark", "p.*")
    return extended.select("doc_id", "mark").join(found, "mark").select(
        "doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words")
    )
