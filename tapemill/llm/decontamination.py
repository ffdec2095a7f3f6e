"""Benchmark decontamination with a positional inverted index of the training texts.

Test items are cut into windows. Each window is looked for from its rarest terms: postings (term, document,
position) of the corpus are shifted by the term's offset in the window, and a start that the rarest few terms
agree on is a candidate, whose remaining terms are then looked up in the index too. The index holds the test
vocabulary's postings near any of those rare terms, which is all that a match can touch.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapemill.llm.common import WORD_BYTES, bound_batches, stored

WINDOW = 13
# A window's rarest terms that have to agree on a start before the others are looked up.
ANCHORS = 3
# An index finds terms up to so many words off their places, where nothing else is asked for.
SLACK = 2
# Test items go in blocks of about this many words, so that a block's vocabulary fits in every task.
BLOCK_WORDS = 1_000_000

_ITEM_WINDOWS = "item_id string, words array<string>"
_POSTINGS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("positions", T.ArrayType(T.IntegerType())),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    """Words: A-Z lower-cased, runs of ASCII letters and digits and of anything beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, windows = [], []
        for item, text in zip(batch["item_id"], batch["text"]):
            words = [w.decode("utf-8", "surrogatepass") for w in words_of(text)]
            for at in range(max(1, len(words) - WINDOW + 1) if words else 0):
                ids.append(item)
                windows.append(words[at : at + WINDOW])
        yield pd.DataFrame({"item_id": pd.Series(ids, dtype=object), "words": pd.Series(windows, dtype=object)})


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of all items as (window, item_ids, words). Items without words have none.

    item_ids are text; a NULL id marks words like any other but is not listed. `window` is a hash of the words.
    """
    bound_batches(benchmark.sparkSession)
    slim = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = slim.mapInPandas(_windows, _ITEM_WINDOWS)
    return rows.groupBy("words").agg(F.collect_set("item_id").alias("item_ids")).select(
        F.xxhash64("words").alias("window"), "item_ids", "words"
    )


def _term_counts(words_seen: frozenset[bytes]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found = Counter(words_of(text))
                for word in words_seen.intersection(found):
                    total[word] += found[word]
        terms = pd.Series([w.decode("utf-8", "surrogatepass") for w in total], dtype=object)
        yield pd.DataFrame({"term": terms, "n": np.array(list(total.values()), np.int64)})

    return count


def _postings(ids: dict[bytes, int], anchors: frozenset[int], reach: int):
    """A column function from texts to word count and the postings within `reach` words of an anchor term."""

    @F.pandas_udf(_POSTINGS)
    def postings(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        wanted = np.zeros(len(ids) + 1, bool)
        wanted[list(anchors)] = True
        for batch in texts:
            sizes, terms, positions = [], [], []
            for text in batch:
                words = words_of(text)
                found = np.fromiter((ids.get(w, 0) for w in words), np.int32, len(words))
                near = np.zeros(len(words) + 1, np.int32)
                at = np.flatnonzero(wanted[found])
                np.add.at(near, np.maximum(at - reach, 0), 1)
                np.add.at(near, np.minimum(at + reach + 1, len(words)), -1)
                kept = np.flatnonzero((found > 0) & (near.cumsum()[:-1] > 0)) if len(at) else at
                sizes.append(len(words))
                terms.append(found[kept])
                positions.append(kept.astype(np.int32))
            yield pd.DataFrame({"n_words": sizes, "terms": terms, "positions": positions})

    return postings


def _blocks(windows: DataFrame) -> list[DataFrame]:
    """The windows in blocks of bounded size, split by hash; usually one."""
    n = windows.count()
    blocks = -(-n * WINDOW // BLOCK_WORDS)
    return [windows.where(F.pmod("window", F.lit(blocks)) == k) for k in range(blocks)]


class Index:
    """The inverted index of one block of windows over a stored table of documents.

    documents: the input's rows with row, mark and n_words. postings: (term, mark, position).
    anchors: (window, rank, term, at, size) for the rarest terms; places: the same for all terms.
    slack: how far from their places terms may stand and still be found; 0 is enough for phrases.
    """

    def __init__(self, docs: DataFrame, windows: DataFrame, kept_columns: list[str], slack: int = SLACK):
        self.slack = slack
        spark = docs.sparkSession
        bound_batches(spark)
        places = windows.select("window", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
        # Bounded by BLOCK_WORDS.
        vocabulary = sorted(r["word"].encode("utf-8", "surrogatepass") for r in places.select("word").distinct().collect())
        ids = {word: k + 1 for k, word in enumerate(vocabulary)}
        texts = docs.select(F.col("text").cast("string").alias("text"))
        counts = texts.mapInPandas(_term_counts(frozenset(vocabulary)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
        frequency = {r["term"].encode("utf-8", "surrogatepass"): r["n"] for r in counts.collect()}
        terms = spark.createDataFrame(
            [(w.decode("utf-8", "surrogatepass"), k, frequency.get(w, 0)) for w, k in ids.items()], "word string, term int, n long"
        )
        places = places.join(terms, "word").select("window", "size", "at", "term", "n")
        rank = F.expr("row_number() OVER (PARTITION BY window ORDER BY n, term, at)")
        self.places = stored(places.withColumn("rank", rank), "places")
        self.anchors = self.places.where(F.col("rank") <= ANCHORS)
        first = {r["term"] for r in self.places.where("rank = 1 AND n > 0").select("term").distinct().collect()}
        found = _postings(ids, frozenset(first), WINDOW - 1 + 2 * slack)(F.col("body"))
        self.documents = stored(
            docs.select(F.struct(*kept_columns).alias("row"), F.col("text").cast("string").alias("body"))
            .select("row", F.monotonically_increasing_id().alias("mark"), found.alias("found"))
            .select("row", "mark", "found.n_words", "found.terms", "found.positions"),
            "index",
        )
        self.postings = self.documents.select("mark", F.explode(F.arrays_zip("terms", "positions")).alias("p")).select(
            F.col("p.terms").alias("term"), "mark", F.col("p.positions").alias("position")
        )

    def candidates(self, slack: int = 0) -> DataFrame:
        """(window, mark, start, size) where the rarest terms agree on a start, up to `slack` words."""
        shifted = self.postings.join(self.anchors, "term").select(
            "window", "mark", "size", "rank", (F.col("position") - F.col("at")).alias("start")
        )
        if slack:
            shifted = shifted.withColumn("start", F.explode(F.sequence(F.col("start") - slack, F.col("start") + slack)))
        agreed = shifted.groupBy("mark", "window", "size", "start").agg(F.bit_or(F.expr("shiftleft(1, rank)")).alias("ranks"))
        return agreed.where(F.expr(f"bit_count(ranks) = least(size, {ANCHORS})")).drop("ranks")

    def phrases(self) -> DataFrame:
        """Exact matches (window, mark, start, size): every term of the window at its place."""
        candidates = stored(self.candidates().where("start >= 0"), "candidates")
        rest = self.places.where(F.col("rank") > ANCHORS).select("window", "at", "term")
        lookups = candidates.join(rest, "window").select(
            "window", "mark", "start", "size", "term", (F.col("start") + F.col("at")).alias("position")
        )
        met = lookups.join(self.postings, ["mark", "position", "term"]).groupBy("mark", "window", "size", "start").count()
        return met.where(f"count = size - {ANCHORS}").drop("count").unionByName(candidates.where(f"size <= {ANCHORS}"))

    def proximity(self, slack: int) -> DataFrame:
        """(window, mark, start, size) where every term of the window stands within `slack` words of its place."""
        if not 0 <= slack <= self.slack:
            raise ValueError(f"the index was built for a slack of {self.slack}, not {slack}")
        candidates = stored(self.candidates(slack), "near-candidates")
        rest = self.places.where(F.col("rank") > ANCHORS).select("window", "at", "term")
        place = F.col("start") + F.col("at")
        lookups = candidates.join(rest, "window").select(
            "window", "mark", "start", "size", "at", "term", F.explode(F.sequence(place - slack, place + slack)).alias("position")
        )
        met = lookups.join(self.postings, ["mark", "position", "term"]).groupBy("mark", "window", "size", "start").agg(
            F.bit_or(F.expr("shiftleft(1, at)")).alias("places")
        )
        whole = met.where(f"bit_count(places) = size - {ANCHORS}").select("mark", "window", "size", "start")
        return whole.unionByName(candidates.where(f"size <= {ANCHORS}"))


def contamination(docs: DataFrame, benchmark: DataFrame, kept_columns: list[str] | None = None) -> DataFrame:
    """Every row (as `row`) with mark, n_words, n_hit, n_items, item_ids, contaminated.

    A word is hit if it lies in an occurrence of any window of an item; a text is contaminated if at least a
    twentieth of its words are. NULL texts have no words and no hits. Repeated rows are judged one by one; an
    empty benchmark hits nothing.
    """
    windows = stored(item_windows(benchmark), "windows")
    blocks = _blocks(windows)
    kept = kept_columns or ["*"]
    if len(blocks) <= 1:
        index = Index(docs, blocks[0] if blocks else windows, kept, slack=0)
        documents, matches = index.documents, index.phrases()
    else:
        # Every block has an index of its own over one stored copy, whose marks they share.
        text = F.col("text").cast("string").alias("text")
        copy = stored(docs.select(F.struct(*kept).alias("row"), F.monotonically_increasing_id().alias("mark"), text), "texts")
        matches = None
        for block in blocks:
            index = Index(copy, block, ["mark"] if matches else ["row", "mark"], slack=0)
            if matches is None:
                documents = index.documents.select("row.row", "row.mark", "n_words")
            own = index.documents.select("mark", F.col("row.mark").alias("own"))
            found = index.phrases().join(own, "mark").select("window", F.col("own").alias("mark"), "start", "size")
            matches = stored(found, "matches").unionByName(matches) if matches else stored(found, "matches")
    matches = stored(matches.select("window", "mark", "start", "size"), "matches")
    hits = (
        matches.select("mark", F.explode(F.expr("sequence(start, start + size - 1)")).alias("position"))
        .distinct()
        .groupBy("mark")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items = (
        matches.select("mark", "window").distinct()
        .join(windows.select("window", "item_ids"), "window")
        .select("mark", F.explode("item_ids").alias("item_id"))
        .groupBy("mark")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    found = stored(hits.join(items, "mark", "left"), "hits")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("item_ids", F.array().cast("array<string>"))
    return documents.join(found, "mark", "left").select(
        "row", "mark", "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("item_ids"),
        ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    judged = contamination(docs, benchmark, ["doc_id"])
    return judged.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns of the input."""
    return contamination(docs, benchmark).where("NOT contaminated").select("row.*")
