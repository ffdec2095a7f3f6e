"""Toxicity from subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its hashed character n-grams and of the word itself, a text's
a mean over its words, and a softmax over two classes reads it. Embeddings and softmax are trained
together on labelled rows, so a misspelling never seen shares most n-grams with the word it disguises.
After training a word adds one number to the score, whatever the embedding's width.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapemill.llm.common import WORD_BYTES, bound_batches, crc_mod, fitted, labelled_sample

HASH_BITS = 18
GRAMS = (3, 4, 5, 6)
WIDTH = 4
EPOCHS = 60
RATE = 0.1
# Texts are means over many words, of which few matter: the mean is scaled up for the softmax.
SCALE = 100.0
DECAY = 1e-4
LEAST_TEXTS = 3
# Every text is averaged together with this many empty words, so that a single word of a short one says less.
PAD = 20
# The fit takes at most this many labelled rows, of at most this many characters each: those whose hash is
# lowest. Everything is scored in full; only the fit is on a sample.
FIT_ROWS = 8_000
FIT_CHARS = 5_000
THRESHOLD = 0.7
# Every so many rows of the sample are not trained on but set the logit that scores THRESHOLD, if there are so many.
HELD_BACK_EVERY = 8
LEAST_HELD_BACK = 25
# That cut leaves at least this share of the clean rows below it.
LEAST_KEPT = 0.92
# A text without words counts as clean, with this share of the weight of all rows.
NO_WORDS = 0.2
# By how much the logit of such a text stays below the cut.
MARGIN = 0.05
# Words a task remembers before it starts over.
MEMORY = 400_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def shares_of(words: list[bytes]) -> tuple[dict[bytes, float], float]:
    """What each distinct word weighs in a text's mean, and the sum: repeats count by their square root."""
    shares = {word: n**0.5 for word, n in Counter(words).items()}
    return shares, sum(shares.values()) + PAD


def grams_of(word: bytes) -> list[int]:
    """Buckets of a word: the word itself and its character n-grams with its ends marked."""
    mask = (1 << HASH_BITS) - 1
    marked = "<" + word.decode("utf-8", "replace") + ">"
    found = [crc32(b"=" + word) & mask]
    for n in GRAMS:
        found += [crc32(marked[i : i + n].encode()) & mask for i in range(len(marked) - n + 1)]
    return found


@dataclass
class Model:
    """weights: what each bucket adds to the logit; bias: the logit of a text without words."""

    weights: np.ndarray
    bias: float

    def scorer(self):
        return _Words(self.weights.tolist(), self.bias)


class _Words(dict):
    """Logit contributions of words, worked out when first met."""

    def __init__(self, weights: list[float], bias: float):
        super().__init__()
        self.weights, self.bias = weights, bias

    def __missing__(self, word: bytes) -> float:
        if len(self) >= MEMORY:
            self.clear()
        buckets = grams_of(word)
        value = sum(map(self.weights.__getitem__, buckets)) / len(buckets)
        self[word] = value
        return value

    def logit(self, text: str | None) -> float:
        shares, total = shares_of(words_of(text))
        return self.bias + sum(self[w] * share for w, share in shares.items()) / total

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(text), -700, 700))))


class _Pool:
    """Weighted sums of `values[:, source]` into `target`, and back, over pairs (source, target, weight)."""

    def __init__(self, source: np.ndarray, target: np.ndarray, weight: np.ndarray, sources: int, targets: int):
        self.ways = []
        for into, out_of, size in ((target, source, targets), (source, target, sources)):
            order = np.argsort(into, kind="stable").astype(np.int32)
            keys = into[order]
            starts = np.flatnonzero(np.diff(keys, prepend=-1))
            self.ways.append((out_of[order], weight[order], starts, keys[starts], size))

    def sum(self, values: np.ndarray, back: bool = False) -> np.ndarray:
        out_of, weight, starts, keys, size = self.ways[back]
        sums = np.zeros((len(values), size), np.float32)
        for k, row in enumerate(values):
            if len(starts):
                sums[k, keys] = np.add.reduceat(row[out_of] * weight, starts)
        return sums


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Fit embeddings and softmax together by Adam on all given rows at once."""
    vocabulary: dict[bytes, int] = {}
    # Plain arrays: there is an entry for every distinct word of every text.
    words, shares, counts, y = array("i"), array("f"), array("i"), []
    for text, label in zip(texts, labels):
        bag, total = shares_of(words_of(text))
        if bag:
            words.extend(vocabulary.setdefault(w, len(vocabulary)) for w in bag)
            shares.extend(share / total for share in bag.values())
            counts.append(len(bag))
            y.append(label)
    y = np.asarray(y, np.float32)
    rows = len(y)
    if rows == 0 or y.min() == y.max():
        share = (y.sum() + 1.0) / (rows + 2.0) if rows else 0.5
        return Model(np.zeros(1 << HASH_BITS), float(np.log(share / (1 - share))))
    words, shares = np.frombuffer(words, np.int32), np.frombuffer(shares, np.float32)
    docs = np.repeat(np.arange(rows, dtype=np.int32), np.frombuffer(counts, np.int32))
    sizes = np.zeros(len(vocabulary), np.int32)

    def all_grams() -> Iterator[int]:
        for k, word in enumerate(vocabulary):
            found = grams_of(word)
            sizes[k] = len(found)
            yield from found

    grams = np.fromiter(all_grams(), np.int32)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # Buckets met in few texts would only be learnt by heart.
    often = (np.bincount(grams, np.bincount(words)[owner], 1 << HASH_BITS) >= LEAST_TEXTS)[grams]
    grams, owner = grams[often], owner[often]
    into_words = _Pool(grams, owner, (1.0 / sizes[owner]).astype(np.float32), 1 << HASH_BITS, len(sizes))
    # One row more, without words.
    y = np.append(y, np.float32(0))
    into_docs = _Pool(words, docs, shares, len(sizes), rows + 1)

    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.02, (WIDTH, 1 << HASH_BITS)).astype(np.float32)
    u = (np.array([[-1.0], [1.0]]) + rng.normal(0, 0.1, (2, WIDTH))).astype(np.float32)
    b = np.zeros((2, 1), np.float32)
    target = np.stack([1 - y, y])
    # Both classes weigh the same, however rare one is.
    weight = (target / target[:, :-1].sum(axis=1, keepdims=True)).sum(axis=0) / 2
    weight[-1] = NO_WORDS
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (e, u, b)]
    for step in range(1, EPOCHS + 1):
        word = into_words.sum(e)
        doc = into_docs.sum(word) * SCALE
        logits = u @ doc + b
        p = np.exp(logits - logits.max(axis=0))
        p /= p.sum(axis=0)
        g = (p - target) * weight
        g_word = into_docs.sum(u.T @ g * SCALE, back=True)
        g_e = into_words.sum(g_word, back=True) + DECAY * e
        for (m, v), param, grad in zip(state, (e, u, b), (g_e, g @ doc.T, g.sum(axis=1, keepdims=True))):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = (u[1] - u[0]) @ e * SCALE
    weights[np.setdiff1d(np.arange(1 << HASH_BITS), grams)] = 0.0
    return Model(weights, float(b[1, 0] - b[0, 0]))


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit from which on rows count as toxic so that the shares of both classes judged right add up to the most.

    Only cuts that keep LEAST_KEPT of the clean rows are looked at, and of those within a standard error of the best
    one the lowest is taken: few toxic rows say little about where it lies.
    """
    order = np.argsort(logits)
    logits, toxic = logits[order], labels[order] == 1
    # Cuts lie between neighbours; below a cut are `kept` clean rows and the toxic ones that it misses.
    kept = np.cumsum(~toxic) / (~toxic).sum()
    missed = np.cumsum(toxic) / toxic.sum()
    able = (np.diff(logits, append=np.inf) > 0) & (kept >= LEAST_KEPT)
    gain = np.where(able, kept - missed, -1.0)[:-1]
    caught = 1 - missed[gain.argmax()]
    error = np.sqrt(max(caught * (1 - caught), 1 / toxic.sum()) / toxic.sum())
    k = int(np.argmax(gain >= gain.max() - error))
    return float(logits[k] + logits[k + 1]) / 2


def calibrated(texts: list[str], labels: list[int]) -> Model:
    """A model whose score reaches THRESHOLD where rows it was not trained on are told apart best.

    Classes weigh the same in training, so the probability it ends with is no share of rows; its bias is shifted, which
    changes no ranking. Too few rows to hold some back, or one class only among them, leave the bias as trained.
    """
    back = np.arange(len(texts)) % HELD_BACK_EVERY == HELD_BACK_EVERY - 1
    held = [(t, y) for t, y, b in zip(texts, labels, back) if b]
    if len(held) < LEAST_HELD_BACK or len({y for _, y in held}) < 2:
        return train(texts, labels)
    model = train([t for t, b in zip(texts, back) if not b], [y for y, b in zip(labels, back) if not b])
    scorer = model.scorer()
    cut = best_cut(np.array([scorer.logit(t) for t, _ in held]), np.array([y for _, y in held]))
    # Whatever the rows say, nothing speaks against a text without words.
    cut = max(cut, scorer.logit("") + MARGIN)
    return Model(model.weights, model.bias - cut + float(np.log(THRESHOLD / (1 - THRESHOLD))))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on labelled documents that are not held out; a bounded number, chosen by hash of the id.

    Rows without id, text or label are not used. A document labelled or listed twice counts twice.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.where(crc_mod(F.col("doc_id"), 3) != 1)
    return fitted(labelled_sample(docs, known, "toxic", FIT_ROWS, FIT_CHARS), calibrated)


def score_of(spark: SparkSession, model: Model):
    """A column function from text to the probability of being toxic."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = shared.value.scorer()
        for batch in texts:
            yield pd.Series([scorer.score(t) for t in batch], dtype="float64")

    return score


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; an empty or NULL text gets the bias alone."""
    score = score_of(docs.sparkSession, fit(docs, labels))
    scored = docs.select(
        "doc_id", (crc_mod(docs["doc_id"], 3) == 1).alias("held_out"), score(docs["text"].cast("string")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents that the classifier does not reject, columns as they came.

    NULL, empty and wordless texts stay; repeated rows go or stay together. The classifier is fitted on the labelled rows among `labelled`, or else among the documents themselves.
    """
    score = score_of(docs.sparkSession, fit(docs if labelled is None else labelled, labels))
    return docs.where(score(docs["text"].cast("string")) < THRESHOLD)
