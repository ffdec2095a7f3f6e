"""Text quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its potentials come from features of the line and of the lines before and after it,
and neighbouring labels prefer to agree as far as training says. Forward-backward gives each line's marginal,
and a document's score is their mean weighted by line length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import bound_batches, crc_mod, fitted, labelled_sample

# The fit takes at most this many labelled rows of at most this many characters and lines.
FIT_ROWS = 4_000
FIT_CHARS = 20_000
FIT_LINES = 60
EPOCHS = 150
RATE = 0.05
DECAY = 1e-3
THRESHOLD = 0.3

_CLASS = np.full(256, 7, np.uint8)  # beyond ASCII
_CLASS[:128] = 6  # other symbols and controls
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in " \t"]] = 3
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = 4
_CLASS[[ord(c) for c in "|!"]] = 5
_CLASSES = 8
_OWN = _CLASSES + 5
WIDTH = 3 * _OWN + 1


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line (lines x WIDTH) and the lines' lengths in bytes plus one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    lines = raw.split(b"\n")
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    classes = _CLASS[np.frombuffer(raw, np.uint8)]
    line = np.repeat(np.arange(len(lines)), lengths + 1)[: len(raw)]
    counts = np.bincount(line * _CLASSES + classes, minlength=len(lines) * _CLASSES).reshape(-1, _CLASSES).astype(np.float64)
    counts[:-1, 6] -= 1  # the line feed itself
    own = np.zeros((len(lines), _OWN))
    own[:, :_CLASSES] = counts / np.maximum(lengths, 1)[:, None]
    own[:, _CLASSES] = np.log1p(lengths) / 8
    repeats = Counter(lines)
    for k, body in enumerate(lines):
        words = body.split()
        if words:
            own[k, _CLASSES + 1] = 1 - len(set(words)) / len(words)
            own[k, _CLASSES + 2] = min(3.0, lengths[k] / len(words) / 10)
        own[k, _CLASSES + 3] = np.log(repeats[body])
    own[:, _CLASSES + 4] = lengths == 0
    out = np.ones((len(lines), WIDTH))
    out[:, :_OWN] = own
    out[:, _OWN : 2 * _OWN] = np.vstack([np.zeros(_OWN), own[:-1]])
    out[:, 2 * _OWN : 3 * _OWN] = np.vstack([own[1:], np.zeros(_OWN)])
    return out, lengths + 1


@dataclass
class Model:
    """unary: weights of the log odds of a good line; stay: log potential of two neighbours that agree."""

    unary: np.ndarray
    stay: float

    def score(self, text: str | None) -> float:
        x, lengths = line_features(text)
        return float(_marginals(x @ self.unary, self.stay) @ lengths / lengths.sum())


def _squash(odds: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def _pass(odds: float, stay: float) -> float:
    """Log odds that a neighbour with these log odds sends across the edge."""
    return float(np.logaddexp(odds + stay, 0.0) - np.logaddexp(odds, stay))


def _marginals(odds: np.ndarray, stay: float) -> np.ndarray:
    """Forward-backward: the probability of good for every line of one document."""
    n = len(odds)
    ahead, behind = np.zeros(n), np.zeros(n)
    for k in range(1, n):
        ahead[k] = _pass(odds[k - 1] + ahead[k - 1], stay)
    for k in range(n - 2, -1, -1):
        behind[k] = _pass(odds[k + 1] + behind[k + 1], stay)
    return _squash(odds + ahead + behind)


def train(texts: list[str], labels: list[int]) -> Model:
    """Maximise the likelihood of line labels, every line taking its document's, by Adam over padded documents."""
    docs = [line_features(t)[0] for t in texts]
    kept = [k for k, d in enumerate(docs) if len(d) <= FIT_LINES]
    y = np.array([labels[k] for k in kept], np.float64)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        unary = np.zeros(WIDTH)
        unary[-1] = np.log(share / (1 - share))
        return Model(unary, 0.0)
    lines = max(len(docs[k]) for k in kept)
    x, there = np.zeros((len(kept), lines, WIDTH)), np.zeros((len(kept), lines))
    for row, k in enumerate(kept):
        x[row, : len(docs[k])] = docs[k]
        there[row, : len(docs[k])] = 1
    # Both classes and all documents weigh the same, whatever their number and length.
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) / there.sum(axis=1)
    edges = there[:, 1:]
    w, stay = np.zeros(WIDTH), np.zeros(1)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, stay)]
    send = lambda o, s: np.logaddexp(o + s, 0.0) - np.logaddexp(o, s)
    for step in range(1, EPOCHS + 1):
        s = stay[0]
        odds = x @ w
        ahead, behind = np.zeros_like(odds), np.zeros_like(odds)
        for k in range(1, lines):
            ahead[:, k] = send(odds[:, k - 1] + ahead[:, k - 1], s)
        for k in range(lines - 2, -1, -1):
            behind[:, k] = send(odds[:, k + 1] + behind[:, k + 1], s) * edges[:, k]
        good = _squash(odds + ahead + behind)
        left, right = (odds + ahead)[:, :-1], (odds + behind)[:, 1:]
        agree = _squash(s + np.logaddexp(left + right, 0.0) - np.logaddexp(left, right))
        g_w = np.einsum("dl,dlf->f", (good - y[:, None]) * there * weight[:, None], x) + DECAY * w
        g_s = np.array([((agree - 1) * edges * weight[:, None]).sum() + DECAY * s * 10])
        for (m, v), param, grad in zip(state, (w, stay), (g_w, g_s)):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(w, float(stay[0]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on labelled documents that are not held out (crc32 of the id modulo 5 is not 0)."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.where(crc_mod(F.col("doc_id"), 5) != 0)
    return fitted(labelled_sample(docs, known, "quality", FIT_ROWS, FIT_CHARS), train)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; NULL is the empty text, which is one empty line."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(t) for t in batch], dtype="float64")

    scored = docs.select(
        "doc_id", (crc_mod(docs["doc_id"], 5) == 0).alias("held_out"), score(docs["text"].cast("string")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
