"""Mixing to target weights with soft membership in domains.

A softmax over hashed words and byte shares, trained on a labelled table, gives every document its domain
posteriors. Nonnegative rates are then fitted so that each domain's expected tokens, the sum of rate x tokens x
posterior, match the target: least squares by projected gradient. A step needs only the domains' residuals,
which are one aggregate over all rows; a document's rate is the replay of those few vectors on its own
posteriors, so no rates are moved or collected.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import WORD_BYTES, bound_batches, fitted, labelled_sample, stored

_log = logging.getLogger(__name__)

HASH_BITS = 15
# The fit takes at most this many labelled rows of at most this many characters, those of lowest hash.
FIT_ROWS = 3_000
FIT_CHARS = 5_000
EPOCHS = 80
RATE = 0.05
DECAY = 1e-5
MAX_STEPS = 30
# Where rates have a least value: steps in all, and how far the budget may rise above the smallest one.
MAX_RAISED_STEPS = 90
MAX_RAISE = 8.0
TOLERANCE = 1e-5
MEMORY = 400_000

# Token shares of the domains that the labels make: good text, poor text, good text that is toxic.
TARGETS = {"clean": 0.88, "poor": 0.09, "toxic": 0.03}
# The pipeline's: toxic text is gone by then.
MIX_TARGETS = {name: share for name, share in TARGETS.items() if name != "toxic"}


def by_quality_and_toxicity() -> Column:
    """Domain of a labelled row: poor if its quality is 0, else toxic or clean; NULL without a quality."""
    return (
        F.when(F.col("quality") == 0, "poor")
        .when((F.col("quality") == 1) & (F.col("toxic") == 1), "toxic")
        .when(F.col("quality") == 1, "clean")
    )


class _Buckets(dict):
    """Feature numbers of words, worked out when first met; the first 256 are byte values."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = number = 256 + (crc32(word) & ((1 << HASH_BITS) - 1))
        return number


def features(text: str | None, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray, int]:
    """Feature numbers and values of a text, and its number of tokens (words between whitespace)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    shares = np.sqrt(np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / max(1, len(raw)))
    words = Counter(raw.translate(WORD_BYTES).split())
    ids = np.fromiter((buckets[w] for w in words), np.int64, len(words))
    values = np.sqrt(np.fromiter(words.values(), np.float64, len(words)))
    norm = np.sqrt((values**2).sum()) + 1.0
    present = np.flatnonzero(shares)
    return np.r_[present, ids], np.r_[shares[present], values / norm * 3], len(raw.split())


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray  # features x domains
    bias: np.ndarray

    def posteriors(self, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        logits = values @ self.weights[ids] + self.bias
        p = np.exp(logits - logits.max())
        return p / p.sum()


def train(texts: list[str], domains: list[str], names: list[str]) -> Classifier:
    """Softmax by Adam on all rows at once. Without rows all domains are equally likely."""
    buckets = _Buckets()
    size = 256 + (1 << HASH_BITS)
    w, b = np.zeros((size, len(names))), np.zeros(len(names))
    if not texts:
        return Classifier(names, w, b)
    bags = [features(t, buckets)[:2] for t in texts]
    ids = np.concatenate([i for i, _ in bags])
    values = np.concatenate([v for _, v in bags])
    row = np.repeat(np.arange(len(bags)), [len(i) for i, _ in bags])
    target = np.eye(len(names))[[names.index(d) for d in domains]]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (w, b)]
    for step in range(1, EPOCHS + 1):
        logits = np.stack([np.bincount(row, values * w[ids, k], len(bags)) for k in range(len(names))], axis=1) + b
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - target) / len(bags)
        g_w = np.stack([np.bincount(ids, values * g[row, k], size) for k in range(len(names))], axis=1) + DECAY * w
        for (m, v), param, grad in zip(state, (w, b), (g_w, g.sum(axis=0))):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Classifier(names, w, b)


def fit_classifier(docs: DataFrame, labels: DataFrame, domain: Column, names: list[str]) -> Classifier:
    """Train on a bounded sample of labelled rows; rows without id, text or domain are not used."""
    known = labels.where("doc_id IS NOT NULL").select("doc_id", domain.alias("domain")).where(F.col("domain").isin(names))
    return fitted(labelled_sample(docs, known, "domain", FIT_ROWS, FIT_CHARS), partial(train, names=names))


def members(docs: DataFrame, classifier: Classifier, kept_columns: list[str]) -> DataFrame:
    """Stored rows (row, draw, tokens, posteriors) with posteriors in the order of the classifier's domains."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.pandas_udf("tokens long, posteriors array<double>")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, buckets = shared.value, _Buckets()
        for batch in texts:
            tokens, posteriors = [], []
            for text in batch:
                ids, values, n = features(text, buckets)
                tokens.append(n)
                posteriors.append(model.posteriors(ids, values))
            yield pd.DataFrame({"tokens": tokens, "posteriors": posteriors})

    text = docs["text"].cast("string")
    draw = F.shiftrightunsigned(F.xxhash64(docs["doc_id"], F.xxhash64(text)), 11) / F.lit(float(1 << 53))
    rows = docs.select(F.struct(*kept_columns).alias("row"), draw.alias("draw"), judge(text).alias("judged"))
    return stored(rows.select("row", "draw", "judged.tokens", "judged.posteriors"), "posteriors")


def rate_after(steps: list[list[float]], least: float) -> Column:
    """A row's rate after the given steps, from a rate of one."""
    p = F.col("posteriors")
    if not steps:
        return F.lit(max(1.0, least))
    vectors = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

    def move(rate: Column, step: Column) -> Column:
        moved = rate
        for k in range(len(steps[0])):
            moved = moved + p[k] * step[k]
        return F.greatest(F.lit(float(least)), moved)

    return F.aggregate(vectors, F.lit(max(1.0, float(least))), move)


def _inverse(gram: np.ndarray) -> np.ndarray:
    return np.linalg.pinv(gram + np.eye(len(gram)) * gram.trace() * 1e-9)


def fit_rates(rows: DataFrame, targets: list[float], least: float = 0.0, budget: float | None = None) -> Column:
    """Rates of at least `least` whose expected tokens by domain match `targets` (shares) of `budget` tokens.

    The budget is all tokens there are, or if `least` forbids that, the smallest one at which no domain has to
    shrink, raised as long as the fullest domain is over its goal: every copy belongs to it in part. Rates start
    at one and a step moves a document along its posteriors by inv(G) x residual, G being
    the tokens' second moments of the posteriors: the gradient of the squared residuals in the metric in which
    a step of one is safe. If no rates match, the fit ends at the least squares within MAX_STEPS steps, those of
    the smallest budget, and a warning gives the shares that come out.
    """
    k = len(targets)
    share = np.array(targets) / sum(targets)
    p = [F.col("posteriors")[i] for i in range(k)]
    sums = [F.sum(F.col("tokens") * p[i]).alias(f"s{i}") for i in range(k)]
    moments = [F.sum(F.col("tokens") * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(k)]
    first = rows.agg(*sums, *moments).first()
    have = np.array([first[f"s{i}"] or 0.0 for i in range(k)])
    if not have.sum():
        return rate_after([], least)
    gram = np.array([[first[f"g{i}_{j}"] or 0.0 for j in range(k)] for i in range(k)])
    total = budget or (have.sum() if least == 0 else max(least, 1.0) * float((have / share).max()))
    raises, most = least > 0 and not budget, MAX_RAISE * total
    goal = share * total
    safe = _inverse(gram)
    steps: list[list[float]] = []
    residual, quick = goal - have * max(1.0, least), safe
    unraised: tuple[list[list[float]], np.ndarray] | None = None
    met = False
    for _ in range(MAX_RAISED_STEPS if raises else MAX_STEPS):
        if met := bool(np.abs(residual).max() <= TOLERANCE * total):
            break
        # Rates at the bound no longer move: a step for the others only is longer, and kept if it helps.
        trial = [*steps, (quick @ residual).tolist()]
        rate = rate_after(trial, least)
        free = F.col("tokens") * (rate > least).cast("double")
        seen = rows.agg(
            *[F.sum(rate * F.col("tokens") * p[i]).alias(f"s{i}") for i in range(k)],
            *[F.sum(free * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(k)],
        ).first()
        after = goal - np.array([seen[f"s{i}"] for i in range(k)])
        helps = np.linalg.norm(after) < 0.9 * np.linalg.norm(residual)
        if quick is safe or helps:
            steps, residual = trial, after
            quick = _inverse(np.array([[seen[f"g{i}_{j}"] for j in range(k)] for i in range(k)]))
        else:
            quick = safe
            continue
        if raises and not helps:
            # The fullest domain's excess, and half as much for what further copies bring it.
            unraised = unraised or (steps, goal - residual)
            fullest = float(((goal - residual) / share).max())
            if (total := total + 1.5 * (fullest - total)) > most:
                break
            residual = residual + share * total - goal
            goal = share * total
    else:
        met = bool(np.abs(residual).max() <= TOLERANCE * total)
    if not met:
        steps, got = unraised or (steps, goal - residual)
        _log.warning("Target shares %s are not met: the rates give %s.", share.round(4).tolist(), (got / got.sum()).round(4).tolist())
    return rate_after(steps, least)


def rated(docs: DataFrame, labels: DataFrame, kept_columns: list[str] | None = None,
          domain: Column | None = None, targets: Mapping[str, float] = TARGETS, least: float = 0.0) -> DataFrame:
    """Every row (as `row`) with tokens, posteriors (by domain name in order), rate and copies.

    copies is the rate rounded up or down by a draw from doc_id and text, so that its mean is the rate. NULL
    text is empty and has no tokens; a domain that nobody belongs to stays at what the posteriors give it.
    """
    names = sorted(targets)
    classifier = fit_classifier(docs, labels, by_quality_and_toxicity() if domain is None else domain, names)
    rows = members(docs, classifier, kept_columns or ["*"])
    rate = fit_rates(rows, [targets[n] for n in names], least)
    rows = rows.select("row", "tokens", "posteriors", "draw", rate.alias("rate"))
    copies = F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("long")
    return rows.select("row", "tokens", "posteriors", "rate", copies.cast("long").alias("copies"))


def mixture(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, tokens, a posterior for each domain, rate and copies of every document."""
    names = sorted(TARGETS)
    return rated(docs, labels, ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "tokens",
        *[F.col("posteriors")[i].alias(f"p_{name}") for i, name in enumerate(names)], "rate", "copies",
    )


def remixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents repeated by their copies, with the columns of the input.

    No rate is below one, so every document stays at least once; domains short of their share are repeated.
    """
    rows = rated(docs, labels, targets=MIX_TARGETS, least=1.0)
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
