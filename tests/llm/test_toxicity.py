"""The toxicity scorer against its definition, its cut, and the filtering stage on odd tables."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from llm_cases import DOCUMENTS, LABELS, MESSY, documents  # noqa: F401

from tapemill.llm import toxicity

CLEAN = ["the weather is mild and the harbour is calm today", "a short note on the history of the old mill"] * 60
TOXIC = ["you are a worthless moron and everyone knows it", "what a pathetic idiot this stupid person is"] * 30


def slow_logit(model, text):
    words = Counter("".join(c.lower() if c.isascii() else c for c in text).split())
    total = sum(math.sqrt(n) for n in words.values()) + toxicity.PAD
    logit = model.bias
    for word, n in words.items():
        marked = f"<{word}>"
        keys = ["=" + word] + [marked[i : i + k] for k in toxicity.GRAMS for i in range(len(marked) - k + 1)]
        buckets = [crc32(key.encode()) % (1 << toxicity.HASH_BITS) for key in keys]
        logit += math.sqrt(n) / total * sum(float(model.weights[b]) for b in buckets) / len(buckets)
    return logit


@pytest.fixture(scope="module")
def model():
    texts = [t for pair in zip(CLEAN, TOXIC + CLEAN) for t in pair]
    return toxicity.calibrated(texts, [int(t in TOXIC) for t in texts])


@pytest.mark.parametrize("text", ["", "the harbour", "Idiot idiot IDIOT calm", "idiott überall", "word " * 500, "a"])
def test_scorer_is_the_mean_of_word_vectors(model, text):
    logit = slow_logit(model, text)
    assert model.scorer().logit(text) == pytest.approx(logit, rel=1e-9, abs=1e-9)
    assert model.scorer().score(text) == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-9)


def test_cut_and_wordless_texts(model):
    scorer = model.scorer()
    assert all(scorer.score(t) >= toxicity.THRESHOLD for t in set(TOXIC))
    assert all(scorer.score(t) < toxicity.THRESHOLD for t in set(CLEAN))
    # A misspelling that was never seen shares most of its n-grams with the word.
    assert scorer.score("you are a worthles morron and everyone knows it") >= toxicity.THRESHOLD
    assert scorer.score("") == scorer.score(None) == scorer.score(" \n.!") < toxicity.THRESHOLD


def test_best_cut_keeps_most_clean_rows_and_is_low_within_an_error():
    logits = np.concatenate((np.linspace(-3, -1, 100), np.linspace(1, 3, 50)))
    labels = np.array([0] * 100 + [1] * 50)
    cut = toxicity.best_cut(logits, labels)
    assert (logits[labels == 0] < cut).mean() >= toxicity.LEAST_KEPT and (logits[labels == 1] >= cut).all()
    mixed = np.array([0, 1] * 100)
    cut = toxicity.best_cut(np.arange(200.0), mixed)
    assert (np.arange(200.0)[mixed == 0] < cut).mean() >= toxicity.LEAST_KEPT
    # All toxic rows below all clean ones: nothing can be caught, nothing clean goes.
    cut = toxicity.best_cut(np.arange(200.0), np.array([1] * 100 + [0] * 100))
    assert (np.arange(100.0, 200.0) < cut).mean() >= toxicity.LEAST_KEPT


def test_few_rows_or_one_class_are_trained_as_they_are():
    assert toxicity.calibrated([], []).bias == 0
    assert toxicity.calibrated(["a b", "c d"], [0, 0]).bias < 0
    assert toxicity.calibrated(["a b"] * 500, [1] * 500).bias > 0


def test_stage_on_odd_tables(spark, documents):  # noqa: F811
    """Empty tables, NULL and empty texts, repeated rows: kept or dropped by text alone, columns as they came."""
    known = [(1000 + k, t) for k, t in enumerate(CLEAN + TOXIC)]
    labels = spark.createDataFrame([(i, 1, int(t in TOXIC)) for i, t in known], LABELS)
    labelled = documents(*known)
    assert toxicity.without_toxic(spark.createDataFrame([], DOCUMENTS), labels, labelled).count() == 0
    given = [*MESSY, (50, TOXIC[0]), (50, TOXIC[0]), (None, TOXIC[1]), (51, CLEAN[0])]
    kept = toxicity.without_toxic(documents(*given), labels, labelled)
    assert kept.columns == DOCUMENTS.fieldNames()
    rows = Counter((r.doc_id, r.text) for r in kept.collect())
    assert all(rows[pair] == n for pair, n in Counter((i, t) for i, t in given if not (t or "").strip()).items())
    assert rows[(51, CLEAN[0])] == 1 and not any(t in TOXIC for _, t in rows)
    assert toxicity.without_toxic(documents(*given), spark.createDataFrame([], LABELS), labelled).count() == len(given)
