"""Hard negatives against plain inner products."""

import math

import numpy as np
import pytest

from tapemill.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, mark string, id string, planes string, anchor string"


def slow(rows):
    taken = []
    for vec_id, values, label in rows:
        if label is None or values is None or any(v is None or not math.isfinite(v) for v in values):
            continue
        if any(abs(v) >= hard_negatives.LARGEST for v in values):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        taken.append((vec_id, label, [math.floor(256 * float(np.float32(v))) for v in values]))
    key = lambda id_: (id_ is None, id_ or 0)
    out = []
    for n, (anchor, label, a) in enumerate(taken):
        if anchor is None or anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), key(i), i, own == label) for k, (i, own, v) in enumerate(taken) if k != n]
        scored.sort(key=lambda s: s[:2])
        for neg, _, positive, _ in [s for s in scored if s[3]][:5]:
            p = -neg
            fit = [s for s in scored if not s[3] and 30 * p <= 100 * -s[0] <= 90 * p][:10]
            out += [(anchor, positive, rank, s[2], p, -s[0]) for rank, s in enumerate(fit, 1)]
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def random_rows(n, dims, seed, scale=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, scale, (4, dims))
    return [(i, [float(np.float32(x)) for x in centres[i % 4] + rng.normal(0, scale, dims)], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("dims, scale", [(16, 0.3), (5, 40.0), (64, 3000.0)])
def test_random_vectors(spark, monkeypatch, dims, scale):
    """Several blocks of anchors; components of one to many bits, dimensions that are no multiple of eight."""
    monkeypatch.setattr(hard_negatives, "MOST_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "ROWS_AT_A_TIME", 37)
    monkeypatch.setattr(hard_negatives, "PAIRS_PER_TASK", 1 << 9)
    rows = random_rows(410, dims, dims, scale)
    frame = spark.createDataFrame([(*r, "m", "i", "p", "a") for r in rows], SCHEMA)
    assert got(hard_negatives.hard_negatives(frame)) == slow(rows) != []


def test_messy_vectors(spark):
    rows = random_rows(260, 8, 1)
    base = rows[0][1]
    rows += [
        (0, base, rows[0][2]), (300, base, 1), (300, base, 1), (None, base, rows[0][2]), (None, base, 3), (700, None, 1),
        (701, base, None), (702, [None] * 8, 1), (703, [float("nan")] * 8, 1), (704, [float("inf")] * 8, 1), (705, [], 2),
        (706, base[:3], 2), (-100, base, 2), (800, [1e9] * 8, 1), (707, base, rows[0][2]), (708, base, rows[0][2]),
    ]
    frame = spark.createDataFrame([(*r, "m", "i", "p", "a") for r in rows], SCHEMA)
    assert got(hard_negatives.hard_negatives(frame)) == slow(rows)


def test_many_equal_vectors(spark):
    """A third of all rows is one vector: ties go by id, all in whole."""
    rows = random_rows(300, 8, 2)
    rows += [(1000 + i, rows[100][1], (rows[100][2] + 1) % 4) for i in range(150)]
    frame = spark.createDataFrame([(*r, "m", "i", "p", "a") for r in rows], SCHEMA)
    assert got(hard_negatives.hard_negatives(frame)) == slow(rows)


def test_none(spark):
    assert got(hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA))) == []
    frame = spark.createDataFrame([(1, [1.0], 1, "", "", "", "")], SCHEMA)
    assert got(hard_negatives.hard_negatives(frame)) == []


def test_planes_round_trip():
    units = np.array([[-300, 299, 0, -1, 1, 5, -256, 255]])
    planes = hard_negatives.pack(units, 10)
    assert planes.shape == (1, 10, 1) and (hard_negatives.unpack(planes) == units).all()
    block = hard_negatives.Anchors(units, np.array([0]), np.array([0]), 10)
    assert hard_negatives.scores(block.tables(), planes).tolist() == [[int((units * units).sum())]]
