"""Hard negatives against all pairs, and on odd tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from transitlake.llm import negatives


def brute(rows, every=100):
    """The contract over all pairs; rows are (vec_id, embedding, label)."""
    usable = set()
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.add((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, tuple(math.floor(256 * np.float32(x).astype(np.float64)) for x in v)))
    rank = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, label, a in usable:
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, b)), j, other == label) for j, other, b in usable if j != i]
        for positive, p, _ in sorted((s for s in scored if s[2]), key=rank)[:5]:
            near = [s for s in scored if not s[2] and 80 * positive <= 100 * s[0] <= 100 * positive]
            out += [(i, p, k + 1, n, positive, score) for k, (score, n, _) in enumerate(sorted(near, key=rank)[:5])]
    return sorted(out, key=repr)


def mined(spark, rows, width="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{width}>, label int").selectExpr("*", "'x' AS own", "1 AS length", "2 AS bucket")
    own = negatives.relabelled(negatives.usable(frame))
    return sorted(map(tuple, negatives.mine(own, own.where("vec_id % 100 = 0")).collect()), key=repr)


def vectors(rng, n, width, labels=4, stretch=0.0):
    centres = rng.normal(size=(labels, width))
    label = rng.integers(0, labels, n)
    x = (0.7 * centres[label] + rng.normal(size=(n, width))) * np.exp(stretch * rng.normal(size=(n, 1)))
    return [(i, [float(np.float32(c)) for c in v], int(k)) for i, (v, k) in enumerate(zip(x, label))]


@pytest.mark.parametrize("stretch", [0.0, 1.5])
def test_all_pairs(spark, stretch):
    rows = vectors(np.random.default_rng(4), 1500, 12, stretch=stretch)
    expected = brute(rows)
    assert len(expected) > 60 and mined(spark, rows) == expected


def test_small_buckets_and_samples(spark, monkeypatch):
    """Far more vectors than the sample, many buckets, one or all coordinates in focus: the same rows."""
    rows = vectors(np.random.default_rng(6), 900, 9, stretch=0.6)
    expected = brute(rows)
    for focus, sample, stretch in ((1, 10, 1.05), (9, 1, 4.0)):
        monkeypatch.setattr(negatives, "FOCUS", focus)
        monkeypatch.setattr(negatives, "SAMPLE", sample)
        monkeypatch.setattr(negatives, "STRETCH", stretch)
        assert mined(spark, rows) == expected


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    rows = vectors(rng, 250, 5)
    rows += [(300 + i, list(rows[100][1]), rows[100][2] if i % 2 else 9) for i in range(30)]  # ties, and no room for all of them
    rows += [rows[3], rows[100], (100, rows[101][1], 2), (None, rows[4][1], 1), (None, rows[5][1], 2), (400, [0.0] * 5, 1), (402, [0.0] * 5, 2)]
    rows += [(500, None, 1), (501, [None] * 5, 1), (502, [float("nan")] * 5, 1), (600, [1.0] * 5, None), (601, [float("-inf")] * 5, 2)]
    rows += [(700, [1.0, 2.0], 1), (701, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0], 2), (800, [], 1), (801, [], 3)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, rows[1:5]) == [] and mined(spark, [(500, None, 1)]) == []


def test_large_numbers_are_exact(spark):
    """Products beyond the whole numbers that doubles hold."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in 1e5 * rng.normal(size=3) + 3e5], int(i % 2)) for i in range(250)]
    wide = [(i, [x + 1 / 256 for x in v], k) for i, v, k in rows]
    frame = spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int")
    own = negatives.usable(frame)
    got = sorted(map(tuple, negatives.mine(own, own.where("vec_id % 100 = 0")).collect()), key=repr)
    whole = {i: ([math.floor(256 * x) for x in v], k) for i, v, k in wide}
    assert got and all(ps == sum(x * y for x, y in zip(whole[a][0], whole[p][0])) for a, p, _, n, ps, ns in got)
    assert all(ns == sum(x * y for x, y in zip(whole[a][0], whole[n][0])) and 80 * ps <= 100 * ns <= 100 * ps for a, p, _, n, ps, ns in got)


def test_ranges_hold_every_vector_above_the_least_cosine():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.normal(size=(2, 4))
        a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
        low, high = negatives.feasible(a, float(a @ b))
        assert ((low <= b) & (b <= high)).all()


def test_candidates_are_pruned():
    """Clusters of vectors of one length: the ranges leave a small part of a bucket."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = centres[np.arange(2000) % 20] * 4 + rng.normal(size=(2000, 16))
    own = np.floor(2560 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    bucket = negatives.Bucket(np.arange(2000), np.zeros(2000, np.int64), own)
    scores = own @ own[0]
    least = float(np.sort(scores)[-20])
    rows = bucket.candidates(own[0], least)
    assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist()) and len(rows) < 400
