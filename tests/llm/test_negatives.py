"""Packed products and mined negatives against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("width,bias", [(1, 1), (7, 300), (64, 200), (64, 40_000), (3, 1_000_000_000)])
def test_packed_scores_are_exact(width, bias):
    pick = np.random.default_rng(width)
    rows = pick.integers(-bias + 1, bias, (37, width))
    rows[0], rows[1], rows[2] = bias - 1, -bias + 1, 0
    packed = hn.Packed(rows, bias)
    for anchor in (*rows[:4], *pick.integers(-bias + 1, bias, (3, width))):
        want = [sum(int(a) * int(b) for a, b in zip(anchor, row)) for row in rows]
        assert packed.scores(anchor).tolist() == want


def brute(rows, positives=5, negatives=3):
    taken = {}
    for vec_id, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and np.isfinite(np.float32(x)) for x in vector):
            taken[vec_id, label, tuple(np.float32(x) for x in vector)] = None
    held = [(i, label, [int(np.floor(256 * np.float64(x))) for x in v]) for i, label, v in taken]
    out = []
    for i, label, v in held:
        if i is None or i % 50:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, other) for j, other, w in held if j != i or other != label))
        for p in [s for s in scored if s[3] == label][:positives]:
            fits = [s for s in scored if s[3] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]][:negatives]
            out += [(i, None if p[1] else p[2], k, None if n[1] else n[2], -p[0], -n[0]) for k, n in enumerate(fits, 1)]
    return sorted(out, key=str)


def found(spark, rows, schema=SCHEMA):
    df = rows if hasattr(rows, "schema") else spark.createDataFrame(rows, schema)
    return sorted((tuple(r) for r in hn.hard_negatives(df, F.col("id") % 50 == 0).collect()), key=str)


def vectors(seed, many=260):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + pick.gauss(0, 0.6) for c in centres[i % 4]], pick.choice([i % 4, i % 3])) for i in range(many)]
    # ties: many copies of one vector under two labels
    rows += [(1000 + i, [0.5] * 6, i % 2) for i in range(80)]
    return rows


@pytest.mark.parametrize("blocks", [(4096, 32768, 1024), (2, 30, 10)])
def test_all_pairs(spark, monkeypatch, blocks):
    for name, value in zip(("ANCHORS", "ROWS", "LEAST_ROWS"), blocks):
        monkeypatch.setattr(hn, name, value)
    rows = vectors(1)
    assert found(spark, rows) == brute(rows) and len(brute(rows)) > 20


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(2, 120) + [
        (None, [0.4] * 6, 0), (None, [0.45] * 6, 1), (50, None, 1), (51, [0.1] * 6, None), (52, [nan] * 6, 0), (53, [inf, 0.0, 0.0], 0),
        (54, [None, 1.0], 0), (55, [], 0), (56, [0.5, 0.5], 1), (100, [0.3] * 6, 3)]
    rows += rows[:30] + [(-50, [0.5] * 6, 0), (0, [0.0] * 6, 1)]
    assert found(spark, rows) == brute(rows)
    extra = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "row", "vector", "a", "c", "score", "nth", "n"):
        extra = extra.withColumn(name, F.lit("other"))
    assert found(spark, extra) == brute(rows)


def test_empty_and_too_large(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1)]) == []
    with pytest.raises(ValueError, match="fit a long"):
        found(spark, [(1, [1e30], 1)])
