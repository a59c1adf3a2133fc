"""The as-of join against a scan for each row, and its plan."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.as_of import as_of_join, metadata_as_of
from tidemark.sources import feed

LEFT, RIGHT = "k string, at long, n int", "k string, since long, a string, b int"


def brute(left, right):
    out = []
    for k, at, n in left:
        known = [(since, a is not None, a or "", b) for rk, since, a, b in right if rk == k and since <= at]
        best = max(known, default=None)
        out.append((k, at, n, None, None, None) if best is None else (k, at, n, best[0], best[2] if best[1] else None, best[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,pieces", [(1, 1), (2, 5), (3, 200)])
def test_equals_a_scan(spark, seed, pieces):
    pick = random.Random(seed)

    def key():
        return "hot" if pick.random() < 0.4 else pick.choice("abcdef")

    left = [(key(), pick.randrange(-20, 100), n) for n in range(150)]
    right = [(key(), pick.randrange(-30, 90), pick.choice([None, "x", "y"]), pick.randrange(3)) for _ in range(60)]
    found = as_of_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "at", "since", pieces)
    assert sorted(map(tuple, found.collect()), key=str) == brute(left, right)


def test_empty_sides(spark):
    left, right = spark.createDataFrame([("a", 1, 1)], LEFT), spark.createDataFrame([], RIGHT)
    assert [tuple(r) for r in as_of_join(left, right, "k", "at", "since").collect()] == [("a", 1, 1, None, None, None)]
    assert as_of_join(left.limit(0), right, "k", "at", "since").collect() == []


def test_no_range_join(spark):
    left, right = spark.createDataFrame([("a", 1, 1)], LEFT), spark.createDataFrame([("a", 1, "x", 1)], RIGHT)
    plan = as_of_join(left, right, "k", "at", "since")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "hashpartitioning(_key" in plan and "_piece" in plan.split("hashpartitioning(_key")[1].split(")")[0]


def test_metadata_as_of(spark):
    changes = spark.createDataFrame([(1, 3, "r"), (1, 7, "r"), (2, 1, "r")], "id long, txn_id long, node_ref string")
    metadata = spark.createDataFrame([(1, 2, "old"), (1, 7, "new"), (2, 5, "later")], "id long, version long, type string")
    log = spark.createDataFrame([(i, i * 10) for i in range(1, 9)], "id long, commit_time_ms long")
    found = metadata_as_of(changes, metadata, log)
    assert sorted((r["id"], r["txn_id"], r["type"], r["stamp_ms"]) for r in found.collect()) == [(1, 3, "old", 30), (1, 7, "new", 70)]


@pytest.mark.parametrize("stretch", [4, 1 << 20])
def test_gaps_and_what_fills_them(spark, monkeypatch, stretch):
    monkeypatch.setattr(feed, "STRETCH", stretch)
    ids = [1, 2, 5, 6, 7, 21, 22, 30]
    log = spark.createDataFrame([(i, i * 100) for i in ids], "id long, commit_time_ms long")
    gaps = sorted(tuple(r) for r in feed.gaps_of(log).collect())
    assert gaps == [(3, 4, 5, 500), (8, 20, 21, 2100), (23, 29, 30, 3000)]
    assert sorted(tuple(r) for r in feed.gaps_of(log, 6).collect()) == gaps[1:]
    later = spark.createDataFrame([(i, 0) for i in (1, 4, 5, 8, 20, 21, 25, 31, 40)], "id long, commit_time_ms long")
    assert sorted(r["id"] for r in feed.late_transactions(later, feed.open_gaps(log)).collect()) == [4, 8, 20, 25]
    assert feed.late_transactions(later, feed.open_gaps(log.where("id < 3"))).collect() == []

    def mark(watermark, hold_back, now=None):
        return feed.settled_mark(log, watermark, hold_back, now).first()[0]

    assert (mark(0, 0), mark(0, 1), mark(0, 901), mark(0, 100_000), mark(7, 901), mark(5, 2501, 3000)) == (30, 22, 7, 2, 7, 7)
    assert mark(40, 100_000) == 40 and feed.settled_mark(log.where(F.lit(False)), 3, 5).first()[0] == 3
