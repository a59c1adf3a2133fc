"""Shards against a plain ranking of all rows."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding

SCHEMA = "doc_id long, text string, source string"


def brute(rows, shards, seed=42):
    """Sorted (id, size, crc, shard, slot)."""
    thin = []
    for doc_id, text, source in rows:
        data = (text or "").encode()
        key = hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        thin.append((doc_id, source, key, zlib.crc32(data), len(data) + 16))
    by_source = {}
    for row in thin:
        by_source.setdefault(row[1], []).append(row)
    placed = []
    for source, own in by_source.items():
        own.sort(key=lambda r: r[2:])
        placed += [((2 * k + 1) / (2 * len(own)), source is not None, source or "", *r[2:], r[0]) for k, r in enumerate(own)]
    placed.sort(key=lambda r: r[:-1])
    n, out, slots = len(placed), [], Counter()
    for place, (*_, crc, size, doc_id) in enumerate(placed):
        shard = place * shards // n
        out.append((doc_id, size, crc, shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=str)


def found(spark, rows, shards, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in sharding.assign(docs, shards, **options).select("id", "size", "crc", "shard", "slot").collect()), key=str)


def corpus(seed, many=300):
    pick = random.Random(seed)
    rows = [(i, pick.choice(["", "é" * pick.randrange(9), "text " * pick.randrange(30)]),
             "hot" if pick.random() < 0.4 else pick.choice(["a", "b", None, ""])) for i in range(many)]
    return rows + rows[:20] + [(None, None, "hot"), (None, None, None), (7, None, "a"), (7, "other", "a")]


@pytest.mark.parametrize("seed,shards", [(1, 40), (2, 7), (3, 1)])
def test_places(spark, seed, shards):
    rows = corpus(seed)
    assert found(spark, rows, shards) == brute(rows, shards)


def test_counts_and_mixture(spark):
    rows = [(i, "x", "hot" if i % 3 else f"s{i % 4}") for i in range(1200)]
    docs = sharding.assign(spark.createDataFrame(rows, SCHEMA), 10)
    shards = Counter((r["shard"], r["source"]) for r in docs.collect())
    whole = Counter(source for *_, source in rows)
    for shard in range(10):
        assert sum(n for (s, _), n in shards.items() if s == shard) == 120
        assert all(abs(shards[shard, source] - whole[source] / 10) <= 1 for source in whole)


def test_fewer_rows_than_shards_and_none(spark):
    rows = [(i, "x", "a") for i in range(3)]
    assert found(spark, rows, 40) == brute(rows, 40)
    assert found(spark, [], 40) == []


def test_other_columns_do_not_clash(spark):
    rows = corpus(5, 40)
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "row", "part", "at", "mark", "key", "shard", "slot", "size", "crc", "n", "fraction", "p"):
        docs = docs.withColumn(name, F.lit("other"))
    got = sharding.assign(docs, 4).select("id", "size", "crc", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 4)


def test_files(spark, tmp_path):
    rows = corpus(6, 60)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.lit(1))
    sharding.write_shards(docs, str(tmp_path / "shards"), 5, seed=3)
    held = spark.read.parquet(str(tmp_path / "shards")).collect()
    got = [(r["row"]["doc_id"], len((r["row"]["text"] or "").encode()) + 16, zlib.crc32((r["row"]["text"] or "").encode()), r["shard"], r["slot"]) for r in held]
    assert sorted(got, key=str) == brute(rows, 5, 3)
    assert sorted(((r["row"]["doc_id"], r["row"]["text"], r["row"]["source"]) for r in held), key=str) == sorted(rows, key=str)
