"""The trie against a plain dictionary of all prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as pt
from tidemark.llm.queries import with_shared_starts

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            held.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in held.items()}


def rebuilt(held):
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        out[c] = held.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    rows = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        leaves = sum(not any(q[:-1] == p for q in nodes if q) for p in below)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(convs[c]) == len(prefix)))
        rows.append((min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members),
                     sum(q[:-1] == prefix for q in nodes if q), leaves,
                     sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(spark, rows, schema=SCHEMA, shared=True):
    df = rows if hasattr(rows, "schema") else spark.createDataFrame(rows, schema)
    turns = pt.turns_of(df)
    return sorted((tuple(r) for r in pt.prefix_trie(with_shared_starts(turns) if shared else turns).collect()), key=str)


def conversations(seed, many=120, hot=0.35):
    pick = random.Random(seed)
    rows = []
    for c in range(many):
        at = pick.randrange(-150, 400)
        if pick.random() < hot:
            turns = [("user", "hot"), ("bot", "answer é")] + [("user", "x")] * pick.randrange(3)
        else:
            turns = [(pick.choice(["user", "bot", None]), pick.choice(["a", "b", "hot", None, "long " * 20])) for _ in range(pick.randrange(1, 9))]
        rows += [(at, None if n == 0 and pick.random() < 0.3 else n, *t) for n, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed,blocks", [(1, 2), (2, 9), (3, 40)])
def test_all_prefixes(spark, seed, blocks):
    rows = conversations(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(blocks))
    try:
        got = found(spark, rows)
        assert got == brute(rebuilt(sequences(rows)))
        assert found(spark, rows, shared=False) == brute(sequences(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_over_many_partitions_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 3)
    monkeypatch.setattr(pt, "SEQUENCES", 10)
    rows = [(c, n, "user", t) for c in range(90) for n, t in enumerate(["same", "turns"])] + [(200, 0, "user", "same"), (300, 0, "bot", "same")]
    assert found(spark, rows, shared=False) == brute(sequences(rows))


def test_a_long_conversation_and_its_copy(spark):
    rows = [(c, n, "user", str(n % 7)) for c in (1, 2) for n in range(400)] + [(3, n, "user", str(n % 7)) for n in range(250)]
    convs = sequences(rows)
    got = {r[1]: r for r in found(spark, rows, shared=False)}
    assert len(got) == 401 and got[250][3:6] == (3, 1, 1) and got[251][3:6] == (2, 1, 1) and got[400][4:6] == (0, 1)
    assert got[0][6] == sum((3 if n < 250 else 2) - 1 for n in range(400)) and len(convs) == 3


def test_odd_rows(spark):
    assert found(spark, []) == []
    # no base, and fewer turns than are replaced: nothing is left, still a member of the root
    rows = [(c, 0, "user", "x") for c in (101, 102, 103, 104, 105, 106)] + [(None, 0, "user", "x"), (5, 0, None, None), (5, 0, None, None)]
    assert found(spark, rows) == brute(rebuilt(sequences(rows)))
    extra = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "token", "chars", "base", "h", "key", "depth"):
        extra = extra.withColumn(name, F.lit("other"))
    assert found(spark, extra) == brute(rebuilt(sequences(rows)))


def test_common_turns():
    a = bytes(range(160))
    for n in range(11):
        b = a[: 16 * n] + b"\xff" * 32
        assert pt.common(a, b) == min(n, 10) == pt.common(b, a)
    assert pt.common(b"", a) == 0 and pt.common(a, a) == 10
