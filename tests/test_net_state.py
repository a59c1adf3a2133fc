"""The fold of a feed against a sequential replay."""

import random

import pytest
from pyspark.errors import PySparkException

from replay import replay_fields
from tidemark.operators.net_state import latest_changes, latest_value, net_state
from tidemark.sources import feed

SCHEMA = "txn_id long, feed_pos long, uuid string, status string, fields map<string,string>, id long"


def random_feed(seed, rows=200, keys=12, hot=0.34):
    rng = random.Random(seed)
    events = []
    for pos in range(rows):
        uuid = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        if rng.random() < 0.2:
            events.append((pos // 7, pos, uuid, "d", None, pos))
        else:
            fields = {f"f{rng.randrange(5)}": rng.choice([None, "", str(rng.randrange(9))]) for _ in range(rng.randrange(4))}
            events.append((pos // 7, pos, uuid, "u", fields if rng.random() < 0.9 else None, pos))
    return events


@pytest.mark.parametrize("seed", range(6))
def test_equals_replay(spark, seed):
    events = random_feed(seed)
    shuffled = random.Random(seed + 100).sample(events, len(events))
    net = net_state(feed.routed(spark.createDataFrame(shuffled, SCHEMA)), "uuid", ["txn_id", "feed_pos"])
    got = {r["uuid"]: (r["op"], r["reset"], r["fields"]) for r in net.collect()}
    assert got == replay_fields([(e[2], e[3] == "d", e[4]) for e in events])


@pytest.mark.parametrize("seed", range(3))
def test_latest_changes(spark, seed):
    events = random_feed(seed)
    rows = feed.routed(spark.createDataFrame(events, SCHEMA))
    got = {r["uuid"]: (r["op"], r["reset"], r["id"]) for r in latest_changes(rows, "uuid", ["txn_id", "feed_pos"], ["id"]).collect()}
    replayed = replay_fields([(e[2], e[3] == "d", None) for e in events])
    last = {}
    for e in events:
        if e[3] == "u":
            last[e[2]] = e[5]
    assert got == {u: (op, reset, last.get(u)) for u, (op, reset, _) in replayed.items()}


def test_latest_value_keeps_null(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, n int, v string")
    assert {r["k"]: r["v"] for r in latest_value(rows, ["k"], ["n"], "v").collect()} == {"a": None, "b": "y"}


@pytest.mark.parametrize("status", ["x", None, "U"])
def test_unknown_status(spark, status):
    rows = spark.createDataFrame([(1, "u"), (2, status)], "id int, status string")
    with pytest.raises(PySparkException, match="no known status"):
        feed.routed(rows).collect()
    assert [r["id"] for r in feed.routed(rows, on_error="reject").collect()] == [1]
