"""A stream of events that carry their fields against one batch, in several splits."""

import random

import pytest

from test_net_state import SCHEMA, random_feed
from replay import replay_fields
from tidemark.sinks.event_store import EventStore
from tidemark.sources import feed
from tidemark.streaming.index_stream import stream_events

ORDER = {"txn_id": "bigint", "feed_pos": "bigint"}


def make_store(spark, tmp_path):
    return EventStore(spark, str(tmp_path / "index"), ORDER, slices=2, buckets=2)


def expected(events):
    return {u: fields for u, (op, _, fields) in replay_fields([(e[2], e[3] == "d", e[4]) for e in events]).items() if op == "upsert"}


def fields_of(store):
    return {r["uuid"]: r["fields"] for r in store.documents().collect()}


@pytest.mark.parametrize("cuts", [[], [9], [3, 20]])
def test_any_split_gives_the_same_index(spark, tmp_path, cuts):
    events = random_feed(41)
    rows = feed.routed(spark.createDataFrame(events, SCHEMA))
    store = make_store(spark, tmp_path)
    edges = [-1, *cuts, events[-1][0]]
    for low, high in zip(edges, edges[1:]):
        store.apply(rows.where(f"txn_id > {low} and txn_id <= {high}"), high)
    assert fields_of(store) == expected(events) and store.watermark() == events[-1][0]


def test_stream(spark, tmp_path):
    events = [(e[0] + 1, *e[1:]) for e in random_feed(42)]
    rows = feed.routed(spark.createDataFrame(events, SCHEMA))
    folder = str(tmp_path / "feed")
    middle = events[-1][0] // 2
    rows.where(f"txn_id <= {middle}").coalesce(1).write.mode("append").parquet(folder)
    store = make_store(spark, tmp_path)

    def run():
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        stream_events(source, store, str(tmp_path / "checkpoint"), seconds=None).awaitTermination()

    run()
    assert fields_of(store) == expected([e for e in events if e[0] <= middle])
    # The rest arrives, with events below the mark among it: they are put in their place.
    late = [(1, 10_000, "late", "u", {"x": "1"}, 1), (1, 10_001, "hot", "u", {"f0": "too old", "only": "late"}, 1), (1, 10_002, "k1", "d", None, 1)]
    events = sorted(events + late, key=lambda e: e[:2])
    both = rows.where(f"txn_id > {middle}").unionByName(feed.routed(spark.createDataFrame(late, SCHEMA)))
    both.coalesce(1).write.mode("append").parquet(folder)
    run()
    assert fields_of(store) == expected(events) and "late" in fields_of(store)


@pytest.mark.parametrize("seed", [7, 8])
def test_any_order_and_repetition_gives_the_same_states(spark, tmp_path, seed):
    events = random_feed(seed)
    pick = random.Random(seed)
    shuffled = pick.sample(events, len(events))
    store = make_store(spark, tmp_path)
    for part in (shuffled[120:], shuffled[:70], shuffled[50:130]):
        store.apply(feed.routed(spark.createDataFrame(part, SCHEMA)), max(e[0] for e in part))
    assert fields_of(store) == expected(events) and store.watermark() == events[-1][0]
    # deletes are kept as places, and writes before them are not
    last = {e[2]: e[:2] for e in events if e[3] == "d"}
    for row in store.states().collect():
        assert (tuple(row["last_delete"]) if row["last_delete"] else None) == last.get(row["uuid"])
        assert all(row["last_delete"] is None or w["seq"] > row["last_delete"] for w in row["writes"].values())


def test_a_transaction_goes_on_in_the_next_files(spark, tmp_path):
    events = [(e[0] + 1, *e[1:]) for e in random_feed(43)]
    rows = feed.routed(spark.createDataFrame(events, SCHEMA))
    folder, middle = str(tmp_path / "feed"), events[len(events) // 2][0]
    place = events[len(events) // 2][1]
    first = f"txn_id < {middle} or (txn_id = {middle} and feed_pos < {place})"
    for part in (first, f"not ({first})"):
        rows.where(part).coalesce(1).write.mode("append").parquet(folder)
    store = make_store(spark, tmp_path)
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stream_events(source, store, str(tmp_path / "checkpoint"), seconds=None).awaitTermination()
    assert fields_of(store) == expected(events)


def test_feed_files_hold_bounded_rows(spark, tmp_path, monkeypatch):
    """Stragglers and ranges are written by as many tasks as their rows ask for, whatever their number."""
    from pyspark.sql import functions as F

    from tidemark.plans import workload

    late = F.col("id") % 2 == 0
    spark.range(400).select(
        F.when(late, F.col("id") * 50 + 6).otherwise(F.col("id") * 50).alias("l_orderkey"), (F.col("id") % 20).alias("l_partkey"),
        F.lit(1).alias("l_linenumber"), F.lit(1).cast("bigint").alias("l_suppkey"),
        *[F.col("id").cast("double").alias(f"l_{c}") for c in ("quantity", "extendedprice", "discount", "tax")],
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit("2020-01-01").cast("timestamp").alias("l_shipdate"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(workload, "FILE_ROWS", 60)
    monkeypatch.setattr(workload, "new_folder", lambda spark, name: f"{tmp_path}/{name}")
    found = {r["uuid"]: r["quantity"] for r in workload.stream_net_state(spark, str(tmp_path)).collect()}
    assert found == {f"p-{k}": 380.0 + k for k in range(20)}
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/stream/feed").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 90
