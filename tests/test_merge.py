"""Upsert, delete and text update against the sequential model; the stored index against the whole-table merge."""

import random

import pytest

from replay import Index
from tidemark.operators import merge
from tidemark.schemas import DOCUMENT_COLUMNS
from tidemark.sinks.control import CommitConflict
from tidemark.sinks.index_store import IndexStore
from tidemark.sinks.snapshot import slice_of

NET = "uuid string, op string, reset boolean, type string, owner string, last_update_ms long, fields map<string,string>"


def random_batches(seed, batches=4, keys=25, size=14):
    rng = random.Random(seed)
    out = []
    for _ in range(batches):
        rows = []
        for key in rng.sample(range(keys), size):
            if rng.random() < 0.25:
                rows.append((f"k{key}", "delete", True, None, None, None, None))
            else:
                fields = {f"f{rng.randrange(4)}": rng.choice([None, str(rng.randrange(9))]) for _ in range(rng.randrange(4))}
                rows.append((f"k{key}", "upsert", rng.random() < 0.15, f"t{rng.randrange(3)}",
                             rng.choice([None, f"o{rng.randrange(3)}"]), rng.randrange(5), fields))
        out.append(rows)
    return out


def modelled(batches, mode):
    index = Index()
    for rows in batches:
        for uuid, op, reset, kind, owner, stamp, fields in rows:
            if op == "delete" or reset:
                index.delete(uuid)
            if op == "upsert":
                index.upsert(uuid, stamp, {"type": kind}, {"owner": owner} if owner is not None else {}, fields, mode)
    return {
        u: (d["always"]["type"], d["optional"].get("owner"), d["stamp"], d["fields"]) for u, d in index.items()
    }


def empty_documents(spark):
    columns = ", ".join(f"{c} {kind}" for c, kind in DOCUMENT_COLUMNS.items())
    return spark.createDataFrame([], f"uuid string, {columns}")


def collected(index):
    return {r["uuid"]: (r["type"], r["owner"], r["last_update_ms"], r["fields"]) for r in index.collect()}


@pytest.mark.parametrize("seed,mode", [(0, "partial"), (2, "replace")])
def test_apply_changes_equals_replay(spark, seed, mode):
    batches = random_batches(seed, batches=3)
    index = empty_documents(spark)
    for rows in batches:
        index = merge.apply_changes(index, spark.createDataFrame(rows, NET), mode)
    assert collected(index) == modelled(batches, mode)


def applied(store, spark, rows, mark, mode="partial"):
    net = spark.createDataFrame(rows, NET).withColumn("slice", slice_of("uuid", store.slices))
    slices = [r[0] for r in net.select("slice").distinct().collect()]
    store.write("meta", merge.apply_changes(store.read("meta", slices), net, mode), slices)
    store.commit(mark)


@pytest.mark.parametrize("seed", [3])
def test_store_equals_replay(spark, tmp_path, seed):
    batches = random_batches(seed)
    store = IndexStore(spark, str(tmp_path / "index"), slices=4, buckets=2).ensure()
    for i, rows in enumerate(batches):
        applied(store, spark, rows, i + 1)
        assert collected(store.read("meta")) == modelled(batches[: i + 1], "partial")
    assert store.watermark() == len(batches)
    # Replaying the last batch is harmless.
    applied(store, spark, batches[-1], len(batches))
    assert collected(store.read("meta")) == modelled(batches + batches[-1:], "partial")


def test_a_slice_left_without_documents_is_empty(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), slices=2, buckets=2).ensure()
    rows = [(f"k{i}", "upsert", False, "t", None, 1, {"a": str(i)}) for i in range(20)]
    applied(store, spark, rows, 1)
    assert len(collected(store.read("meta"))) == 20
    applied(store, spark, [(f"k{i}", "delete", True, None, None, None, None) for i in range(20)], 2)
    assert collected(store.read("meta")) == {}


def test_a_batch_rewrites_its_slices_only(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "index"), slices=8, buckets=2).ensure()
    applied(store, spark, [(f"k{i}", "upsert", False, "t", None, 1, {}) for i in range(100)], 1)

    def files():
        return {str(f) for f in (tmp_path / "index" / "meta").rglob("*.parquet")}

    before = files()
    applied(store, spark, [("k7", "upsert", False, "u", None, 2, {})], 2)
    assert {f.split("slice=")[1][0] for f in before ^ files()} == {str(spark.range(1).select(slice_of(merge.F.lit("k7"), 8)).first()[0])}
    assert collected(store.read("meta"))["k7"][0] == "u" and len(collected(store.read("meta"))) == 100


def test_the_index_side_is_not_shuffled(spark, tmp_path):
    """Neither a merge nor the whole index has an exchange above a snapshot; a merge reads it once."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = IndexStore(spark, str(tmp_path / "index"), slices=4, buckets=8).ensure()
        applied(store, spark, [(f"k{i}", "upsert", False, "t", None, 1, {}) for i in range(100)], 1)
        whole = store.index()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in whole and "SortMergeJoin" in whole
        net = spark.createDataFrame(random_batches(1)[0], NET)
        merged = merge.apply_changes(store.read("meta", [0, 1]), net)._jdf.queryExecution().executedPlan().toString()
        assert merged.count("Exchange hashpartitioning") == 1 and merged.count("FileScan") == 1
        assert "slice" in merged.split("PartitionFilters: [")[1].split("]")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_stamp_guard(spark):
    index = merge.conform(spark.createDataFrame([("a", "old", 10, {"x": "1"})], "uuid string, type string, last_update_ms long, fields map<string,string>"))
    for stamp, kind in ((9, "old"), (10, "new"), (11, "new"), (None, "new")):
        docs = merge.conform(spark.createDataFrame([("a", "new", stamp, {"y": None})], "uuid string, type string, last_update_ms long, fields map<string,string>"))
        row = merge.apply_upserts(index, docs).first()
        assert row["type"] == kind
        assert row["fields"] == ({"x": "1"} if kind == "old" else {"x": "1", "y": None})


def test_absent_fields_survive_and_nulls_overwrite(spark):
    schema = "uuid string, parents array<string>, aspects array<string>, owner string, content_info struct<mimetype:string,size:string,encoding:string>, fields map<string,string>"
    old = merge.conform(spark.createDataFrame([("a", ["p"], ["x"], "me", ("text", "1", "U"), {"k": "1", "n": "2"})], schema))
    new = merge.conform(spark.createDataFrame([("a", None, None, None, (None, "2", "U"), {"n": None})], schema))
    row = merge.apply_upserts(old, new).first()
    assert (row["parents"], row["aspects"], row["owner"]) == (["p"], None, "me")
    assert tuple(row["content_info"]) == (None, "2", "U") and row["fields"] == {"k": "1", "n": None}
    row = merge.apply_upserts(old, new, "replace").first()
    assert (row["parents"], row["owner"], row["fields"]) == (None, None, {"n": None})


def test_merge_mode_is_checked(spark):
    with pytest.raises(ValueError):
        merge.apply_upserts(empty_documents(spark), empty_documents(spark), "other")


def test_delete(spark):
    index = spark.createDataFrame([("a",), ("b",)], "uuid string")
    gone = spark.createDataFrame([("b",), ("c",)], "uuid string")
    assert [r[0] for r in merge.apply_deletes(index, gone).collect()] == ["a"]


def test_apply_content(spark):
    index = spark.createDataFrame(
        [("a", "1", "one"), ("b", None, None), ("c", "3", "three")], "uuid string, content_id string, content_text string"
    )
    content = spark.createDataFrame(
        [("a", "2", "two"), ("b", "4", ""), ("z", "9", "never inserted")], "uuid string, content_id string, content_text string"
    )
    assert sorted(map(tuple, merge.apply_content(index, content).collect()), key=str) == [
        ("a", "2", "two"), ("b", None, None), ("c", "3", "three")
    ]


def test_control_row(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"), 2, 2)
    assert store.watermark() == 0 and not store.exists() and store.head() is None
    store.ensure(create_index=False, create_control=False)
    assert store.head() is None and not store.exists()
    store.ensure(create_index=False)
    assert store.head()["last_txn_id"] == 0 and not store.exists()
    store.ensure()
    assert store.exists() and store.read("meta").count() == 0 and store.index().count() == 0
    store.commit(7)
    store.commit(5)
    assert store.watermark() == 7
    assert IndexStore(spark, str(tmp_path / "s")).ensure().watermark() == 7


def test_the_second_of_two_writers_fails(spark, tmp_path):
    one = IndexStore(spark, str(tmp_path / "s"), 2, 2).ensure(create_index=False)
    two = IndexStore(spark, str(tmp_path / "s"))
    one.commit(3)
    with pytest.raises(CommitConflict):
        two.commit(4)
    assert IndexStore(spark, str(tmp_path / "s")).watermark() == 3
    assert two.refresh()["last_txn_id"] == 3
    two.commit(4)
    assert one.refresh()["last_txn_id"] == 4


def test_progress_is_kept_for_each_stream(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"), 2, 2).ensure(create_index=False)
    store.commit(1, ("a", 0))
    store.commit(2, ("b", 5))
    store.commit(3)
    assert store.has_applied("a", 0) and not store.has_applied("a", 1)
    assert store.has_applied("b", 5) and not store.has_applied("c", 0)


def test_old_commits_go(spark, tmp_path, monkeypatch):
    store = IndexStore(spark, str(tmp_path / "s"), 2, 2).ensure(create_index=False)
    monkeypatch.setattr(IndexStore, "KEPT", 2)
    for i in range(1, 6):
        store.commit(i)
    assert len(list((tmp_path / "s" / "commits").iterdir())) == 2 and IndexStore(spark, str(tmp_path / "s")).watermark() == 5


def test_unfinished_commit_is_not_seen(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"), 2, 2).ensure()
    (tmp_path / "s" / "commits" / "c=1" / "_temporary").mkdir(parents=True)
    assert IndexStore(spark, str(tmp_path / "s")).head()["commit_id"] == 0
    store.commit(3)
    assert IndexStore(spark, str(tmp_path / "s")).watermark() == 3


def test_the_layout_is_fixed_at_creation(spark, tmp_path):
    IndexStore(spark, str(tmp_path / "s"), 4, 2).ensure()
    again = IndexStore(spark, str(tmp_path / "s"), 9, 9)
    assert (again.slices, again.buckets) == (4, 2)


def test_a_store_is_found_by_another_catalog(spark, tmp_path):
    store = IndexStore(spark, str(tmp_path / "s"), 4, 2).ensure()
    applied(store, spark, [("k1", "upsert", False, "t", None, 1, {})], 1)
    for snapshot in store._families.values():
        spark.sql(f"drop table {snapshot.table}")
    assert list(collected(IndexStore(spark, str(tmp_path / "s")).read("meta"))) == ["k1"]
