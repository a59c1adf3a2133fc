"""Plans that must hold at scale: what reaches the scan, what is broadcast, what is shuffled."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookups
from tidemark.operators.enrich import attach_readers
from tidemark.operators.net_state import _dealt, latest_changes, net_state
from tidemark.sources import feed


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def log(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") * 10).alias("commit_time_ms"), F.lit("x").alias("unused"))
    rows.write.parquet(str(tmp_path / "log"))
    return spark.read.parquet(str(tmp_path / "log"))


def test_page_is_pushed_down(log):
    plan = plan_of(feed.pending_transactions(log, 499, 100))
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(id,500)" in plan


def test_bounds_read_two_columns(log):
    plan = plan_of(feed.page_bounds(log, 499))
    assert "ReadSchema: struct<id:bigint>" in plan and "unused" not in plan


def test_range_is_pushed_down(log):
    plan = plan_of(feed.changes_between(log.withColumnRenamed("id", "txn_id"), 5, 9))
    assert "GreaterThanOrEqual(id,5)" in plan and "LessThanOrEqual(id,9)" in plan


def events(spark):
    return spark.range(100).select(
        F.lit("hot").alias("uuid"), (F.col("id") % 5 == 0).alias("is_delete"), "id",
        F.create_map(F.lit("a"), F.col("id").cast("string")).alias("fields"),
    )


def test_folds_aggregate_before_the_shuffle(spark):
    plan = plan_of(net_state(events(spark), "uuid", ["id"]))
    assert plan.count("partial_max") >= 2 and "partial_collect_list" in plan and plan.count("Exchange hashpartitioning") == 2
    plan = plan_of(latest_changes(events(spark), "uuid", ["id"], ["fields"]))
    assert "partial_max_by" in plan and plan.count("Exchange hashpartitioning") == 1


def test_fields_are_folded_after_they_are_dealt_out(spark):
    """No task sorts all it reads of the feed; the rows of a hot key go to several tasks."""
    assert "Aggregate" not in plan_of(net_state(events(spark), "uuid", ["id"])).split("Exchange hashpartitioning")[-1]
    mixed = events(spark).unionByName(events(spark).withColumn("uuid", F.concat(F.lit("k"), "id")))
    mixed = mixed.unionByName(events(spark))
    dealt = _dealt(mixed, "uuid", ["id"]).groupBy((F.col("uuid") == "hot").alias("hot")).agg(F.countDistinct("uuid", "_part").alias("n"))
    assert {r["hot"]: r["n"] for r in dealt.collect()} == {True: 2, False: 100}


def without_broadcasts(spark, function):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return function()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_dimension_is_shuffled(spark):
    nodes = spark.range(3000).select(F.col("id").alias("uuid"), (F.col("id") % 2).alias("acl_id"))
    readers = spark.createDataFrame([(1, ["a"])], "acl_id long, readers array<string>")
    small, large = without_broadcasts(spark, lambda: [plan_of(attach_readers(nodes, readers, **o)) for o in ({}, {"max_bytes": -1})])
    assert "BroadcastHashJoin" in small and "Exchange hashpartitioning(acl_id" not in small
    assert "hashpartitioning(acl_id" in large and "_salt" in large


def test_only_hot_keys_are_copied_by_their_share(spark):
    """One access list on a third of the rows, one missing on a sixth: only the first is copied, the others are not."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") + 100)
        nodes = spark.range(3000).select(F.col("id").alias("uuid"), key.alias("acl_id"))
        readers = spark.range(3200).select(F.col("id").alias("acl_id"), F.array(F.col("id").cast("string")).alias("readers"))
        assert lookups.hot_keys(nodes, "acl_id", 12) == {7: 4}
        joined = lookups.lookup_join(nodes, readers, "acl_id", "uuid", max_bytes=-1)
        copies = [n for n in joined._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate explode(sequence(0" in n]
        assert len(copies) == 1
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, lookups.lookup_join(nodes, readers, "acl_id", "uuid").collect()), key=str)
        salted = without_broadcasts(spark, lambda: lookups.lookup_join(nodes, readers, "acl_id", "uuid", max_bytes=-1))
        assert salted.where("acl_id = 7").count() == 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_few_ids_read_few_files(spark, tmp_path):
    lookups.write_lookup(spark.range(400).withColumn("text", F.lit("x")), str(tmp_path / "texts"), 16)
    table = spark.read.parquet(str(tmp_path / "texts"))
    few = lookups.pruned(table, spark.createDataFrame([(3,), (4,)], "id long"), 16)
    assert "PartitionFilters: [id_bucket" in plan_of(few) or "PartitionFilters: [isnotnull(id_bucket" in plan_of(few)
    opened = few.select(F.input_file_name()).distinct().count()
    assert opened <= 2 < len(table.inputFiles()) and few.where("id in (3, 4)").count() == 2
