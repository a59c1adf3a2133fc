"""Bulk lines are ASCII, valid JSON and hold the document."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import conform
from tidemark.sinks.bulk_export import bulk_actions, bulk_lines, change_set, export_bulk
from tidemark.sinks.snapshot import slice_of

TEXT = 'é 漢 😀 "quoted" back\\slash \\u0041 tab\t new\nline \u0001'


def index(spark):
    schema = (
        "uuid string, type string, parents array<string>, readers array<string>, owner string, tags array<string>, "
        "alive boolean, last_update_ms long, content_info struct<mimetype:string,size:string,encoding:string>, "
        "fields map<string,string>, content_id string, content_text string"
    )
    fields = {"cm%3Aname": json.dumps(TEXT, ensure_ascii=False), "n": "3", "list": '["é",null]', "none": None,
              "slash": json.dumps("\\é")}
    df = spark.createDataFrame([
        ('u"1', "t", ["p"], [], "ö", ["a"], True, 5, ("text/plain", None, "U"), fields, "c1", TEXT),
        ("u2", "t", None, ["x"], None, [], True, 6, None, {}, None, None),
    ], schema)
    return conform(df, "content_id", "content_text")


def parsed(value):
    action, body = value.split("\n")
    return json.loads(action), json.loads(body)


def test_lines(spark):
    rows = {r["uuid"]: r["value"] for r in bulk_lines(index(spark), "docs").collect()}
    assert all(v.isascii() for v in rows.values())
    action, body = parsed(rows['u"1'])
    assert action == {"update": {"_index": "docs", "_id": 'u"1'}} and body["doc_as_upsert"] is True
    assert body["doc"] == {
        "TYPE": "t", "PARENT": ["p"], "READER": [], "METADATA_INDEXING_LAST_UPDATE": 5, "OWNER": "ö",
        "PROPERTIES": None, "ASPECT": None, "TAG": ["a"], "ALIVE": True, "cm%3Acontent%2Emimetype": "text/plain",
        "cm%3Acontent%2Esize": None, "cm%3Acontent%2Eencoding": "U", "cm%3Acontent": TEXT, "contentId": "c1",
        "cm%3Aname": TEXT, "n": 3, "list": ["é", None], "none": None, "slash": "\\é",
    }
    assert set(parsed(rows["u2"])[1]["doc"]) == {
        "TYPE", "READER", "METADATA_INDEXING_LAST_UPDATE", "PROPERTIES", "ASPECT", "TAG", "ALIVE"
    }


def test_changes_and_files(spark, tmp_path):
    """Null-safe differences; deletes beside updates; each file within the limit and of one slice."""
    before = index(spark)
    more = before.where("uuid = 'u2'").select(F.explode(F.sequence(F.lit(0), F.lit(39))).alias("i"), *[c for c in before.columns if c != "uuid"])
    more = more.select(F.concat(F.lit("n"), "i").alias("uuid"), *[c for c in before.columns if c != "uuid"])
    gone = before.where("uuid = 'u2'").withColumn("uuid", F.lit("gone"))
    touched = before.withColumn("owner", F.when(F.col("uuid") == 'u"1', None).otherwise(F.col("owner")))
    changes = change_set(before.unionByName(gone), touched.unionByName(more))
    actions = bulk_actions(changes, "docs")
    export_bulk(actions, str(tmp_path / "bulk"), limit=1500, slices=3)
    files = [f for f in (tmp_path / "bulk").rglob("*.txt")]
    lines = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    heads = [line for line in lines if "doc" not in line]
    assert sorted(h["update"]["_id"] for h in heads if "update" in h) == sorted(['u"1', *(f"n{i}" for i in range(40))])
    assert [h["delete"] for h in heads if "delete" in h] == [{"_index": "docs", "_id": "gone"}]
    assert len(lines) == 2 * 41 + 1 and len(files) > 4 and all(0 < f.stat().st_size <= 1500 for f in files)
    slices = {r["uuid"]: r["s"] for r in actions.select("uuid", slice_of("uuid", 3).alias("s")).collect()}
    for f in files:
        keys = [json.loads(line) for line in f.read_text().splitlines() if '"_id"' in line]
        assert {slices[(k.get("update") or k["delete"])["_id"]] for k in keys} == {int(str(f).split("slice=")[1].split("/")[0])}
    with pytest.raises(ValueError, match="can't fit"):
        export_bulk(actions, str(tmp_path / "none"), limit=100, slices=3)
