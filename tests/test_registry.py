"""Model definitions, prefixes and their reports."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.values import parse_properties
from tidemark.operators import quality
from tidemark.operators.enrich import attach_readers, prefix_properties, readers_by_acl
from tidemark.operators.registry import build_registry, holders, model_name, read_models, registry_changes, small_registry

XML = [
    ("<model name='r1:m'/>", "r1:m"),
    ('<?xml version="1.0" encoding="UTF-8"?>\n<model name="cm:x" xmlns="u"><types/></model>\n', "cm:x"),
    ("<m:model xmlns:m='u' name='r2:m'><x/></m:model>", "r2:m"),
    ("<set name='z:z'><model name='in:m'/></set>", "in:m"),
    ("<set><!-- <model name='no:no'/> --><a/><m:model xmlns:m='u' other='1' name=\"in:m\"/><model name='l:l'/></set>", "in:m"),
    ("<set><models name='no:no'/><model name='in:m'/></set>", "in:m"),
    ("<model name='r1:m'>", None),
    ("<a><b></a></b>", None),
    ("junk", None),
    ("", None),
    (None, None),
    ("<model/>", None),
    ("<other name='x:y'/>", None),
    ("<model name='x:y'></model>trailing", None),
    ("<model name='a:b'/><model name='c:d'/>", None),
    ("<model name='a:b'/><junk>", None),
    ("<model name='a:b'/><junk/>", None),
    ("<set><model name='a&amp;b:m'/></set>", "a&b:m"),
    ("<model name='a:b'/> <!-- end -->", "a:b"),
    ("<!DOCTYPE model [<!ENTITY e 'v'>]><model name='a:b'/>", "a:b"),
    ("<!DOCTYPE model [<!-- ]> \" --><!ENTITY e \"]>\"> ]>\n<model name='a:b'/>", "a:b"),
    ("<!DOCTYPE model SYSTEM 'x>y.dtd'><model name='a:b'/>", "a:b"),
    ("<set><a><![CDATA[<!--]]></a><model name='a:b'/><b><![CDATA[-->]]></b></set>", "a:b"),
    ("<set><a><![CDATA[<?]]></a><model name='a:b'/><b><![CDATA[?>]]></b></set><?last?>", "a:b"),
    ("<!-- <model name='no:no'/> -->" + "<!-- x -->\n" * 4000 + "<model name='a:b'/>", "a:b"),
    ("<model name='a:b'/><![CDATA[x]]>", None),
]


@pytest.mark.parametrize("xml,name", XML)
def test_model_name(spark, xml, name):
    assert spark.createDataFrame([(xml,)], "x string").select(model_name(F.col("x"))).first()[0] == name


def models(spark):
    diffs = spark.createDataFrame(
        [("{u1}a", 1), ("{u1}b", 2), ("{u2}c", 3), ("{u3}d", 4), ("{u4}e", 5)], "name string, pos long"
    )
    xml = spark.createDataFrame(
        [("{u1}a", "<model name='old:m'/>"), ("{u1}b", "<model name='new:m'/>"), ("{u2}c", "<model name='nocolon'/>"),
         ("{u3}d", "<model")], "name string, xml string"
    )
    return read_models(diffs, xml)


def test_registry_and_report(spark):
    assert {r["uri"]: r["prefix"] for r in build_registry(models(spark)).collect()} == {"{u1}": "new"}
    bad = {(r["key"], r["detail"]) for r in quality.bad_models(models(spark)).collect()}
    assert bad == {("{u2}c", "nocolon"), ("{u3}d", None), ("{u4}e", None)}


def registry(spark):
    return spark.createDataFrame([("{u1}", "p"), ("{u2}", "p")], "uri string, prefix string")


def renamed(spark, body, **options):
    nodes = spark.createDataFrame([("n1", body), ("n2", None)], "uuid string, body string")
    nodes = nodes.withColumn("properties", parse_properties(F.col("body"))).drop("body")
    out = prefix_properties(nodes, registry(spark), **options)
    rows = out.select("uuid", F.transform_values("properties", lambda k, v: F.to_json(v)).alias("p")).collect()
    return {r["uuid"]: r["p"] for r in rows}


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_prefixes(spark, max_rows):
    got = renamed(spark, '{"{u1}a":1,"{u9}b":"x","{u1}c":null}', max_rows=max_rows)
    assert got == {"n1": {"p:a": "1", "{u9}:b": '"x"', "p:c": "null"}, "n2": {}}


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_colliding_names_keep_the_last(spark, max_rows):
    assert renamed(spark, '{"{u1}a":1,"{u2}a":2,"{u1}z":3}', max_rows=max_rows)["n1"] == {"p:a": "2", "p:z": "3"}


@pytest.mark.parametrize("options", [{"max_rows": 0}, {"max_rows": 0, "max_bytes": -1}, {}])
def test_key_without_brace(spark, options):
    with pytest.raises(PySparkException, match="no brace closes"):
        renamed(spark, '{"bare":1}', **options)
    assert renamed(spark, '{"bare":1,"{u1}a":2}', on_error="reject", **options)["n1"] == {"p:a": "2"}


def test_small_registry(spark):
    assert small_registry(registry(spark), 2) == {"{u1}": "p", "{u2}": "p"}
    assert small_registry(registry(spark), 1) is None


@pytest.mark.parametrize("max_bytes", [1 << 20, -1])
def test_readers(spark, max_bytes):
    acls = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "acl_id long, readers array<string>")
    nodes = spark.createDataFrame([(f"n{i}", i % 4) for i in range(40)] + [("n", None)], "uuid string, acl_id long")
    got = {r["uuid"]: r["readers"] for r in attach_readers(nodes, readers_by_acl(acls), max_bytes=max_bytes).collect()}
    assert got == {"n": [], **{f"n{i}": (["a", "b"] if i % 4 == 1 else []) for i in range(40)}}


def test_duplicate_acl(spark):
    acls = spark.createDataFrame([(1, ["a"]), (1, ["b"]), (2, ["c"])], "acl_id long, readers array<string>")
    with pytest.raises(PySparkException, match="access list given twice: 1"):
        readers_by_acl(acls).collect()
    asked = spark.createDataFrame([(2,)], "acl_id long")
    assert [tuple(r) for r in readers_by_acl(acls, asked).collect()] == [(2, ["c"])]
    kept = {r["acl_id"]: r["readers"] for r in readers_by_acl(acls, on_error="reject").collect()}
    assert kept == {1: None, 2: ["c"]}
    assert [(r["key"], r["detail"]) for r in quality.duplicate_acls(acls).collect()] == [("1", "2")]


def test_only_holders_of_a_changed_namespace_are_built_anew(spark):
    old = spark.createDataFrame([("{u1}", "a"), ("{u2}", "b"), ("{u3}", "c")], "uri string, prefix string")
    new = spark.createDataFrame([("{u1}", "a"), ("{u2}", "z"), ("{u4}", "d")], "uri string, prefix string")
    changes = registry_changes(old, new)
    assert {tuple(r) for r in changes.collect()} == {("{u2}", "b", "z"), ("{u3}", "c", None), ("{u4}", None, "d")}
    index = spark.createDataFrame(
        [("kept", ["a:x", "{u9}:y"]), ("renamed", ["a:x", "b:y", "b:z"]), ("lost", ["c:x"]), ("found", ["{u4}:b"]), ("none", [])],
        "uuid string, property_names array<string>")
    assert sorted(r["uuid"] for r in holders(index, changes).collect()) == ["found", "lost", "renamed"]
