"""Column expressions on hand-made edge cases."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.names import decode_name, encode_name
from tidemark.functions.refs import model_prefix, qname_local, qname_uri, ref_tail, ref_to_uuid
from tidemark.functions.text import escape_json, unescape_unicode
from tidemark.functions.values import flatten_value, parse_properties, parsed_properties, text_value


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize("ref,uuid,tail", [
    ("workspace://SpacesStore/u-1", "u-1", "u-1"),
    ("a://b/c/", "c/", ""),
    ("a://b/c\nd", None, "c\nd"),
    ("a/b", None, "b"),
    (None, None, None),
])
def test_references(spark, ref, uuid, tail):
    assert one(spark, ref, ref_to_uuid) == uuid
    assert one(spark, ref, ref_tail) == tail


def test_reference_without_slash(spark):
    assert one(spark, "abc", ref_to_uuid) is None
    assert one(spark, "abc", lambda c: ref_tail(c, on_error="null")) is None
    with pytest.raises(PySparkException, match="reference without a slash"):
        one(spark, "abc", ref_tail)


@pytest.mark.parametrize("name,uri,local", [
    ("{http://x/1}name", "{http://x/1}", "name"), ("{a}b}c", "{a}b}", "c"), ("plain", "", "plain"), ("{u}", "{u}", ""),
])
def test_qualified_names(spark, name, uri, local):
    assert one(spark, name, qname_uri) == uri
    assert one(spark, name, qname_local) == local


def test_model_prefix(spark):
    assert one(spark, "cm:contentmodel", model_prefix) == "cm"
    assert one(spark, "a:b:c", model_prefix) == "a"
    assert one(spark, "none", model_prefix) is None


def test_field_names(spark):
    name = "cm:content.size a-b*c+d~é"
    encoded = one(spark, name, encode_name)
    assert encoded == "cm%3Acontent%2Esize%20a%2Db%2Ac%2Bd%7E%C3%A9"
    assert one(spark, encoded, decode_name) == name


VALUES = [
    ('[{"locale":"en","value":"x"},{"locale":"fr","value":"y"}]', "x"),
    ('[{"locale":"en"}]', ""),
    ('[{"locale":"en","value":null}]', ""),
    ('[{"locale":"en","value":7}]', "7"),
    ('[{"locale":"en","value":"x","z":1}]', [{"locale": "en", "value": "x", "z": 1}]),
    ('[{"locale":"en","z":1}]', [{"locale": "en", "z": 1}]),
    ('[{"id":"a","n":1},null,3]', ["a", None, 3]),
    ('[{"id":null}]', [None]),
    ('[[{"id":"a"}]]', [[{"id": "a"}]]),
    ('{"a":1,"b":null}', ["a=1", "b=null"]),
    ('{"id":"a"}', ["id=a"]),
    ("[]", []),
    ("{}", []),
    ("3", 3),
    ("1.5", 1.5),
    ("true", True),
    ('"a \\"quoted\\" é"', 'a "quoted" é'),
]


@pytest.mark.parametrize("value,expected", VALUES)
def test_flatten(spark, value, expected):
    flat = one(spark, f'{{"p":{value}}}', lambda c: flatten_value(F.try_element_at(parse_properties(c), F.lit("p"))))
    assert json.loads(flat) == expected


def test_flatten_null(spark):
    for body in ('{"p":null}', "{}", None, "null"):
        assert one(spark, body, lambda c: flatten_value(F.try_element_at(parse_properties(c), F.lit("p")))) is None


@pytest.mark.parametrize("body", ["broken", '{"p":', "[1]", ""])
def test_malformed_properties(spark, body):
    assert one(spark, body, lambda c: parsed_properties(c).isNull()) is True
    with pytest.raises(PySparkException, match="no JSON object"):
        one(spark, body, lambda c: F.size(parse_properties(c)))


def test_text_value(spark):
    def of(body):
        return one(spark, body, lambda c: text_value(F.try_element_at(parse_properties(c), F.lit("p"))))

    assert of('{"p":"x"}') == "x"
    assert of('{"p":12}') == "12"
    assert of('{"p":null}') is None
    assert json.loads(of('{"p":{"a":1}}')) == {"a": 1}


TEXTS = ["plain", "", "tab\t new\n ret\r back\b form\f", 'quote " and \\ slash /', "é ü 漢字", "emoji 😀 end", "\u0001\u001f", "a\\u0041"]


@pytest.mark.parametrize("text", TEXTS)
def test_escape_parses_back(spark, text):
    escaped = one(spark, text, escape_json)
    assert escaped.isascii()
    assert json.loads(f'"{escaped}"') == text


def test_escape_of_null(spark):
    assert one(spark, None, escape_json) is None


@pytest.mark.parametrize("escaped,text", [
    ("\\u0024", "$"), ("cost \\u0024\\u0031.", "cost $1."), ("\\ud83d\\ude00!", "😀!"), ("no escapes", "no escapes"),
    ("\\n stays", "\\n stays"), ("\\u00e9\\u00E9", "éé"), ("\\u12", "\\u12"), ("lone \\ud83d here", "lone \\ud83d here"),
    ("\\u0041 \\u0042", "A B"), ("", ""), (None, None),
])
def test_unescape(spark, escaped, text):
    assert one(spark, escaped, unescape_unicode) == text


def test_unescape_long_run(spark):
    assert one(spark, "\\u6f22" * 200_000, unescape_unicode) == "漢" * 200_000


def test_properties_are_parsed_once(spark):
    rows = spark.createDataFrame([("{}",)], "p string").select(parse_properties(F.col("p")))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("VariantType,true), p#") == 1
