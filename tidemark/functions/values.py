"""Flattening of open property values: variant in, JSON text out."""

from pyspark.sql import functions as F

from tidemark import constants as K


def as_array(v):
    return v.try_cast("array<variant>")


def as_map(v):
    return v.try_cast("map<string,variant>")


def _has(m, key):
    return F.coalesce(F.map_contains_key(m, key), F.lit(False))


def is_locale_list(v):
    """A non-empty list whose first element holds a locale and at most a value beside it."""
    first = as_map(F.get(as_array(v), F.lit(0)))
    return _has(first, K.LOCALE) & (
        (F.size(first) == 1) | ((F.size(first) == 2) & _has(first, K.LOCALE_VALUE))
    )


def locale_value(v):
    """Value of the first locale as text, empty when it has none."""
    return F.coalesce(F.try_variant_get(v, f"$[0].{K.LOCALE_VALUE}", "string"), F.lit(""))


def map_pairs(v):
    """`key=value` texts of a map value."""
    return F.transform(
        F.map_entries(v.try_cast("map<string,string>")),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))),
    )


def collection_element(e):
    """A map element that carries an id becomes that id; anything else stays."""
    return F.when(_has(as_map(e), K.REFERENCE_ID), F.try_variant_get(e, f"$.{K.REFERENCE_ID}", "variant")).otherwise(e)


def flatten_value(v, json=None):
    """JSON text of a property value as the index stores it; null for a null value.

    `json` is the value's own JSON text where the caller has it already. It tells the kinds apart: most
    values are scalars or lists of scalars, which are stored as they are.
    """
    json = F.to_json(v) if json is None else json
    holds_maps = json.startswith("[") & json.contains("{")
    return (
        F.when(json == "null", F.lit(None).cast("string"))
        .when(json.startswith("{"), F.to_json(map_pairs(v)))
        .when(holds_maps, _flatten_list(v))
        .otherwise(json)
    )


def _flatten_list(v):
    return F.when(is_locale_list(v), json_text(locale_value(v))).otherwise(
        F.to_json(F.transform(as_array(v), collection_element))
    )


def json_text(text):
    """A string column as a JSON string literal."""
    whole = F.to_json(F.array(text))
    return F.substr(whole, F.lit(2), F.length(whole) - 2)


def text_value(v):
    """A scalar as plain text, anything else as JSON; null for a null value."""
    return F.when(F.is_variant_null(v), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))
    )


def parsed_properties(json):
    """JSON object at rest -> map of variants; null text (or JSON null) gives an empty map, malformed text null."""
    nothing = json.isNull() | (F.trim(json) == "null")
    return F.when(nothing, F.from_json(F.lit("{}"), "map<string,variant>")).otherwise(F.from_json(json, "map<string,variant>"))


def parse_properties(json):
    """As parsed_properties, but malformed text raises."""
    parsed = parsed_properties(json)
    failure = F.raise_error(F.concat(F.lit("properties that are no JSON object: "), F.substring(json, 1, 200)))
    # coalesce names the parsed text once, so it is parsed once
    return F.coalesce(parsed, F.from_json(failure.cast("string"), "map<string,variant>"))
