"""The document builder: one index document per enriched node."""

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.names import encode_name
from tidemark.functions.values import as_map, flatten_value, text_value
from tidemark.operators.enrich import ancestor_uuids

EXCLUDED = (K.CONTENT, K.CONTENT_TRANSFORM_STATUS)


def tags_of(name_paths, root=K.TAG_ROOT):
    """Second element of every name path below the root, in order, duplicates kept."""
    under_root = F.filter(name_paths, lambda p: (F.size(p) > 1) & (F.get(p, F.lit(0)) == root))
    return F.transform(under_root, lambda p: F.get(p, F.lit(1)))


def primary_parent(ancestors):
    return F.get(ancestors, F.lit(0))


def parents_of(ancestors):
    return F.when(F.size(ancestors) > 0, ancestors)


def owner_of(owner, modifier):
    """Owner, else modifier, else null (field left out)."""
    return F.coalesce(owner, modifier)


def content_member(properties, member):
    """One member of the content property as text; null when either is missing."""
    content = F.try_element_at(properties, F.lit(K.CONTENT))
    return F.try_variant_get(content, f"$.{member}", "string")


def content_size(properties):
    """Size of the content as the JSON text it came in: a number stays one."""
    content = F.try_element_at(properties, F.lit(K.CONTENT))
    return F.nullif(F.to_json(F.try_variant_get(content, f"$.{K.CONTENT_SIZE}", "variant")), F.lit("null"))


def content_info(properties):
    """Mimetype, size (JSON text) and encoding of the content; null as a whole when the node has no content."""
    has_content = as_map(F.try_element_at(properties, F.lit(K.CONTENT))).isNotNull()
    return F.when(has_content, F.struct(
        content_member(properties, K.CONTENT_MIME).alias("mimetype"),
        content_size(properties).alias("size"),
        content_member(properties, K.CONTENT_ENCODING).alias("encoding"),
    ))


def property_names(properties):
    """Sorted names of the kept properties."""
    return F.sort_array(F.array_except(F.map_keys(properties), F.array(*map(F.lit, EXCLUDED))))


def with_property_fields(nodes):
    """Add `fields`: encoded name -> JSON text of every kept property. The name is always among them, null if
    the node has none."""
    kept = F.filter(F.map_entries("properties"), lambda e: ~e["key"].isin(*EXCLUDED))
    texts = F.transform(kept, lambda e: F.struct(
        encode_name(e["key"]).alias("key"), e["value"].alias("value"), F.to_json(e["value"]).alias("json")
    ))
    flat = F.transform("_texts", lambda e: F.struct(
        e["key"].alias("key"), flatten_value(e["value"], e["json"]).alias("value")
    ))
    name = F.struct(encode_name(F.lit(K.NAME)).alias("key"), F.lit(None).cast("string").alias("value"))
    unnamed = F.when(~F.map_contains_key("properties", K.NAME), F.array(name)).otherwise(F.array().cast(
        "array<struct<key:string,value:string>>"))
    return (
        nodes.withColumn("_texts", texts)
        .withColumn("fields", F.map_from_entries(F.concat(flat, unnamed)))
        .drop("_texts")
    )


def build_documents(nodes, stamp_ms, *carry, tag_root=K.TAG_ROOT):
    """Enriched nodes (uuid, id, type, readers, ancestors, aspects, name_paths as lists of names, prefixed
    properties) -> documents, with content_id and store for the text phase and the carried columns."""
    properties = F.col("properties")
    parents = F.col("_parents")
    no_tags = F.array().cast("array<string>")

    def named(name):
        return text_value(F.try_element_at(properties, F.lit(name)))

    return with_property_fields(nodes.withColumn("_parents", ancestor_uuids(F.col("ancestors")))).select(
        "uuid",
        "type",
        primary_parent(parents).alias("primary_parent"),
        parents_of(parents).alias("parents"),
        "readers",
        owner_of(named(K.OWNER), named(K.MODIFIER)).alias("owner"),
        property_names(properties).alias("property_names"),
        "aspects",
        F.coalesce(tags_of(F.col("name_paths"), tag_root), no_tags).alias("tags"),
        F.lit(True).alias("alive"),
        F.lit(stamp_ms).cast("bigint").alias("last_update_ms"),
        content_info(properties).alias("content_info"),
        "fields",
        content_member(properties, K.CONTENT_ID).alias("content_id"),
        named(K.STORE_IDENTIFIER).alias("store"),
        "id",
        *carry,
    )
