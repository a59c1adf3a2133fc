"""Namespace registry: which prefix stands for which namespace uri."""

from pyspark.sql import functions as F

from tidemark.functions.refs import model_prefix, qname_uri

# What may stand before the root: declaration, comments, instructions, the document type with its internal subset.
_COMMENT, _INSTRUCTION = r"<!--[^-]*+(?:-[^-]++)*+-->", r"<\?[^?]*+(?:\?(?!>)[^?]*+)*+\?>"
_QUOTED = r"\"[^\"]*+\"|'[^']*+'"
_SUBSET = rf"\[(?:{_COMMENT}|{_INSTRUCTION}|{_QUOTED}|[^\]\"'<]++|<)*+\]\s*+"
_PROLOG = rf"^(?:\s++|{_COMMENT}|{_INSTRUCTION})*+(?:<!DOCTYPE(?:[^\[\"'>]++|{_QUOTED})*+(?:{_SUBSET})?+>)?+"
_FIRST_MODEL = "(//*[local-name()='model'])[1]/@name"


def model_name(xml):
    """`name` of the first `model` element, whatever its namespace prefix; null if malformed or absent.

    What follows the prolog, set into an element of its own, must parse as a whole and give that element one child and no
    text, so a second root and whatever trails the first are malformed. Marks inside the root are left alone. Only then
    the name is looked up, without the document type, so nothing outside the text is ever fetched.
    """
    whole = F.concat(F.lit("<all>"), F.regexp_replace(xml, _PROLOG, ""), F.lit("</all>"))
    parses = F.from_xml(xml, "_corrupt_record string")["_corrupt_record"].isNull() & F.from_xml(
        whole, "_corrupt_record string")["_corrupt_record"].isNull()
    roots = F.xpath_int(whole, F.lit("count(/all/*) + 2 * count(/all/text()[normalize-space()])"))
    roots = F.when(parses, roots)
    found = F.when(roots == 1, F.xpath_string(whole, F.lit(_FIRST_MODEL)))
    return F.nullif(found, F.lit(""))


def read_models(diffs, definitions):
    """Every listed model beside what its definition says; prefix is null where the definition is unusable."""
    listed = diffs.join(definitions, "name", "left")
    return listed.select(
        "name",
        "pos",
        qname_uri("name").alias("uri"),
        F.col("xml").isNotNull().alias("has_definition"),
        model_name(F.col("xml")).alias("model_name"),
    ).withColumn("prefix", model_prefix("model_name"))


def build_registry(models):
    """One prefix per uri, the last listed definition winning."""
    return models.where("prefix is not null").groupBy("uri").agg(F.max_by("prefix", "pos").alias("prefix"))


def registry_size(registry):
    """How many namespaces are known, as one row."""
    return registry.agg(F.count(F.lit(1)).alias("n"))


def ordered_registry(registry):
    """The registry by uri."""
    return registry.orderBy("uri")


def small_registry(registry, max_rows=1000):
    """The registry as a {uri: prefix} dict when it has at most max_rows rows, else None."""
    rows = registry.limit(max_rows + 1).collect()
    return {r["uri"]: r["prefix"] for r in rows} if len(rows) <= max_rows else None


def registry_changes(old, new):
    """uri, old_prefix, new_prefix of the namespaces that two registries know differently; null where one doesn't."""
    before, after = old.select("uri", F.col("prefix").alias("old_prefix")), new.select("uri", F.col("prefix").alias("new_prefix"))
    return before.join(after, "uri", "full_outer").where(~F.col("old_prefix").eqNullSafe(F.col("new_prefix")))


def holders(index, changes):
    """Keys of the documents that name a property of a changed namespace, by its old prefix, or its uri where there was
    none: an inverted list from prefixes to documents, met by the changes. Only these have to be built anew."""
    name = F.col("name")
    prefix = F.when(name.startswith("{"), qname_uri("name")).otherwise(F.substring_index(name, ":", 1))
    listed = index.select("uuid", F.explode("property_names").alias("name")).select("uuid", prefix.alias("prefix"))
    wanted = changes.select(F.coalesce("old_prefix", "uri").alias("prefix")).distinct()
    return listed.join(wanted, "prefix", "left_semi").select("uuid").distinct()
