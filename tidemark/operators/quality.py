"""Rows the feed cannot index, as data: every report has the columns rule, key and detail."""

from functools import reduce

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.refs import has_tail, qname_uri, ref_to_uuid


def _report(df, rule, key, detail):
    return df.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"),
                     F.col(detail).cast("string").alias("detail") if isinstance(detail, str) else
                     detail.cast("string").alias("detail"))


def bad_status(changes):
    """Change rows with a status that is neither an update nor a delete."""
    known = F.coalesce(F.col("status").isin(K.STATUS_UPDATED, K.STATUS_DELETED), F.lit(False))
    return _report(changes.where(~known), "bad_status", "id", "status")


def duplicate_acls(acls):
    """ACL ids delivered more than once."""
    counts = acls.groupBy("acl_id").agg(F.count(F.lit(1)).alias("n"))
    return _report(counts.where("n > 1"), "duplicate_acl", "acl_id", "n")


def unknown_envelope_members(members):
    return _report(members, "unknown_member", "member", F.lit(None))


def keys_without_brace(keys):
    return _report(keys.where(F.instr("name", "}") == 0), "key_without_brace", "name", F.lit(None))


def unknown_namespaces(names):
    """Property names that still begin with their uri once prefixes are put in: no model declares it."""
    return _report(names.where(F.col("name").startswith("{")), "unknown_namespace", "name", qname_uri("name"))


def bad_models(models):
    """Listed models without a usable definition."""
    return _report(models.where("prefix is null"), "bad_model", "name", "model_name")


def bad_references(rows, ref="node_ref", key="id"):
    """References that do not give a document key, by either reading of them, and rows without any."""
    bad = F.col(ref).isNull() | ref_to_uuid(ref).isNull() | ~has_tail(ref)
    return _report(rows.where(bad), "bad_reference", key, ref)


def missing_metadata(updates, metadata):
    """Updated nodes the metadata table does not know."""
    return _report(updates.join(metadata.select("id"), "id", "left_anti"), "missing_metadata", "id", "uuid")


def repeated_metadata(thin):
    """Nodes with several metadata rows of one version: which one counts can't be told."""
    return _report(thin.where("n > 1"), "repeated_metadata", "id", "uuid")


def bad_properties(documents):
    """Nodes whose properties are no JSON object."""
    return _report(documents, "bad_properties", "id", "uuid")


def missing_content(changed, found):
    """Documents whose changed text is not among the texts found (by uuid and content id); they stay candidates."""
    return _report(changed.join(found.select("uuid", "content_id"), ["uuid", "content_id"], "left_anti"), "missing_content", "uuid", "content_id")


def failed_nodes(changes, updates, documents, found):
    """id, rule: nodes of a batch that are not indexed as their change rows ask, or lack their text, each with one of its
    causes among the findings."""
    rows = changes.select("id").distinct()
    known = found.where(F.col("rule").isin("bad_status", "bad_reference")).select(F.col("key").cast("bigint").alias("id"), "rule")
    lost = updates.select("id").join(documents.select("id"), "id", "left_anti")
    causes = found.where(F.col("rule").isin("missing_metadata", "repeated_metadata", "bad_properties")).select(F.col("key").cast("bigint").alias("id"), "rule")
    # what else keeps an updated node from being built is its access list
    lost = lost.join(causes, "id", "left").select("id", F.coalesce("rule", F.lit("duplicate_acl")).alias("rule"))
    texts = found.where("rule = 'missing_content'").select(F.col("key").alias("uuid"), "rule")
    textless = documents.select("uuid", "id").join(texts, "uuid").select("id", "rule")
    every = combined(rows.join(known, "id"), lost, textless)
    return every.groupBy("id").agg(F.min("rule").alias("rule"))


def still_pending(pending, changes, failed):
    """id, rule, tries after a batch: nodes that failed in it, tried once more, and earlier ones it didn't try."""
    if pending is None:
        return failed.withColumn("tries", F.lit(1).cast("bigint"))
    tried = failed.join(pending.select("id", F.col("tries").alias("_before")), "id", "left")
    tried = tried.select("id", "rule", (F.coalesce("_before", F.lit(0)) + 1).cast("bigint").alias("tries"))
    return tried.unionByName(pending.join(changes.select("id").distinct(), "id", "left_anti"))


def combined(*reports):
    return reduce(lambda a, b: a.unionByName(b), reports)


def counts(report):
    return report.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
