"""Joining change rows to metadata, access-control readers and namespace prefixes."""

from pyspark.sql import functions as F

from tidemark.functions.refs import qname_local, qname_uri, ref_to_uuid
from tidemark.operators.lookups import join_on_keys, lookup_join, measure
from tidemark.operators.registry import small_registry

NO_READERS = "array<string>"


def attach_metadata(changes, metadata, size):
    """Metadata of every changed node (measured `size` bytes of changes); nodes without any drop out and are
    reported by quality.missing_metadata."""
    return join_on_keys(changes, metadata, "id", size)


def with_references(changes, metadata):
    """Changes whose rows without a reference take the one that the node's metadata has, if it has any."""
    lost = changes.where("node_ref is null").select("id").distinct()
    rows, size = measure(lost)
    if not rows or "node_ref" not in metadata.columns:
        return changes
    own = join_on_keys(lost, metadata.select("id", F.col("node_ref").alias("_ref")), "id", size)
    own = own.groupBy("id").agg(F.max("_ref").alias("_ref"))
    filled = lookup_join(changes, own, "id", F.struct("txn_id", "feed_pos"), size=size)
    return filled.withColumn("node_ref", F.coalesce("node_ref", "_ref")).drop("_ref")


def latest_metadata(updates, metadata, size):
    """(id, uuid, reset, acl_id, version, n) of the updated nodes: the row of the highest version of each, and n
    rows that have it. Tables without versions have one version only, null."""
    version = F.col("version") if "version" in metadata.columns else F.lit(None).cast("bigint")
    thin = attach_metadata(updates, metadata.select("id", "acl_id", version.alias("version")), size)
    return thin.groupBy("id", "uuid", "reset", "version").agg(
        F.max("acl_id").alias("acl_id"), F.count(F.lit(1)).alias("n")
    ).groupBy("id", "uuid", "reset").agg(F.max(F.struct("version", "acl_id", "n")).alias("m")).select(
        "id", "uuid", "reset", "m.acl_id", "m.version", "m.n")


def readers_by_acl(acls, acl_ids=None, on_error="fail"):
    """Readers per ACL id. An id listed twice raises, or gets no readers with on_error="reject"."""
    wanted = acls if acl_ids is None else acls.join(acl_ids.select("acl_id").distinct(), "acl_id", "left_semi")
    grouped = wanted.groupBy("acl_id").agg(
        F.count(F.lit(1)).alias("n"), F.any_value("readers").alias("readers")
    )
    if on_error == "fail":
        failure = F.raise_error(F.concat(F.lit("access list given twice: "), F.col("acl_id").cast("string")))
        readers = F.when(F.col("n") > 1, failure.cast(NO_READERS)).otherwise(F.col("readers"))
    else:
        readers = F.when(F.col("n") == 1, F.col("readers"))
    return grouped.select("acl_id", readers.alias("readers"))


def attach_readers(nodes, readers, spread_by="uuid", **options):
    """Readers of each node's ACL, an empty list where the ACL is unknown."""
    joined = lookup_join(nodes.drop("readers"), readers, "acl_id", spread_by, **options)
    return joined.withColumn("readers", F.coalesce("readers", F.array().cast(NO_READERS)))


def prefixed_key(key, prefix):
    return F.concat(F.coalesce(prefix, qname_uri(key)), F.lit(":"), qname_local(key))


def checked_key(key, on_error="fail"):
    """The key, raising where no brace closes its namespace; null instead with on_error="reject"."""
    failure = F.raise_error(F.concat(F.lit("property name that no brace closes: "), key)).cast("string")
    return F.when(F.instr(key, "}") > 0, key).otherwise(failure if on_error == "fail" else F.lit(None))


def prefix_properties(nodes, registry, id_col="uuid", on_error="fail", max_rows=1000, **options):
    """Rewrite `{uri}local` keys of the `properties` map to `prefix:local`.

    An unknown uri stays in place of its prefix; of two keys that end up the same the last wins. A registry
    of at most max_rows namespaces is applied in place. A larger one is joined, property by property.
    """
    known = small_registry(registry, max_rows)
    if known is None:
        return _prefix_by_join(nodes, registry, id_col, on_error, options)
    literals = [F.lit(x) for pair in sorted(known.items()) for x in pair]
    prefixes = F.create_map(*literals) if literals else F.lit(None).cast("map<string,string>")
    entries = F.map_entries("properties")
    if on_error == "reject":
        entries = F.filter(entries, lambda e: F.instr(e["key"], "}") > 0)
    renamed = F.transform(entries, lambda e: F.struct(
        prefixed_key(checked_key(e["key"]), F.try_element_at(prefixes, qname_uri(e["key"]))).alias("key"),
        e["value"].alias("value"),
    ))
    return _last_wins(nodes.withColumn("_entries", renamed))


def _last_wins(nodes):
    """Turn `_entries` into the `properties` map, the last one of equal keys winning. The entries are a
    column of their own so that they are computed once."""
    entries, keys = F.col("_entries"), F.col("_entries.key")
    latest = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys) - i - 1, F.lit(0))), e["key"]),
    )
    unique = F.size(F.array_distinct(keys)) == F.size(keys)
    return nodes.withColumn("properties", F.map_from_entries(F.when(unique, entries).otherwise(latest))).drop("_entries")


def _prefix_by_join(nodes, registry, id_col, on_error, options):
    keyed = nodes.select(
        id_col, F.posexplode(F.map_entries("properties")).alias("pos", "entry")
    ).select(
        id_col, "pos", checked_key(F.col("entry.key"), on_error).alias("key"), F.col("entry.value").alias("value")
    ).where("key is not null").withColumn("uri", qname_uri("key"))
    spread = F.xxhash64(id_col, "key")
    named = lookup_join(keyed.withColumn("_spread", spread), registry, "uri", "_spread", **options)
    regrouped = named.groupBy(id_col).agg(
        F.array_sort(
            F.collect_list(F.struct("pos", prefixed_key(F.col("key"), F.col("prefix")).alias("key"), "value")),
            lambda a, b: a["pos"] - b["pos"],
        ).alias("_sorted")
    ).select(
        id_col,
        F.transform("_sorted", lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))).alias("_entries"),
    )
    empty = F.map_entries(F.map_filter("properties", lambda k, v: F.lit(False)))
    joined = nodes.join(regrouped, id_col, "left").withColumn("_entries", F.coalesce("_entries", empty))
    return _last_wins(joined)


def ancestor_uuids(ancestors):
    """References of the ancestors -> uuids, a non-matching reference giving null."""
    return F.transform(ancestors, ref_to_uuid)
