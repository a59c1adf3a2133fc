"""The registered queries: every operator run over the driver tables."""

import math
from dataclasses import replace

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.names import decode_name, encode_name
from tidemark.functions.refs import has_tail, qname_uri, ref_tail, ref_to_uuid
from tidemark.functions.text import escape_json, unescape_unicode
from tidemark.functions.values import flatten_value, parse_properties
from tidemark.operators import content, document, merge, quality, registry
from tidemark.operators.enrich import (
    attach_metadata, attach_readers, prefix_properties, prefixed_key, readers_by_acl,
)
from tidemark.operators.lookups import lookup_join, measure, pruned, write_lookup
from tidemark.operators.net_state import latest_changes, latest_value, net_state
from tidemark.operators.as_of import metadata_as_of
from tidemark.plans.cycle import Options, Sources, catch_up, replay_pending
from tidemark.session import new_folder
from tidemark.sinks.bulk_export import bulk_actions, bulk_lines, change_set, export_bulk
from tidemark.sinks.event_store import EventStore
from tidemark.sinks.index_store import IndexStore
from tidemark.sinks.snapshot import staged
from tidemark.sources import envelopes, feed
from tidemark.sources import tables as t
from tidemark.streaming.index_stream import stream_events, stream_index

PAGE_MARK = 500


def _joined(array):
    return F.array_join(F.col(array) if isinstance(array, str) else array, ",")


def _pairs(fields):
    """Sorted `name=value` lines of a field map."""
    lines = F.transform(
        F.map_entries(fields), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))
    )
    return F.array_join(F.sort_array(lines), "|")


# -- feed ------------------------------------------------------------------------------------------------


def pending_transactions(spark, d):
    return feed.pending_transactions(t.transactions(spark, d), PAGE_MARK)


def page_bounds(spark, d):
    return feed.page_bounds(t.transactions(spark, d), PAGE_MARK)


def changes_between(spark, d):
    rest = feed.page_bounds(t.transactions(spark, d), PAGE_MARK, None).first()
    rows = feed.changes_between(t.change_lines(spark, d), rest["min_txn_id"], rest["max_txn_id"])
    return rows.select("txn_id", "id", "node_ref", "status")


def txn_reconcile(spark, d):
    lines = feed.transaction_counts(t.change_lines(spark, d)).withColumn("feed", F.lit("lines"))
    events = feed.transaction_counts(t.change_events(spark, d)).withColumn("feed", F.lit("events"))
    return lines.unionByName(events)


def indexing_lag(spark, d):
    log = t.transactions(spark, d)
    store = IndexStore(spark, new_folder(spark, "lag")).ensure(create_index=False)
    page = feed.page_bounds(log, store.watermark()).first()
    store.commit(page["max_txn_id"])
    return feed.indexing_lag(log, store.watermark())


def envelope_decode(spark, d):
    """The log as JSON pages of one hundred transactions, decoded again."""
    rows = t.transactions(spark, d).select(
        F.floor(F.col("id") / 100).alias("page"),
        F.struct("id", F.col("commit_time_ms").alias("commitTimeMs"), F.lit(1).alias("updates")).alias("row"),
    )
    pages = rows.groupBy("page").agg(
        F.to_json(F.struct(F.collect_list("row").alias("transactions"), F.max("row.id").alias("maxTxnId"))).alias("body")
    )
    decoded = envelopes.decode_envelope(pages, "body", "transactions")
    return decoded.select(
        "id", F.col("commitTimeMs").alias("commit_time_ms"), "updates", "deletes",
        F.col("maxTxnId").alias("page_max_id"),
    )


def envelope_members(spark, d):
    """Members of change-row envelopes that the schema does not name."""
    pages = t.table(spark, d, "events").groupBy(F.floor(F.col("event_id") / 100).alias("page")).agg(
        F.to_json(F.struct(F.collect_list(
            F.struct(F.col("user_id").alias("id"), F.lit("u").alias("status"), F.col("event_type").alias("kind"), "props")
        ).alias("nodes"), F.max("value").alias("highest"))).alias("body")
    )
    return envelopes.unknown_members(pages, "body", "changes")


# -- net state -------------------------------------------------------------------------------------------


def _number(field):
    return F.try_element_at("fields", F.lit(field)).cast("double").alias(field)


def _line_events(spark, d):
    lines = feed.routed(t.change_lines(spark, d))
    key = F.when(F.col("is_delete"), ref_tail("node_ref")).otherwise(ref_to_uuid("node_ref"))
    return lines.withColumn("uuid", key)


def net_state_lines(spark, d):
    net = net_state(_line_events(spark, d), "uuid", t.LINE_ORDER)
    return net.select(
        "uuid", "op", F.col("reset").cast("int").alias("is_reset"),
        _number("quantity"), _number("price"), _number("discount"), _number("tax"),
    )


def net_state_events(spark, d):
    events = feed.routed(t.change_events(spark, d)).withColumn("uuid", ref_to_uuid("node_ref"))
    net = net_state(events, "uuid", ["txn_id", "feed_pos"])
    return net.select("uuid", "op", F.col("reset").cast("int").alias("is_reset"), _pairs("fields").alias("fields"))


def net_changes(spark, d):
    rows = feed.routed(t.change_events(spark, d)).withColumn("uuid", ref_to_uuid("node_ref"))
    net = latest_changes(rows, "uuid", ["txn_id", "feed_pos"], ["id"])
    return net.select("uuid", "op", F.col("reset").cast("int").alias("is_reset"), "id")


def content_latest(spark, d):
    return latest_value(t.table(spark, d, "conversations"), ["conv_id", "role"], ["turn"], "text")


# -- lookups and registry --------------------------------------------------------------------------------


def metadata_join(spark, d):
    changed = t.change_events(spark, d).where("status = 'u'").select("id").distinct()
    metadata = t.document_metadata(spark, d).select("id", "node_ref", "type", "acl_id")
    return attach_metadata(changed, metadata, measure(changed)[1])


def metadata_pruned(spark, d):
    """The same for few ids and metadata by bucket of the id, of which only their buckets are read."""
    folder = f"{new_folder(spark, 'metadata')}/by-id"
    write_lookup(t.document_metadata(spark, d).select("id", "node_ref", "type", "acl_id"), folder, 16)
    changed = t.change_events(spark, d).where("status = 'u' and id % 40 = 3").select("id").distinct()
    metadata = pruned(spark.read.parquet(folder), changed, 16)
    return attach_metadata(changed, metadata, measure(changed)[1])


def missing_metadata(spark, d):
    changed = t.change_lines(spark, d).where("status = 'u'").select("id", ref_to_uuid("node_ref").alias("uuid")).distinct()
    return quality.missing_metadata(changed, t.document_metadata(spark, d))


def acl_expand(spark, d):
    nodes = t.document_metadata(spark, d).select(F.col("id").alias("doc_id"), "acl_id")
    readers = readers_by_acl(t.acl_readers(spark, d), nodes)
    return attach_readers(nodes, readers, "doc_id").select("doc_id", "acl_id", _joined("readers").alias("readers"))


def acl_expand_salted(spark, d):
    """The same with the readers side taken as too large to broadcast."""
    nodes = t.document_metadata(spark, d).select(F.col("id").alias("doc_id"), "acl_id")
    readers = readers_by_acl(t.acl_readers(spark, d), nodes)
    expanded = attach_readers(nodes, readers, "doc_id", max_bytes=-1)
    return expanded.select("doc_id", "acl_id", _joined("readers").alias("readers"))


def acl_duplicates(spark, d):
    customers = t.table(spark, d, "customer").select(F.col("c_nationkey").cast("bigint").alias("acl_id"))
    return quality.duplicate_acls(customers).select("rule", "key", "detail")


def _nation_models(spark, d):
    """Models per nation sharing their region's uri: some malformed, some unnamed, some nested or prefixed."""
    nation = t.table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    name = F.concat(F.lit("{http://nation/"), "r", F.lit("}model"), "k")
    label = F.concat(F.lit("n"), F.col("k"))
    xml = (
        F.when(F.col("k") % 6 == 0, F.concat(F.lit("<model name='"), label, F.lit(":m'>")))
        .when(F.col("k") % 6 == 1, F.concat(F.lit("<model name='"), label, F.lit("'/>")))
        .when(F.col("k") % 6 == 2, F.concat(F.lit("<x:model xmlns:x='u' name='"), label, F.lit(":m'><x:a/></x:model>")))
        .when(F.col("k") % 6 == 3, F.concat(F.lit("<set name='z:z'><model name=\""), label, F.lit(":m\"/></set>")))
        .when(F.col("k") % 6 == 4, F.concat(F.lit("<?xml version='1.0'?><!-- <model name='q:q'/> --><model name='"), label, F.lit(":m'></model>")))
    )
    return nation.select(name.alias("name"), F.col("k").cast("bigint").alias("pos"), xml.alias("xml"))


def model_registry(spark, d):
    nations = _nation_models(spark, d)
    diffs = t.model_diffs(spark, d).unionByName(nations.select("name", (F.col("pos") + 100).alias("pos")))
    definitions = t.model_definitions(spark, d).unionByName(nations.select("name", "xml").where("xml is not null"))
    return registry.build_registry(registry.read_models(diffs, definitions))


def bad_models(spark, d):
    nations = _nation_models(spark, d)
    models = registry.read_models(nations.select("name", "pos"), nations.select("name", "xml").where("xml is not null"))
    return quality.bad_models(models)


def _event_keys(spark, d):
    key = F.concat(F.lit("{http://region/"), F.get_json_object("props", "$.k").cast("int") % 7, F.lit("}"), "event_type")
    return t.table(spark, d, "events").select("event_id", key.alias("name"))


def _registry(spark, d):
    return registry.build_registry(registry.read_models(t.model_diffs(spark, d), t.model_definitions(spark, d)))


def property_prefix(spark, d):
    keys = _event_keys(spark, d).withColumn("uri", qname_uri("name"))
    named = lookup_join(keys, _registry(spark, d), "uri", "event_id")
    return named.select(
        "event_id", prefixed_key(F.col("name"), F.col("prefix")).alias("prefixed"),
        F.col("prefix").isNotNull().cast("int").alias("known"),
    )


def _prefixed(keys, known):
    """Names with the prefixes that are known in place of their uris."""
    named = lookup_join(keys.withColumn("uri", qname_uri("name")), known, "uri", "name")
    return named.select(prefixed_key(F.col("name"), F.col("prefix")).alias("name"))


def unknown_namespaces(spark, d):
    keys = _event_keys(spark, d).select("name").distinct()
    return quality.unknown_namespaces(_prefixed(keys, _registry(spark, d)))


def registry_size(spark, d):
    return registry.registry_size(_registry(spark, d))


def registry_listing(spark, d):
    return registry.ordered_registry(_registry(spark, d))


def txn_mismatch(spark, d):
    """The log's own counters against the line feed; every fiftieth transaction counts one update too many."""
    log = feed.transaction_counts(t.change_lines(spark, d)).select(
        F.col("txn_id").alias("id"), (F.col("updates") + F.when(F.col("txn_id") % 50 == 0, 1).otherwise(0)).alias("updates"), "deletes")
    return feed.reconciled(log, t.change_lines(spark, d))


# -- names, references, text -----------------------------------------------------------------------------


def field_dictionary(spark, d):
    part, pages = t.table(spark, d, "part"), t.table(spark, d, "pages")
    names = part.select(F.col("p_name").alias("name")).union(part.select("p_type")).union(pages.select("url")).distinct()
    encoded = names.withColumn("encoded", encode_name("name"))
    return encoded.withColumn("decoded", decode_name("encoded"))


def ref_uuid(spark, d):
    return t.table(spark, d, "pages").select("page_id", ref_to_uuid("url").alias("uuid"))


def ref_tails(spark, d):
    return t.table(spark, d, "pages").select("page_id", ref_tail("url").alias("tail"))


def bad_references(spark, d):
    pages = t.table(spark, d, "pages")
    mixed = pages.select("page_id", F.when(F.col("page_id") % 3 == 0, ref_tail("url")).otherwise(F.col("url")).alias("ref"))
    return quality.bad_references(mixed, "ref", "page_id")


def unescape_text(spark, d):
    clean = t.escaped_documents(spark, d).select("doc_id", unescape_unicode(F.col("escaped")).alias("text"))
    return clean.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n"))


def escape_text(spark, d):
    escaped = t.table(spark, d, "documents").select("doc_id", escape_json(F.col("text")).alias("escaped"))
    return escaped.select("doc_id", F.md5("escaped").alias("escaped_md5"), F.length("escaped").cast("bigint").alias("n"))


# -- documents -------------------------------------------------------------------------------------------


def _flat(index, *more):
    """Index rows as flat columns that any engine can compare."""
    info = F.col("content_info")
    return index.select(
        "uuid", "type", "primary_parent", _joined("parents").alias("parents"), _joined("readers").alias("readers"),
        "owner", _joined("property_names").alias("property_names"), _joined("aspects").alias("aspects"),
        _joined("tags").alias("tags"), F.col("alive").cast("int").alias("alive"), "last_update_ms",
        info["mimetype"].alias("mime"), info["size"].alias("size"), info["encoding"].alias("encoding"),
        _pairs("fields").alias("fields"), *more,
    )


def _documents(spark, d, stamp, known=None, only=None, **options):
    nodes = t.document_metadata(spark, d).withColumn("uuid", ref_to_uuid("node_ref"))
    if only is not None:
        nodes = nodes.join(only, "uuid", "left_semi")
    nodes = nodes.withColumn("properties", parse_properties(F.col("properties")))
    named = prefix_properties(nodes, _registry(spark, d) if known is None else known, **options)
    readers = readers_by_acl(t.acl_readers(spark, d), t.document_metadata(spark, d))
    return document.build_documents(attach_readers(named, readers), stamp)


def documents_built(spark, d):
    return _flat(_documents(spark, d, 1_700_000_000_000))


def documents_built_by_join(spark, d):
    """The same with the registry taken as too large to apply in place."""
    return _flat(_documents(spark, d, 1_700_000_000_000, max_rows=0))


def registry_propagated(spark, d):
    """The index after a namespace has got another prefix: its holders are built anew, all others stay as they are."""
    old = _registry(spark, d)
    new = old.withColumn("prefix", F.when(F.col("prefix") == "r3", "r9").otherwise(F.col("prefix")))
    index = staged(_documents(spark, d, 1_700_000_000_000), f"{new_folder(spark, 'renamed')}/index")
    stale = staged(registry.holders(index, registry.registry_changes(old, new)), f"{new_folder(spark, 'renamed')}/stale")
    kept = index.join(stale, "uuid", "left_anti").withColumn("rebuilt", F.lit(0))
    return _flat(kept.unionByName(_documents(spark, d, 1_700_000_000_000, new, stale).withColumn("rebuilt", F.lit(1))), "rebuilt")


def primary_parent(spark, d):
    refs = F.transform(t.url_segments("url"), lambda s: F.concat(F.lit("workspace://SpacesStore/"), s))
    pages = t.table(spark, d, "pages").select("page_id", F.transform(refs, ref_to_uuid).alias("a"))
    return pages.select(
        "page_id", document.primary_parent(F.col("a")).alias("primary_parent"),
        _joined(document.parents_of(F.col("a"))).alias("parents"),
    )


def tags(spark, d):
    pages = t.table(spark, d, "pages").select("page_id", F.array(t.url_segments("url")).alias("name_paths"))
    return pages.select("page_id", _joined(document.tags_of(F.col("name_paths"), "fr")).alias("tags"))


def owner_fallback(spark, d):
    turns = t.table(spark, d, "conversations")
    by_role = F.when(F.col("role") == "user", F.concat(F.lit("u"), F.col("conv_id")))
    by_turn = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("t"), F.col("turn")))
    return turns.select("conv_id", "turn", document.owner_of(by_role, by_turn).alias("owner"))


def value_flatten(spark, d):
    """One value of every shape built from each turn."""
    shapes = F.to_json(F.struct(
        F.array(F.struct(F.col("role").alias("locale"), F.col("text").alias("value"))).alias("localised"),
        F.array(F.struct(F.col("role").alias("locale"))).alias("bare_locale"),
        F.array(F.struct(F.col("role").alias("locale"), F.col("text").alias("value"), F.lit(1).alias("z"))).alias("no_locale"),
        F.array(F.struct(F.col("conv_id").alias("id"), F.col("role").alias("name"))).alias("references"),
        F.struct(F.col("conv_id").alias("a"), F.col("role").alias("b")).alias("map"),
        F.col("turn").alias("number"),
        F.col("text").alias("plain"),
        F.array("turn", "conv_id").alias("numbers"),
    ))
    turns = t.table(spark, d, "conversations").select("conv_id", "turn", parse_properties(shapes).alias("p"))
    names = ["localised", "bare_locale", "no_locale", "references", "map", "number", "plain", "numbers"]
    return turns.select(
        "conv_id", "turn", *[flatten_value(F.try_element_at("p", F.lit(n))).alias(n) for n in names]
    )


# -- content ---------------------------------------------------------------------------------------------


def _stored_content(spark, d):
    """documents that have labels are in the index: quality 1 with their present content id, else with none."""
    labelled = t.table(spark, d, "documents").join(t.table(spark, d, "labels"), "doc_id")
    return labelled.select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("uuid"),
        F.when(F.col("quality") == 1, F.col("n_chars").cast("string")).alias("content_id"),
        F.lit(None).cast("string").alias("content_text"),
    )


def index_lookup(spark, d):
    keys = t.table(spark, d, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id")).alias("uuid"))
    return content.lookup_index(keys, _stored_content(spark, d))


def _changed(spark, d):
    documents = _documents(spark, d, 0).withColumn("reset", F.lit(False))
    candidates = content.content_candidates(documents).select("id", "uuid", "content_id", "reset")
    changed = content.changed_content(candidates, _stored_content(spark, d))
    return staged(changed.select("id", "uuid", "content_id"), f"{new_folder(spark, 'content')}/changed")


def content_changed(spark, d):
    changed = _changed(spark, d)
    fetched = content.non_empty(content.fetch_text(changed, t.document_texts(spark, d), measure(changed)[1]))
    return fetched.select("uuid", "content_id", F.md5("content_text").alias("text_md5"))


def content_applied(spark, d):
    changed = _changed(spark, d)
    fetched = content.fetch_text(changed, t.document_texts(spark, d), measure(changed)[1])
    updated = merge.apply_content(_stored_content(spark, d), fetched)
    return updated.select("uuid", "content_id", F.md5("content_text").alias("text_md5"))


# -- index upkeep ----------------------------------------------------------------------------------------


def _customer_index(spark, d):
    customers = t.table(spark, d, "customer").select(
        F.concat(F.lit("c-"), F.col("c_custkey")).alias("uuid"),
        F.lit("customer").alias("type"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("owner"),
        (F.lit(946_684_800_000) + (F.col("c_custkey") % 5) * 10_000_000_000).cast("bigint").alias("last_update_ms"),
        F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")).alias("fields"),
    )
    return merge.conform(customers)


def _order_documents(spark, d):
    """The latest order of each customer, as an update of the customer's document."""
    orders = t.table(spark, d, "orders").select(
        F.concat(F.lit("c-"), F.col("o_custkey")).alias("uuid"), t.millis("o_orderdate").alias("last_update_ms"),
        "o_orderkey", "o_orderpriority", "o_orderstatus",
    )
    last = orders.groupBy("uuid").agg(
        F.max(F.struct("last_update_ms", "o_orderkey", "o_orderpriority", "o_orderstatus")).alias("o")
    )
    return last.select(
        "uuid", F.lit("buyer").alias("type"),
        F.when(F.col("o.o_orderkey") % 3 == 0, F.col("o.o_orderstatus")).alias("owner"),
        F.col("o.last_update_ms").alias("last_update_ms"),
        F.create_map(F.lit("priority"), F.col("o.o_orderpriority"), F.lit("segment"), F.lit(None).cast("string")).alias("fields"),
    )


def _upserted(spark, d, mode):
    index = merge.apply_upserts(_customer_index(spark, d), merge.conform(_order_documents(spark, d)), mode)
    return index.select("uuid", "type", "owner", "last_update_ms", _pairs("fields").alias("fields"))


def apply_upsert(spark, d):
    return _upserted(spark, d, "partial")


def apply_upsert_replace(spark, d):
    return _upserted(spark, d, "replace")


def apply_delete(spark, d):
    index = t.table(spark, d, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("uuid"), F.col("lang").alias("type"), F.col("source").alias("owner"),
        F.col("n_chars").cast("bigint").alias("last_update_ms"),
    )
    toxic = t.table(spark, d, "labels").where("toxic = 1").select(
        F.concat(F.lit("workspace://SpacesStore/doc-"), F.col("doc_id")).alias("node_ref")
    )
    left = merge.apply_deletes(index, toxic.select(ref_tail("node_ref").alias("uuid")))
    return left.select("uuid", F.col("type").alias("lang"), F.col("owner").alias("source"), F.col("last_update_ms").alias("n_chars"))


def _field_numbers(index):
    return index.select("uuid", _number("quantity"), _number("price"), _number("discount"), _number("tax"))


def _event_store(spark, events, folder):
    return EventStore(spark, folder, {c: events.schema[c].dataType.simpleString() for c in t.LINE_ORDER}, slices=4, buckets=8)


def two_batches(spark, d):
    """The line feed in two commits, the second half of the log first."""
    events = _line_events(spark, d)
    last = events.agg(F.max("txn_id")).first()[0]
    store = _event_store(spark, events, new_folder(spark, "two-batches"))
    for low, high in ((last // 2, last), (0, last // 2)):
        store.apply(events.where(F.col("txn_id").between(low + 1, high)), high)
    return _field_numbers(store.documents())


#: Files of a range at least, ranges, and rows of a file about.
FILES, GROUPS, FILE_ROWS = 2, 3, 1_000_000
#: Buckets of a streamed index at least, and change rows for each.
BUCKETS, BUCKET_ROWS = 8, 25_000


def _feed_files(rows, folder, last, place, files, backwards=False):
    """Rows as files, so many for each of GROUPS ranges of transactions; a range's last transaction goes on in the next
    range with its rows of an even place. Backwards: the last range is written, and so comes, first."""
    for i in sorted(range(GROUPS), reverse=backwards):
        low, high = last * i // GROUPS, last * (i + 1) // GROUPS
        here = F.col("txn_id").between(low + 1, high)
        if i < GROUPS - 1:
            here = here & ~((F.col("txn_id") == high) & place)
        if i:
            here = here | ((F.col("txn_id") == low) & place)
        rows.where(here).repartition(files, F.rand(7)).write.mode("append").parquet(folder)


def _file_numbers(n):
    """Files of each of GROUPS ranges of n rows: no task writes or reads more than FILE_ROWS or so."""
    return max(FILES, math.ceil(n / GROUPS / FILE_ROWS))


def _bucket_number(n):
    """Buckets for n change rows: a snapshot is read, joined and rewritten by one task for each."""
    return max(BUCKETS, math.ceil(n / BUCKET_ROWS))


def stream_net_state(spark, d):
    """The line feed as files that come in the wrong order, some transactions over two of them and every 50th, a
    straggler, after all others."""
    events = _line_events(spark, d)
    folder = new_folder(spark, "stream")
    late = F.col("txn_id") % 50 == 7
    last, n, n_late = events.agg(F.max("txn_id"), F.count(F.lit(1)), F.count_if(late)).first()
    files = _file_numbers(n - n_late)
    _feed_files(events.where(~late), f"{folder}/feed", last, F.col("l_linenumber") > 2, files, backwards=True)
    events.where(late).repartition(math.ceil(n_late / FILE_ROWS) or 1, F.rand(7)).write.mode("append").parquet(f"{folder}/feed")
    store = _event_store(spark, events, f"{folder}/index")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/feed")
    stream_events(source, store, f"{folder}/checkpoint", seconds=None).awaitTermination()
    return _field_numbers(store.documents())


def stream_documents(spark, d):
    """The whole cycle over a stream of the documents' changes, some transactions over two micro-batches."""
    sources = document_sources(spark, d)
    folder = new_folder(spark, "stream-documents")
    last = sources.log.agg(F.max("id")).first()[0]
    n = sources.changes.count()
    files = _file_numbers(n)
    _feed_files(sources.changes, f"{folder}/feed", last, F.col("id") % 2 == 0, files)
    store = IndexStore(spark, f"{folder}/index", slices=4, buckets=_bucket_number(n)).ensure()
    source = spark.readStream.schema(sources.changes.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/feed")
    stream_index(source, store, sources, f"{folder}/checkpoint", seconds=None).awaitTermination()
    return _cycle_rows(store)


def document_sources(spark, d):
    return Sources(
        log=t.document_log(spark, d),
        changes=t.document_changes(spark, d),
        metadata=t.document_metadata(spark, d),
        acls=t.acl_readers(spark, d),
        model_diffs=t.model_diffs(spark, d),
        model_definitions=t.model_definitions(spark, d),
        texts=t.document_texts(spark, d),
    )


def _cycle_rows(store):
    text = F.col("content_id"), F.md5("content_text").alias("text_md5")
    return _flat(store.index(), *text)


def index_cycle(spark, d):
    """The whole cycle over the documents, all that is pending in one batch."""
    store = IndexStore(spark, new_folder(spark, "cycle"), slices=4, buckets=8).ensure()
    catch_up(store, document_sources(spark, d), max_results=None)
    return _cycle_rows(store)


HOLD_BACK_MS = 3 * 86_400_000


def settled_mark(spark, d):
    """How far the mark may move over a log with gaps, at several ages of its commits."""
    log = t.sparse_log(spark, d)
    moments = {days: log.where(F.col("id") <= 450 + days).agg(F.max("commit_time_ms")).first()[0] for days in (0, 100, 900)}
    rows = [feed.settled_mark(log.where(F.col("id") <= 450 + days), 20, HOLD_BACK_MS, now).select(F.lit(days).alias("days"), "settled_id")
            for days, now in moments.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def log_gaps(spark, d):
    return feed.gaps_of(t.sparse_log(spark, d), 0)


def late_transactions(spark, d):
    """What has filled the gaps of the sparse log once the whole log is there."""
    return feed.late_transactions(t.transactions(spark, d), feed.open_gaps(t.sparse_log(spark, d)))


def held_back_cycle(spark, d):
    """The cycle over a log in which every seventh transaction comes after all others."""
    sources = document_sources(spark, d)
    late = F.col("id") % 7 == 3
    store = IndexStore(spark, new_folder(spark, "held-back"), slices=4, buckets=8).ensure()
    options = Options(hold_back_ms=0)
    catch_up(store, replace(sources, log=sources.log.where(~late), changes=sources.changes.where("txn_id % 7 != 3")), None, options)
    catch_up(store, sources, None, options)
    return _cycle_rows(store).drop("last_update_ms")


def documents_as_of(spark, d):
    """A document for each update, from the metadata that held at its transaction and with that transaction's stamp."""
    updates = t.document_changes(spark, d).where("status = 'u'")
    nodes = metadata_as_of(updates.select("id", "node_ref", "txn_id"), t.document_versions(spark, d), t.document_log(spark, d))
    nodes = nodes.withColumn("properties", parse_properties(F.col("properties"))).withColumn("uuid", ref_to_uuid("node_ref"))
    named = prefix_properties(nodes, _registry(spark, d))
    readers = readers_by_acl(t.acl_readers(spark, d), t.document_metadata(spark, d))
    return _flat(document.build_documents(attach_readers(named, readers), F.col("stamp_ms"), "txn_id"), "txn_id")


def _damaged(sources):
    """Unknown statuses, lost references, metadata lost, cut short or given twice, and an access list given twice."""
    doc = F.col("id")
    changes = sources.changes.withColumn("status", F.when(doc % 17 == 3, "x").otherwise(F.col("status")))
    changes = changes.withColumn("node_ref", F.when(doc % 13 != 5, F.col("node_ref")))
    metadata = sources.metadata.where(doc % 29 != 8).withColumn(
        "properties", F.when(doc % 19 == 4, F.substring("properties", 1, 20)).otherwise(F.col("properties")))
    return replace(
        sources, changes=changes, metadata=metadata.unionByName(metadata.where(doc % 23 == 6)),
        acls=sources.acls.unionByName(sources.acls.where("acl_id = 7")))


def rejects_report(spark, d):
    """Findings by rule, and documents indexed, of a cycle over damaged input that leaves bad rows out."""
    damaged = replace(_damaged(document_sources(spark, d)), texts=None)
    store = IndexStore(spark, new_folder(spark, "rejects"), slices=4, buckets=8).ensure()
    catch_up(store, damaged, None, Options(on_error="reject"))
    found = spark.read.parquet(f"{store.root}/rejects/c=1").select("rule")
    return quality.counts(found.unionByName(store.read("meta").select(F.lit("indexed").alias("rule"))))


def rejects_replayed(spark, d):
    """The index after a cycle over damaged input once the input is repaired and what was left out is driven again."""
    sources = document_sources(spark, d)
    store = IndexStore(spark, new_folder(spark, "replayed"), slices=4, buckets=8).ensure()
    catch_up(store, _damaged(sources), None, Options(on_error="reject"))
    replay_pending(store, sources)
    return _cycle_rows(store).drop("last_update_ms")


def export_changes(spark, d):
    """Customers before and after their orders are merged in, every eleventh gone, as bulk actions read back."""
    before = _customer_index(spark, d)
    after = merge.apply_upserts(before, merge.conform(_order_documents(spark, d)))
    after = after.where(F.substring("uuid", 3, 20).cast("bigint") % 11 != 0)
    folder = f"{new_folder(spark, 'bulk')}/lines"
    export_bulk(bulk_actions(change_set(before, after), "documents"), folder, limit=20_000, slices=8)
    heads = spark.read.text(folder).where("value like '{\"update\":%' or value like '{\"delete\":%'")
    action = F.when(F.col("value").startswith('{"update"'), "update").otherwise("delete")
    return heads.select(F.coalesce(F.get_json_object("value", "$.update._id"), F.get_json_object("value", "$.delete._id")).alias("uuid"), action.alias("action"))


def bulk_export(spark, d):
    """Documents as bulk lines, read back from the text."""
    built = _documents(spark, d, 1_700_000_000_000)
    texts = t.document_texts(spark, d).withColumnRenamed("text", "content_text")
    lines = bulk_lines(built.join(texts, "id"), "documents").select(F.split("value", "\n").alias("lines"))
    payload = lines.select(F.col("lines")[0].alias("action"), F.col("lines")[1].alias("body"))
    doc = F.from_json("body", "doc map<string,variant>")["doc"]
    held = payload.select(F.get_json_object("action", "$.update._id").alias("uuid"), doc.alias("doc"))

    def text(name):
        return F.try_variant_get(F.try_element_at("doc", F.lit(name)), "$", "string")

    def items(name):
        return _joined(F.try_element_at("doc", F.lit(name)).try_cast("array<string>"))

    return held.select(
        "uuid",
        text(K.FIELD_TYPE).alias("type"),
        text(K.FIELD_PRIMARY_PARENT).alias("primary_parent"),
        items(K.FIELD_READERS).alias("readers"),
        text(K.FIELD_OWNER).alias("owner"),
        items(K.FIELD_TAGS).alias("tags"),
        text(K.FIELD_LAST_UPDATE).cast("bigint").alias("last_update_ms"),
        text("cm%3Aname").alias("name"),
        text(K.FIELD_CONTENT_SIZE).alias("size"),
        text(K.FIELD_CONTENT_ID).alias("content_id"),
        F.md5(text(K.FIELD_CONTENT_TEXT)).alias("text_md5"),
        F.size("doc").alias("n_fields"),
    )


def quality_report(spark, d):
    """Findings per rule over all feeds."""
    events = t.change_events(spark, d).withColumn(
        "status", F.when(F.col("feed_pos") % 97 == 0, F.lit(None)).when(F.col("feed_pos") % 89 == 0, "x").otherwise(F.col("status"))
    )
    nations = _nation_models(spark, d)
    models = registry.read_models(nations.select("name", "pos"), nations.select("name", "xml").where("xml is not null"))
    keys = _event_keys(spark, d).select(
        F.when(F.col("event_id") % 50 == 0, F.regexp_replace("name", r"[{}]", "")).otherwise(F.col("name")).alias("name")
    ).distinct()
    changed = t.table(spark, d, "documents").select(
        (F.col("doc_id") * 2).alias("id"), F.concat(F.lit("doc-"), F.col("doc_id")).alias("uuid"),
        F.col("n_chars").cast("string").alias("content_id"),
    )
    parts = t.change_lines(spark, d).where("status = 'u'").select("id", ref_to_uuid("node_ref").alias("uuid")).distinct()
    pages = t.table(spark, d, "pages").select(
        "page_id", F.when(F.col("page_id") % 3 == 0, ref_tail("url")).otherwise(F.col("url")).alias("ref")
    )
    acls = t.table(spark, d, "customer").select(F.col("c_nationkey").alias("acl_id"))
    return quality.counts(quality.combined(
        quality.bad_status(events),
        quality.duplicate_acls(acls),
        quality.unknown_envelope_members(envelope_members(spark, d)),
        quality.keys_without_brace(keys),
        quality.unknown_namespaces(_prefixed(keys.where(F.instr("name", "}") > 0), _registry(spark, d))),
        quality.bad_models(models),
        quality.bad_references(pages, "ref", "page_id"),
        quality.missing_metadata(parts, t.document_metadata(spark, d)),
        quality.missing_content(changed, content.non_empty(content.fetch_text(changed, t.document_texts(spark, d), measure(changed)[1]))),
    ))


QUERIES = {
    "net_state": net_state_lines,
    "net_state_events": net_state_events,
    "net_changes": net_changes,
    "pending_transactions": pending_transactions,
    "page_bounds": page_bounds,
    "changes_between": changes_between,
    "txn_reconcile": txn_reconcile,
    "txn_mismatch": txn_mismatch,
    "indexing_lag": indexing_lag,
    "log_gaps": log_gaps,
    "settled_mark": settled_mark,
    "late_transactions": late_transactions,
    "envelope_decode": envelope_decode,
    "envelope_members": envelope_members,
    "metadata_join": metadata_join,
    "metadata_pruned": metadata_pruned,
    "missing_metadata": missing_metadata,
    "acl_expand": acl_expand,
    "acl_expand_salted": acl_expand_salted,
    "acl_duplicates": acl_duplicates,
    "model_registry": model_registry,
    "bad_models": bad_models,
    "property_prefix": property_prefix,
    "unknown_namespaces": unknown_namespaces,
    "registry_size": registry_size,
    "registry_listing": registry_listing,
    "field_dictionary": field_dictionary,
    "ref_uuid": ref_uuid,
    "ref_tail": ref_tails,
    "bad_references": bad_references,
    "unescape_text": unescape_text,
    "escape_text": escape_text,
    "documents_built": documents_built,
    "documents_built_by_join": documents_built_by_join,
    "registry_propagated": registry_propagated,
    "primary_parent": primary_parent,
    "tags": tags,
    "owner_fallback": owner_fallback,
    "value_flatten": value_flatten,
    "index_lookup": index_lookup,
    "content_changed": content_changed,
    "content_applied": content_applied,
    "content_latest": content_latest,
    "apply_upsert": apply_upsert,
    "apply_upsert_replace": apply_upsert_replace,
    "apply_delete": apply_delete,
    "two_batches": two_batches,
    "stream_net_state": stream_net_state,
    "index_cycle": index_cycle,
    "stream_index": stream_documents,
    "held_back_cycle": held_back_cycle,
    "documents_as_of": documents_as_of,
    "rejects_report": rejects_report,
    "rejects_replayed": rejects_replayed,
    "bulk_export": bulk_export,
    "export_changes": export_changes,
    "quality_report": quality_report,
}
