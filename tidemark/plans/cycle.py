"""The indexing cycle: next page of the log -> net changes -> documents -> rewritten slices -> commit."""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.refs import ref_tail, ref_to_uuid
from tidemark.functions.values import parse_properties, parsed_properties
from tidemark.operators import content, quality
from tidemark.operators.document import build_documents
from tidemark.operators.enrich import (
    attach_metadata, attach_readers, latest_metadata, prefix_properties, readers_by_acl, with_references,
)
from tidemark.operators.lookups import BROADCAST_BYTES, join_on_keys, measure, pruned
from tidemark.operators.merge import apply_changes, apply_texts
from tidemark.operators.net_state import latest_changes
from tidemark.operators.registry import build_registry, read_models
from tidemark.sinks.snapshot import slice_of, staged
from tidemark.sources.feed import changes_between, late_transactions, open_gaps, page_bounds, routed, settled_mark

# What the pipeline reads of a node: its other parts (children, paths) are never fetched.
METADATA_COLUMNS = ("id", "type", "acl_id", "properties", "aspects", "name_paths", "ancestors")


@dataclass
class Sources:
    """Tables a cycle reads. `texts` may be None when only metadata is indexed. lookup_buckets: metadata and texts were
    written by lookups.write_lookup in so many buckets, and a batch reads those of its ids."""

    log: DataFrame
    changes: DataFrame
    metadata: DataFrame
    acls: DataFrame
    model_diffs: DataFrame
    model_definitions: DataFrame
    texts: DataFrame = None
    findings: DataFrame = None  # rule, key, detail of what the input itself holds and nobody understands
    lookup_buckets: int = None


@dataclass
class Options:
    merge: str = "partial"
    on_error: str = "fail"
    store_name: str = K.LIVE_STORE
    tag_root: str = K.TAG_ROOT
    small_registry: int = 1000
    hold_back_ms: int = None  # how long the mark waits for the transactions of a gap; None: it doesn't look for gaps


def run_batch(store, sources, max_results=K.DEFAULT_MAX_TRANSACTIONS, options=None, now_ms=None):
    """Index the next page of the log. Returns its bounds, or None when nothing is pending.

    Any failure leaves the last commit in place, so the page is read again; applying it twice is harmless.

    With a hold-back the page ends before the first gap in the transaction ids that is younger (at now_ms, by default
    the log's latest commit time). Older gaps are passed over but remembered, and what fills one is read with the next
    page.
    """
    options = options or Options()
    store.refresh()
    if options.hold_back_ms is not None:
        return _run_held_back(store, sources, max_results, options, now_ms)
    bounds = page_bounds(sources.log, store.watermark(), max_results).first()
    if not bounds["n_txn"]:
        return None
    changes = changes_between(sources.changes, bounds["min_txn_id"], bounds["max_txn_id"])
    apply_page(store, sources, changes, bounds["max_txn_id"], bounds["repo_max_commit_ms"], options)
    return bounds


def _run_held_back(store, sources, max_results, options, now_ms):
    mark, known = store.watermark(), store.open_gaps()
    limit = settled_mark(sources.log, mark, options.hold_back_ms, now_ms).first()["settled_id"]
    bounds = page_bounds(sources.log, mark, max_results, limit).first()
    late = None if known is None else staged(late_transactions(sources.log, known), f"{store.root}/work/late")
    n_late = late.count() if late is not None else 0
    if not bounds["n_txn"] and not n_late:
        return None
    reached = bounds["max_txn_id"] if bounds["n_txn"] else mark
    changes = changes_between(sources.changes, mark + 1, reached)
    if n_late:
        # nodes of late transactions are replayed from the start, so that what has come after them still comes last
        rows = join_on_keys(late.select(F.col("id").alias("txn_id")), sources.changes, "txn_id", 24 * n_late)
        nodes = staged(rows.select("id").distinct(), f"{store.root}/work/late-nodes")
        history = join_on_keys(nodes, sources.changes.where(F.col("txn_id") <= mark), "id", measure(nodes)[1])
        changes = changes.unionByName(history.select(changes.columns))
    gaps = open_gaps(sources.log.where(F.col("id") <= reached))
    apply_page(store, sources, changes, reached, bounds["repo_max_commit_ms"], options, gaps=gaps)
    return bounds


def catch_up(store, sources, max_results=K.DEFAULT_MAX_TRANSACTIONS, options=None):
    """Run batches until the log is exhausted; returns how many ran."""
    batches = 0
    while run_batch(store, sources, max_results, options):
        batches += 1
    return batches


def apply_page(store, sources, changes, mark, stamp_ms, options=None, progress=None, gaps=None):
    """Apply change rows and move the mark. progress: the stream and micro-batch they are; gaps: see Control.commit.

    Intermediate tables are written to the store's shared folder: they cut the plan where sizes are
    measured, and a lost executor costs only the tasks it ran. The next batch writes over them.
    """
    options = options or Options()
    work = f"{store.root}/work"

    if sources.findings is not None and options.on_error == "fail":
        strange = sources.findings.first()
        if strange:
            raise ValueError(f"input that is not understood: {strange['rule']} {strange['key']}")
    models = staged(read_models(sources.model_diffs, sources.model_definitions), f"{work}/models")
    registry = build_registry(models)

    changes = staged(changes, f"{work}/read")
    if sources.lookup_buckets is not None:
        tables = {name: getattr(sources, name) for name in ("metadata", "texts")}
        sources = replace(sources, **{name: table and pruned(table, changes, sources.lookup_buckets) for name, table in tables.items()})
    changes = staged(with_references(changes, sources.metadata), f"{work}/changes")
    net = staged(net_changes(changes, store.slices, options.on_error), f"{work}/net")
    extent = _extent(net)
    updates = net.where("op = 'upsert'").select("id", "uuid", "reset")
    thin = staged(_checked(latest_metadata(updates, sources.metadata, extent["size"]), options), f"{work}/thin")
    nodes, refused_acls = _enriched(thin, extent["size"], sources, registry, options, work)
    built = staged(
        build_documents(nodes, stamp_ms, "reset", "refused_keys", "bad_properties", tag_root=options.tag_root), f"{work}/documents"
    )
    documents = built.where("not bad_properties")
    # A delete stands when no document follows it, be it last in the feed or the metadata gone.
    removed = net.where("op = 'delete' or reset").join(documents.select("uuid"), "uuid", "left_anti")
    incoming = documents.withColumn("op", F.lit("upsert")).unionByName(
        removed.select("uuid", F.lit("delete").alias("op"), F.lit(True).alias("reset")), allowMissingColumns=True
    )
    if extent["slices"]:
        store.write("meta", apply_changes(store.read("meta", extent["slices"]), incoming, options.merge), extent["slices"])

    reports = [
        quality.bad_status(changes),
        quality.bad_references(changes),
        quality.bad_models(models),
        quality.missing_metadata(updates, thin),
        quality.repeated_metadata(thin),
        quality.bad_properties(built.where("bad_properties")),
        quality.keys_without_brace(_names(documents, "refused_keys")),
        quality.unknown_namespaces(_names(documents, "property_names")),
        *[report for report in (refused_acls, sources.findings) if report is not None],
    ]
    if sources.texts is not None and extent["slices"]:
        reports.append(_refresh_text(store, sources, net, documents, extent, work, options))
    found = staged(quality.combined(*reports), f"{store.root}/rejects/c={store.next_commit()}")
    failed = quality.failed_nodes(changes, updates, documents, found)
    store.commit(mark, progress, gaps, quality.still_pending(store.pending(), changes, failed))


def replay_pending(store, sources, options=None):
    """Drive the nodes again that earlier batches could not index, without new change rows. Returns how many there were.

    Their change rows up to the mark are read again, so the last of them decides as it did. Nodes that can be indexed
    now leave the pending table; the others stay, with one more try.
    """
    store.refresh()
    pending = store.pending()
    n = pending.count() if pending is not None else 0
    if n:
        mark = store.watermark()
        history = join_on_keys(pending.select("id"), sources.changes.where(F.col("txn_id") <= mark), "id", 24 * n)
        stamp = sources.log.agg(F.max("commit_time_ms")).first()[0]
        apply_page(store, sources, history.select(sources.changes.columns), mark, stamp, options)
    return n


def net_changes(changes, slices, on_error="fail"):
    """Change rows -> one row per document key: op, reset, node id and slice of the index."""
    rows = routed(changes, on_error)
    tail = ref_tail("node_ref", on_error if on_error == "fail" else "null")
    key = F.when(F.col("is_delete"), tail).otherwise(ref_to_uuid("node_ref"))
    keyed = rows.withColumn("uuid", key).where("uuid is not null")
    net = latest_changes(keyed, "uuid", ["txn_id", "feed_pos"], ["id"])
    return net.withColumn("slice", slice_of("uuid", slices))


def _extent(net):
    """Bytes of the document keys of a batch, and the slices they lie in."""
    width = F.octet_length("uuid") + 16
    return net.agg(F.coalesce(F.sum(width), F.lit(0)).alias("size"), F.collect_set("slice").alias("slices")).first()


def _checked(thin, options):
    """Raise where a node has several metadata rows of one version, unless such nodes are to be left out."""
    if options.on_error == "reject":
        return thin
    failure = F.raise_error(F.concat(F.lit("metadata given twice: "), F.col("id").cast("string"))).cast("bigint")
    return thin.withColumn("n", F.when(F.col("n") > 1, failure).otherwise(F.col("n")))


def _enriched(thin, size, sources, registry, options, work):
    """Metadata, readers and prefixed properties of the updated nodes, and the access lists that were refused.

    Readers small enough to broadcast are attached to the finished rows. Otherwise they are attached to the
    keys first, so that the join on the ACL moves thin rows and the wide metadata is shuffled once, by id.
    """
    keys, refused = thin.where("n = 1").select("id", "uuid", "reset", "acl_id", F.col("version").alias("_version")), None
    if options.on_error == "reject":
        wanted = sources.acls.join(keys.select("acl_id").distinct(), "acl_id", "left_semi")
        refused = quality.duplicate_acls(wanted)
        twice = refused.select(F.col("key").cast("bigint").alias("acl_id"))
        keys = keys.join(twice, "acl_id", "left_anti")
    readers = staged(readers_by_acl(sources.acls, keys, options.on_error), f"{work}/readers")
    readers_size = measure(readers)[1]
    wide = sources.metadata.select(*METADATA_COLUMNS, *(["version"] if "version" in sources.metadata.columns else []))
    if "version" not in wide.columns:
        wide = wide.withColumn("version", F.lit(None).cast("bigint"))
    wide = wide.drop("acl_id")
    if readers_size <= BROADCAST_BYTES:
        nodes = attach_readers(attach_metadata(keys, wide, size), readers, size=readers_size)
    else:
        nodes = wide.join(attach_readers(keys, readers, size=readers_size), "id")
    # building a document costs more than moving its row, and the scan may have few row groups: all tasks build
    nodes = nodes.where(F.col("version").eqNullSafe(F.col("_version"))).drop("version", "_version").repartition("uuid")
    parsed = parsed_properties(F.col("properties")) if options.on_error == "reject" else parse_properties(F.col("properties"))
    nodes = nodes.withColumn("_parsed", parsed).withColumn("bad_properties", F.col("_parsed").isNull())
    nodes = nodes.withColumn("properties", F.coalesce("_parsed", parsed_properties(F.lit("{}")))).drop("_parsed")
    nodes = nodes.withColumn("refused_keys", F.filter(F.map_keys("properties"), lambda k: F.instr(k, "}") == 0))
    return prefix_properties(nodes, registry, on_error=options.on_error, max_rows=options.small_registry), refused


def _refresh_text(store, sources, net, documents, extent, work, options):
    """Drop the texts of removed documents and write those whose content id moved; returns the report of missing ones."""
    candidates = content.content_candidates(documents, options.store_name)
    moved = content.changed_content(candidates, store.read("text", extent["slices"]))
    changed = staged(moved.select("id", "uuid", "content_id", slice_of("uuid", store.slices).alias("slice")), f"{work}/changed")
    removed = net.where("op = 'delete' or reset").select("uuid", "slice")
    size = changed.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("uuid") + F.octet_length("content_id") + 64), F.lit(0)).alias("size")).first()
    slices = [r[0] for r in changed.select("slice").union(removed.select("slice")).distinct().collect()]
    if slices:
        found = content.non_empty(content.fetch_text(changed.drop("slice"), sources.texts, size["size"]))
        store.write("text", apply_texts(store.read("text", slices), found, removed), slices)
    written = store.read("text", slices).select("uuid", "content_id")
    return quality.missing_content(changed, written)


def _names(documents, column):
    return documents.select(F.explode(column).alias("name")).distinct()
