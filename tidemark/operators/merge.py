"""Guarded partial upsert, delete and text update of a keyed index."""

from pyspark.sql import functions as F

from tidemark.schemas import DOCUMENT_COLUMNS, OPTIONAL_COLUMNS

FRESH, KEPT, MERGED = "fresh", "kept", "merged"


def conform(df, *extra):
    """The document columns of df in index order, missing ones as typed nulls, plus the extra columns."""
    have = set(df.columns)
    columns = [
        F.col(c) if c in have else F.lit(None).cast(kind).alias(c) for c, kind in DOCUMENT_COLUMNS.items()
    ]
    return df.select("uuid", *columns, *extra)


def merge_maps(old, new):
    """Entries of both maps, the new ones winning."""
    kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(new, k))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def _incoming_state(mode):
    """How an incoming upsert meets the stored document: replaces it, leaves it, or merges into it."""
    stored, newer = F.col("old.uuid").isNotNull(), F.col("old.last_update_ms") > F.col("new.last_update_ms")
    fresh = ~stored | F.col("new.reset")
    settled = F.lit(FRESH) if mode == "replace" else F.lit(MERGED)
    return F.when(fresh, FRESH).when(F.coalesce(newer, F.lit(False)), KEPT).otherwise(settled)


def _merged_columns(state):
    for c in DOCUMENT_COLUMNS:
        old, new = F.col(f"old.{c}"), F.col(f"new.{c}")
        if c == "fields":
            both = merge_maps(old, new)
        elif c in OPTIONAL_COLUMNS:
            both = F.coalesce(new, old)
        else:
            both = new
        yield F.when(state == FRESH, new).when(state == KEPT, old).otherwise(both).alias(c)


def apply_changes(index, net, mode="partial"):
    """The index after a batch. `net` has one row per uuid (op, reset and document columns).

    One full outer join on the key: documents the batch doesn't name and those guarded by a newer stamp stay as they
    are, deleted ones go, the rest are merged.
    """
    if mode not in ("partial", "replace"):
        raise ValueError(f"merge mode must be partial or replace, not {mode!r}")
    old, new = conform(index).alias("old"), conform(net, "op", "reset").alias("new")
    joined = old.join(new, F.col("old.uuid") == F.col("new.uuid"), "full_outer")
    state = F.when(F.col("new.uuid").isNull(), KEPT).otherwise(_incoming_state(mode))
    left = F.col("new.op").isNull() | (F.col("new.op") != "delete")
    return joined.where(left).select(F.coalesce("old.uuid", "new.uuid").alias("uuid"), *_merged_columns(state))


def apply_upserts(index, documents, mode="partial"):
    """Insert new documents; into stored ones merge the incoming fields, unless the stored stamp is newer."""
    upserts = documents.withColumn("op", F.lit("upsert")).withColumn("reset", F.lit(False))
    return apply_changes(index, upserts, mode)


def apply_deletes(index, uuids):
    """The index without the documents of the given keys."""
    deletes = uuids.select("uuid").distinct().withColumn("op", F.lit("delete")).withColumn("reset", F.lit(True))
    return apply_changes(index, deletes)


def apply_content(index, content):
    """Set content_id and content_text of documents that exist; never inserts, empty text changes nothing."""
    updates = content.where(F.length("content_text") > 0).select(
        "uuid", F.col("content_id").alias("_id"), F.col("content_text").alias("_text")
    )
    hit = F.col("_text").isNotNull()
    return (
        index.join(updates, "uuid", "left")
        .withColumn("content_id", F.when(hit, F.col("_id")).otherwise(F.col("content_id")))
        .withColumn("content_text", F.when(hit, F.col("_text")).otherwise(F.col("content_text")))
        .drop("_id", "_text")
    )


def apply_texts(stored, found, removed):
    """Texts after a batch: those found (uuid, content_id, content_text) replace the stored ones, removed documents (uuid)
    lose theirs; one full outer join."""
    gone = removed.select("uuid", F.lit(True).alias("_gone"))
    named = found.select("uuid", "content_id", "content_text").join(gone, "uuid", "full_outer").alias("new")
    joined = stored.alias("old").join(named, F.col("old.uuid") == F.col("new.uuid"), "full_outer")
    hit, gone = F.col("new.content_text").isNotNull(), F.coalesce("new._gone", F.lit(False))
    return joined.where(hit | ~gone).select(
        F.coalesce("old.uuid", "new.uuid").alias("uuid"),
        *[F.when(hit, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in ("content_id", "content_text")])
