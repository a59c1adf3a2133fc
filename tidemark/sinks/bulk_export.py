"""Export of index rows as bulk-load lines for an external search engine."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.text import ASCII_JSON, escape_json
from tidemark.sinks.snapshot import slice_of


def _quoted(text):
    return F.concat(F.lit('"'), escape_json(text), F.lit('"'))


def document_members(df):
    """Array of `"name":value` texts of a document, in ASCII-only JSON; absent fields are left out."""

    def member(name, value, present):
        return F.when(present, F.concat(F.lit(f'"{name}":'), value))

    def always(name, value):
        return member(name, F.coalesce(value, F.lit("null")), F.lit(True))

    def given(name, value, column):
        return member(name, value, F.col(column).isNotNull())

    info = F.col("content_info")
    members = [
        always(K.FIELD_TYPE, _quoted(F.col("type"))),
        given(K.FIELD_PRIMARY_PARENT, _quoted(F.col("primary_parent")), "primary_parent"),
        given(K.FIELD_PARENTS, F.to_json("parents", ASCII_JSON), "parents"),
        always(K.FIELD_READERS, F.to_json("readers", ASCII_JSON)),
        always(K.FIELD_LAST_UPDATE, F.col("last_update_ms").cast("string")),
        given(K.FIELD_OWNER, _quoted(F.col("owner")), "owner"),
        always(K.FIELD_PROPERTY_NAMES, F.to_json("property_names", ASCII_JSON)),
        always(K.FIELD_ASPECTS, F.to_json("aspects", ASCII_JSON)),
        always(K.FIELD_TAGS, F.to_json("tags", ASCII_JSON)),
        always(K.FIELD_ALIVE, F.col("alive").cast("string")),
        given(K.FIELD_CONTENT_MIME, F.coalesce(_quoted(info["mimetype"]), F.lit("null")), "content_info"),
        given(K.FIELD_CONTENT_SIZE, F.coalesce(_ascii(info["size"]), F.lit("null")), "content_info"),
        given(K.FIELD_CONTENT_ENCODING, F.coalesce(_quoted(info["encoding"]), F.lit("null")), "content_info"),
    ]
    if "content_text" in df.columns:
        members += [
            given(K.FIELD_CONTENT_TEXT, _quoted(F.col("content_text")), "content_text"),
            given(K.FIELD_CONTENT_ID, _quoted(F.col("content_id")), "content_id"),
        ]
    open_members = F.transform(
        F.map_entries(F.coalesce("fields", F.create_map().cast("map<string,string>"))),
        lambda e: F.concat(_quoted(e["key"]), F.lit(":"), F.coalesce(_ascii(e["value"]), F.lit("null"))),
    )
    return F.concat(F.array_compact(F.array(*members)), open_members)


def _ascii(json):
    """JSON text with characters beyond ASCII escaped."""
    escaped = F.replace(F.replace(escape_json(json), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    return F.when(json.rlike(r"[^\x00-\x7F]"), escaped).otherwise(json)


def bulk_lines(index, index_name):
    """Two-line bulk action per document: the `update` line and the `doc_as_upsert` line."""
    body = F.concat(F.lit("{"), F.array_join(document_members(index), ","), F.lit("}"))
    action = F.concat(
        F.lit('{"update":{"_index":"'), escape_json(F.lit(index_name)),
        F.lit('","_id":'), _quoted(F.col("uuid")), F.lit("}}"),
    )
    return index.select(
        "uuid", F.concat(action, F.lit('\n{"doc_as_upsert":true,"doc":'), body, F.lit("}")).alias("value")
    )


def change_set(before, after):
    """What turns one state of the index into another: the documents of `after` that are new or differ in any field
    (action "update"), and the keys of those that are gone (action "delete"). One full outer join; nulls are equal."""
    columns = [c for c in after.columns if c != "uuid"]

    def comparable(df, alias):
        # maps can't be compared; their sorted entries can
        kinds = dict(df.dtypes)
        values = [F.sort_array(F.map_entries(c)).alias(c) if kinds[c].startswith("map") else F.col(c) for c in columns]
        return df.select("uuid", F.struct(*columns).alias("doc"), F.struct(*values).alias("values")).alias(alias)

    joined = comparable(before, "old").join(comparable(after, "new"), F.col("old.uuid") == F.col("new.uuid"), "full_outer")
    gone, same = F.col("new.uuid").isNull(), F.col("old.values").eqNullSafe(F.col("new.values")) & F.col("old.uuid").isNotNull()
    return joined.where(~same | gone).select(
        F.coalesce("new.uuid", "old.uuid").alias("uuid"), F.when(gone, F.lit("delete")).otherwise(F.lit("update")).alias("action"), "new.doc.*")


def bulk_actions(changes, index_name):
    """uuid, action and value, the bulk lines of each change: an update as in bulk_lines, or a line that deletes."""
    head = F.concat(F.lit('{"delete":{"_index":"'), escape_json(F.lit(index_name)), F.lit('","_id":'), _quoted(F.col("uuid")), F.lit("}}"))
    updates = bulk_lines(changes.where("action = 'update'"), index_name).select("uuid", F.lit("update").alias("action"), "value")
    return updates.unionByName(changes.where("action = 'delete'").select("uuid", "action", head.alias("value")))


def packed(actions, limit, slices):
    """actions with slice and pack, the file of its slice each goes to: by a running sum of bytes within the slice, in
    the order of the keys, so that no file is larger than limit. An action that is larger by itself is refused."""
    size = F.octet_length("value") + 1
    largest = actions.agg(F.coalesce(F.max(size), F.lit(0))).first()[0]
    if largest > limit:
        raise ValueError(f"a bulk action of {largest} bytes can't fit a file of {limit}")
    order = Window.partitionBy("slice").orderBy("uuid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(size).over(order), F.lit(0))
    # a file takes the actions that begin within its span; the last may reach beyond it by its own length
    span = max(1, limit - largest + 1)
    return actions.withColumn("slice", slice_of("uuid", slices)).withColumn("pack", F.floor(before / span))


def export_bulk(actions, path, limit=64 << 20, slices=64):
    """Write bulk actions as text, each file under the limit, in folders by slice of the index and pack."""
    files = packed(actions, limit, slices).repartition("slice", "pack").sortWithinPartitions("slice", "pack", "uuid")
    files.select("slice", "pack", "value").write.mode("errorifexists").partitionBy("slice", "pack").text(path)
