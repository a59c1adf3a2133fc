"""Views of the driver tables in the shapes the engine reads (see FIXTURES.md)."""

from pyspark.sql import functions as F

ACL_COUNT = 30
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def millis(ts):
    """Epoch millis of a zone-less timestamp, whatever the session's zone."""
    ts = F.col(ts)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000
        + seconds.cast("bigint") * 1000
        + F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")
    )


def transactions(spark, folder):
    """orders as the transaction log."""
    orders = table(spark, folder, "orders")
    return orders.select((F.col("o_orderkey") + 1).alias("id"), millis("o_orderdate").alias("commit_time_ms"))


def change_lines(spark, folder):
    """lineitem as a change feed with fields: a return deletes the part's document, anything else updates it.

    Every update names quantity, price and tax (null on a finished line); discount only where there is one.
    """
    def named(name, value):
        return F.lit(name), value.cast("string")

    always = [
        *named("quantity", F.col("l_quantity")),
        *named("price", F.col("l_extendedprice")),
        *named("tax", F.when(F.col("l_linestatus") != "F", F.col("l_tax"))),
    ]
    discounted = F.create_map(*always, *named("discount", F.col("l_discount")))
    fields = F.when(F.col("l_discount") > 0, discounted).otherwise(F.create_map(*always))
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") + 1).alias("txn_id"),
        F.col("l_partkey").alias("id"),
        F.concat(F.lit("workspace://SpacesStore/p-"), F.col("l_partkey")).alias("node_ref"),
        F.when(F.col("l_returnflag") == "R", "d").otherwise("u").alias("status"),
        fields.alias("fields"),
        *LINE_ORDER,
    )


def change_events(spark, folder):
    """events as a change feed: an error deletes the user's document, anything else updates one field."""
    fields = F.create_map(F.col("event_type"), F.get_json_object("props", "$.k"))
    return table(spark, folder, "events").select(
        (F.floor(F.col("event_id") / 10) + 1).cast("bigint").alias("txn_id"),
        F.col("user_id").alias("id"),
        F.concat(F.lit("workspace://SpacesStore/u-"), F.col("user_id")).alias("node_ref"),
        F.when(F.col("event_type") == "error", "d").otherwise("u").alias("status"),
        fields.alias("fields"),
        F.col("event_id").alias("feed_pos"),
    )


def acl_readers(spark, folder):
    """nation x customer: the readers of a nation's ACL are its customers' market segments."""
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").cast("bigint").alias("acl_id"))
    segments = table(spark, folder, "customer").groupBy(
        F.col("c_nationkey").cast("bigint").alias("acl_id")
    ).agg(F.sort_array(F.collect_set("c_mktsegment")).alias("readers"))
    return nation.join(segments, "acl_id", "left").withColumn(
        "readers", F.coalesce("readers", F.array().cast("array<string>"))
    )


def model_diffs(spark, folder):
    """One model per region."""
    return table(spark, folder, "region").select(
        F.concat(F.lit("{http://region/"), F.col("r_regionkey"), F.lit("}model")).alias("name"),
        F.col("r_regionkey").cast("bigint").alias("pos"),
    )


def model_definitions(spark, folder):
    """Region 0 and 1 define the content and system prefixes the document builder knows, the rest r<key>."""
    key = F.col("r_regionkey")
    prefix = F.when(key == 0, "cm").when(key == 1, "sys").otherwise(F.concat(F.lit("r"), key))
    return table(spark, folder, "region").select(
        F.concat(F.lit("{http://region/"), key, F.lit("}model")).alias("name"),
        F.concat(F.lit('<model name="'), prefix, F.lit(':model"/>')).alias("xml"),
    )


def document_metadata(spark, folder):
    """documents with their labels as node metadata; uri 7 is declared by no model."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, folder, "labels")
    doc, lang, source, size = F.col("doc_id"), F.col("lang"), F.col("source"), F.col("n_chars")
    quality, toxic = F.col("quality"), F.col("toxic")
    locale = F.array(F.struct(lang.alias("locale"), source.alias("value")))
    properties = F.to_json(F.struct(
        F.when(doc % 7 != 0, F.concat(F.lit("doc-"), doc)).alias("{http://region/0}name"),
        locale.alias("{http://region/0}title"),
        F.when(quality == 1, source).alias("{http://region/0}owner"),
        F.when(doc % 3 != 0, F.concat(F.lit("m"), doc % 10)).alias("{http://region/0}modifier"),
        F.concat(F.lit("c"), doc % 10).alias("{http://region/0}creator"),
        F.when(doc % 11 != 0, F.struct(
            size.cast("string").alias("contentId"), F.lit("text/plain").alias("mimetype"),
            size.alias("size"), F.lit("UTF-8").alias("encoding"), lang.alias("locale"),
        )).alias("{http://region/0}content"),
        F.lit("Ready").alias("{http://region/0}content.tr_status"),
        F.when(doc % 5 != 0, "SpacesStore").otherwise("ArchiveStore").alias("{http://region/1}store-identifier"),
        F.array(F.struct(source.alias("id"), lang.alias("name"))).alias("{http://region/2}categories"),
        F.when(quality.isNotNull(), F.struct(quality.alias("quality"), toxic.alias("toxic")))
        .alias("{http://region/3}flags"),
        F.concat(F.lit("n"), doc).alias("{http://region/7}note"),
    ))
    return documents.join(labels, "doc_id", "left").select(
        doc.alias("id"),
        F.concat(F.lit("workspace://SpacesStore/doc-"), doc).alias("node_ref"),
        F.concat(F.lit("cm:"), lang).alias("type"),
        (doc % ACL_COUNT).cast("bigint").alias("acl_id"),
        properties.alias("properties"),
        F.when(quality == 1, F.array(F.lit("cm:rated"), F.lit("cm:titled")))
        .when(quality == 0, F.array(F.lit("cm:titled")))
        .otherwise(F.array().cast("array<string>")).alias("aspects"),
        F.array(
            F.array(F.lit("Tags"), lang), F.array(F.lit("Tags")),
            F.array(F.lit("Company Home"), source), F.array(F.lit("Tags"), source),
        ).alias("name_paths"),
        F.when(doc % 4 != 0, F.array(
            F.concat(F.lit("workspace://SpacesStore/"), source), F.concat(F.lit("workspace://SpacesStore/"), lang),
        )).alias("ancestors"),
    )


def document_changes(spark, folder):
    """Change rows of the documents: each is created; a toxic one is deleted; a toxic one of quality comes back."""
    labelled = table(spark, folder, "documents").select("doc_id").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )
    first = F.floor(F.col("doc_id") / 10).cast("bigint") + 1
    steps = F.array_compact(F.array(
        F.struct(F.lit("u").alias("status"), first.alias("txn_id")),
        F.when(F.col("toxic") == 1, F.struct(F.lit("d").alias("status"), (first + 1).alias("txn_id"))),
        F.when((F.col("toxic") == 1) & (F.col("quality") == 1),
               F.struct(F.lit("u").alias("status"), (first + 3).alias("txn_id"))),
    ))
    return labelled.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("workspace://SpacesStore/doc-"), F.col("doc_id")).alias("node_ref"),
        F.col("doc_id").alias("feed_pos"),
        F.inline(steps),
    )


def document_log(spark, folder):
    """Transaction log of the document changes."""
    ids = document_changes(spark, folder).select("txn_id").distinct()
    return ids.select(F.col("txn_id").alias("id"), (F.lit(1_700_000_000_000) + F.col("txn_id") * 1000).alias("commit_time_ms"))


def document_versions(spark, folder):
    """Metadata of the documents by version: the first from their first change, of toxic ones a second, reviewed."""
    metadata = document_metadata(spark, folder).withColumn("version", F.floor(F.col("id") / 10).cast("bigint") + 1)
    toxic = table(spark, folder, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    reviewed = metadata.join(toxic, "id", "left_semi").withColumn("type", F.lit("cm:reviewed")).withColumn("version", F.col("version") + 2)
    return metadata.unionByName(reviewed)


def sparse_log(spark, folder):
    """The log without the transactions that come late: every 97th and, of each thousand, twenty in a row."""
    return transactions(spark, folder).where("id % 97 != 0 and id % 1000 not between 500 and 519")


def document_texts(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")


def url_segments(url):
    """Non-empty path segments of a url."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]+([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def escaped_documents(spark, folder):
    """documents with every character beyond ASCII written as its escapes, one for each UTF-16 unit."""
    beyond = r"[^\x00-\x7F]+"
    runs = F.transform(
        F.regexp_extract_all("text", F.lit(beyond), F.lit(0)),
        lambda r: F.regexp_replace(F.hex(F.encode(r, "UTF-16BE")), "([0-9A-F]{4})", r"\\u$1"),
    )
    pieces = F.zip_with(F.split("text", beyond, -1), runs, lambda plain, run: F.concat(plain, F.coalesce(run, F.lit(""))))
    return table(spark, folder, "documents").select("doc_id", "text", F.array_join(pieces, "").alias("escaped"))
