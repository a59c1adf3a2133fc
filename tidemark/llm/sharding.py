"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; the k-th of n rows has the fractional rank
(2k - 1) / 2n. Sorted by it the sources interleave in proportion, so equal cuts of that order match the mixture, and
row counts of two shards differ by one at most. Ranks come from range partitions, their sizes and the place of a row
within its partition, so neither a source nor a shard has to fit one task.

Null and empty texts count no bytes. Rows without a source are a source of their own. Rows that repeat id and text are
ranked one after the other, and each gets a slot of its own. An empty table gives no rows. Only the named columns are
looked at, so others of any name can't clash.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_broadcast, stored

#: What a row takes beside its text, in bytes.
ROW_BYTES = 16


def partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def placed(rows, *keys):
    """rows with `part`, the range partition by the keys they fall into, and `at`, their place in it from 0; stored."""
    mark = F.monotonically_increasing_id()  # partition and place of a row, as Spark defines it
    ordered = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys).withColumn("mark", mark)
    return stored(ordered.select(
        *rows.columns, F.shiftright("mark", 33).alias("part"), F.col("mark").bitwiseAND((1 << 33) - 1).alias("at")), "ranges")


def thin_rows(docs, seed, id_col, text_col, source_col, *more):
    """id, source, size, crc, key (of the seeded shuffle) and row (a number of its own) of each row; stored."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[id_col].cast("string"), F.lit(""))).cast("binary"))
    return stored(docs.select(
        docs[id_col].alias("id"), docs[source_col].alias("source"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("crc"), key.alias("key"), F.monotonically_increasing_id().alias("row"), *more), "thin-rows")


def ranked(thin):
    """thin with `fraction`: the fractional rank of each row within its source."""
    rows = placed(thin, "source", "key", "crc", "size", "row")
    # a range partition holds one stretch of each of its sources
    stretches = rows.groupBy("source", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    of_source = Window.partitionBy("source")
    before = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stored(stretches.select(
        F.col("source").alias("s_source"), F.col("part").alias("s_part"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(of_source).alias("in_source")), "stretches")
    n, size = stretches.agg(F.count(F.lit(1)), F.coalesce(F.max(F.octet_length(F.col("s_source").cast("string"))), F.lit(0))).first()
    joined = rows.join(bounded_broadcast(stretches, n, 64 + size), F.col("source").eqNullSafe(F.col("s_source")) & (F.col("part") == F.col("s_part")))
    odd = (2 * (F.col("at") + F.col("shift")) + 1).cast("double")
    return joined.select(*thin.columns, (odd / (2 * F.col("in_source")).cast("double")).alias("fraction"))


def assign(docs, shards=40, seed=42, id_col="doc_id", text_col="text", source_col="source", row_col=None):
    """id, source, size, crc, shard and slot (gapless from 0 in its shard) of every row; row_col passes on as `row`."""
    thin = thin_rows(docs, seed, id_col, text_col, source_col, *([docs[row_col].alias("given")] if row_col else []))
    rows = placed(ranked(thin), "fraction", "source", "key", "crc", "size", "row")
    # one row for each partition, so the window over all of them is small
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(everything).alias("total"))
    place, total = F.col("before") + F.col("at"), F.col("total")
    found = rows.join(F.broadcast(parts), F.col("part") == F.col("p")).select("*", place.alias("place"))
    shard = F.floor(F.call_function("div", F.col("place") * shards, total)).cast("long")
    found = found.withColumn("shard", shard)
    begin = F.call_function("div", F.col("shard") * total + (shards - 1), F.lit(shards).cast("long"))
    slot = (F.col("place") - begin).cast("long")
    return found.select("id", "source", "size", "crc", F.col("shard").cast("int").alias("shard"), slot.alias("slot"),
                        *([F.col("given").alias("row")] if row_col else []))


def write_shards(docs, folder, shards=40, **options):
    """Write docs, all columns, as Parquet in folders shard=0 and so on, each in the order of its slots.

    Rows are numbered in a written copy, so that each finds its slot again; several files make up a large shard.
    """
    names = docs.columns
    numbered = stored(docs.select(F.struct(*[docs[f"`{n}`"].alias(n) for n in names]).alias("row"),
                                  F.monotonically_increasing_id().alias("no")), "numbered")
    option = {k: options.get(k, v) for k, v in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    looked = numbered.select(*[F.col("row")[n].alias(k) for k, n in option.items()], "no")
    places = assign(looked, shards, options.get("seed", 42), "id_col", "text_col", "source_col", "no").select(F.col("row").alias("r"), "shard", "slot")
    whole = numbered.join(places, F.col("no") == F.col("r")).select("row", "shard", "slot")
    ordered = whole.repartitionByRange(max(shards, partitions(docs.sparkSession)), "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
