"""Key lookups that hold up when one key owns a large share of the rows."""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
#: Keys the frequency sketch returns, and how many it keeps count of.
HOT_KEYS, COUNTED = 64, 8192


def measure(df):
    """(rows, approximate bytes) of a small-looking side, taken in one distributed aggregate."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0)
    )
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def hot_keys(facts, key, parts):
    """{key: copies} of the keys with more rows than a fair task's share of `parts`: one for each such share.

    One pass: a frequency sketch, merged from partial ones, whose result is bounded whatever the data.
    """
    row = facts.agg(F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k", F.col(key), F.lit(HOT_KEYS), F.lit(COUNTED)).alias("top")).first()
    return {t["item"]: math.ceil(t["count"] * parts / row["n"]) for t in row["top"] or () if t["item"] is not None and t["count"] * parts > row["n"]}


def lookup_join(facts, dim, key, spread_by, max_bytes=BROADCAST_BYTES, size=None):
    """Left join of facts to a dimension that is unique on `key`.

    A dimension measured below max_bytes is broadcast and the facts are not shuffled at all. For a larger one the hot
    keys are looked for first: only they are salted, each by its share of the rows, and only their rows of the
    dimension are copied. Facts without a key meet nothing and are spread over all tasks.
    """
    size = measure(dim)[1] if size is None else size
    if size <= max_bytes:
        return facts.join(F.broadcast(dim), key, "left")
    spark = facts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField(key, facts.schema[key].dataType), T.StructField("_salts", T.IntegerType())])
    hot = F.broadcast(spark.createDataFrame(list(hot_keys(facts, key, parts).items()), schema))
    salts = F.when(F.col(key).isNull(), parts).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = facts.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts).cast("int")).drop("_salts")
    copied = dim.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return spread.join(copied, [key, "_salt"], "left").drop("_salt")


def keep_keys(big, keys, on, size, max_bytes=BROADCAST_BYTES):
    """Drop rows of `big` whose key is not asked for, where that costs no shuffle of `big`.

    Keys measured below max_bytes are broadcast. A larger set is left to the join that follows, which
    shuffles both sides anyway.
    """
    if size <= max_bytes:
        return big.join(F.broadcast(keys), on, "left_semi")
    return big


def join_on_keys(keys, big, on, size, max_bytes=BROADCAST_BYTES):
    """Inner join of a measured key table to a big table, broadcasting the keys while they are small."""
    side = F.broadcast(keys) if size <= max_bytes else keys
    return big.join(side, on, "inner")


# -- lookup tables by bucket of their id ------------------------------------------------------------------


def id_bucket(key, buckets):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_lookup(df, folder, buckets, key="id"):
    """Write a lookup table partitioned by the bucket of its key, a file for each."""
    df.withColumn("id_bucket", id_bucket(key, buckets)).repartition("id_bucket").write.partitionBy("id_bucket").parquet(folder)


def pruned(table, keys, buckets, key="id"):
    """The part of a table written by write_lookup whose buckets hold any of the keys: a partition filter, so a batch of
    few ids opens few files. The driver sees bucket numbers only."""
    wanted = [r[0] for r in keys.select(id_bucket(key, buckets).alias("b")).distinct().collect()]
    return table.where(F.col("id_bucket").isin(wanted)).drop("id_bucket")
