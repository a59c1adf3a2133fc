"""Second phase of a batch: refresh text whose content id moved."""

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.lookups import join_on_keys


def lookup_index(keys, index):
    """Content id the index holds per key: empty when it has no such document, null when that has none."""
    held = index.select("uuid", "content_id", F.lit(True).alias("_hit"))
    joined = keys.join(held, "uuid", "left")
    return joined.withColumn(
        "content_id", F.when(F.col("_hit").isNull(), F.lit("")).otherwise(F.col("content_id"))
    ).drop("_hit")


def content_candidates(documents, store=K.LIVE_STORE):
    """Documents of the live store that carry a content id."""
    return documents.where(
        F.col("uuid").isNotNull() & F.col("content_id").isNotNull() & (F.col("store") == store)
    )


def changed_content(candidates, stored):
    """Candidates whose content id differs from the stored one. No stored row, a stored null and a document
    re-created in this batch (`reset`) all count as changed."""
    held = lookup_index(candidates.withColumnRenamed("content_id", "_wanted"), stored)
    before = F.when(~F.col("reset"), F.col("content_id"))
    return held.where(~F.col("_wanted").eqNullSafe(before)).drop("content_id").withColumnRenamed("_wanted", "content_id")


def fetch_text(changed, texts, size):
    """Text of each changed document by node id. The text table is read for changed rows only: its keys
    are broadcast while their measured size allows, otherwise both sides are shuffled on the id."""
    return join_on_keys(changed, texts.select("id", F.col("text").alias("content_text")), "id", size)


def non_empty(fetched):
    return fetched.where(F.length("content_text") > 0)
