"""Each row with the value that held at its time: an as-of join without a range condition."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

#: Pieces that the time of all rows is cut into, so that a key with a third of them spreads over as many tasks.
PIECES = 16


def as_of_join(left, right, key, left_time, right_time, pieces=PIECES):
    """Every row of left, with the columns of right from the row of its key of the greatest right_time not above its
    left_time; null where there is none. Of several such rows the greatest counts, column by column.

    One union of both sides is sorted by time within each key and piece of time, where each row looks back to the last
    right row. What held before a piece comes from the pieces before, a row for each key and piece. Times are whole
    numbers; columns of the right side must be orderable and, but for the key, named apart from the left ones.
    """
    values = [c for c in right.columns if c != key]
    first, last = left.select(F.col(left_time).alias("t")).union(right.select(right_time)).agg(F.min("t"), F.max("t")).first()
    if first is None:
        first = last = 0
    width = max(1, math.ceil((last - first + 1) / pieces))
    row = F.struct(*left.columns)
    held = F.struct(F.col(right_time).alias("_time"), *values)
    ours = left.select(F.col(key).alias("_key"), F.col(left_time).alias("_at"), F.lit(1).alias("_side"), row.alias("_row"))
    theirs = right.select(F.col(key).alias("_key"), F.col(right_time).alias("_at"), F.lit(0).alias("_side"), held.alias("_held"))
    both = ours.unionByName(theirs, allowMissingColumns=True).withColumn("_piece", F.floor((F.col("_at") - first) / width))

    in_piece = Window.partitionBy("_key", "_piece").orderBy("_at", "_side", "_held").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("_own", F.last("_held", ignorenulls=True).over(in_piece)).where("_side = 1")
    ends = both.groupBy("_key", "_piece").agg(F.max("_held").alias("_end"))
    of_key = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(F.col("_key").alias("_k"), F.col("_piece").alias("_p"), F.last("_end", ignorenulls=True).over(of_key).alias("_before")).where("_before is not null")
    joined = met.join(before, (F.col("_key") == F.col("_k")) & (F.col("_piece") == F.col("_p")), "left")
    found = joined.select("_row", F.coalesce("_own", "_before").alias("_found"))
    return found.select("_row.*", *[F.col("_found")[c].alias(c) for c in values])


def metadata_as_of(changes, metadata, log):
    """Change rows (id, txn_id) with the metadata version that held at their transaction, and that transaction's commit
    time as stamp_ms; those without metadata as yet drop out."""
    taken = [c for c in metadata.columns if c == "id" or c not in changes.columns]
    found = as_of_join(changes, metadata.select(*taken), "id", "txn_id", "version").where("version is not null")
    times = log.groupBy(F.col("id").alias("txn_id")).agg(F.max("commit_time_ms").alias("stamp_ms"))
    return found.join(times, "txn_id", "left")
