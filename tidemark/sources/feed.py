"""The transaction log and its change rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.operators.lookups import join_on_keys, lookup_join, measure


def pending_transactions(log, watermark, max_results=K.DEFAULT_MAX_TRANSACTIONS):
    """Next page of the log above the watermark, lowest ids first; None lifts the page limit."""
    fresh = log.where(F.col("id") >= watermark + 1)
    return fresh if max_results is None else fresh.orderBy("id").limit(max_results)


def page_bounds(log, watermark, max_results=K.DEFAULT_MAX_TRANSACTIONS, last=None):
    """One row: bounds and size of the next page, up to transaction `last` if given, beside the repository-wide maxima:
    those that the log states (repo_txn_id, repo_commit_ms) where it does and they are higher than what it lists."""
    page = pending_transactions(log if last is None else log.where(F.col("id") <= last), watermark, max_results)
    nothing = F.lit(None).cast("bigint")
    stated = [F.col(c) if c in log.columns else nothing for c in ("repo_txn_id", "repo_commit_ms")]
    tagged = page.select(F.col("id").alias("page_id"), F.lit(None).cast("bigint").alias("log_id"),
                         F.lit(None).cast("bigint").alias("commit_time_ms"))
    whole = log.select(nothing.alias("page_id"), F.greatest("id", stated[0]).alias("log_id"),
                       F.greatest("commit_time_ms", stated[1]).alias("commit_time_ms"))
    return tagged.unionByName(whole).agg(
        F.coalesce(F.min("page_id"), F.lit(watermark + 1)).alias("min_txn_id"),
        F.coalesce(F.max("page_id"), F.lit(watermark + 1)).alias("max_txn_id"),
        F.count("page_id").alias("n_txn"),
        F.max("log_id").alias("repo_max_txn_id"),
        F.max("commit_time_ms").alias("repo_max_commit_ms"),
    )


def changes_between(changes, lo, hi):
    """Change rows of the transactions from lo to hi, both included."""
    return changes.where(F.col("txn_id").between(lo, hi))


def routed(changes, on_error="fail"):
    """Add is_delete from the status code. An unknown code raises, or is left out with on_error="reject"
    (see quality.bad_status for the rows left out)."""
    status = F.col("status")
    known = F.coalesce(status.isin(K.STATUS_UPDATED, K.STATUS_DELETED), F.lit(False))
    if on_error == "reject":
        return changes.where(known).withColumn("is_delete", status == K.STATUS_DELETED)
    failure = F.raise_error(F.concat(F.lit("change row of no known status: "), F.coalesce(status, F.lit("null"))))
    return changes.withColumn(
        "is_delete", F.when(known, status == K.STATUS_DELETED).otherwise(failure.cast("boolean"))
    )


def transaction_counts(changes):
    """Updates and deletes per transaction, to reconcile a feed with its log."""
    return changes.groupBy("txn_id").agg(
        F.count_if(F.col("status") == K.STATUS_UPDATED).alias("updates"),
        F.count_if(F.col("status") == K.STATUS_DELETED).alias("deletes"),
    )


def reconciled(log, changes):
    """Transactions whose own counters (updates, deletes) differ from the change rows there are of them."""
    found = transaction_counts(changes).select(
        F.col("txn_id").alias("id"), F.col("updates").alias("found_updates"), F.col("deletes").alias("found_deletes"))
    both = log.select("id", "updates", "deletes").join(found, "id", "left").fillna(0, ["found_updates", "found_deletes"])
    return both.where("updates != found_updates or deletes != found_deletes")


def indexing_lag(log, watermark):
    """How far the index trails the log, as one row."""
    return log.agg(
        F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("repo_max_txn_id")
    ).select(
        "repo_max_txn_id",
        F.lit(watermark).cast("bigint").alias("last_txn_id"),
        (F.col("repo_max_txn_id") - F.lit(watermark)).cast("bigint").alias("lag"),
    )


# -- gaps in the transaction ids ---------------------------------------------------------------------------

#: Ids of one stretch, whose gaps are looked for together.
STRETCH = 1 << 20


def gaps_of(log, after=None):
    """from_id, to_id, next_id, next_ms: ranges of ids that the log lacks between two of its transactions, with the id and
    commit time of the one that follows. after: only above this id, which counts as there.

    Ids are cut into stretches and compared within them, so the log is dealt out by range and no task sorts it all; only
    the first and last id of each stretch are compared over stretches.
    """
    rows = log.select("id", F.col("commit_time_ms").alias("ms"))
    if after is not None:
        start = log.sparkSession.createDataFrame([(after, None)], "id long, ms long")
        rows = rows.where(F.col("id") > after).unionByName(start)
    rows = rows.groupBy("id").agg(F.max("ms").alias("ms")).withColumn("stretch", F.floor(F.col("id") / STRETCH))
    nearby = Window.partitionBy("stretch").orderBy("id")
    within = rows.withColumn("before", F.lag("id").over(nearby))
    edges = rows.groupBy("stretch").agg(F.max("id").alias("last"), F.min(F.struct("id", "ms")).alias("first"))
    across = edges.select(F.lag("last").over(Window.orderBy("stretch")).alias("before"), "first.id", "first.ms")
    found = within.select("before", "id", "ms").unionByName(across).where("before < id - 1")
    return found.select((F.col("before") + 1).alias("from_id"), (F.col("id") - 1).alias("to_id"), F.col("id").alias("next_id"), F.col("ms").alias("next_ms"))


def settled_mark(log, watermark, hold_back_ms, now_ms=None):
    """One row, settled_id: the last transaction before the first gap above the mark that is younger than the hold-back,
    or the last of all. A gap is as old as the commit that follows it, at now_ms (by default the log's latest commit)."""
    if now_ms is None:
        now_ms = log.agg(F.max("commit_time_ms")).first()[0] or 0
    young = gaps_of(log, watermark).where(F.col("next_ms") > now_ms - hold_back_ms).select(F.col("from_id").alias("gap"), F.lit(None).cast("bigint").alias("id"))
    both = young.unionByName(log.select(F.lit(None).cast("bigint").alias("gap"), "id")).agg(F.min("gap").alias("gap"), F.max("id").alias("last"))
    return both.select(F.coalesce(F.col("gap") - 1, F.greatest("last", F.lit(watermark)), F.lit(watermark)).cast("bigint").alias("settled_id"))


def open_gaps(log):
    """from_id, to_id of the gaps of a log, the one before its first transaction included."""
    return gaps_of(log, 0).select("from_id", "to_id")


def late_transactions(log, gaps):
    """Transactions of the log that lie in gaps left open. One union of both, in which each id looks back for the last
    gap that begins before it, within stretches of ids and from the stretches before."""
    starts = gaps.select(F.col("from_id").alias("at"), F.lit(0).alias("side"), "to_id", F.lit(None).cast("bigint").alias("id"))
    ids = log.select(F.col("id").alias("at"), F.lit(1).alias("side"), F.lit(None).cast("bigint").alias("to_id"), "id")
    first, last = gaps.agg(F.min("from_id"), F.max("to_id")).first()
    both = starts.unionByName(ids.where(F.col("id").between(first, last)) if first is not None else ids.limit(0))
    both = both.withColumn("stretch", F.floor(F.col("at") / STRETCH))
    nearby = Window.partitionBy("stretch").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    reach = both.withColumn("reach", F.max("to_id").over(nearby))
    ends = both.groupBy("stretch").agg(F.max("to_id").alias("end"))
    earlier = ends.select("stretch", F.max("end").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    covered = F.coalesce(F.greatest("reach", "earlier"), F.lit(-1))
    return reach.where("id is not null").join(F.broadcast(earlier), "stretch").where(covered >= F.col("id")).select("id").distinct()


def settled(rows, mark, metadata):
    """Rows in which a delete from below the mark counts only if its node has no metadata now: else the node came
    back later, and is read as it is."""
    late = (F.col("txn_id") < mark) & (F.col("status") == K.STATUS_DELETED)
    ids = rows.where(late).select("id").distinct()
    n, size = measure(ids)
    if not n:
        return rows
    alive = join_on_keys(ids, metadata.select("id"), "id", size).distinct().withColumn("_alive", F.lit(True))
    marked = lookup_join(rows, alive, "id", F.struct("txn_id", "feed_pos"), size=size)
    status = F.when(late & F.coalesce("_alive", F.lit(False)), F.lit(K.STATUS_UPDATED)).otherwise(F.col("status"))
    return marked.withColumn("status", status).drop("_alive")
