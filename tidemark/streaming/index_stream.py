"""Structured Streaming front end: a stream of change rows kept in step with the index."""

from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.plans.cycle import apply_page, run_batch
from tidemark.sinks.snapshot import staged
from tidemark.sources.feed import settled


def _start(stream, apply, checkpoint, seconds):
    """Start the stream; seconds=None works through what is there and stops."""
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _extent(store, rows, checkpoint, batch_id):
    """The rows of a micro-batch as a table, and the mark they lead to; None if they are there already or none.

    What was applied is told by the micro-batch's number in the commit, not by the mark: a transaction may go on
    in the next files, and files may come out of order.
    """
    if store.has_applied(checkpoint, batch_id):
        return None, None
    rows = staged(rows, f"{store.root}/work/batch")
    return rows, rows.agg(F.max("txn_id")).first()[0]


def stream_index(changes, store, sources, checkpoint, seconds=K.DEFAULT_CYCLE_SECONDS, options=None):
    """Index a stream of change rows with metadata as of each micro-batch.

    The registry, the log's latest commit time and every lookup table are read anew for each micro-batch. Rows
    may come in any order: a node is read as it is now, so a late update does no harm (see `settled` for deletes).
    """

    def apply(rows, batch_id):
        rows, mark = _extent(store, rows, checkpoint, batch_id)
        if mark is not None:
            stamp = sources.log.agg(F.max("commit_time_ms")).first()[0]
            rows = settled(rows, store.watermark(), sources.metadata)
            apply_page(store, sources, rows, mark, stamp, options, progress=(checkpoint, batch_id))

    return _start(changes, apply, checkpoint, seconds)


def stream_events(events, store, checkpoint, seconds=K.DEFAULT_CYCLE_SECONDS):
    """Index a stream of events that carry their own fields (an EventStore).

    Files may come in any order and transactions be split over them: every event is merged by its place in the feed.
    """

    def apply(rows, batch_id):
        rows, mark = _extent(store, rows, checkpoint, batch_id)
        if mark is not None:
            store.apply(rows, mark, (checkpoint, batch_id))

    return _start(events, apply, checkpoint, seconds)


def stream_cycle(store, read_sources, checkpoint, seconds=K.DEFAULT_CYCLE_SECONDS, max_results=K.DEFAULT_MAX_TRANSACTIONS, options=None):
    """Every `seconds` index the next page of at most max_results transactions above the mark.

    read_sources gives the tables as they are now. Where the stream stands is told by the store's mark, a transaction id;
    the stream itself is only the clock, so a restart from any checkpoint, or from none, goes on at the right page. A
    page's change rows are read by the range of its ids, which reaches the scan as a pushed filter.
    """
    clock = store.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()

    def apply(rows, batch_id):
        run_batch(store, read_sources(), max_results, options)

    return _start(clock, apply, checkpoint, seconds)
