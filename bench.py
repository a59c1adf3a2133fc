"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.cycle import run_batch
from tidemark.plans.workload import QUERIES, document_sources
from tidemark.session import local_session, new_folder
from tidemark.sinks.index_store import IndexStore

HEADLINE = [
    "net_state", "net_state_events", "net_changes", "txn_reconcile", "acl_expand", "acl_expand_salted",
    "property_prefix", "documents_built", "documents_built_by_join", "content_changed", "apply_upsert",
    "bulk_export", "unescape_text", "two_batches", "index_cycle", "documents_as_of", "export_changes", "index_page",
]
#: Transactions of a page, the default of a cycle.
PAGE = 100



def timed_page(spark, folder, runs):
    """Best time of a page of PAGE transactions, from the mark to the commit."""
    store = IndexStore(spark, new_folder(spark, "bench"), slices=8, buckets=8).ensure()
    sources, spent = document_sources(spark, folder), []
    for _ in range(runs):
        start = time.time()
        run_batch(store, sources, PAGE)
        spent.append(time.time() - start)
    return round(min(spent), 3)


def timed(spark, name, folder, runs):
    """Best of the runs, each materialised in full by the noop sink."""
    if name == "index_page":
        return timed_page(spark, folder, runs)
    best = None
    for _ in range(runs):
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent = time.time() - start
        best = spent if best is None else min(best, spent)
    return round(best, 3)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {name: timed(spark, name, folder, runs) for name in names}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
