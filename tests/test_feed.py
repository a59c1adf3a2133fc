"""Log paging, bounds, envelopes."""

import json

from tidemark.sources import envelopes, feed


def log(spark, ids):
    return spark.createDataFrame([(i, i * 1000) for i in ids], "id long, commit_time_ms long")


def test_page_starts_above_the_mark(spark):
    page = feed.pending_transactions(log(spark, [5, 1, 9, 7, 3]), 3, 2).collect()
    assert [r["id"] for r in page] == [5, 7]


def test_bounds(spark):
    row = feed.page_bounds(log(spark, range(1, 11)), 4, 3).first()
    assert tuple(row) == (5, 7, 3, 10, 10_000)
    assert feed.page_bounds(log(spark, range(1, 11)), 4, None).first()["max_txn_id"] == 10


def test_bounds_of_nothing(spark):
    row = feed.page_bounds(log(spark, [1, 2]), 2, 3).first()
    assert tuple(row) == (3, 3, 0, 2, 2000)


def test_changes_between_is_inclusive(spark):
    rows = spark.createDataFrame([(i,) for i in range(6)], "txn_id long")
    assert sorted(r[0] for r in feed.changes_between(rows, 2, 4).collect()) == [2, 3, 4]


def test_lag(spark):
    assert tuple(feed.indexing_lag(log(spark, [1, 2, 8]), 3).first()) == (8, 3, 5)


def test_counts_reconcile(spark):
    rows = spark.createDataFrame([(1, "u"), (1, "d"), (1, "u"), (2, "d")], "txn_id long, status string")
    assert sorted(map(tuple, feed.transaction_counts(rows).collect())) == [(1, 2, 1), (2, 0, 1)]


def body(spark, value):
    return spark.createDataFrame([(json.dumps(value),)], "body string")


def test_decode_every_kind(spark):
    node = {
        "id": 1, "nodeRef": "a://b/c", "type": "t", "aclId": 2, "properties": {"{u}a": [1, {"id": 2}], "{u}b": None},
        "namePaths": [{"namePath": ["Tags", "x"]}], "ancestors": ["a://b/d"], "aspects": ["q"],
        "paths": [{"path": "p", "apath": "a", "qname": "q"}],
    }
    samples = {
        "transactions": ({"transactions": [{"id": 1, "commitTimeMs": 5, "updates": 1, "deletes": 0}],
                          "maxTxnCommitTime": 9, "maxTxnId": 8}, {"maxTxnId": 8, "id": 1, "commitTimeMs": 5}),
        "changes": ({"nodes": [{"id": 4, "nodeRef": "r", "txnId": 3, "status": "u"}]}, {"id": 4, "status": "u", "txnId": 3}),
        "metadata": ({"nodes": [node]}, {"id": 1, "ancestors": ["a://b/d"]}),
        "acl_readers": ({"aclsReaders": [{"aclId": 7, "readers": ["x"], "denied": []}]}, {"aclId": 7, "readers": ["x"]}),
        "model_diffs": ({"diffs": [{"name": "{u}m", "type": "NEW", "oldChecksum": None, "newChecksum": 3}]}, {"name": "{u}m"}),
    }
    for kind, (envelope, expected) in samples.items():
        rows = envelopes.decode_envelope(body(spark, envelope), "body", kind)
        got = rows.select(*expected).first().asDict()
        assert got == expected, kind
        assert envelopes.unknown_members(body(spark, envelope), "body", kind).count() == 0, kind


def test_empty_envelope(spark):
    assert envelopes.decode_envelope(body(spark, {"nodes": []}), "body", "changes").count() == 0


def test_unknown_members(spark):
    value = {"nodes": [{"id": 1, "extra": 1}, {"id": 2, "extra": 2, "more": 3}], "page": 1}
    found = envelopes.unknown_members(body(spark, value), "body", "changes").collect()
    assert sorted(r[0] for r in found) == ["extra", "more", "page"]
