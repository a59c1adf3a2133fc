"""Saved JSON responses of a repository as the tables a cycle reads.

Each folder holds text files with one response per line: `transactions`, `changes`, `metadata`,
`acl_readers` and `model_diffs` as envelopes, `model_definitions` as {"name", "xml"} and `texts` as
{"id", "text"}.
"""

from functools import reduce

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans.cycle import Sources
from tidemark.schemas import ENVELOPES, NODE
from tidemark.sources.envelopes import decode_envelope, unknown_members


def _decoded(spark, folder, kind, row_schema=None):
    return decode_envelope(spark.read.text(f"{folder}/{kind}"), "value", kind, row_schema)


def transactions(spark, folder):
    """The log, with the maxima of the whole repository that each response states."""
    rows = _decoded(spark, folder, "transactions")
    return rows.select(
        "id", F.col("commitTimeMs").alias("commit_time_ms"), "updates", "deletes",
        F.col("maxTxnId").alias("repo_txn_id"), F.col("maxTxnCommitTime").alias("repo_commit_ms"),
    )


def changes(spark, folder):
    """Change rows; their place in the response is their order within a transaction."""
    rows = _decoded(spark, folder, "changes")
    return rows.select(
        "id", F.col("nodeRef").alias("node_ref"), F.col("txnId").alias("txn_id"), "status",
        F.col("aclId").alias("acl_id"), "tenant", F.col("pos").cast("bigint").alias("feed_pos"),
    )


def metadata(spark, folder):
    """Node metadata, the open properties kept as JSON text. A node saved twice: the later transaction counts."""
    rows = _decoded(spark, folder, "metadata", NODE.replace("map<string,variant>", "string"))
    return rows.select(
        "id", F.col("nodeRef").alias("node_ref"), "type", F.col("aclId").alias("acl_id"), "properties", "aspects",
        F.transform("namePaths", lambda p: p["namePath"]).alias("name_paths"), "ancestors", F.col("txnId").alias("version"),
    ).distinct()


def acl_readers(spark, folder):
    rows = _decoded(spark, folder, "acl_readers")
    return rows.select(F.col("aclId").alias("acl_id"), "readers")


def model_diffs(spark, folder):
    """Models with their place in the response: of two that share a uri the later one counts."""
    return _decoded(spark, folder, "model_diffs").select("name", F.col("pos").cast("bigint").alias("pos"))


def findings(spark, folder):
    """Members of the responses that no schema names."""
    kinds = [unknown_members(spark.read.text(f"{folder}/{kind}"), "value", kind) for kind in ENVELOPES]
    return quality.unknown_envelope_members(reduce(lambda a, b: a.unionByName(b), kinds).distinct())


def response_sources(spark, folder):
    """A malformed response raises when it is read; unknown members raise or are reported as the cycle is told."""
    return Sources(
        findings=findings(spark, folder),
        log=transactions(spark, folder),
        changes=changes(spark, folder),
        metadata=metadata(spark, folder),
        acls=acl_readers(spark, folder),
        model_diffs=model_diffs(spark, folder),
        model_definitions=spark.read.schema("name string, xml string").json(f"{folder}/model_definitions"),
        texts=spark.read.schema("id bigint, text string").json(f"{folder}/texts"),
    )
