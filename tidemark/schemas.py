"""Schemas of the inputs, the index tables and the control table, as DDL text."""

# Members of the saved responses.
TRANSACTION = "id bigint, commitTimeMs bigint, updates int, deletes int"
CHANGE_NODE = "id bigint, nodeRef string, txnId bigint, status string, aclId bigint, tenant string"
NODE = (
    "id bigint, tenantDomain string, nodeRef string, type string, aclId bigint, txnId bigint, "
    "properties map<string,variant>, aspects array<string>, "
    "paths array<struct<path:string,apath:string,qname:string>>, "
    "namePaths array<struct<namePath:array<string>>>, ancestors array<string>, "
    "parentAssocs array<string>, parentAssocsCrc bigint, owner string, readers array<string>"
)
ACL_READERS = (
    "aclId bigint, aclChangeSetId bigint, tenantDomain string, "
    "readers array<string>, denied array<string>"
)
MODEL_DIFF = "name string, type string, oldChecksum bigint, newChecksum bigint"

# Response envelopes: kind -> (name of the row list, schema of one row, further top-level members).
ENVELOPES = {
    "transactions": ("transactions", TRANSACTION, {"maxTxnCommitTime": "bigint", "maxTxnId": "bigint"}),
    "changes": ("nodes", CHANGE_NODE, {}),
    "metadata": ("nodes", NODE, {}),
    "acl_readers": ("aclsReaders", ACL_READERS, {}),
    "model_diffs": ("diffs", MODEL_DIFF, {}),
}

# Metadata half of the index. content_info and the optional columns are null when the field is absent;
# a present field without a value is a null member (content_info) or a null map entry (fields).
DOCUMENT_COLUMNS = {
    "type": "string",
    "primary_parent": "string",
    "parents": "array<string>",
    "readers": "array<string>",
    "owner": "string",
    "property_names": "array<string>",
    "aspects": "array<string>",
    "tags": "array<string>",
    "alive": "boolean",
    "last_update_ms": "bigint",
    "content_info": "struct<mimetype:string,size:string,encoding:string>",
    "fields": "map<string,string>",
}
# Columns a document may leave out; the stored value then survives a partial upsert.
OPTIONAL_COLUMNS = ("primary_parent", "parents", "owner", "content_info")

TEXT_COLUMNS = {"content_id": "string", "content_text": "string"}

COMMIT = "commit_id bigint, last_txn_id bigint, slices int, buckets int, streams map<string,bigint>, gaps bigint, pending bigint, writer string"
