"""What each registered query must return, as SQL over the driver tables."""

# Events of the line feed with a total order per document.
_LINE_EVENTS = """
ev as (
  select 'p-' || l_partkey as uuid, l_returnflag = 'R' as is_del, l_orderkey + 1 as txn_id,
         l_quantity, l_extendedprice, l_discount, case when l_linestatus <> 'F' then l_tax end as tax,
         row_number() over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as seq
  from lineitem),
ends as (
  select uuid, max(seq) filter (where is_del) as last_del, max(seq) filter (where not is_del) as last_upd
  from ev group by uuid),
live as (
  select ev.* from ev join ends using (uuid) where not is_del and (last_del is null or seq > last_del)),
vals as (
  select uuid, arg_max(l_quantity, seq) as quantity, arg_max(l_extendedprice, seq) as price,
         arg_max(l_discount, seq) filter (where l_discount > 0) as discount,
         arg_max(struct_pack(t := tax), seq).t as tax
  from live group by uuid)"""

_EVENTS = """
ev as (
  select 'u-' || user_id as uuid, user_id, event_type = 'error' as is_del, event_type, event_id as seq,
         json_extract_string(props, '$.k') as k
  from events),
ends as (
  select uuid, any_value(user_id) as user_id, max(seq) filter (where is_del) as last_del,
         max(seq) filter (where not is_del) as last_upd
  from ev group by uuid)"""

_OP = "case when last_upd is not null and (last_del is null or last_upd > last_del) then 'upsert' else 'delete' end as op"

# Documents of the metadata view, as flat columns.
_BUILT = """
readers as (
  select c_nationkey as acl_id, array_to_string(list_sort(list(distinct c_mktsegment)), ',') as readers
  from customer group by c_nationkey),
nodes as (
  select d.*, quality, toxic, coalesce(readers, '') as readers
  from documents d left join labels l on l.doc_id = d.doc_id left join readers r on r.acl_id = d.doc_id % 30),
built as (
  select doc_id, text, n_chars, quality, toxic, 'doc-' || doc_id as uuid, 'cm:' || lang as type,
    case when doc_id % 4 <> 0 then source end as primary_parent,
    case when doc_id % 4 <> 0 then source || ',' || lang end as parents,
    readers,
    case when quality = 1 then source when doc_id % 3 <> 0 then 'm' || (doc_id % 10) end as owner,
    array_to_string(list_filter([
      'cm:creator', case when doc_id % 3 <> 0 then 'cm:modifier' end, case when doc_id % 7 <> 0 then 'cm:name' end,
      case when quality = 1 then 'cm:owner' end, 'cm:title', 'r2:categories',
      case when quality is not null then 'r3:flags' end, 'sys:store-identifier', '{http://region/7}:note'],
      lambda x: x is not null), ',') as property_names,
    case quality when 1 then 'cm:rated,cm:titled' when 0 then 'cm:titled' else '' end as aspects,
    lang || ',' || source as tags,
    1 as alive,
    case when doc_id % 11 <> 0 then 'text/plain' end as mime,
    case when doc_id % 11 <> 0 then n_chars::varchar end as size,
    case when doc_id % 11 <> 0 then 'UTF-8' end as encoding,
    array_to_string(list_filter([
      '%7Bhttp%3A%2F%2Fregion%2F7%7D%3Anote="n' || doc_id || '"',
      'cm%3Acreator="c' || (doc_id % 10) || '"',
      case when doc_id % 3 <> 0 then 'cm%3Amodifier="m' || (doc_id % 10) || '"' end,
      case when doc_id % 7 <> 0 then 'cm%3Aname="doc-' || doc_id || '"' else 'cm%3Aname=null' end,
      case when quality = 1 then 'cm%3Aowner="' || source || '"' end,
      'cm%3Atitle="' || source || '"',
      'r2%3Acategories=["' || source || '"]',
      case when quality is not null then 'r3%3Aflags=["quality=' || quality || '","toxic=' || toxic || '"]' end,
      'sys%3Astore%2Didentifier="' || case when doc_id % 5 <> 0 then 'SpacesStore' else 'ArchiveStore' end || '"'],
      lambda x: x is not null), '|') as fields
  from nodes)"""

_FLAT = (
    "uuid, type, primary_parent, parents, readers, owner, property_names, aspects, tags, alive, "
    "{stamp} as last_update_ms, mime, size, encoding, fields"
)

_MODELS = """
models as (
  select n_nationkey as k, n_regionkey as r, '{http://nation/' || n_regionkey || '}' as uri,
         '{http://nation/' || n_regionkey || '}model' || n_nationkey as name, n_nationkey % 6 in (2, 3, 4) as good
  from nation)"""

_KEYS = """
keys as (
  select event_id, json_extract_string(props, '$.k')::int % 7 as r, event_type,
         '{http://region/' || (json_extract_string(props, '$.k')::int % 7) || '}' || event_type as name
  from events)"""

_SEGMENTS = """
segs as (
  select page_id, list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'),
                              lambda s: s <> '') as s
  from pages)"""

_UPSERT = """
with stored as (
  select 'c-' || c_custkey as uuid, case when c_custkey % 2 = 0 then c_mktsegment end as owner,
         946684800000 + (c_custkey % 5) * 10000000000 as stamp, c_name as name, c_mktsegment as segment
  from customer),
ranked as (
  select 'c-' || o_custkey as uuid, epoch_ms(o_orderdate) as stamp, o_orderkey, o_orderpriority, o_orderstatus,
         row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
  from orders),
incoming as (
  select uuid, stamp, o_orderpriority as priority, case when o_orderkey % 3 = 0 then o_orderstatus end as owner
  from ranked where rn = 1),
met as (
  select coalesce(i.uuid, s.uuid) as uuid, s.uuid as s_uuid, i.uuid as i_uuid, s.owner as s_owner, i.owner as i_owner,
         s.stamp as s_stamp, i.stamp as i_stamp, name, segment, priority,
         case when i.uuid is null or s.stamp > i.stamp then 'kept'
              when s.uuid is null then 'fresh' else '{settled}' end as state
  from stored s full join incoming i on s.uuid = i.uuid)
select uuid, case state when 'kept' then 'customer' else 'buyer' end as type,
  case state when 'kept' then s_owner when 'fresh' then i_owner else coalesce(i_owner, s_owner) end as owner,
  (case state when 'kept' then s_stamp else i_stamp end)::bigint as last_update_ms,
  case state when 'kept' then 'name=' || name || '|segment=' || segment
             when 'fresh' then 'priority=' || priority || '|segment=null'
             else 'name=' || name || '|priority=' || priority || '|segment=null' end as fields
from met"""

_NUMBERS = f"""
with {_LINE_EVENTS}
select uuid, quantity, price, discount, tax from vals"""

SQL = {
    "net_state": f"""
with {_LINE_EVENTS}
select uuid, {_OP}, (last_del is not null)::int as is_reset, quantity, price, discount, tax
from ends left join vals using (uuid)""",
    "net_state_events": f"""
with {_EVENTS},
vals as (
  select ev.uuid, event_type || '=' || arg_max(k, seq) as pair
  from ev join ends using (uuid) where not is_del and (last_del is null or seq > last_del)
  group by ev.uuid, event_type),
pairs as (select uuid, array_to_string(list_sort(list(pair)), '|') as fields from vals group by uuid)
select uuid, {_OP}, (last_del is not null)::int as is_reset, coalesce(fields, '') as fields
from ends left join pairs using (uuid)""",
    "net_changes": f"""
with {_EVENTS}
select uuid, {_OP}, (last_del is not null)::int as is_reset, case when last_upd is not null then user_id end as id
from ends""",
    "pending_transactions": """
select o_orderkey + 1 as id, epoch_ms(o_orderdate) as commit_time_ms
from orders where o_orderkey + 1 >= 501 order by id limit 100""",
    "page_bounds": """
with page as (select o_orderkey + 1 as id from orders where o_orderkey + 1 >= 501 order by id limit 100)
select coalesce((select min(id) from page), 501) as min_txn_id, coalesce((select max(id) from page), 501) as max_txn_id,
       (select count(*) from page) as n_txn, max(o_orderkey + 1) as repo_max_txn_id,
       max(epoch_ms(o_orderdate)) as repo_max_commit_ms
from orders""",
    "changes_between": """
select l_orderkey + 1 as txn_id, l_partkey as id, 'workspace://SpacesStore/p-' || l_partkey as node_ref,
       case when l_returnflag = 'R' then 'd' else 'u' end as status
from lineitem
where l_orderkey + 1 between (select min(o_orderkey + 1) from orders where o_orderkey + 1 >= 501)
                         and (select max(o_orderkey + 1) from orders)""",
    "txn_reconcile": """
select 'lines' as feed, l_orderkey + 1 as txn_id, count(*) filter (where l_returnflag <> 'R') as updates,
       count(*) filter (where l_returnflag = 'R') as deletes
from lineitem group by l_orderkey
union all
select 'events', event_id // 10 + 1, count(*) filter (where event_type <> 'error'),
       count(*) filter (where event_type = 'error')
from events group by event_id // 10""",
    "indexing_lag": """
with page as (select o_orderkey + 1 as id from orders order by id limit 100)
select max(o_orderkey + 1) as repo_max_txn_id, (select max(id) from page) as last_txn_id,
       max(o_orderkey + 1) - (select max(id) from page) as lag
from orders""",
    "envelope_decode": """
select o_orderkey + 1 as id, epoch_ms(o_orderdate) as commit_time_ms, 1 as updates, cast(null as integer) as deletes,
       max(o_orderkey + 1) over (partition by (o_orderkey + 1) // 100) as page_max_id
from orders""",
    "envelope_members": """
select distinct unnest(['highest', 'kind', 'props']) as member from events""",
    "metadata_join": """
select distinct doc_id as id, 'workspace://SpacesStore/doc-' || doc_id as node_ref, 'cm:' || lang as type,
       doc_id % 30 as acl_id
from documents where doc_id in (select user_id from events where event_type <> 'error')""",
    "missing_metadata": """
select distinct 'missing_metadata' as rule, l_partkey::varchar as key, 'p-' || l_partkey as detail
from lineitem where l_returnflag <> 'R' and l_partkey not in (select doc_id from documents)""",
    "acl_expand": f"""
with {_BUILT}
select doc_id, doc_id % 30 as acl_id, readers from nodes""",
    "acl_expand_salted": f"""
with {_BUILT}
select doc_id, doc_id % 30 as acl_id, readers from nodes""",
    "acl_duplicates": """
select 'duplicate_acl' as rule, c_nationkey::varchar as key, count(*)::varchar as detail
from customer group by c_nationkey having count(*) > 1""",
    "model_registry": f"""
with {_MODELS}
select '{{http://region/' || r_regionkey || '}}' as uri,
       case r_regionkey when 0 then 'cm' when 1 then 'sys' else 'r' || r_regionkey end as prefix
from region
union all
select uri, arg_max('n' || k, k) from models where good group by uri""",
    "bad_models": f"""
with {_MODELS}
select 'bad_model' as rule, name as key, case when k % 6 = 1 then 'n' || k end as detail from models where not good""",
    "property_prefix": f"""
with {_KEYS}
select event_id, case when r = 0 then 'cm' when r = 1 then 'sys' when r < 5 then 'r' || r
                      else '{{http://region/' || r || '}}' end || ':' || event_type as prefixed,
       (r < 5)::int as known
from keys""",
    "unknown_namespaces": f"""
with {_KEYS}
select distinct 'unknown_namespace' as rule, '{{http://region/' || r || '}}:' || event_type as key, '{{http://region/' || r || '}}' as detail
from keys where r >= 5""",
    "registry_size": """
select count(*) as n from region""",
    "registry_listing": """
select '{http://region/' || r_regionkey || '}' as uri,
       case r_regionkey when 0 then 'cm' when 1 then 'sys' else 'r' || r_regionkey end as prefix
from region order by uri""",
    "txn_mismatch": """
select l_orderkey + 1 as id, count(*) filter (where l_returnflag <> 'R') + 1 as updates,
       count(*) filter (where l_returnflag = 'R') as deletes,
       count(*) filter (where l_returnflag <> 'R') as found_updates, count(*) filter (where l_returnflag = 'R') as found_deletes
from lineitem where (l_orderkey + 1) % 50 = 0 group by l_orderkey""",
    "field_dictionary": """
with names as (select p_name as name from part union select p_type from part union select url from pages)
select name, replace(replace(replace(url_encode(name), '.', '%2E'), '-', '%2D'), '~', '%7E') as encoded,
       name as decoded
from names""",
    "ref_uuid": """
select page_id, nullif(regexp_extract(url, '^.+://.+/(.+)$', 1), '') as uuid from pages""",
    "ref_tail": """
select page_id, regexp_extract(url, '([^/]*)$', 1) as tail from pages""",
    "bad_references": """
select 'bad_reference' as rule, page_id::varchar as key, regexp_extract(url, '([^/]*)$', 1) as detail
from pages where page_id % 3 = 0""",
    "unescape_text": """
select doc_id, md5(text) as text_md5, length(text) as n from documents""",
    "escape_text": r"""
with chars as (select doc_id, unnest(string_split(text, '')) as c, generate_subscripts(string_split(text, ''), 1) as i from documents),
parts as (
  select doc_id, i, case c when '"' then '\"' when '\' then '\\' when chr(10) then '\n' when chr(13) then '\r' when chr(9) then '\t'
                       else case when ord(c) < 128 then c
                                 when ord(c) < 65536 then printf('\u%04X', ord(c))
                                 else printf('\u%04X\u%04X', 55296 + (ord(c) - 65536) // 1024, 56320 + (ord(c) - 65536) % 1024) end end as e
  from chars),
texts as (select doc_id, string_agg(e, '' order by i) as escaped from parts group by doc_id)
select doc_id, md5(coalesce(escaped, '')) as escaped_md5, length(coalesce(escaped, '')) as n from documents left join texts using (doc_id)""",
    "documents_built": f"""
with {_BUILT}
select {_FLAT.format(stamp="1700000000000")} from built""",
    "documents_built_by_join": f"""
with {_BUILT}
select {_FLAT.format(stamp="1700000000000")} from built""",
    "primary_parent": f"""
with {_SEGMENTS}
select page_id, s[1] as primary_parent, case when len(s) > 0 then array_to_string(s, ',') end as parents from segs""",
    "tags": f"""
with {_SEGMENTS}
select page_id, case when len(s) > 1 and s[1] = 'fr' then s[2] else '' end as tags from segs""",
    "owner_fallback": """
select conv_id, turn, case when role = 'user' then 'u' || conv_id when turn % 2 = 1 then 't' || turn end as owner
from conversations""",
    "value_flatten": """
select conv_id, turn, to_json(text)::varchar as localised, '""' as bare_locale,
       '[{"locale":' || to_json(role)::varchar || ',"value":' || to_json(text)::varchar || ',"z":1}]' as no_locale,
       '[' || conv_id || ']' as references, '["a=' || conv_id || '","b=' || role || '"]' as map,
       turn::varchar as number, to_json(text)::varchar as plain, '[' || turn || ',' || conv_id || ']' as numbers
from conversations""",
    "index_lookup": f"""
with {_BUILT}
select uuid, case when quality is null then '' when quality = 1 then n_chars::varchar end as content_id from built""",
    "content_changed": f"""
with {_BUILT}
select uuid, n_chars::varchar as content_id, md5(text) as text_md5
from built where doc_id % 11 <> 0 and doc_id % 5 <> 0 and quality is distinct from 1 and text <> ''""",
    "content_applied": f"""
with {_BUILT},
hits as (select *, quality = 0 and doc_id % 11 <> 0 and doc_id % 5 <> 0 and text <> '' as hit from built where quality is not null)
select uuid, case when hit or quality = 1 then n_chars::varchar end as content_id,
       case when hit then md5(text) end as text_md5
from hits""",
    "content_latest": """
select conv_id, role, arg_max(text, turn) as text from conversations group by conv_id, role""",
    "apply_upsert": _UPSERT.replace("{settled}", "merged"),
    "apply_upsert_replace": _UPSERT.replace("{settled}", "fresh"),
    "apply_delete": """
select 'doc-' || doc_id as uuid, lang, source, n_chars
from documents where doc_id not in (select doc_id from labels where toxic = 1)""",
    "two_batches": _NUMBERS,
    "stream_net_state": _NUMBERS,
    "index_cycle": f"""
with {_BUILT},
mark as (
  select max(doc_id // 10 + 1 + case when toxic = 1 and quality = 1 then 3 when toxic = 1 then 1 else 0 end) as m
  from nodes),
kept as (select * from built where toxic is distinct from 1 or quality = 1)
select {_FLAT.format(stamp="1700000000000 + 1000 * (select m from mark)")},
       case when doc_id % 11 <> 0 and doc_id % 5 <> 0 and text <> '' then n_chars::varchar end as content_id,
       case when doc_id % 11 <> 0 and doc_id % 5 <> 0 and text <> '' then md5(text) end as text_md5
from kept""",
    "rejects_report": """
with nodes as (
  select doc_id, coalesce(toxic, 0) = 1 as toxic, coalesce(quality, 0) = 1 as good, doc_id % 29 = 8 as gone, doc_id % 13 = 5 as unnamed,
         1 + (coalesce(toxic, 0) = 1)::int + (coalesce(toxic, 0) = 1 and coalesce(quality, 0) = 1)::int as n_rows
  from documents left join labels using (doc_id)),
updated as (
  select * from nodes where doc_id % 17 <> 3 and not (unnamed and gone) and (not toxic or good)),
known as (select * from updated where not gone),
single as (select * from known where doc_id % 23 <> 6),
listed as (select * from single where doc_id % 30 <> 7),
found as (
  select 'bad_status' as rule, n_rows as n from nodes where doc_id % 17 = 3
  union all select 'bad_reference', n_rows from nodes where unnamed and gone
  union all select 'missing_metadata', 1 from updated where gone
  union all select 'repeated_metadata', 1 from known where doc_id % 23 = 6
  union all select 'duplicate_acl', 1 from (select 1 from single where doc_id % 30 = 7 limit 1)
  union all select 'bad_properties', 1 from listed where doc_id % 19 = 4
  union all select 'unknown_namespace', 1 from (select 1 from listed where doc_id % 19 <> 4 limit 1)
  union all select 'indexed', 1 from listed where doc_id % 19 <> 4)
select rule, sum(n)::bigint as n from found group by rule""",
    "bulk_export": f"""
with {_BUILT}
select uuid, type, primary_parent, readers, owner, tags, 1700000000000 as last_update_ms,
       case when doc_id % 7 <> 0 then 'doc-' || doc_id end as name, size, size as content_id, md5(text) as text_md5,
       -- always: type, readers, stamp, names, aspects, tags, alive, name, text, creator, title, categories, store, note
       14 + 2 * (doc_id % 4 <> 0)::int + (owner is not null)::int + 4 * (doc_id % 11 <> 0)::int
          + (doc_id % 3 <> 0)::int + coalesce((quality = 1)::int, 0) + (quality is not null)::int as n_fields
from built""",
    "quality_report": f"""
with {_KEYS}, {_MODELS},
named as (select distinct case when event_id % 50 = 0 then replace(replace(name, '{{', ''), '}}', '') else name end as name,
                 event_id % 50 = 0 as bare, r from keys),
found as (
  select 'bad_status' as rule from events where event_id % 97 = 0 or event_id % 89 = 0
  union all select 'duplicate_acl' from (select c_nationkey from customer group by 1 having count(*) > 1)
  union all select 'unknown_member' from (select distinct unnest(['highest', 'kind', 'props']) from events)
  union all select 'key_without_brace' from named where bare
  union all select 'unknown_namespace' from named where not bare and r >= 5
  union all select 'bad_model' from models where not good
  union all select 'bad_reference' from pages where page_id % 3 = 0
  union all select 'missing_metadata' from (select distinct l_partkey from lineitem
     where l_returnflag <> 'R' and l_partkey not in (select doc_id from documents))
  union all select 'missing_content' from documents
     where doc_id * 2 not in (select doc_id from documents where text <> ''))
select rule, count(*) as n from found group by rule""",
}
SQL["stream_index"] = SQL["index_cycle"]
SQL["held_back_cycle"] = f"select * exclude (last_update_ms) from ({SQL['index_cycle']})"

_SPARSE = """
whole as (select o_orderkey + 1 as id, epoch_ms(o_orderdate) as ms from orders),
sparse as (select * from whole where id % 97 <> 0 and id % 1000 not between 500 and 519)"""

_GAPS = """
select * from (select lag(id) over (order by id) + 1 as from_id, id - 1 as to_id, id as next_id, ms as next_ms
               from (select id, ms from {log} union all select {after}, null)) where from_id <= to_id"""

SQL["log_gaps"] = f"with {_SPARSE} {_GAPS.format(log='sparse', after=0)}"

SQL["late_transactions"] = f"""
with {_SPARSE}
select id from whole where id < (select max(id) from sparse) and id not in (select id from sparse)"""


def _settled(days):
    log = f"(select * from sparse where id <= {450 + days})"
    gaps = _GAPS.format(log=f"(select * from sparse where id between 21 and {450 + days})", after=20)
    return f"""
        select {days} as days, coalesce(
            (select min(from_id) from ({gaps}) where next_ms > (select max(ms) from {log}) - 3 * 86400000) - 1,
            (select max(id) from {log})) as settled_id"""


SQL["settled_mark"] = f"with {_SPARSE} {' union all '.join(map(_settled, (0, 100, 900)))}"

SQL["documents_as_of"] = f"""
with {_BUILT},
firsts as (select doc_id, toxic, quality, doc_id // 10 + 1 as first from nodes),
updates as (
  select doc_id, first as txn_id from firsts
  union all select doc_id, first + 3 from firsts where toxic = 1 and quality = 1),
versions as (
  select doc_id, first as version, false as reviewed from firsts
  union all select doc_id, first + 2, true from firsts where toxic = 1),
found as (
  select u.doc_id, u.txn_id, reviewed from updates u asof join versions v on u.doc_id = v.doc_id and u.txn_id >= v.version)
select txn_id, {_FLAT.format(stamp="1700000000000 + 1000 * txn_id").replace(" type,", " case when reviewed then 'cm:reviewed' else type end as type,")}
from found join built using (doc_id)"""

SQL["metadata_pruned"] = f"select * from ({SQL['metadata_join']}) where id % 40 = 3"
SQL["rejects_replayed"] = SQL["held_back_cycle"]
SQL["export_changes"] = f"""
with after as ({SQL['apply_upsert']}),
before as (
  select 'c-' || c_custkey as uuid, 'customer' as type, case when c_custkey % 2 = 0 then c_mktsegment end as owner,
         946684800000 + (c_custkey % 5) * 10000000000 as last_update_ms, 'name=' || c_name || '|segment=' || c_mktsegment as fields
  from customer),
kept as (select * from after where substr(uuid, 3)::bigint % 11 <> 0)
select coalesce(k.uuid, b.uuid) as uuid, case when k.uuid is null then 'delete' else 'update' end as action
from before b full join kept k on k.uuid = b.uuid
where k.uuid is null or b.uuid is null or (k.type, k.last_update_ms, k.fields) <> (b.type, b.last_update_ms, b.fields) or k.owner is distinct from b.owner"""

SQL["registry_propagated"] = f"""
select * replace (replace(property_names, 'r3:', 'r9:') as property_names, replace(fields, 'r3%3A', 'r9%3A') as fields),
       contains(property_names, 'r3:')::int as rebuilt
from ({SQL['documents_built']})"""
