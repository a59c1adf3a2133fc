"""One query for each operator, over its whole table with production parameters, and SQL where it can say it."""

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe, decontaminate, hard_negatives, language_id, line_dedup, prefix_trie, quality_rules, secrets, sharding, simhash,
    token_counts, toxicity, url_filter,
)
from tidemark.llm.common import crc32_of, stored

TOKEN_LIMIT = 512
#: The rules op7 judges by.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark, folder):
    counted = token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_language(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = crc32_of(F.col("doc_id")) % 4 == 2
    model = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs, model)
    return found.select("doc_id", (crc32_of(F.col("doc_id")) % 4 == 2).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "rejected")


def op4_line_dedup(spark, folder):
    found = line_dedup.deduplicated(table(spark, folder, "documents"))
    listed = F.transform("spans", lambda s: F.concat_ws(":", s["start"], F.least(s["end"], F.col("n_chars_before"))))
    return found.withColumn("n_chars_before", F.length("before")).select(
        F.col("row.doc_id").alias("doc_id"), F.coalesce(F.size("spans"), F.lit(0)).alias("n_deleted_runs"),
        F.coalesce(F.array_join(listed, ","), F.lit("")).alias("deleted"),
        (F.coalesce("n_chars_before", F.lit(0)) - F.coalesce(F.length("row.text"), F.lit(0))).alias("n_deleted_chars"),
        F.col("row.text").alias("text"))


def op5_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    net = toxicity.fit(docs, labels.where(crc32_of(F.col("doc_id")) % 3 != 1))
    return toxicity.toxicity(docs, net).select(
        "doc_id", (crc32_of(F.col("doc_id")) % 3 == 1).alias("held_out"), "score", "predicted")


def op6_decontamination(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_url_filter(spark, folder):
    rules = spark.createDataFrame(URL_RULES, "rule string, action string")
    judged = url_filter.judge(table(spark, folder, "pages"), rules)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op8_quality_rules(spark, folder):
    judged = quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "rule")


def op9_byte_bpe(spark, folder):
    coded = byte_bpe.encode(table(spark, folder, "documents").select("doc_id", "text"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_secrets(spark, folder):
    docs = table(spark, folder, "documents")
    spans = secrets.secret_spans(docs)
    listed = F.struct("start", "rank", F.concat_ws(":", "kind", "start", "end").alias("span"))
    base = F.col("rank") < len(secrets.BASE)

    def joined(column):
        return F.array_join(F.array_sort(column)["span"], ",")

    def counted(kind):
        return F.sum((F.col("kind") == kind).cast("long"))

    digests = spans.groupBy("id", "mark").agg(
        *[counted(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        joined(F.collect_list(F.when(base, listed))).alias("base"), joined(F.collect_list(listed)).alias("spans"),
        F.sum((F.col("verdict") == "live").cast("long")).alias("n_live"), F.sum((F.col("verdict") == "copied").cast("long")).alias("n_copied"))
    digests = digests.withColumnsRenamed({"id": "d_id", "mark": "d_mark"})
    rows = docs.select(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))
    return rows.join(digests, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("mark") == F.col("d_mark")), "left").select(
        "doc_id", *[F.coalesce(f"n_{kind}", F.lit(0)).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def op11_sharding(spark, folder):
    places = sharding.assign(table(spark, folder, "documents"), shards=40)
    return places.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def with_shared_starts(turns):
    """Each conversation c begins with the first h turns of conversation c - c % 100 and goes on with its own turns
    after its first h, where h is crc32(c) % 6. A row of pos 0 for each conversation keeps those without a turn."""
    first = F.col("conv_id") - F.col("conv_id") % 100
    own = turns.withColumn("base", first).withColumn("h", (crc32_of(F.col("conv_id")) % 6).cast("int"))
    starts = turns.where((F.col("conv_id") == first) & (F.col("pos") <= 5))
    held = starts.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).cast("int").alias("held"))
    rest = own.where(F.col("pos") > F.col("h")).join(held, "base", "left")
    rest = rest.withColumn("pos", F.col("pos") - F.col("h") + F.least("h", F.coalesce("held", F.lit(0))))
    known = own.select("conv_id", "base", "h").distinct()
    shared = known.join(starts.withColumnRenamed("conv_id", "base"), "base").where(F.col("pos") <= F.col("h"))
    columns = "conv_id", F.col("pos").cast("int").alias("pos"), "token", "chars"
    none = known.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("token"), F.lit(None).cast("long").alias("chars"))
    return rest.select(*columns).unionByName(shared.select(*columns)).unionByName(none)


def op12_prefix_trie(spark, folder):
    turns = stored(prefix_trie.turns_of(table(spark, folder, "conversations")), "turns")
    return prefix_trie.prefix_trie(with_shared_starts(turns))


def op13_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_simhash, op3_language, op4_line_dedup, op5_toxicity, op6_decontamination, op7_url_filter,
    op8_quality_rules, op9_byte_bpe, op10_secrets, op11_sharding, op12_prefix_trie, op13_hard_negatives)}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"list_filter(string_split_regex({LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

def crc32_sql(hexed):
    """DuckDB has no crc32: fold the bits of the bytes, given as hex text, the lowest of each byte first."""
    bits = (f"flatten(list_transform(regexp_extract_all({hexed}, '..'), lambda h: "
            "list_transform(range(8), lambda k: (cast('0x' || h as bigint) >> k) & 1)))")
    step = "case when (xor(acc, bit) & 1) = 1 then xor(acc >> 1, 3988292384) else acc >> 1 end"
    return f"xor(list_reduce({bits}, lambda acc, bit: {step}, 4294967295::bigint), 4294967295)"


SHARDS, SEED = 40, 42

SQL = {
    "op6_decontamination": f"""
        with items as (select distinct item_id, {WORDS} as words from benchmark),
        windows as (
            select distinct item_id, words[i : i + least(10, len(words)) - 1] as w
            from (select item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) as i from items where len(words) > 0)),
        docs as (select doc_id, text, {WORDS} as words from documents),
        sizes as (select distinct len(w) as n from windows),
        grams as (
            select doc_id, i, n, words[i : i + n - 1] as w
            from (select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i from docs, sizes where len(words) >= n)),
        hits as (select doc_id, item_id, i, n from grams join windows using (w)),
        places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
        found as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
                  from hits group by doc_id)
        select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from docs left join places using (doc_id) left join found using (doc_id)""",
    "op7_url_filter": f"""
        with rules(rule, action) as (values {", ".join(str(r) for r in URL_RULES)}),
        parts as (select rule, action, split_part(rule, '/', 1) as rule_host, substr(rule, strpos(rule, '/')) as rule_path from rules),
        urls as (select page_id, coalesce(url, '') as u, strpos(coalesce(url, ''), '://') as cut from pages),
        parsed as (
            select page_id,
                   case when cut > 0 then translate(regexp_extract(substr(u, cut + 3), '^([^/?#]*)', 1),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
                   case when cut > 0 then regexp_extract(substr(u, cut + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
            from urls),
        fits as (
            select page_id, rule, action, row_number() over (partition by page_id order by length(rule) desc) as nth
            from parsed join parts on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
        select page_id, host, path, rule, coalesce(action, 'allow') as verdict
        from parsed left join (select * from fits where nth = 1) using (page_id)""",
    "op11_sharding": f"""
        with thin as (
            select doc_id, source, coalesce(text, '') as t, md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as key from documents),
        sized as (select doc_id, source, key, octet_length(encode(t)) + 16 as size, {crc32_sql("hex(encode(t))")} as crc from thin),
        ranked as (
            select *, (2 * row_number() over (partition by source order by key, crc, size) - 1)::double
                      / (2 * count(*) over (partition by source))::double as fraction from sized),
        placed as (
            select *, row_number() over (order by fraction, source nulls first, key, crc, size) - 1 as place, count(*) over () as total from ranked)
        select doc_id, cast(size as bigint) as size, cast(crc as bigint) as text_crc32, 'rows' as law,
               cast(place * {SHARDS} // total as integer) as shard,
               cast(place - (place * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS} as bigint) as slot, cast(null as integer) as grown_shard
        from placed""",
    "op12_prefix_trie": f"""
        with turns as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
            from conversations where conv_id is not null),
        heads as (
            select conv_id, conv_id - conv_id % 100 as base, {crc32_sql("hex(encode(cast(conv_id as varchar)))")} % 6 as h
            from (select distinct conv_id from turns)),
        parts as (
            select heads.conv_id, 0 as half, pos, role, text from heads join turns on turns.conv_id = base and pos <= h
            union all
            select heads.conv_id, 1 as half, pos, role, text from heads join turns on turns.conv_id = heads.conv_id and pos > h),
        rebuilt as (
            select conv_id, list(sha256(cast(length(role) as varchar) || ':' || role || text) order by half, pos) as seq,
                   list(length(text) order by half, pos) as chars
            from parts group by conv_id),
        convs as (select heads.conv_id, coalesce(seq, []) as seq, coalesce(chars, []) as chars from heads left join rebuilt using (conv_id)),
        members as (
            select conv_id, d, seq[1:d] as prefix, len(seq) = d as ends, case when d > 0 then chars[d] else 0 end as own
            from (select *, unnest(range(0, len(seq) + 1)) as d from convs)),
        nodes as (
            select prefix, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(own) as own,
                   sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256
            from members group by prefix),
        children as (select prefix[1:depth - 1] as prefix, count(*) as n_children from nodes where depth > 0 group by 1),
        full_nodes as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children using (prefix)),
        below as (
            select prefix[1:k] as prefix, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * own) as saved_tokens
            from (select *, unnest(range(0, depth + 1)) as k from full_nodes) group by 1)
        select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children,
               cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
        from full_nodes n join below using (prefix) left join nodes p on n.depth > 0 and p.prefix = n.prefix[1:n.depth - 1]""",
    "op13_hard_negatives": """
        with rows as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
            from (select distinct * from embeddings)
            where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as score
            from rows a join rows b on a.vec_id <> b.vec_id or a.label <> b.label where a.vec_id % 50 = 0),
        positives as (
            select * from (select anchor_id, id as positive_id, score as positive_score,
                                  row_number() over (partition by anchor_id order by score desc, id) as nth from scored where same) where nth <= 5),
        negatives as (
            select p.anchor_id, positive_id, id as negative_id, positive_score, score as negative_score,
                   row_number() over (partition by p.anchor_id, positive_id order by score desc, id) as rank
            from positives p join scored s on s.anchor_id = p.anchor_id and not same
                 and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score)
        select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from negatives where rank <= 3""",
}
