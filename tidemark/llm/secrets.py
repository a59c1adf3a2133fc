"""Secret scans: candidate spans, and how widely the corpus shares each value.

Candidates are found by patterns. Each value's hash is counted by distinct repositories and owners: what many
owners or many repositories hold is a copied example, what few hold and doesn't look like a placeholder seems live.
Tokens without a telling form are reported only if they seem live and belong to one owner. By default the source of
a document is its owner and the document itself (its id) is the repository.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, stored

#: Base kinds: name, pattern, group of the value, least characters of the value.
BASE = [
    ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
#: Further kinds of a telling form, and at last tokens that mix cases and digits.
FORMS = [
    ("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 20),
    ("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
]
MIXED = [("mixed", r"(?<![A-Za-z0-9_-])(?=[a-zA-Z_-]*[0-9])(?=[A-Z0-9_-]*[a-z])(?=[a-z0-9_-]*[A-Z])[A-Za-z0-9_-]{20,}", 0, 20)]
KINDS = BASE + FORMS + MIXED
PLACEHOLDER = r"(?i)example|sample|changeme|placeholder|your|dummy|xxxx|1234567|abcdef"


def candidates(docs, owner_col="source", repository_col=None, id_col="doc_id", text_col="text"):
    """id, mark, owner, repository, rank, kind, start, end, value of each match that is long enough.

    Matches of a kind are leftmost and don't overlap; too short ones are dropped after matching. start and end
    are code points, end exclusive. A match begins after the lengths of what lies between matches and of the
    matches before it, so one running sum over the pieces of a text gives all positions.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    repository_col = repository_col or id_col
    # documents without an id are told apart by their texts
    unnamed = F.concat(F.lit("\n"), F.hex(F.xxhash64(text))) if repository_col == id_col else F.lit("")
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"),
                       F.coalesce(docs[owner_col].cast("string"), F.lit("")).alias("owner"),
                       F.coalesce(docs[repository_col].cast("string"), unnamed).alias("repository"))
    found = [
        F.when(F.col("text").rlike(pattern), F.struct(F.lit(rank).alias("rank"), F.arrays_zip(
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("all"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("value"),
            F.split("text", pattern, -1).alias("gap")).alias("parts")))
        for rank, (_, pattern, group, _) in enumerate(KINDS)
    ]
    keys = ["id", "mark", "owner", "repository"]
    pieces = (
        rows.select(*keys, F.filter(F.array(*found), lambda x: x.isNotNull()).alias("kinds")).where(F.size("kinds") > 0)
        .select(*keys, F.explode("kinds").alias("k"))
        .select(*keys, F.col("k.rank").alias("rank"), F.posexplode("k.parts").alias("at", "p")).where("p.all is not null")
        .select(*keys, "rank", "at", F.length("p.gap").cast("long").alias("gap"), F.length("p.all").cast("long").alias("size"),
                F.col("p.value").alias("value"))
        .distinct()  # repeated rows are one document
    )
    so_far = Window.partitionBy(*keys, "rank").orderBy("at")
    placed = pieces.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("rank") + 1)
    return placed.where(F.length("value") >= least).select(
        *keys, "rank", F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("rank") + 1).alias("kind"),
        (F.col("end") - F.col("size")).alias("start"), "end", "value")


def ownership(found):
    """hash, n_repositories, n_owners of each value.

    A value that fills a third of the corpus is dealt out by its repositories, then counted before it is shuffled
    by value; its owners arrive once from each task.
    """
    held = found.select(F.sha2("value", 256).alias("hash"), "repository", "owner")
    repositories = held.select("hash", "repository").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_repositories"))
    owners = held.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"))
    return repositories.join(owners, "hash")


def secret_spans(docs, owner_col="source", repository_col=None, id_col="doc_id", text_col="text", copied_owners=3,
                 copied_repositories=10):
    """id, mark, rank, kind, start, end, hash, n_repositories, n_owners, verdict of every span.

    verdict: `copied` if at least copied_owners owners or copied_repositories repositories hold the value,
    `placeholder` if it looks like one or has fewer than 6 different characters, else `live`. All base spans stay. Forms are added where no base span
    overlaps them, mixed tokens where neither does, if live and of one owner. A null owner is an owner of its own; a null
    repository too, or, where documents are the repositories, each text without an id; repeated rows count once; other columns of docs are ignored.
    """
    found = stored(candidates(docs, owner_col, repository_col, id_col, text_col), "secret-candidates")
    variety = F.size(F.array_distinct(F.split("value", "")))
    held = ownership(found)
    spans = found.select("id", "mark", "rank", "kind", "start", "end", F.sha2("value", 256).alias("hash"),
                         (F.col("value").rlike(PLACEHOLDER) | (variety < 6)).alias("dull")).distinct()
    copied = (F.col("n_owners") >= copied_owners) | (F.col("n_repositories") >= copied_repositories)
    spans = spans.join(held, "hash").withColumn("verdict", F.when(copied, "copied").when(
        F.col("dull"), "placeholder").otherwise("live")).drop("dull")
    before = Window.partitionBy("id", "mark").orderBy("start", "rank")
    first_form, first_mixed = len(BASE), len(BASE) + len(FORMS)

    def free_of(below):
        """No span of a lower rank overlaps."""
        last_end = F.max(F.when(F.col("rank") < below, F.col("end"))).over(before.rowsBetween(Window.unboundedPreceding, -1))
        next_start = F.min(F.when(F.col("rank") < below, F.col("start"))).over(before.rowsBetween(1, Window.unboundedFollowing))
        return F.coalesce(last_end <= F.col("start"), F.lit(True)) & F.coalesce(next_start >= F.col("end"), F.lit(True))

    stays = F.when(F.col("rank") < first_form, F.lit(True)).when(F.col("rank") < first_mixed, free_of(first_form)).otherwise(
        free_of(first_mixed) & (F.col("verdict") == "live") & (F.col("n_owners") == 1))
    return spans.withColumn("stays", stays).where("stays").drop("stays")
