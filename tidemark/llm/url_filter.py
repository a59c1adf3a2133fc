"""URL filter: host suffixes and path prefixes of a URL, looked up by short hash prefixes.

A rule is a host and a path ("example.org/es/"); it fits its host, all subdomains of it, and every path that
starts with its path. Each URL is expanded into the expressions a rule could have: the suffixes of its host
with as many labels, and the prefixes of its path with as many characters, as some rule has. An expression
meets the rules by the first bytes of its SHA-256; the whole digest confirms it, and the longest rule wins.
"""

from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, bounded_broadcast

#: Hex digits of the hash prefix that is joined on.
PREFIX = 8


def parsed(url):
    """(host, path) of a URL column: the host up to / ? # or the end, A-Z lower-cased; the path up to ? #."""
    rest = F.expr("substring(_url, locate('://', _url) + 3)")
    has = F.expr("locate('://', _url) > 0")
    host = F.when(has, ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise("")
    path = F.when(has, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def compiled(rules):
    """rules (rule string, action string) with host, path, digest and shape; a rule given twice counts once,
    as `block` if its actions differ. Rules without a slash have the empty path; null rules are left out."""
    one = rules.where("rule is not null").groupBy("rule").agg(F.max("action").alias("action"))
    host = ascii_lower(F.substring_index("rule", "/", 1))
    path = F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")
    return one.select("rule", "action", host.alias("host"), path.alias("path")).select(
        "rule", "action", F.sha2(F.concat("host", F.lit("\n"), "path"), 256).alias("digest"),
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))


def judge(pages, rules, id_col="page_id", url_col="url", default="allow"):
    """id, url, host, path, rule, verdict of every row.

    Longest rule: the one of the most characters; of equal ones the blocking one, then the greater string. URLs
    that no rule fits get rule null and the default verdict; null URLs and those without :// have an empty host
    and path, which no rule fits. Repeated rows are judged alike; other columns of pages are ignored.
    The distinct shapes (labels, characters) of the rules reach the driver: host labels x path lengths, whatever
    the number of rules. Rules are broadcast while their count times 256 bytes fits the limit.
    """
    table = compiled(rules)
    known = table.groupBy("labels", "chars").agg(F.count(F.lit(1)).alias("n")).collect()
    base = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url")).withColumn("_url", F.coalesce(F.col("url"), F.lit("")))
    host, path = parsed("_url")
    base = base.withColumns({"host": host, "path": path}).drop("_url")
    keys = base.select("url", "host", "path")
    if not known:
        return base.select("id", "url", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    shapes = F.array(*[F.struct(F.lit(r["labels"]).alias("labels"), F.lit(r["chars"]).alias("chars")) for r in known])
    labels = F.size(F.split("host", r"\."))
    expanded = (
        keys.where("host != ''").distinct()
        .withColumn("n_labels", labels).withColumn("shape", F.explode(shapes))
        .where("shape.labels <= n_labels and shape.chars <= length(path)")
        .select("url", F.sha2(F.concat(
            F.expr("substring_index(host, '.', -shape.labels)"), F.lit("\n"), F.expr("substring(path, 1, shape.chars)")), 256).alias("d"))
        .withColumn("prefix", F.substring("d", 1, PREFIX))
    )
    listed = table.withColumn("prefix", F.substring("digest", 1, PREFIX))
    listed = bounded_broadcast(listed, sum(r["n"] for r in known), 256)
    fits = expanded.join(listed, "prefix").where("d = digest")
    order = F.struct(F.length("rule").alias("length"), (F.col("action") == "block").alias("blocks"), F.col("rule").alias("rule"),
                     F.col("action").alias("action"))
    best = fits.groupBy("url").agg(F.max(order).alias("best")).select(F.col("url").alias("u"), "best")
    return base.join(best, base["url"] == best["u"], "left").select(
        "id", "url", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"))
