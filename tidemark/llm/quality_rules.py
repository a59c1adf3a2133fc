"""Quality rules: a decision list learned from labelled statistics, as ordered Spark conditions.

Statistics of every text become whole-number metrics (shares per 1000). Labelled rows are counted by grid
cell of their metrics, and sequential covering runs on the cells: a rule grows by the threshold condition of
the highest gain on two thirds of the labelled rows, is pruned on the others, and the rows it covers leave.
All counts are aggregations over the cells; a few hundred sums a step reach the driver.
"""

from functools import reduce
from math import log2

from pyspark.sql import functions as F

from tidemark.llm.common import keyed, same_document, stored

#: Fixed value: what separates words.
GAPS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Threshold grid: 1, 2, 5 times the powers of ten, and 0; every metric is a whole number.
GRID = [0] + [m * 10**e for e in range(5) for m in (1, 2, 5)]
#: Metrics by name: (numerator, denominator) of a share per 1000, or a plain number.
METRICS = {
    "symbols": ("n_symbols", "n_words"), "repeats": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
    "capitals": ("n_capitals", "word_chars"), "exclamations": ("n_exclamations", "n_words"), "word_length": ("word_chars", "n_words"),
    "words": ("n_words", None),
}


def statistics(docs, id_col="doc_id", text_col="text"):
    """id, mark and the counts of every row; null and empty texts count 0 throughout."""
    text = F.col("text")
    words = (
        keyed(docs, id_col, text_col)
        .withColumn("trimmed", F.btrim(text, F.lit(GAPS)))
        .withColumn("words", F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
                    .otherwise(F.split("trimmed", r"[ \t-\r]+")))
        .withColumn("lines", F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(GAPS)) != ""))
    )
    counted = words.select(
        "id", "mark", "words", F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[^ \t-\r]+", ""))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        (F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).cast("long").alias("n_exclamations"),
    )
    # windows of three words sorted by hash: those beside an equal one are repeated
    windows = F.slice(
        F.transform("words", lambda w, i: F.struct(
            F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i"))),
        1, F.greatest(F.size("words") - 2, F.lit(0)))
    kept = [c for c in counted.columns if c != "words"]
    ordered = counted.select(*kept, F.sort_array(windows).alias("ws"))
    repeated = ordered.select(*kept, F.filter("ws", lambda w, i: (
        (w["h"] == F.get("ws", i - 1)["h"]) | (w["h"] == F.get("ws", i + 1)["h"]))).alias("again"))
    places = F.flatten(F.transform("again", lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    return repeated.select(*kept, F.size(F.array_distinct(places)).cast("long").alias("n_repeat_words"))


def metric(name):
    top, below = METRICS[name]
    if below is None:
        return F.col(top)
    return F.when(F.col(below) > 0, F.floor(1000 * F.col(top) / F.col(below))).otherwise(F.lit(0)).cast("long")


def condition(part):
    name, sign, threshold = part
    return metric(name) >= threshold if sign == ">=" else metric(name) < threshold


def text_of(rule):
    return " and ".join(f"{name} {sign} {threshold}" for name, sign, threshold in rule)


def fired(rules):
    """The first rule that holds, as text; null where none does."""
    if not rules:
        return F.lit(None).cast("string")
    chain = F
    for rule in rules:
        chain = chain.when(reduce(lambda a, b: a & b, map(condition, rule)), F.lit(text_of(rule)))
    return chain.otherwise(F.lit(None).cast("string"))


def learn(stats, labels, id_col="doc_id", label_col="quality", bad=0, max_rules=8, max_conditions=3, least_rows=8,
          least_precision=0.95):
    """Ordered rules, each a list of (metric, sign, threshold), that find rows labelled `bad`.

    stats: statistics() of the documents; labels: id and label of some, null labels and ids left out. A row
    is for growing or pruning by its id's hash. A rule is taken if it finds at least least_rows bad rows among
    those left, with at least least_precision of what it covers, on both parts together; the first that
    doesn't ends the list, as no labels give an empty one.
    """
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg(
        F.max((F.col(label_col) == bad).cast("int")).alias("bad"))
    rows = stats.join(marks, stats["id"] == marks["l_id"])
    cell = {name: sum((metric(name) >= t).cast("int") for t in GRID).cast("byte").alias(name) for name in METRICS}
    grow = F.pmod(F.xxhash64("id"), F.lit(3)) < 2
    sums = {
        "gp": F.sum((grow & (F.col("bad") == 1)).cast("long")), "gn": F.sum((grow & (F.col("bad") == 0)).cast("long")),
        "pp": F.sum((~grow & (F.col("bad") == 1)).cast("long")), "pn": F.sum((~grow & (F.col("bad") == 0)).cast("long")),
    }
    names, counts = list(METRICS), list(sums)
    cells = stored(rows.select(*cell.values(), "id", "bad").groupBy(*names).agg(*[v.alias(k) for k, v in sums.items()]), "quality-cells")

    def holds(part):
        name, sign, threshold = part
        at = GRID.index(threshold) + 1
        return F.col(name) >= at if sign == ">=" else F.col(name) < at

    def best_condition(left):
        """All four sums of each (metric, cell number): at most the metrics times the grid."""
        long = left.select(F.explode(F.array(*[F.struct(F.lit(n).alias("m"), F.col(n).alias("c")) for n in names])).alias("x"), *counts)
        found = long.groupBy("x.m", "x.c").agg(*[F.sum(c).alias(c) for c in counts]).collect()
        totals = {c: sum(r[c] for r in found if r["m"] == names[0]) for c in counts}
        if not totals["gp"]:
            return None, totals, None
        before, best = log2(totals["gp"] / (totals["gp"] + totals["gn"])), (1e-9, [])
        for name in names:
            own = sorted((r for r in found if r["m"] == name), key=lambda r: r["c"])
            for sign in (">=", "<"):
                for at, threshold in enumerate(GRID, 1):
                    covered = {c: sum(r[c] for r in own if (r["c"] >= at) == (sign == ">=")) for c in counts}
                    if covered["gp"] and covered["gp"] + covered["gn"] < totals["gp"] + totals["gn"]:
                        gain = covered["gp"] * (log2(covered["gp"] / (covered["gp"] + covered["gn"])) - before)
                        part = ((name, sign, threshold), covered)
                        if gain > best[0] + 1e-9:
                            best = (gain, [part])
                        elif best[1] and gain > best[0] - 1e-9 and best[1][0][0][:2] == (name, sign):
                            best[1].append(part)
        if not best[1]:
            return None, totals, None
        # thresholds that tell the rows apart alike: the one in the middle
        part, covered = best[1][(len(best[1]) - 1) // 2]
        return part, totals, covered

    rules, left = [], cells
    while len(rules) < max_rules:
        rule, sums_after, covered = [], [], left
        while len(rule) < max_conditions:
            part, _, after = best_condition(covered)
            if part is None:
                break
            rule.append(part)
            sums_after.append(after)
            covered = covered.where(holds(part))
            if not after["gn"]:
                break
        # pruned to the length of the best balance on the rows that didn't grow it; the shorter of equal ones
        worth = [((s["pp"] - s["pn"]) / (s["pp"] + s["pn"]) if s["pp"] + s["pn"] else -1.0) for s in sums_after]
        if not rule:
            break
        size = max(range(len(rule)), key=lambda i: (worth[i], -i)) + 1
        rule, s = rule[:size], sums_after[size - 1]
        good, all_rows = s["gp"] + s["pp"], sum(s.values())
        if good < least_rows or good < least_precision * all_rows:
            break
        rules.append(rule)
        left = left.where(~reduce(lambda a, b: a & b, map(holds, rule)))
    return rules


def judged(stats, rules):
    """stats with rule (the first that holds, null if none) for every row."""
    return stats.withColumn("rule", fired(rules))


def base_failed():
    """What fails whatever the rules: few words, or repeats in over half of them."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(docs, labels, id_col="doc_id", text_col="text", **options):
    """id, mark, counts, base_failed, rule, kept of every row of docs; other columns are ignored."""
    stats = stored(statistics(docs, id_col, text_col), "quality-statistics")
    rules = learn(stats.where(~base_failed()), labels, id_col, **options)  # of what the base leaves
    return judged(stats, rules).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs, labels, id_col="doc_id", text_col="text", **options):
    """The rows of docs, all columns, that quality_rules keeps."""
    kept = quality_rules(docs, labels, id_col, text_col, **options).where("kept").select("id", "mark").distinct()
    rows = docs.select(F.struct("*").alias("_row"), docs[id_col].alias("id"),
                       F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("mark"))
    return rows.join(kept, same_document(rows, kept), "left_semi").select("_row.*")
