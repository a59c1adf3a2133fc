"""Quality statistics against plain counts, and decision lists on planted rules."""

import random

import brute

from tidemark.llm import quality_rules as Q

TEXTS = [
    None, "", " \t\n\x0b\x0c\r", "one", "a b", "a b c", "a b c a b c", "x x x x x", "a  b\tc\nd\r\ne\x0bf\x0cg", "\x1ca\u00a0b \x85c",
    "## && || <> $% *", "l1\nl1\n l1\n\n\nl1 ", "É é ß 日本 🙂 " * 30, "the same line of words here\n" * 100, "w " * 5000, "aé!! BÉ!! " * 60,
]


def test_statistics(spark):
    pick = random.Random(2)
    texts = TEXTS + [" ".join(f"w{pick.randrange(9)}" for _ in range(pick.randrange(120))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, lines string")
    found = Q.statistics(docs).withColumn("base_failed", Q.base_failed()).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["id"]: tuple(r[n] for n in names) for r in found} == {i: brute.base_statistics(t) for i, t in enumerate(texts)}


def planted(pick, bad):
    words = [f"w{pick.randrange(9999)}" for _ in range(pick.randrange(60, 150))]
    if bad == 1:
        words = [w[:-1] + "#" for w in words]
    if bad == 2:
        words = [w.upper() + "LONGWORDINCAPITALS" for w in words]
    return " ".join(words)


def table(spark, n=400):
    pick = random.Random(7)
    kinds = [pick.choice((0, 0, 0, 1, 2)) for _ in range(n)]
    docs = spark.createDataFrame([(i, planted(pick, k), 1) for i, k in enumerate(kinds)], "doc_id long, text string, kept int")
    return docs, kinds


def test_planted_rules_are_found(spark):
    docs, kinds = table(spark)
    labels = spark.createDataFrame([(i, int(k == 0), 0) for i, k in enumerate(kinds) if i % 2], "doc_id long, quality int, toxic int")
    found = Q.quality_rules(docs, labels)
    rows = {r["id"]: r for r in found.collect()}
    assert all(rows[i]["kept"] == (k == 0) for i, k in enumerate(kinds))
    assert all((rows[i]["rule"] is None) == (k == 0) for i, k in enumerate(kinds))
    assert len({r["rule"] for r in rows.values()}) == 3
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [i for i, k in enumerate(kinds) if k == 0]


def test_noise_gives_no_rule(spark):
    docs, kinds = table(spark, 120)
    pick = random.Random(1)
    labels = spark.createDataFrame([(i, pick.randrange(2)) for i in range(120)], "doc_id long, quality int")
    assert Q.learn(Q.statistics(docs), labels, least_rows=20) == []


def test_null_labels_repeated_rows_and_empty_tables(spark):
    docs, _ = table(spark, 60)
    docs = docs.unionByName(docs.limit(10)).unionByName(spark.createDataFrame([(None, None, 1), (None, "x", 1)], docs.schema))
    labels = spark.createDataFrame([(None, 0), (1, None), (2, 0), (2, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        found = Q.quality_rules(docs, some)
        assert found.count() == 72 and found.where("rule is not null").count() == 0
    assert Q.quality_rules(docs.limit(0), labels).collect() == [] and Q.keep_good(docs.limit(0), labels).collect() == []


def test_rules_are_applied_in_order(spark):
    stats = Q.statistics(spark.createDataFrame([(1, "a# b#"), (2, "a b c"), (3, "a")], "doc_id long, text string"))
    rules = [[("symbols", ">=", 500)], [("symbols", ">=", 1), ("words", ">=", 1)], [("words", ">=", 2)]]
    found = {r["id"]: r["rule"] for r in Q.judged(stats, rules).collect()}
    assert found == {1: "symbols >= 500", 2: "words >= 2", 3: None}


def test_no_python_in_the_plan(spark):
    docs, kinds = table(spark, 30)
    labels = spark.createDataFrame([(i, int(k == 0)) for i, k in enumerate(kinds)], "doc_id long, quality int")
    plan = Q.quality_rules(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
