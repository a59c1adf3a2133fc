"""Contamination against a plain search for every window."""

import hashlib
import random

import brute
import pytest

from tidemark.llm import decontaminate as D


def corpus(seed, common):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(common)] + ["É", "é", "naïve", "42"]

    def text(n):
        return "".join(pick.choice(vocabulary) + pick.choice((" ", " ", ", ", ".\n", "-")) for _ in range(n))

    items = [(i, text(n)) for i, n in enumerate((30, 25, 12, 10, 9, 3, 1, 0))] + [(100, None), (3, "W1 w2"), (101, "a " * 15)]
    docs = []
    for i in range(40):
        parts = [text(pick.randrange(40))]
        for _ in range(pick.randrange(3)):
            held = (pick.choice(items[:5])[1] or "").split(" ")
            a = pick.randrange(max(1, len(held) - 8))
            parts += [" ".join(held[a : a + pick.randrange(8, 25)]).upper(), text(5)]
        docs.append((i, " ".join(parts)))
    return docs + [(50, None), (51, ""), (52, "..."), (53, "a " * 400), (54, items[0][1])], items


@pytest.mark.parametrize("seed, common", [(1, 400), (2, 12)])
def test_contamination(spark, seed, common):
    docs, items = corpus(seed, common)
    frame = spark.createDataFrame([(i, t, 9, "x") for i, t in docs], "doc_id long, text string, n_words int, item string").repartition(3)
    tests = spark.createDataFrame(items + items[:1], "item_id long, text string")
    found = {r["id"]: r for r in D.contamination(frame, tests).collect()}
    assert len(found) == len(docs)
    for doc, n_words, n_hit, n_items, digest in brute.decontamination(docs, items):
        r = found[doc]
        assert (r["n_words"], r["n_hit"], len(r["items"])) == (n_words, n_hit, n_items), doc
        assert hashlib.sha256(",".join(r["items"]).encode()).hexdigest() == digest
    kept = D.keep_clean(frame, tests)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in found.items() if not r["n_hit"])


def test_both_sides_of_the_size_check(spark, monkeypatch):
    docs, items = corpus(3, 60)
    frame, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    few = sorted(map(tuple, D.contamination(frame, tests).collect()))
    import tidemark.llm.common as common

    monkeypatch.setattr(D, "bounded_broadcast", lambda df, n, width: common.bounded_broadcast(df, n, width, limit=-1))
    assert sorted(map(tuple, D.contamination(frame, tests).collect())) == few


def test_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, text), (1, text), (1, "other"), (None, text)], "doc_id long, text string")
    items = spark.createDataFrame([(None, text), (7, text)], "item_id long, text string")
    found = D.contamination(docs, items).collect()
    assert sorted((r["id"] or 0, r["n_hit"], tuple(r["items"])) for r in found) == [(0, 11, ("", "7")), (1, 0, ()), (1, 11, ("", "7")), (1, 11, ("", "7"))]
    assert D.contamination(docs.limit(0), items).collect() == []
    assert {r["n_hit"] for r in D.contamination(docs, items.limit(0)).collect()} == {0}


def test_proximity(spark):
    docs = [(1, "alpha beta gamma"), (2, "alpha x beta y gamma"), (3, "alpha x x x beta gamma"), (4, "gamma beta alpha"), (5, "alpha gamma"), (6, None)]
    index = D.Index(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "Alpha beta gamma")], "item_id long, text string"))
    found = {slop: sorted({r["id"] for r in D.proximity_matches(index, slop).collect()}) for slop in (0, 1, 2, 4)}
    assert found == {0: [1], 1: [1, 2], 2: [1, 2, 4], 4: [1, 2, 3, 4]}
