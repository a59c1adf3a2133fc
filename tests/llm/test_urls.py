"""URL verdicts against a plain scan of the rules."""

import random

import brute
import pytest

from tidemark.llm import url_filter as U
from tidemark.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http:///es/x", "https://EXAMPLE.org/es/1?x#y", "http://a.b.example.org/en/12/", "http://example.org/en/1",
    "http://example.org/en/", "http://notexample.org/es/", "http://example.org", "http://org/es/", "http://x.com/fr/a", "http://com/de/", "x://y.COM/de/?q",
    "http://x.com:80/de/", "http://é.org/ñ", "http://x.com/de/a#b?c", "http://x.org?y=/es/", "http://" + "a." * 300 + "org/" + "p" * 5000, "a://b://c.org/",
]


@pytest.fixture
def pages(spark):
    pick = random.Random(5)
    urls = URLS + [f"http://{pick.choice(('', 'a.', 'b.a.'))}{pick.choice(('example.org', 'org', 'x.com', 'net'))}/{pick.choice(('es/', 'en/1', 'en/2', 'fr/', 'de/', ''))}"
                   f"{pick.randrange(30)}{pick.choice(('', '?a', '#b'))}" for _ in range(200)]
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")


def check(pages, rules, found):
    rows = {r["id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}
    wanted = {r["page_id"]: brute.url_verdict(r["url"], rules) for r in pages.collect()}
    assert rows == wanted


@pytest.mark.parametrize("limit", [1 << 25, -1])
def test_verdicts(spark, pages, monkeypatch, limit):
    import tidemark.llm.common as common

    monkeypatch.setattr(U, "bounded_broadcast", lambda df, n, width: common.bounded_broadcast(df, n, width, limit))
    check(pages, URL_RULES, U.judge(pages, spark.createDataFrame(URL_RULES, "rule string, action string")))


def test_a_short_hash_is_confirmed_by_the_whole(spark, pages, monkeypatch):
    monkeypatch.setattr(U, "PREFIX", 1)
    check(pages, URL_RULES, U.judge(pages, spark.createDataFrame(URL_RULES, "rule string, action string")))


def test_rows_and_rules_that_repeat(spark, pages):
    rules = URL_RULES + [("org/", "block"), (None, "block"), ("x.com", "block")]
    found = U.judge(pages.union(pages.limit(30)), spark.createDataFrame(rules, "rule string, action string"))
    assert found.count() == pages.count() + 30
    assert {r["verdict"] for r in found.where("rule = 'org/'").collect()} == {"block"}
    assert found.where("rule = 'x.com'").count() > 0
    assert U.judge(pages.limit(0), spark.createDataFrame(URL_RULES, "rule string, action string")).collect() == []
    nothing = U.judge(pages, spark.createDataFrame([], "rule string, action string"))
    assert {r["verdict"] for r in nothing.collect()} == {"allow"} and nothing.count() == pages.count()
