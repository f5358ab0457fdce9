"""URL filter against plain search, and its rules."""
import re

from oppflow.llm.queries import HOST_RULES
from oppflow.llm.url_filter import HostRule, Vocabulary, automaton, hits, judge_urls


def plain_hits(url, terms):
    return {i for i, t in enumerate(terms) if re.search(rf"(?<![A-Za-z0-9]){re.escape(t)}(?![A-Za-z0-9])", url)}


def test_hits_equal_plain_search():
    terms = ["sex", "bet", "betting", "spam-farm", "farm", "a"]
    for url in ("", "sex", "essex.org", "http://bet.betting.com/a", "x-spam-farm-y", "asex a1 a", "ésexé", "bet/bet/bets"):
        assert hits(url, automaton(terms)) == plain_hits(url, terms)


def judged(spark, urls, rules=HOST_RULES, vocabulary=None):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    return {r.page_id: r for r in judge_urls(df, rules, vocabulary).collect()}


def test_rules_and_verdicts(spark):
    urls = [
        "https://WWW.Example.NET/en/1", "http://a.net/x", "http://a.net", "http://a.network/x", "http://example.com/de/5?x=/fr/", "http://b.example.com/de",
        "http://a.org/fr/#t", "http://a.org/x?u=://b.net/", None, "no scheme/net/", "http://casino.org/fr/1", "http://casino.example.com/1",
        "http://spam-farm.example.com/1", "http://ads.example.com/1", "http://essexxx.example.com/", "", "mailto:x://net/",
    ]
    got = judged(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("www.example.net", "/en/1", "example.net/en/", "allow"), ("a.net", "/x", "net/", "block"), ("a.net", "", None, "allow"), ("a.network", "/x", None, "allow"),
        ("example.com", "/de/5", "example.com/de/", "block"), ("b.example.com", "/de", None, "allow"), ("a.org", "/fr/", "org/fr/", "allow"),
        ("a.org", "/x", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("casino.org", "/fr/1", "org/fr/", "allow"),
        ("casino.example.com", "/1", None, "block"), ("spam-farm.example.com", "/1", None, "block"), ("ads.example.com", "/1", None, "allow"),
        ("essexxx.example.com", "/", None, "allow"), ("", "", None, "allow"), ("net", "/", "net/", "block"),
    ]


def test_longest_rule_and_empty_vocabulary(spark):
    rules = [HostRule("a.com", "/", "block"), HostRule("a.com", "/x/", "allow"), HostRule("b.a.com", "/", "allow")]
    got = judged(spark, ["http://a.com/x/1", "http://a.com/y", "http://c.b.a.com/y", "http://casino.com/"], rules, Vocabulary(strict=(), soft={}))
    assert [got[i].verdict for i in range(4)] == ["allow", "block", "allow", "allow"]


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.net/")], "page_id long, url string")
    assert [r.verdict for r in judge_urls(df, HOST_RULES).collect()] == ["block"] * 3
    assert judge_urls(df.limit(0), HOST_RULES).collect() == []
