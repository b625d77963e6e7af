"""URL verdicts: host and path by the letter, longest rule, blocks over aliases."""

import random

import pytest
from conftest_llm import SF, plain_components
from groundsheet.llm import url_rules
from groundsheet.llm.queries import QUERIES, URL_RULES

CASES = {
    "http://Example.ORG/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
    "https://www.example.org/en/17?x#y": ("www.example.org", "/en/17", "example.org/en/1", "block"),
    "https://www.example.org/en/2": ("www.example.org", "/en/2", "org/", "allow"),
    "ftp://a.com/de/": ("a.com", "/de/", "com/de/", "block"), "http://a.com/fr/x": ("a.com", "/fr/x", "com/fr/", "allow"),
    "http://a.com": ("a.com", "", None, "allow"), "http://a.org?x=/es/": ("a.org", "", None, "allow"),
    "http://notexample.orgs/es/": ("notexample.orgs", "/es/", None, "allow"), "no scheme.org/es/": ("", "", None, "allow"),
    None: ("", "", None, "allow"), "": ("", "", None, "allow"), "http://x://y.org/z": ("x:", "//y.org/z", None, "allow"),
    "http://ÀB.Org/é": ("Àb.org", "/é", "org/", "allow"), "http:///only/path": ("", "/only/path", None, "allow"),
    "http://a.org#/es": ("a.org", "", None, "allow"), "://b.org/": ("b.org", "/", "org/", "allow"),
}


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(urls)], "page_id long, url string, key string, root int")


def test_rules_by_the_letter(spark):
    links = spark.createDataFrame([], "url string, target string")
    got = {r.page_id: tuple(r)[1:5] for r in url_rules.judge_urls(pages(spark, CASES), URL_RULES, links).collect()}
    assert [got[k] for k in range(len(CASES))] == list(CASES.values())


def test_no_rules_no_pages(spark):
    links = spark.createDataFrame([("http://a.b/1", None), (None, None)], "url string, target string")
    assert url_rules.judge_urls(pages(spark, ["http://a.b/1"]), [], links).first().verdict == "allow"
    assert url_rules.judge_urls(pages(spark, ["x"]).limit(0), URL_RULES, links).collect() == []


def test_contradiction():
    with pytest.raises(ValueError):
        url_rules.matching_rule(None, None, [("allow", "a/"), ("block", "a/")])


def test_aliases_carry_blocks(spark):
    """Chains, cycles, stars and repeats against a plain search; an allowed name stays allowed."""
    draw = random.Random(5)
    urls = [f"http://{draw.choice(['a.com/de', 'b.net', 'c.org', 'd.com/fr', 'e.net'])}/{k}" for k in range(300)]
    edges = [(draw.choice(urls), draw.choice(urls)) for _ in range(120)] + [(urls[0], u) for u in urls[200:260]]
    edges += [(urls[k], urls[k + 1]) for k in range(100, 130)] + [(urls[1], urls[1]), (urls[2], None)]
    want_edges = [(a, b) for a, b in edges if b]
    top = plain_components(want_edges, urls)
    blocked = {top[u] for u in urls if "a.com/de" in u}
    links = spark.createDataFrame(edges * 2, "url string, target string")
    rows = url_rules.judge_urls(pages(spark, urls + urls[:5]), URL_RULES, links).collect()
    assert len(rows) == 305
    for r in rows:
        url = (urls + urls[:5])[r.page_id]
        if r.rule:
            assert r.verdict == ("block" if "a.com/de" in url else "allow")
        else:
            assert r.verdict == ("block" if top[url] in blocked else "allow"), url


def test_block_of_a_name_that_is_no_page(spark):
    links = spark.createDataFrame([("http://z.net/1", "https://a.com/de/9")], "url string, target string")
    assert url_rules.judge_urls(pages(spark, ["https://z.net/1#top"]), URL_RULES, links).first().verdict == "block"


def test_links_in_html(spark):
    html = (
        '<head><LINK href="http://t.org/1" rel="canonical"><link rel=stylesheet href=http://no.org/>'
        "<meta http-equiv='Refresh' content='0; URL=http://t.org/2'><link rel='canonical' href='/relative'></head>"
    )
    frame = spark.createDataFrame([("http://s.org/", html), ("http://n.org/", None)], "url string, html string")
    assert sorted(r.target for r in url_rules.alias_links(frame).collect()) == ["http://t.org/1", "http://t.org/2"]


def test_whole_table(spark):
    assert QUERIES["op2_url_rules"](spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()
