"""URL rules and aliases."""

import pytest
from pyspark.sql import functions as F

from tillcast.llm import url_filter as uf


def verdicts(spark, pages, edges=(), **kw):
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("node", F.lit(1))
    links = spark.createDataFrame(list(edges), "url string, target string")
    return {r.page_id: r for r in uf.judge_urls(frame, links, **kw).collect()}


def test_host_and_path(spark):
    urls = ["HTTP://A.Example.NET/en/X?q#f", "https://x.org", "https://x.org?a/b", "nothing", "", None, "a://b://c/d", "http:///p", "http://é.net/ü"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in frame.select(uf.url_host(F.col("u")), uf.url_path(F.col("u"))).collect()]
    assert got == [("a.example.net", "/en/X"), ("x.org", ""), ("x.org", ""), ("", ""), ("", ""), ("", ""), ("b:", "//c/d"), ("", "/p"), ("é.net", "/ü")]


def test_longest_rule_wins(spark):
    got = verdicts(spark, [(1, "http://a.example.net/en/1"), (2, "http://a.example.net/de/1"), (3, "http://example.com/de/"), (4, "http://myexample.com/de/"),
                           (5, "http://b.org/fr/x"), (6, "http://net/"), (7, "http://net"), (8, None), (8, None), (9, "http://notnet/")])
    assert [(got[i].rule, got[i].verdict) for i in range(1, 10)] == [
        ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"), (None, "allow"), ("org/fr/", "allow"), ("net/", "block"),
        (None, "block"), (None, "allow"), (None, "allow")]  # 7 has no path for a rule to fit, but is another writing of 6


def test_aliases_take_blocks_unless_one_is_allowed(spark):
    pages = [(1, "http://www.a.com/x.html"), (2, "https://a.com/x?utm=1"), (3, "http://c.com/1"), (4, "http://bad.net/1"), (5, "http://d.com/1"),
             (6, "http://q.net/z"), (7, "http://q.org/fr/z"), (8, "http://lone.com/")]
    edges = [("http://a.com/x", "http://c.com/1"), ("http://c.com/1", "http://hop.com/"), ("http://hop.com/", "http://bad.net/1"),
             ("http://d.com/1", "http://q.net/z"), ("http://q.net/z", "http://q.org/fr/z"), ("http://lone.com/", None), (None, "http://bad.net/1")]
    got = {i: r.verdict for i, r in verdicts(spark, pages, edges).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block", 7: "allow", 8: "allow"}


def test_hub_of_aliases_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(uf, "small_enough", lambda *a: False)
    pages = [(i, f"http://h{i}.com/") for i in range(400)] + [(1000, "http://login.net/")]
    got = verdicts(spark, pages, [(u, "http://login.net/") for _, u in pages])
    assert {r.verdict for r in got.values()} == {"block"}


def test_a_source_that_is_no_page_reaches_its_other_writings(spark):
    got = verdicts(spark, [(1, "http://www.a.com/x.html"), (2, "http://b.com/")], [("http://a.com/x", "http://bad.net/")])
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "allow"}


def test_edges_from_pages(spark):
    html = ['<link rel="canonical" href="http://a.net/1">', "<LINK href=/p/2 REL=canonical>", '<meta http-equiv="refresh" content="0; url=//m.b.com/x?a=1&amp;b=2">',
            '<link rel="stylesheet" href="/s.css">', None, ""]
    pages = spark.createDataFrame([(i, "https://h.com/a", x) for i, x in enumerate(html)], "page_id long, url string, html string")
    assert sorted(r.target for r in uf.page_edges(pages).collect()) == ["http://a.net/1", "http://m.b.com/x?a=1&b=2", "https://h.com/p/2"]


def test_whole_and_relative_targets_of_all_links(spark):
    cases = [('<meta http-equiv=refresh content="0; url=/a;v=1/b">', ["https://h.com/a;v=1/b"]),
             ("""<META content="5;URL='x?n=http://o.com/;k'" http-equiv='Refresh'>""", ["https://h.com/d/e/x?n=http://o.com/;k"]),
             ("<meta http-equiv=refresh content=0;url=../p;q>", ["https://h.com/d/p;q"]),
             ("<meta http-equiv=refresh content=0; url=/s;t>", ["https://h.com/s;t"]),
             ('<link rel=canonical href=it\'s><link href="b>c" rel="canonical"/>', ["https://h.com/d/e/b>c", "https://h.com/d/e/it's"]),
             ('<link\nrel="canonical"\ndata-href="/no" href="./y/../../z/.">', ["https://h.com/d/z/"]),
             ('<link rel=canonical href="?a=1"><meta http-equiv="refresh" content="0;url=#top"><link rel=canonical href="../../../u">',
              ["https://h.com/d/e/f.html?a=1", "https://h.com/d/e/f.html?q=/w/#top", "https://h.com/u"]),
             ('<link rel=canonical href="mailto:a@b.c"><meta http-equiv=refresh content="30"><link rel="icon" href="/i">', [])]
    pages = spark.createDataFrame([(f"https://h.com/d/e/f.html?q=/w/#{i}", x) for i, (x, _) in enumerate(cases)], "url string, html string")
    got = [(int(r.url.split("#")[1]), r.target) for r in uf.page_edges(pages).collect()]
    assert sorted(got) == sorted((i, t) for i, (_, want) in enumerate(cases) for t in want)
    bare = spark.createDataFrame([("http://h.com", '<link rel=canonical href="x">'), ("none", '<link rel=canonical href="x">')], "url string, html string")
    assert [r.target for r in uf.page_edges(bare).collect()] == ["http://h.com/x"]


def test_long_and_open_tags(spark):
    html = ["<link " + "a b=c " * 200_000 + "rel=canonical href=/x>", '<meta content="' + "x" * 500_000, '<link rel=canonical href="/a><p>"', "<link <link rel=canonical href=/y>"]
    pages = spark.createDataFrame([(f"http://h.com/{i}", x) for i, x in enumerate(html)], "url string, html string")
    got = {r.url[-1]: r.target for r in uf.page_edges(pages).collect()}
    assert got["0"] == "http://h.com/x"


@pytest.mark.parametrize("rules", [(), uf.DEFAULT_RULES])
def test_nothing(spark, rules):
    assert verdicts(spark, [], rules=rules) == {}
    assert verdicts(spark, [(1, "http://x.net/")], rules=()) [1].verdict == "allow"


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://x.net/", "")], "page_id long, url string, html string")
    plan = uf.judge_urls(pages, uf.page_edges(pages))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
