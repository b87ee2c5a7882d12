"""Rules, links and propagation on pages with known answers; the SQL on both."""

import duckdb
import pytest

from tollgate.llm import url_filter as U
from tollgate.llm.url_filter_query import RULES, SQL

CANON = '<html><head><LINK href="{}" rel="canonical"/></head>'
PAGES = [
    (1, "http://A.example.com/de/x?q#f", None, "example.com/de/", "block"),
    (2, "https://b.org/en/1", CANON.format("http://a.example.com/de/x?q"), None, "block"),  # alias of 1
    (3, "https://b.org/en/2", CANON.format("https://B.org/en/1#top"), None, "block"),  # alias of 2
    (4, "https://b.org/fr/2", CANON.format("/en/1"), "org/fr/", "allow"),  # explicit, also for the component
    (5, "https://c.com/x", '<meta http-equiv=refresh content="0; url=//spam.net/q">', None, "block"),  # target is no page
    (6, "https://c.com/x/y", "<link rel='stylesheet' href='//spam.net/q'>", None, "allow"),
    (7, "https://d.com/p/q", CANON.format("r"), None, "allow"),
    (8, "https://d.com/p/r", "", None, "allow"),
    (9, "https://x.example.net/en/a", "", "example.net/en/", "allow"),
    (10, "https://x.example.net", "", None, "allow"),  # empty path: no rule's path starts it
    (11, "https://notexample.net/en/", "", "net/", "block"),
    (12, None, None, None, "allow"),
    (13, "mailto:me", "", None, "allow"),
    (5, "https://c.com/x", None, None, "block"),
    (None, "https://d.com/p/q", None, None, "allow"),
    (14, "x://y?z=://w.net/", CANON.format("mailto:a@b"), None, "allow"),
]
# 4 is an alias of 2: its explicit allow keeps the whole component.
EXPECTED = {2: "allow", 3: "allow"}


@pytest.mark.parametrize("in_place", [256, 0])
def test_pages(spark, in_place, monkeypatch):
    monkeypatch.setattr(U, "IN_PLACE", in_place)
    df = spark.createDataFrame([(i, u, h, "z") for i, u, h, *_ in PAGES], "page_id long, url string, html string, rule string")
    got = U.verdicts(df, RULES).collect()
    want = [(i, rule, EXPECTED.get(i, v)) for i, _, _, rule, v in PAGES]
    assert sorted(((r.page_id, r.rule, r.verdict) for r in got), key=str) == sorted(want, key=str)
    without = U.verdicts(df.filter("page_id <> 4"), RULES).collect()
    assert {r.page_id: r.verdict for r in without if r.page_id in (2, 3)} == {2: "block", 3: "block"}
    assert U.verdicts(df.limit(0), RULES).count() == 0
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", [p[:3] for p in PAGES])
    rel = con.sql(SQL)
    at = [rel.columns.index(c) for c in got[0].__fields__]
    assert sorted((tuple(r[k] for k in at) for r in rel.fetchall()), key=str) == sorted(map(tuple, got), key=str)


def test_redirects_and_hot_target(spark):
    pages = spark.createDataFrame([(i, f"https://s{i}.com/", None) for i in range(50)], "page_id long, url string, html string")
    moves = spark.createDataFrame([(f"https://s{i}.com", "https://hub.com/") for i in range(40)] + [("https://hub.com/", "http://bad.net/a")], "src string, dst string")
    got = {r.page_id: r.verdict for r in U.verdicts(pages, RULES, redirects=moves).collect()}
    assert got == {i: "block" if i < 40 else "allow" for i in range(50)}


@pytest.mark.parametrize("href,want", [
    ("?a=1&amp;b=2", "https://h.com/p/q.html?a=1&b=2"), ("../x", "https://h.com/x"), ("./x/./y/..", "https://h.com/p/x/"), ("../../..", "https://h.com/"),
    ("", "https://h.com/p/q.html?z=1"), ("#top", "https://h.com/p/q.html?z=1"), ("r?y#f", "https://h.com/p/r?y"), ("/a/../b", "https://h.com/b"),
    ("//o.net/a/./b", "https://o.net/a/b"), ("HTTP://o.net/&#x61;", "HTTP://o.net/a"), ("mailto:a@b", None), ("x&quot;y", 'https://h.com/p/x"y'), (" s ", "https://h.com/p/s")])
def test_targets(href, want):
    assert U.resolve("https://h.com/p/q.html?z=1", href) == want


def test_links_as_browsers_read_them(spark):
    pages = [
        (1, "http://spam.net/d/i?a=1&b=2", None, "block"),
        (2, "https://b.org/2", '<link rel="alternate Canonical" title="a > b" href="http://spam.net/d/i?a=1&amp;b=2">', "block"),
        (3, "https://b.org/d/3", "<link href='../2' rel=canonical>", "block"),
        (4, "https://b.org/d/3?page=2", '<link rel="canonical" href="?page=1">', "allow"),
        (5, "https://b.org/d/3?page=1", '<meta content="5; URL=\'3\'" http-equiv="Refresh">', "block"),  # alias of 3, and so is 4
        (6, "https://b.org/6", '<link rel="canonically" href="/2">', "allow"),
    ]
    want = {i: v for i, *_, v in pages} | {4: "block"}
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in U.verdicts(df, RULES).collect()} == want
    long = spark.createDataFrame([(1, "https://b.org/1", "x <p " * 400_000 + '<link rel=canonical href="http://spam.net/">'), (2, "https://b.org/" + "y" * 1_000_000, "")], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in U.verdicts(long, RULES).collect()} == {1: "block", 2: "allow"}
