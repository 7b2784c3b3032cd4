"""Url rules and the fate of aliases."""

import random

import duckdb

from citymart.llm.queries import ORACLES, URL_RULES
from citymart.llm.urls import alias_links, judge_pages

SCHEMA = "page_id long, url string, html string, host string, verdict string, component long"


def link(url):
    return f'<html><head><link rel="canonical" href="{url}"></head>'


PAGES = [
    (1, "http://a.org/x", link("http://b.com/y")),
    (2, "http://b.com/y", None),
    (3, "http://c.com/z", "<META HTTP-EQUIV='refresh' content='0; url=http://b.com/y'>"),
    (4, "http://B.net/q", link("http://d.com/r?x=1")),
    (5, "https://d.com/r?x=1#f", ""),
    (6, None, None),
    (7, "nohost", ""),
    (8, "http://e.com/a", link("/b&amp;c")),
    (9, "http://e.com/b&c", link("//z.net/")),
    (10, "http://n.org/fr/1", link("http://q.net/")),
    (11, "http://w.com/", link("http://n.org/fr/1")),
    (12, "http://EXAMPLE.com/de/?q", None),
    (13, "ftp://u@www.example.net/en/a/#", None),
    (14, "http://example.net/en", None),
    (15, "http://notexample.com/de/", None),
    (16, "a://b://net/", "canonical refresh"),
    (17, "://net/", link("")),
    (18, "http://net?/", link("relative")),
    (19, "http://v.com/", "<link href=http://w.com/ rel=canonical><link rel='icon' href='http://q.net/i'>"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "v", 1) for r in rows], SCHEMA)


def test_rules_and_aliases(spark):
    found = {r.page_id: r for r in judge_pages(frame(spark, PAGES), URL_RULES).collect()}
    assert {i for i, r in found.items() if r.verdict == "block"} == {4, 5, 8, 9, 12, 14, 17}
    assert tuple(found[4]) == (4, "b.net", "/q", "net/", "block")
    assert tuple(found[5]) == (5, "d.com", "/r", None, "block")  # shares the fate of 4
    assert found[11].verdict == found[10].verdict == found[19].verdict == "allow"  # an allowed alias goes first
    assert tuple(found[6])[1:] == tuple(found[7])[1:] == ("", "", None, "allow")
    assert found[13].rule == "example.net/en/" and found[14].rule == "net/" and found[15].rule is None
    assert (found[16].host, found[17].host, found[18].host, found[18].path) == ("b:", "net", "net", "")


def test_equals_its_sql(spark):
    df = frame(spark, PAGES)
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    assert set(map(tuple, judge_pages(df, URL_RULES).collect())) == set(con.execute(ORACLES["op10_urls"]).fetchall())


def test_a_long_chain_and_a_hot_address(spark):
    chain = [(i, f"http://h{i}.com/", link(f"http://h{i + 1}.com/")) for i in range(60)]
    star = [(100 + i, f"http://s{i}.com/", link("http://bad.net/")) for i in range(150)]
    found = judge_pages(frame(spark, [*chain, (99, "http://h60.com/", link("http://bad.net/")), *star]), URL_RULES)
    assert {r.verdict for r in found.collect()} == {"block"} and found.count() == 211


def test_links_can_be_given(spark):
    links = spark.createDataFrame([("a.com/", "q.net/")], "a string, b string")
    pages = frame(spark, [(1, "http://a.com/", None), (2, "http://b.com/", None)])
    assert {tuple(r)[::4] for r in judge_pages(pages, URL_RULES, links).collect()} == {(1, "block"), (2, "allow")}


def test_odd_rows_and_empty_table(spark):
    long = "x" * 300_000 + link("http://q.net/")
    rows = [(None, "http://a.com/", long), (3, "http://a.com/", None), (3, "http://a.com/", None)]
    found = judge_pages(frame(spark, rows), URL_RULES).collect()
    assert len(found) == 3 and {r.verdict for r in found} == {"block"}
    assert judge_pages(frame(spark, []), URL_RULES).collect() == []
    assert judge_pages(frame(spark, PAGES), []).filter("verdict = 'block' or rule is not null").count() == 0


def refresh(target, quote='"'):
    return f"<meta http-equiv=refresh content={quote}0; url={target}{quote}>"


def test_targets_are_read_whole_and_resolved(spark):
    bad = [
        ("http://b.net/y?a=1&b=2", "http://a1.com/", refresh("http://b.net/y?a=1&amp;b=2")),
        ("http://b.net/y;jsessionid=3", "http://a2.com/", refresh("http://b.net/y;jsessionid=3")),
        ("http://a3.com/d/page2.html", "http://a3.com/d/page.html", refresh("page2.html")),
        ("http://a4.com/x?q", "http://a4.com/d/e.html?z", link("../x?q")),
        ("http://a5.com/d/e?a=1", "http://a5.com/d/e", refresh("?a=1")),
        ("http://a6.com/d/", "http://a6.com/d/e/f", refresh("./../#top")),
        ("http://a7.com", "http://a7.com/d", link("http://a7.com/")),
        ("http://a8.com/", "http://a8.com/d", link("HTTP://A8.com")),
        ("http://a9.com?q", "http://a9.com/d", link("/?q")),
        ("http://a10.com/b", "http://a10.com/a", refresh("/c/./../b")),
    ]
    # each page's target is another page, which calls a blocked address canonical
    pages = [(2 * i, page, html) for i, (_, page, html) in enumerate(bad)]
    pages += [(2 * i + 1, target, link("http://q.net/")) for i, (target, _, _) in enumerate(bad)]
    pages += [(100, "http://z.com/d/e", link("mailto:x@a1.com")), (101, "http://z.com/y", refresh("http://b.net/"))]
    pages += [(102, "http://z.com/x", refresh("http://bad.net"))]
    found = {r.page_id: r.verdict for r in judge_pages(frame(spark, pages), URL_RULES).collect()}
    assert {i for i, v in found.items() if v == "allow"} == {100}
    edges = {(r.a, r.b) for r in alias_links(frame(spark, pages)).collect()}
    assert {b for a, b in edges if a == "a1.com/"} == {"b.net/y?a=1&b=2"}
    assert ("a4.com/d/e.html?z", "a4.com/x?q") in edges and ("a6.com/d/e/f", "a6.com/d/") in edges


def test_given_links_without_a_path(spark):
    links = spark.createDataFrame([("a.com", "q.net")], "a string, b string")
    assert judge_pages(frame(spark, [(1, "http://a.com/", None)]), URL_RULES, links).first().verdict == "block"


def linked_pages(n=1500, seed=6):
    """Pages of a few sites that link to each other in every way, some to blocked or allowed hosts."""
    rng = random.Random(seed)
    hosts = ["a.com", "b.com", "C.com", "d.com:80"]
    targets = ["b.html", "../x", "?q=1", "./", "../../y;s=1", "/r/./s/../t", "//b.com", "#top", "mailto:a@b.com", ".", "..", "z?u=http://q.net/"]
    rows = []
    for i in range(n):
        url = f"http://{rng.choice(hosts)}/{rng.choice(['', 'd/', 'd/e/'])}p{rng.randrange(n)}{rng.choice(['', '?k=1&l=2', '#f'])}"
        to = rng.choice([*targets, f"http://{rng.choice(hosts)}/p{rng.randrange(n)}?a=1&amp;b=2", f"/d/p{rng.randrange(n)}"])
        if rng.random() < 0.02:
            to = rng.choice(["http://bad.net/x", "http://ok.org/fr/1", "HTTP://EXAMPLE.com/de/"])
        html = rng.choice([link(to), refresh(to), refresh(to, "'"), None, "no link"])
        rows.append((i, rng.choice([url] * 9 + [f"http://{hosts[0]}"]), html))
    return rows + PAGES_WITH_DOTS


PAGES_WITH_DOTS = [(9001, "http://ok.com/dir/a.html", link("b.html")), (9002, "http://ok.com/dir/b.html", refresh("http://bad.net/"))]


def test_many_links_equal_the_sql(spark):
    df = frame(spark, linked_pages())
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    found = sorted(map(tuple, judge_pages(df, URL_RULES).collect()), key=str)
    assert found == sorted(con.execute(ORACLES["op10_urls"]).fetchall(), key=str)
    verdicts = {r[0]: r[4] for r in found}
    assert verdicts[9001] == verdicts[9002] == "block" and 100 < sum(v == "block" for v in verdicts.values()) < len(found) - 100
