import json

from pyspark.sql import Row

from trendloom import schemas
from trendloom.functions.dom import parse_page
from trendloom.operators import extract
from trendloom.sources import configs as config_scans
from trendloom.sources import pages as page_scans

JSON_SITE = Row("news", "https://news.example/{}", 1, "json_script", "application/ld+json", "ItemList",
                "itemListElement", {"headline": "name", "link": "url", "summary": "description"},
                None, None, None, None, None, None)


def dom_site(name, position="parent", tag="li", cls="clearfix", headline="h2"):
    return Row(name, "https://dom.example/{}", 1, "html_dom", None, None, None, None, tag, cls, headline, position,
               "p", "date")


def script(body, kind="application/ld+json"):
    text = body if isinstance(body, str) else json.dumps(body)
    return f'<script type="{kind}">{text}</script>'


def run(spark, site, *htmls):
    configs = spark.createDataFrame([site], schemas.SOURCES)
    pages = spark.createDataFrame([(site[0], k, h) for k, h in enumerate(htmls, 1)], schemas.PAGES)
    found = extract.extract_records(pages, configs).orderBy("page_num", "pos").collect()
    return [(r.page_num, r.headline, r.link, r.summary) for r in found]


def test_json_script_cases(spark):
    good = {"name": "A", "url": "/a", "description": "first"}
    items = lambda *e, kind="ItemList": {"@type": kind, "itemListElement": list(e)}
    found = run(
        spark, JSON_SITE,
        script(items(good, {"name": "B"})),                       # 1: missing keys become null
        script("{broken") + script(items(good)),                  # 2: invalid JSON is skipped
        script([items(good)]),                                    # 3: a top-level array does not count
        script(items(good, kind="Other")),                        # 4: other type
        script({"@type": "ItemList"}),                            # 5: no array
        script(items(good, {"name": "B"}, "text", good)),         # 6: rows before a non-object stay
        script(items(good), kind="text/json") + "<script></script>",  # 7: other script type
        "<!-- " + script(items(good)) + " -->",                   # 8: inside a comment
        script(items(good)) + script(items({"name": "C"})),       # 9: two lists, in order
        script({"@type": ["ItemList"], "itemListElement": [good]}),  # 10: the type is not equal
        script({"@type": "ItemList", "itemListElement": {"a": good}}),  # 11: not a list
    )
    assert found == [
        (1, "A", "/a", "first"), (1, "B", None, None), (2, "A", "/a", "first"),
        (6, "A", "/a", "first"), (6, "B", None, None),
        (9, "A", "/a", "first"), (9, "C", None, None),
    ]


def test_anchor_positions(spark):
    page = '<li class="x clearfix"><a href="/p"><h2>Big <b>news</b> <a href="/c">now</a></h2></a><p>s<i>um</i></p></li>'
    assert run(spark, dom_site("s"), page) == [(1, "Bignewsnow", "/p", "sum")]
    assert run(spark, dom_site("s", "child"), page) == [(1, "Bignewsnow", "/c", "sum")]
    assert run(spark, dom_site("s", None), page) == [(1, "Bignewsnow", "/c", "sum")]
    assert run(spark, dom_site("s", "self"), page) == []
    assert run(spark, dom_site("s", "self", headline="a"), page) == [(1, "Bignewsnow", "/p", "sum")]


def test_dom_cases(spark):
    found = run(
        spark, dom_site("s", "child"),
        '<li class="clearfix"><h2>no anchor</h2></li>',
        '<li class="clearfix"><h2><a href="/e"></a></h2></li>',
        '<li class="clearfix"><h2><a>no address</a></h2></li>',
        '<li class="clearfix"><li class="clearfix"><h2><a href="/n">nested</a></h2></li></li>',
        '<li class="clearfixed"><h2><a href="/o">other class</a></h2></li>',
        '<li class="clearfix"><h2><a href="/q?a=1&amp;b=2">T &amp; T<script>var x</script><br>x</a></h2><p>open<p>more</li>',
    )
    assert found == [
        (3, "no address", None, None), (4, "nested", "/n", None), (4, "nested", "/n", None),
        (6, "T & Tx", "/q?a=1&b=2", "openmore"),
    ]


def test_tree_keeps_comment_gap_and_ignores_stray_end_tags():
    root = parse_page("<div>a <!-- c --> b</span></div><p>after</p>")
    assert root.first("div").text() == "ab"
    assert root.first("p").parent is root


def test_fallback_reads_browser_capture_only_for_empty_sites(spark):
    block = '<li class="clearfix"><h2><a href="/{0}">{0}</a></h2></li>'
    attempts = spark.createDataFrame(
        [("a", 1, 1, block.format("static")), ("a", 1, 3, block.format("browser")),
         ("b", 1, 1, "<html></html>"), ("b", 1, 3, block.format("browser")),
         ("c", 1, 1, "<html></html>"), ("c", 1, 3, "Access Denied" + block.format("refused"))],
        schemas.ATTEMPTS,
    )
    configs = spark.createDataFrame([dom_site(n, "child") for n in "abc"], schemas.SOURCES)
    found = extract.extract_with_fallback(
        page_scans.resolve_attempts(attempts), page_scans.browser_pages(attempts), configs
    )
    assert {(r.site, r.headline) for r in found.collect()} == {("a", "static"), ("b", "browser")}


def test_attempt_resolution(spark):
    attempts = spark.createDataFrame(
        [("s", 1, 1, ""), ("s", 1, 2, "two"), ("s", 2, 1, "Access Denied is fine here"), ("s", 2, 2, "x"),
         ("s", 3, 1, None), ("s", 3, 3, "Access Denied"), ("s", 4, 3, "three"), ("s", 5, 2, None)],
        schemas.ATTEMPTS,
    )
    rows = {r.page_num: (r.tier, r.html) for r in page_scans.resolve_attempts(attempts).collect()}
    assert rows == {1: (2, "two"), 2: (1, "Access Denied is fine here"), 4: (3, "three")}


def test_frontier_and_missing_pages(spark):
    rows = [Row(*(("s", "https://s/{}", n) + tuple([None] * 11))) for n in (3,)]
    rows += [Row(*(("none", "https://n/{}", 0) + tuple([None] * 11))), Row(*(("wide", "w{}", 70000) + tuple([None] * 11)))]
    frontier = config_scans.url_frontier(spark.createDataFrame(rows, schemas.SOURCES))
    assert [r.url for r in frontier.filter("site = 's'").orderBy("page_num").collect()] == ["https://s/1", "https://s/2", "https://s/3"]
    wide = frontier.filter("site = 'wide'")
    assert wide.count() == wide.select("page_num").distinct().count() == 70000
    assert frontier.filter("site = 'none'").isEmpty()
    captured = spark.createDataFrame([("s", 2)], "site string, page_num int")
    left = page_scans.missing_pages(frontier.filter("site = 's'"), captured)
    assert sorted(r.page_num for r in left.collect()) == [1, 3]


def test_reject_reasons(spark):
    lacking = Row("x", "https://x/{}", 1, "json_script", "t", "s", "k", {"headline": "h"}, *[None] * 6)
    configs = spark.createDataFrame([JSON_SITE, dom_site("d"), lacking], schemas.SOURCES)
    reasons = {r.site_name: r.reject_reason for r in config_scans.with_reject_reason(configs).collect()}
    assert reasons == {"news": None, "d": None, "x": "missing mapping.link"}
