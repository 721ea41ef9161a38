"""Main text of pages with every kind of boilerplate around an article."""

from trendloom.llm.html_text import extract_main_text, main_text

ARTICLE = (
    "<article><h1>The  river &amp; the town</h1><p>The river runs through the town of Alden, and every spring "
    "the water rises to the old stone wall by the mill.</p><p>Ok.</p><p>People there keep boats in the yards, "
    "&#8220;just in case&#8221;, and they say the wall has held for <a href='/x'>two hundred</a> years.</p></article>"
)
EXPECTED = (
    "The river & the town\nThe river runs through the town of Alden, and every spring the water rises to the old "
    "stone wall by the mill.\nOk.\nPeople there keep boats in the yards, “just in case”, and they say the "
    "wall has held for two hundred years."
)
BOILERPLATE = (
    "<head><title>T</title><style>p{x:1}</style><script>var t='</p>'; write('<p>no</p>');</script></head>"
    "<header><div>Site name and a long slogan that goes on and on about the news of the day</div></header>"
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>World</a></li></ul></nav>"
    "<div class='ad banner'>Buy the best boots in the whole wide world today for half the price!</div>"
    "<div id='cookie-notice'>We use cookies to make this site better for everyone who reads it each day.</div>"
    "<aside>Most read: a story about a cat that learned to open doors and windows all by itself.</aside>"
)
AFTER = (
    "<section class='comments'><p>Great article, I grew up there and remember the flood of the old days.</p></section>"
    "<form><label>Mail</label><input name='m'><button>Subscribe to the letter now please</button></form>"
    "<ul class='links'><li><a href='/1'>More stories from the valley and the hills</a></li>"
    "<li><a href='/2'>Older stories from the archive of the paper</a></li></ul>"
    "<footer>&copy; The Alden paper &middot; all rights reserved, every one of them, for ever.</footer>"
)


def test_article_without_boilerplate():
    page = f"<!DOCTYPE html><html><body>{BOILERPLATE}{ARTICLE}{AFTER}</body></html>"
    assert main_text(page) == EXPECTED


def test_broken_markup_and_edge_cases():
    broken = "<html><body><nav><li><a>Menu</nav><article><p><b>Lead line that stays with the rest<br><p>" + "Word " * 40
    assert main_text(broken) == "Lead line that stays with the rest\n" + " ".join(["Word"] * 40)
    assert main_text(None) == "" and main_text("") == "" and main_text("<html><script>x</script></html>") == ""
    assert main_text("just text,   no\tmarkup") == "just text, no markup"
    assert main_text("<div hidden>gone</div><p>short</p>") == "short"
    long_page = "<article>" + "<p>" + "long text " * 20000 + "</p>" * 2 + "</article>"
    assert len(main_text(long_page)) == len("long text " * 20000) - 1


def test_query_columns_nulls_and_clashes(spark):
    page = f"<html><body>{BOILERPLATE}{ARTICLE}{AFTER}</body></html>"
    rows = [(1, "http://a/x", page, "clash", 5), (1, "http://a/x", page, "clash", 5), (2, None, None, None, None),
            (None, "u", "", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in extract_main_text(pages).collect()), key=str)
    assert got == sorted([(1, "http://a/x", EXPECTED, len(EXPECTED)), (1, "http://a/x", EXPECTED, len(EXPECTED)),
                          (2, None, "", 0), (None, "u", "", 0)], key=str)
    assert extract_main_text(pages.limit(0)).count() == 0


def test_given_pages_keep_article_only(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for row in extract_main_text(pages).collect():
        assert row.text and "©" not in row.text
