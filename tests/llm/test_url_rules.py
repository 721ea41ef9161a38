"""Rule list by hand; mined rules against counting all token combinations."""

from itertools import combinations

from pyspark.sql import functions as F

from trendloom.llm.url_rules import mine_rules, matched_urls, url_tokens, url_verdicts

PAGES = "page_id long, url string, host string, verdict string"
LABELS = "doc_id long, quality int, toxic int, url string"


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "h", "v") for k, u in enumerate(urls)], PAGES)


def test_listed_rules(spark):
    cases = [
        ("http://a.net/x", "a.net", "/x", "net/", "block"),
        ("HTTP://WWW.Example.NET/en/1?q#f", "www.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
        ("http://net/", "net", "/", "net/", "block"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("http://a.net?x=/", "a.net", "", None, "allow"),
        ("http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("http://x.org/fr/?a", "x.org", "/fr/", "org/fr/", "allow"),
        ("http://x.org/fr", "x.org", "/fr", None, "allow"),
        ("no scheme.net/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("a://b.net/c://d.org/fr/", "b.net", "/c://d.org/fr/", "net/", "block"),
        ("http://É.NET/\nx", "É.net", "/\nx", "net/", "block"), ("://", "", "", None, "allow"),
    ]
    none = spark.createDataFrame([], LABELS)
    rows = url_verdicts(pages(spark, [c[0] for c in cases] * 2), none).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [c[1:] for c in cases] * 2
    assert url_verdicts(pages(spark, []), none).count() == 0


def by_counting(rows, least, confidence, most=3):
    seen, bad_of = {}, {}
    for tokens, bad in rows:
        for k in range(1, most + 1):
            for part in combinations(sorted(tokens), k):
                seen[part] = seen.get(part, 0) + 1
                bad_of[part] = bad_of.get(part, 0) + bad
    rules = {p: bad_of[p] / n for p, n in seen.items() if bad_of[p] >= least and bad_of[p] / n >= confidence}
    return {p for p, c in rules.items() if not any(set(q) < set(p) and rules[q] >= c for q in rules)}


def test_mined_rules_like_counting(spark):
    urls = [f"http://h{k % 3}.site{k % 5}.com/{'buy' if k % 7 == 0 else 'read'}/p{k % 4}?ref=1" for k in range(120)]
    bad = [k % 7 == 0 and k % 4 < 2 or k % 15 == 0 for k in range(120)]
    table = pages(spark, urls).select("page_id", url_tokens(F.col("url")).alias("tokens")).orderBy("page_id").collect()
    labelled = spark.createDataFrame([(r.tokens, b) for r, b in zip(table, bad)], "tokens array<string>, bad boolean")
    rules = mine_rules(labelled, min_support=0.01, min_count=4, min_confidence=0.7)
    got = {tuple(r.rule_tokens) for r in rules.collect()}
    want = by_counting([(r.tokens, b) for r, b in zip(table, bad)], 4, 0.7)
    assert got == want and got
    hit = {r.url for r in matched_urls(pages(spark, urls), rules).collect()}
    assert hit == {u for u, r in zip(urls, table) if any(set(w) <= set(r.tokens) for w in want)}


def test_labels_lead_to_verdicts(spark):
    urls = [f"http://shop{k % 2}.example.com/p/{k}" for k in range(60)] + ["http://shop1.example.com/new/q"]
    labels = spark.createDataFrame([(k, 1 - k % 2, None, "x") for k in range(60)] + [(3, 1, 0, "x"), (None, 0, 0, "x")], LABELS)
    verdicts = {r.page_id: (r.verdict, r.rule) for r in url_verdicts(pages(spark, urls), labels).collect()}
    assert all(verdicts[k] == ("block" if k % 2 else "allow", None) for k in range(60)) and verdicts[60] == ("block", None)


def test_rules_of_four_tokens_and_small_hosts_in_a_large_table(spark):
    four = [({"h0:com", "h1:a", "p:x", "q:s"} - ({drop} if drop else set()), drop is None)
            for drop in (None, "h0:com", "h1:a", "p:x", "q:s") for _ in range(8)]
    rows = [(sorted(t), b) for t, b in four] + [(["h0:org", f"h1:good{k % 7}", f"p:{k % 5}"], False) for k in range(4000)]
    rows += [(["h0:org", "h1:evil", f"p:{k % 5}"], True) for k in range(6)]  # 0.15 % of the labels
    labelled = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    got = {tuple(r.rule_tokens): r.confidence for r in mine_rules(labelled).collect()}
    assert got == {("h0:com", "h1:a", "p:x", "q:s"): 1.0, ("h1:evil",): 1.0}


def test_many_equal_tokens_stay_few_rules(spark):
    rows = [([f"p:{k:02d}" for k in range(30)], True)] * 9 + [(["p:x"], False)] * 9
    rules = mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    assert sorted(tuple(r.rule_tokens) for r in rules) == [(f"p:{k:02d}",) for k in range(30)]
