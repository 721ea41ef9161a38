from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row, functions as F

from trendloom import schemas
from trendloom.functions import scores as S
from trendloom.functions import text as X
from trendloom.operators import clean, market, scoring, tables
from trendloom.operators.ordering import keep_first, with_ordinal
from trendloom.sources import articles as article_scans
from trendloom.sources import configs as config_scans
from trendloom.sources import prices

NOW = datetime(2026, 6, 22, 10, 0)
RECORDS = "site string, ingest_seq long, headline string, link string, summary string"


def lit_time(value=NOW):
    return F.lit(value).cast("timestamp")


def test_ordinals_of_sparse_numbers_without_a_window(spark):
    df = spark.range(100_000).select((F.col("id") * 2_147_483_659).alias("seq"), F.lit("x").alias("g"))
    rows = with_ordinal(df, "seq", ["g"])
    assert "Window" not in rows._jdf.queryExecution().toString()
    assert rows.where("ordinal <> seq DIV 2147483659 + 1").isEmpty() and rows.count() == 100_000
    assert with_ordinal(df.limit(0), "seq").count() == 0


def test_ordinals_are_dense_over_cells_and_groups(spark):
    df = spark.range(0, 1000, 7).select((F.col("id") * 1000003).alias("seq"), (F.col("id") % 3).alias("g"))
    rows = with_ordinal(df, "seq", ["g"]).orderBy("g", "seq").collect()
    assert [r.ordinal for r in rows] == list(range(1, len(rows) + 1))


def test_keep_first_on_a_hot_key(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    kept = keep_first(df.orderBy(F.col("id").desc()), ["k"], ["id"])
    assert kept.filter("k = 'hot'").first().id == 0
    assert kept.count() == df.select("k").distinct().count()


def test_first_copy_without_link_removes_later_good_one(spark):
    records = spark.createDataFrame(
        [("a", 1, "Big News!", None, None), ("a", 2, "big news", "/x", None), ("b", 3, "BIG NEWS", "/y", None),
         ("a", 4, None, "/n", None), ("a", 5, "None", "/m", None), ("a", 6, "ÉCOLE – 1", "/e", None)],
        RECORDS,
    )
    assert {r.ingest_seq for r in clean.clean_records(records).collect()} == {3, 6}
    assert {r.ingest_seq for r in clean.clean_records(records, scope="all").collect()} == {6}
    counts = {r.site: (r.before, r.after, r.removed) for r in clean.dedup_counts(records).collect()}
    assert counts == {"a": (5, 3, 2), "b": (1, 1, 0)}


def test_normalised_headline_is_stable_and_keeps_letters(spark):
    texts = ["  Ünder_score  9!", "A\tB ", "...", "L'été — déjà"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("n", X.normalised_headline("t"))
    rows = df.withColumn("again", X.normalised_headline("n")).collect()
    assert [r.n for r in rows] == ["ünder_score  9", "a\tb", "", "lété  déjà"]
    assert all(r.n == r.again for r in rows)


def test_keyword_search_ignores_case_and_wildcards(spark):
    df = spark.createDataFrame(
        [(1, "s", "Stock MARKET up", NOW), (2, "s", "mark_et", NOW), (3, "t", "market 5%", NOW.replace(hour=11))],
        "title_id long, source_id string, title string, date_captured timestamp",
    )
    assert [r.title for r in clean.keyword_search(df).collect()] == ["market 5%", "Stock MARKET up"]
    assert [r.title for r in clean.keyword_preview(df, rows=1).collect()] == ["market 5%"]
    assert [r.title for r in clean.keyword_search(df, "k_e").collect()] == ["mark_et"]


def test_insert_ignores_known_titles_and_repeats(spark):
    stored = spark.createDataFrame([(7, "a", "Known", "/k", None, NOW, 3)], schemas.ARTICLES)
    records = spark.createDataFrame(
        [("a", 1, "New one", "/1", None), ("a", 2, "Known", "/2", None), ("a", 3, "New one", "/3", None),
         ("b", 1, "New one", "/4", None), ("b", 2, "Other", "/5", None), ("b", 3, None, "/6", None)],
        RECORDS,
    )
    once = tables.insert_articles(stored, records, lit_time())
    rows = {r.title: r for r in once.collect()}
    assert {t: (r.title_id, r.source_id, r.link) for t, r in rows.items()} == {
        "Known": (7, "a", "/k"), "New one": (8, "a", "/1"), "Other": (9, "b", "/5"),
    }
    assert rows["Other"].date_captured == NOW and rows["Other"].cluster_id is None
    assert tables.new_articles(once, records, lit_time()).isEmpty()
    empty = spark.createDataFrame([], schemas.ARTICLES)
    assert min(r.title_id for r in tables.insert_articles(empty, records, lit_time()).collect()) == 1


def test_score_changes_only_touch_existing_rows(spark):
    clusters = spark.createDataFrame([(1, "one", 2.0), (2, "two", 1.0), (3, "three", 1.0)], "cluster_id long, main_title string, volume double").withColumn("last_updated", lit_time())
    later = NOW.replace(day=23)
    actions = spark.createDataFrame(
        [(1, 0.5, 0.6, 1.0, later, "UPSERT"), (2, 0.0, 0.0, 1.0, later, "DELETE"), (9, 0.4, 0.4, 1.0, later, "UPSERT")],
        "cluster_id long, calculated_score double, avg_sentiment double, avg_jaccard double, evaluated_at timestamp, action string",
    )
    rows = {r.cluster_id: (r.score, r.last_updated) for r in tables.apply_actions(clusters, actions).collect()}
    assert rows == {1: (0.5, later), 3: (0.0, NOW)}
    two_steps = tables.purge_clusters(tables.update_scores(clusters, actions), actions)
    assert {r.cluster_id: (r.score, r.last_updated) for r in two_steps.collect()} == rows
    articles = spark.createDataFrame([(1, 2), (2, 1)], "title_id long, cluster_id long")
    assert {r.title_id: r.cluster_id for r in tables.unlink_purged(articles, actions).collect()} == {1: None, 2: 1}


def test_config_upsert_replaces_whole_rows(spark):
    stored = spark.createDataFrame([("a", "u1", 1, '{"headline":"h"}'), ("b", "u2", 2, None)], "site_name string, url_template string, pages int, mapping string")
    incoming = spark.createDataFrame([(1, "a", "old", {"headline": "x"}), (2, "a", "new", {"headline": "y"})], "seq long, site_name string, url_template string, mapping map<string,string>")
    rows = {r.site_name: r for r in config_scans.upsert_configs(stored, incoming).collect()}
    assert (rows["a"].url_template, rows["a"].pages, rows["a"].mapping) == ("new", None, '{"headline":"y"}')
    assert rows["b"].pages == 2
    sparse = config_scans.sparse_fields(config_scans.scan_configs(stored)).filter("site_name = 'b'").first()
    assert sparse.fields == {"url_template": "u2", "pages": "2"}


def test_mock_cluster_scores(spark):
    payload = spark.createDataFrame(
        [Row(cluster_id=5501, metrics_payload=[
            Row(db_serial_number=101, headline_text="t", summary_text="bad", raw_metrics=Row(jaccard_similarity=1.0)),
            Row(db_serial_number=102, headline_text="bad", summary_text="", raw_metrics=Row(jaccard_similarity=0.38))])],
    )
    members = scoring.payload_members(payload)
    lexicon = spark.createDataFrame([("bad", -2.5)], schemas.LEXICON)
    history = spark.createDataFrame([(5501, -0.45, datetime(2026, 6, 21, 10))], schemas.HISTORY)
    measures = scoring.topic_measures(members, lexicon).first()
    assert (measures.volume, measures.avg_jaccard) == (2, 0.69)
    assert scoring.topic_cohesion(members).first().avg_jaccard == 0.69
    compound = round(-2.5 / (2.5**2 + 15) ** 0.5, 4)
    assert measures.avg_sentiment == compound == scoring.topic_sentiment(members, lexicon).first().avg_sentiment
    action = scoring.evaluate_topics(members, lexicon, history, lit_time()).first()
    assert action.calculated_score == pytest.approx(round(-0.30000015 + compound * 0.5 * 0.69, 4))
    assert action.action == "UPSERT" and action.evaluated_at == NOW
    fresh = scoring.evaluate_topics(members, lexicon, history.limit(0), lit_time()).first()
    assert fresh.calculated_score == pytest.approx(round(compound * 0.5 * 0.69, 4))


def test_decay_liveness_and_clamp(spark):
    df = spark.createDataFrame([(-0.45, datetime(2026, 6, 21, 10)), (0.9, datetime(2026, 6, 23, 10))], "s double, t timestamp")
    rows = [r.d for r in df.select(S.decayed("s", "t", lit_time()).alias("d")).collect()]
    assert rows[0] == pytest.approx(-0.30000015) and rows[1] == pytest.approx(0.9 / 0.666667)
    values = spark.createDataFrame([(1.4,), (-3.0,), (0.00099,), (0.001,)], "v double")
    rows = values.select(S.clamp_unit("v").alias("c"), S.is_dead("v").alias("d")).collect()
    assert [(r.c, r.d) for r in rows] == [(1.0, False), (-1.0, False), (0.00099, True), (0.001, False)]


def test_history_scan(spark):
    rows = [(1, 0.5, "2026-06-21 10:00:00"), (2, 0.5, "broken"), (3, None, "2026-06-21 10:00:00"), (4, 0.1, None)]
    clusters = spark.createDataFrame(rows, "cluster_id long, score double, last_updated string")
    found = {r.cluster_id: r.last_evaluated_at for r in article_scans.scan_history(clusters, lit_time()).collect()}
    assert found == {1: datetime(2026, 6, 21, 10), 2: NOW}
    assert article_scans.scan_history(clusters.drop("score"), lit_time()).isEmpty()


def test_ranked_topics(spark):
    clusters = spark.createDataFrame(
        [(1, "a", 11, 2.0, 0.2, 0.1, 1.0, NOW), (2, "b", 12, 1.0, -0.7, -0.5, 1.0, NOW), (3, "c", 13, 1.0, None, None, 1.0, NOW),
         (4, "d", 14, 1.0, 0.2, 0.0, 1.0, NOW)],
        "cluster_id long, main_title string, title_id long, volume double, score double, avg_sentiment double, avg_jaccard double, last_updated timestamp",
    )
    articles = spark.createDataFrame([(11, "s"), (12, "t")], "title_id long, summary string")
    rows = sorted(scoring.ranked_topics(clusters, articles).collect())
    assert [(r.rank, r.cluster_id, r.sentiment_label) for r in rows] == [(1, 2, "Negative"), (2, 1, "Positive"), (3, 4, "Neutral")]
    signed = sorted(scoring.ranked_topics(clusters, articles, order="score", limit=2).collect())
    assert [r.cluster_id for r in signed] == [1, 4]


def test_market(spark):
    payload = spark.createDataFrame([('{"NIFTY_50":{"current":23500.5,"prev_close":23400.0},"CRUDE_OIL":{"current":78.2,"prev_close":79.0}}',)], "body string")
    stored = tables.upsert_tickers(spark.createDataFrame([], schemas.TICKERS), prices.scan_tickers(payload), lit_time())
    assert {r.ticker_symbol: r.change_pct for r in market.ticker_changes(stored).collect()} == {"NIFTY_50": 0.43, "CRUDE_OIL": -1.01}
    update = spark.createDataFrame([("CRUDE_OIL", 80.0, 0.0, 1), ("CRUDE_OIL", 81.0, 0.0, 2)], "symbol string, current double, prev_close double, seq long")
    merged = tables.upsert_tickers(stored, update, lit_time(NOW.replace(hour=11)), "seq")
    rows = {r.ticker_symbol: r for r in merged.collect()}
    assert rows["CRUDE_OIL"].current_price == 81.0 and rows["NIFTY_50"].updated_at == NOW
    assert market.ticker_changes(merged).filter("ticker_symbol = 'CRUDE_OIL'").first().change_pct is None
    coins = spark.createDataFrame([('{"bitcoin":{"usd":64123.5,"usd_24h_change":1.005},"solana":{"usd":0.5,"usd_24h_change":0},"ether":{"usd":1000000}}',)], "body string")
    cards = {r.name: (r.trend, r.price, r.change) for r in market.price_cards(prices.scan_prices(coins)).collect()}
    assert cards == {"BITCOIN": ("up", "$64,123.5", "1.00%"), "SOLANA": ("down", "$0.5", "0.00%"), "ETHER": (None, "$1,000,000", None)}


def test_growth(spark):
    plans = spark.createDataFrame([(1, 1000, 12, 3), (2, 500, 0, 2), (3, 10, 5, 0)], "plan_id long, monthly long, rate_pct int, years int")
    rows = {(r.plan_id, r.year): (r.invested, r.interest, r.total) for r in market.growth_schedule(plans).collect()}
    assert rows[1, 3] == (36000, 4859.14, 45351.94)
    assert rows[2, 2] == (12000, 0.0, 12000.0) and len(rows) == 5


def test_similarity_properties(spark):
    words = st.text(alphabet="abé \t", max_size=12)

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(words, words), min_size=20, max_size=40))
    def check(pairs):
        df = spark.createDataFrame(pairs, "a string, b string")
        rows = df.select(
            X.jaccard("a", "b").alias("j"), X.jaccard("b", "a").alias("j2"),
            X.levenshtein_similarity("a", "b").alias("l"), X.levenshtein_similarity("b", "a").alias("l2"),
            "a", "b",
        ).collect()
        for r in rows:
            assert r.j == r.j2 and r.l == r.l2 and 0 <= r.j <= 1 and 0 <= r.l <= 1
            assert r.a != r.b or r.l == 1.0

    check()
