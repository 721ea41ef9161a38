import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom import schemas
from trendloom.plans import jobs
from trendloom.sources.pages import stream_pages
from trendloom.sources.store import TableStore
from trendloom.streaming import jobs as streams

NOW = datetime(2026, 6, 22, 10)


def at(batch_id):
    return F.timestamp_seconds(F.lit(1782122400 + batch_id * 300))


def page(*names):
    items = [{"name": n, "url": f"/{n}", "description": f"about {n}"} for n in names]
    return f'<script type="j">{json.dumps({"@type": "L", "items": items})}</script>'


@pytest.fixture
def configs(spark):
    row = ("s", "https://s/{}", 2, "json_script", "j", "L", "items",
           {"headline": "name", "link": "url", "summary": "description"}, *[None] * 6)
    return spark.createDataFrame([row], schemas.SOURCES)


def test_a_repeated_run_replaces_its_own_rows_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    links = spark.createDataFrame([(1, 7)], schemas.LINKS)
    assert store.read("t", schemas.LINKS).isEmpty()
    store.write("t", links, "a")
    store.write("t", links.withColumn("title_id", F.lit(2).cast("long")), "b")
    store.write("t", links.withColumn("title_id", F.lit(3).cast("long")), "b")
    assert sorted((r.title_id, r.run) for r in store.read("t", schemas.LINKS).collect()) == [(1, "a"), (3, "b")]
    assert [r.title_id for r in store.read("t", schemas.LINKS, "b").collect()] == [1]
    broken = links.withColumn("title_id", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        store.write("t", broken, "c")
    assert store.read("t", schemas.LINKS).count() == 2


def test_ticker_stream_keeps_latest_and_skips_nothing(spark, tmp_path):
    landing = tmp_path / "landing"
    store = TableStore(spark, str(tmp_path / "store"))
    schema = "seq long, body string"

    def land(seq, **values):
        body = json.dumps({k: {"current": v, "prev_close": 10.0} for k, v in values.items()})
        spark.createDataFrame([(seq, body)], schema).coalesce(1).write.mode("append").parquet(str(landing))

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(str(landing))
        streams.stream_tickers(stream, store, str(tmp_path / checkpoint), at).awaitTermination()
        return {r.ticker_symbol: r.current_price for r in jobs.current_tickers(store).collect()}

    land(1, A=11.0)
    assert run("c") == {"A": 11.0}
    # A new checkpoint begins at batch 0 again; what is new must not be taken for a replay.
    land(2, A=13.0, B=5.0)
    assert run("other") == {"A": 13.0, "B": 5.0}
    assert run("c") == {"A": 13.0, "B": 5.0}
    rows = store.read(jobs.TICKS, schemas.TICKS).count()
    assert run("c") == {"A": 13.0, "B": 5.0} and store.read(jobs.TICKS, schemas.TICKS).count() == rows


def test_a_failed_round_is_started_again(spark, tmp_path):
    landing, tried = str(tmp_path / "landing"), []
    spark.createDataFrame([(1,)], "n long").write.parquet(landing)

    def step(batch, run, number):
        tried.append(run)
        if len(tried) == 1:
            raise ValueError("this round fails")

    def start():
        return streams.run_stream(spark.readStream.schema("n long").parquet(landing), "again", step, str(tmp_path / "c"))

    streams.keep_running(start, pause=0.0, attempts=3)
    assert len(tried) == 2 and tried[0] == tried[1]


def test_articles_that_arrive_during_clustering_stay(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))

    def add(title_id, title):
        row = [(title_id, "s", title, "/1", None, NOW)]
        store.write(jobs.ARTICLES, spark.createDataFrame(row, schemas.ARTICLE_ROWS), f"in-{title_id}")

    add(1, "alpha beta")
    real = jobs.clustering.cluster_articles

    def slow(articles, **options):
        found = real(articles, **options)
        add(2, "gamma delta")
        return found

    monkeypatch.setattr(jobs.clustering, "cluster_articles", slow)
    assert jobs.cluster_open_articles(store) == 1
    assert {r.title_id: r.cluster_id for r in jobs.all_articles(store).collect()} == {1: 1, 2: None}
    monkeypatch.setattr(jobs.clustering, "cluster_articles", real)
    assert jobs.cluster_open_articles(store) == 1
    assert {r.title_id: r.cluster_id for r in jobs.all_articles(store).collect()} == {1: 1, 2: 2}


def test_only_new_texts_are_scored(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], schemas.LEXICON)
    seen, real = [], jobs.scoring.member_sentiment

    def counted(members, words):
        seen.append(sorted(r.title_id for r in members.collect()))
        return real(members, words)

    monkeypatch.setattr(jobs.scoring, "member_sentiment", counted)
    scores = []
    for number, text in enumerate(("good alpha", "bad beta"), start=1):
        rows = [(number, "s", text, "/", None, NOW)]
        store.write(jobs.ARTICLES, spark.createDataFrame(rows, schemas.ARTICLE_ROWS), f"in-{number}")
        jobs.cluster_open_articles(store)
        scores.append({r.cluster_id: r.calculated_score for r in jobs.rescore_topics(store, lexicon, at(0), batch=number).collect()})
    assert seen == [[1], [2]]
    assert set(scores[0]) == {1} and set(scores[1]) == {1, 2} and scores[1][1] > scores[0][1] > 0 > scores[1][2]


def test_article_and_topic_streams(spark, tmp_path, configs):
    landing, store = tmp_path / "pages", TableStore(spark, str(tmp_path / "store"))
    lexicon = spark.createDataFrame([("rate", 2.0), ("storm", -2.0)], schemas.LEXICON)

    def land(number, *names):
        spark.createDataFrame([("s", number, page(*names))], schemas.PAGES).coalesce(1).write.mode("append").parquet(str(landing))

    def ingest():
        streams.stream_pages_to_articles(
            stream_pages(spark, str(landing)), configs, store, str(tmp_path / "c1"), at
        ).awaitTermination()
        return {r.title: r.title_id for r in jobs.all_articles(store).collect()}

    def trends():
        stream = stream_pages(spark, str(landing)).select("page_num")
        streams.stream_topics(stream, lexicon, store, str(tmp_path / "c2"), at).awaitTermination()
        return {r.main_title: r for r in jobs.current_clusters(store).collect()}

    land(1, "central rate news", "central rate views", "winter storm")
    assert ingest() == {"central rate news": 1, "central rate views": 2, "winter storm": 3}
    topics = trends()
    assert set(topics) == {"central rate news", "winter storm"}
    assert topics["central rate news"].volume == 2.0 and topics["central rate news"].score > 0 > topics["winter storm"].score
    assert jobs.open_articles(store).isEmpty()
    first_score = topics["central rate news"].score
    land(2, "central rate news", "summer heat")
    assert ingest()["summer heat"] == 4
    topics = trends()
    # No words of the lexicon: the new topic is dead at once; the older one is compounded.
    assert set(topics) == {"central rate news", "winter storm"}
    assert topics["central rate news"].score > first_score
    linked = {r.title_id: r.cluster_id for r in jobs.all_articles(store).collect()}
    assert linked[1] == linked[2] != linked[3] and linked[4] is not None


def test_full_mode_appends_topics_and_relinks(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = [(1, "s", "alpha beta", "/1", "gamma", NOW), (2, "s", "alpha beta gamma", "/2", None, NOW)]
    store.write(jobs.ARTICLES, spark.createDataFrame(rows, schemas.ARTICLE_ROWS), "in")
    assert jobs.cluster_open_articles(store) == 1
    assert jobs.cluster_open_articles(store) == 0
    assert jobs.cluster_open_articles(store, full=True) == 1
    assert {r.cluster_id for r in jobs.all_articles(store).collect()} == {2}
    lexicon = spark.createDataFrame([("alpha", 2.0)], schemas.LEXICON)
    stored = {r.cluster_id: r for r in jobs.rescore_topics(store, lexicon, at(0), jaccard="stored").collect()}
    assert stored[2].avg_jaccard == pytest.approx((1 + round(2 / 3, 2)) / 2)
