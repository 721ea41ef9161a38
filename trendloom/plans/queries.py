"""Every operator as a named query over a folder of input tables.

Keys start with the operator's id. Times leave as text and nested values as flat columns or JSON, so
that results can be compared with plain SQL.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendloom import schemas
from trendloom.functions import scores as S
from trendloom.functions import text as X
from trendloom.operators import clean, clustering, extract, market, scoring, similarity, tables
from trendloom.operators.scratch import Scratch
from trendloom.operators.sentiment import compound_sentiment
from trendloom.plans import jobs
from trendloom.session import ensure_checkpoint_dir
from trendloom.sources import articles as article_scans
from trendloom.sources import configs as config_scans
from trendloom.sources import pages as page_scans
from trendloom.sources import prices
from trendloom.sources import samples
from trendloom.sources.samples import as_of, time_text
from trendloom.sources.store import TableStore
from trendloom.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def scratch_store(spark: SparkSession) -> TableStore:
    """A store in a new folder below the shared checkpoint folder."""
    return TableStore(spark, f"{ensure_checkpoint_dir(spark)}/store-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- sources and scans


@query
def s1_source_configs(spark, sf_dir):
    configs = config_scans.scan_configs(samples.source_table(spark, sf_dir))
    checked = config_scans.with_reject_reason(configs)
    sparse = config_scans.sparse_fields(configs).select("site_name", F.size("fields").alias("set_fields"))
    return checked.join(sparse, "site_name").select(
        "site_name", "url_template", "pages", "strategy", "anchor_position",
        F.element_at("mapping", "headline").alias("headline_key"),
        F.element_at("mapping", "link").alias("link_key"),
        "set_fields", "reject_reason",
    )


@query
def s2_url_frontier(spark, sf_dir):
    return config_scans.url_frontier(config_scans.scan_configs(samples.source_table(spark, sf_dir)))


@query
def s3_captured_pages(spark, sf_dir):
    return samples.pages(spark, sf_dir).select(
        "site", "page_num", F.length("html").alias("chars"), F.md5("html").alias("digest")
    )


@query
def s4_attempt_resolution(spark, sf_dir):
    resolved = page_scans.resolve_attempts(samples.attempts(spark, sf_dir))
    return resolved.select("site", "page_num", "tier", F.md5("html").alias("digest"))


@query
def s5_articles_full(spark, sf_dir):
    scanned = article_scans.scan_articles(samples.topics(spark, sf_dir), only_unassigned=False)
    return scanned.select("title_id", "title", "summary", time_text("published_at"))


@query
def s6_articles_unassigned(spark, sf_dir):
    half = samples.articles(spark, sf_dir).withColumn(
        "cluster_id", F.when(F.col("title_id") % 4 != 0, F.col("title_id") % 50)
    )
    return article_scans.scan_articles(half).select("title_id", "title", "summary", time_text("published_at"))


@query
def s7_history(spark, sf_dir):
    history = article_scans.scan_history(samples.clusters(spark, sf_dir), as_of())
    return history.select("cluster_id", "score", time_text("last_evaluated_at"))


@query
def s8_price_scan(spark, sf_dir):
    return prices.scan_prices(samples.price_payloads(spark, sf_dir), keep=("event_id",))


@query
def s9_ticker_scan(spark, sf_dir):
    payloads = samples.ticker_payloads(samples.table(spark, sf_dir, "events"))
    return prices.scan_tickers(payloads, keep=("seq",))


# ---------------------------------------------------------------- extraction


@query
def x1_json_script(spark, sf_dir):
    configs = samples.page_configs(spark, sf_dir).withColumn("strategy", F.lit("json_script"))
    return extract.json_script_records(samples.script_pages(spark, sf_dir), configs)


@query
def x2_html_dom(spark, sf_dir):
    configs = samples.page_configs(spark, sf_dir).withColumn("strategy", F.lit("html_dom"))
    return extract.html_dom_records(samples.pages(spark, sf_dir).drop("url"), configs)


@query
def x3_anchor_position(spark, sf_dir):
    base = samples.page_configs(spark, sf_dir).withColumns(
        {"strategy": F.lit("html_dom"), "container_tag": F.lit("div"), "container_class": F.lit("card"),
         "headline_tag": F.lit("h2")}
    )
    found = [
        extract.html_dom_records(
            samples.card_pages(spark, sf_dir), base.withColumn("anchor_position", F.lit(mode).cast("string"))
        ).withColumn("mode", F.lit(mode or "default"))
        for mode in ("child", "parent", None)
    ]
    return functools.reduce(DataFrame.unionByName, found)


@query
def x4_strategy_routing(spark, sf_dir):
    return extract.extract_records(samples.script_pages(spark, sf_dir), samples.page_configs(spark, sf_dir))


@query
def x5_zero_yield_fallback(spark, sf_dir):
    """The static capture of every second site is blank, so these come from the browser capture."""
    full = samples.script_pages(spark, sf_dir)
    blank = F.when(F.length("site") % 2 == 0, F.lit("<html></html>")).otherwise(F.col("html"))
    configs = samples.page_configs(spark, sf_dir)
    return extract.extract_with_fallback(full.withColumn("html", blank), full, configs)


# ---------------------------------------------------------------- cleaning


@query
def c1_normalised_headline(spark, sf_dir):
    return samples.records(spark, sf_dir).select("ingest_seq", X.normalised_headline("headline").alias("norm"))


@query
def c2_first_headlines(spark, sf_dir):
    return clean.first_headlines(samples.records(spark, sf_dir)).select("site", "norm", "ingest_seq", "link")


@query
def c2_first_headlines_all_sites(spark, sf_dir):
    first = clean.first_headlines(samples.records(spark, sf_dir), scope="all")
    return first.select("site", "norm", "ingest_seq", "link")


@query
def c3_dedup_counts(spark, sf_dir):
    return clean.dedup_counts(samples.records(spark, sf_dir))


@query
def c4_drop_incomplete(spark, sf_dir):
    return clean.clean_records(samples.records(spark, sf_dir))


@query
def c5_keyword_search(spark, sf_dir):
    return clean.keyword_search(samples.articles(spark, sf_dir), "then")


@query
def c6_keyword_preview(spark, sf_dir):
    return clean.keyword_preview(samples.articles(spark, sf_dir), "then")


@query
def c7_headline_noise(spark, sf_dir):
    number = F.col("title_id")
    title = (
        F.when(number % 5 == 0, F.concat(F.lit("chart of the day | "), "title"))
        .when(number % 5 == 1, F.concat(F.lit("Data Story: "), "title", F.lit(" : REPORT")))
        .when(number % 5 == 2, F.concat("title", F.lit(" - Times of India")))
        .when(number % 5 == 3, F.lit(None))
        .otherwise(F.col("title"))
    )
    return samples.articles(spark, sf_dir).select("title_id", X.strip_headline_noise(title).alias("stripped"))


# ---------------------------------------------------------------- sinks and table maintenance


@query
def k1_config_upsert(spark, sf_dir):
    stored = samples.source_table(spark, sf_dir)
    number = F.regexp_extract("site_name", r"(\d+)$", 1).cast("int")
    versions = stored.filter(number % 2 == 0).withColumn("seq", F.explode(F.sequence(F.lit(1), F.lit(2))))
    incoming = versions.select(
        "seq", "site_name", "url_template", (F.col("pages") + F.col("seq").cast("int")).alias("pages"),
        "strategy", F.create_map(F.lit("headline"), F.concat(F.lit("title"), F.col("seq"))).alias("mapping"),
        F.lit("en").alias("edition"),
    )
    return config_scans.upsert_configs(stored, incoming).select(
        "site_name", "url_template", "pages", "strategy", "mapping", "script_type", "container_tag", "edition"
    )


@query
def k2_insert_articles(spark, sf_dir):
    stored = samples.stored_articles(spark, sf_dir)
    merged = tables.insert_articles(stored, samples.records(spark, sf_dir), as_of())
    return merged.select("title_id", "source_id", "title", "link", time_text("date_captured"), "cluster_id")


def _appended(spark, sf_dir):
    averages = clustering.cluster_averages(_measured(spark, sf_dir))
    return tables.new_clusters(samples.clusters(spark, sf_dir), averages)


@query
def k3_cluster_append(spark, sf_dir):
    return _appended(spark, sf_dir).select(
        "cluster_id", "main_title", "title_id", "avg_levenshtein", "avg_jaccard", "volume", "score",
        time_text("last_updated"),
    )


@query
def k4_article_links(spark, sf_dir):
    members = samples.topic_members(spark, sf_dir).filter(F.col("title_id") % 3 != 0)
    linked = tables.link_articles(samples.topics(spark, sf_dir), members, _appended(spark, sf_dir))
    return linked.select("title_id", "cluster_id")


@query
def k5_schema_evolution(spark, sf_dir):
    old = samples.clusters(spark, sf_dir).select("cluster_id", "main_title", "volume")
    articles = tables.with_cluster_column(samples.articles(spark, sf_dir).drop("cluster_id"))
    counted = articles.agg(F.count(F.lit(1)).alias("rows"), F.count("cluster_id").alias("linked"))
    added = tables.with_score_columns(old)
    return added.select(
        "cluster_id", "main_title", "volume", "score", "avg_sentiment", "avg_jaccard",
        counted.select("rows").scalar().alias("article_rows"),
        counted.select("linked").scalar().alias("article_links"),
    )


def _actions(spark, sf_dir):
    """Score actions from arithmetic: some dead, some for clusters that do not exist."""
    ids = samples.topics(spark, sf_dir).select((F.col("cluster_id") * 2 % 70).alias("cluster_id")).distinct()
    dead = F.col("cluster_id") % 6 == 0
    return ids.select(
        "cluster_id",
        F.when(dead, F.lit(0.0)).otherwise(F.col("cluster_id") / 100.0).alias("calculated_score"),
        (F.col("cluster_id") / 200.0).alias("avg_sentiment"),
        F.lit(1.0).alias("avg_jaccard"),
        as_of().alias("evaluated_at"),
        F.when(dead, F.lit("DELETE")).otherwise(F.lit("UPSERT")).alias("action"),
    )


_SCORED = ["cluster_id", "main_title", "volume", "score", "avg_sentiment", "avg_jaccard"]


@query
def k6_score_update(spark, sf_dir):
    updated = tables.update_scores(samples.clusters_stored(spark, sf_dir), _actions(spark, sf_dir))
    return updated.select(*_SCORED, time_text("last_updated"))


@query
def k7_purge_clusters(spark, sf_dir):
    left = tables.apply_actions(samples.clusters_stored(spark, sf_dir), _actions(spark, sf_dir))
    return left.select(*_SCORED, time_text("last_updated"))


@query
def k8_ticker_upsert(spark, sf_dir):
    ticks = samples.ticks(spark, sf_dir)
    no_rows = spark.createDataFrame([], schemas.TICKERS)
    early = ticks.filter(F.col("symbol") != "view")
    stored = tables.upsert_tickers(no_rows, early, F.to_timestamp(F.lit("2024-02-01 00:00:00")), "event_id")
    late = ticks.filter(F.col("symbol") != "error").withColumn("current", F.col("current") + 1.0)
    merged = tables.upsert_tickers(stored, late, as_of(), "event_id")
    return merged.select("ticker_symbol", "current_price", "prev_close_price", time_text("updated_at"))


@query
def k9_atomic_commit(spark, sf_dir):
    """Two runs that add to a table, the second one repeated, and what a reader then sees."""
    store = scratch_store(spark)
    articles = samples.articles(spark, sf_dir).drop("cluster_id")
    store.write("articles", articles.filter("title_id % 2 = 0"), "load-6")
    for _ in range(2):
        store.write("articles", articles.filter("title_id % 2 = 1"), "load-7")
    rows = store.read("articles", schemas.ARTICLE_ROWS)
    last = rows.agg(F.max(F.split("run", "-")[1].cast("int"))).scalar()
    return rows.select("title_id", "source_id", "title", last.alias("last_batch"))


# ---------------------------------------------------------------- similarity and joins


@query
def l1_combined_text(spark, sf_dir):
    text = X.combined_text("title", F.when(F.col("title_id") % 5 != 0, F.col("summary")))
    return samples.articles(spark, sf_dir).select("title_id", text.alias("text"))


@query
def l2_tfidf(spark, sf_dir):
    weights = similarity.tfidf_weights(samples.clustering_input(spark, sf_dir))
    return weights.select("title_id", "term", F.round("weight", 6).alias("weight"))


@query
def l3_pair_cosine(spark, sf_dir):
    """Earlier articles within the gap that exceed the cosine, reduced per article."""
    return similarity.earlier_matches(samples.clustering_input(spark, sf_dir))


@query
def l4_time_gate(spark, sf_dir):
    """Members of a topic within and beyond 72 hours of its anchor."""
    articles = samples.clustering_input(spark, sf_dir)
    members = samples.topic_members(spark, sf_dir).join(articles, "title_id")
    anchors = articles.select(F.col("title_id").alias("anchor_id"), F.col("published_at").alias("anchor_time"))
    gap = similarity.gap_seconds(F.unix_seconds("published_at"), F.unix_seconds("anchor_time"))
    return members.join(anchors, "anchor_id").select(
        "title_id", "anchor_id", (gap / 3600.0).alias("hours"), similarity.within_gap(gap).alias("inside")
    )


@query
def l5_best_match(spark, sf_dir):
    return similarity.best_topic(
        samples.clustering_input(spark, sf_dir), samples.topic_members(spark, sf_dir)
    )


@query
def l6_greedy_clusters(spark, sf_dir):
    return clustering.cluster_articles(samples.clustering_input(spark, sf_dir))


def _with_anchor_titles(spark, sf_dir):
    articles = samples.clustering_input(spark, sf_dir)
    anchors = articles.select(F.col("title_id").alias("anchor_id"), F.col("title").alias("main_title"))
    return articles.join(samples.topic_members(spark, sf_dir), "title_id").join(anchors, "anchor_id")


def ascii_only(column: str) -> Column:
    return F.regexp_replace(column, r"[^\x00-\x7F]", "?")


@query
def l7_levenshtein(spark, sf_dir):
    pairs = _with_anchor_titles(spark, sf_dir)
    value = X.levenshtein_similarity(ascii_only("title"), ascii_only("main_title"))
    return pairs.select("title_id", "anchor_id", F.round(value, 4).alias("similarity"))


@query
def l8_jaccard(spark, sf_dir):
    value = X.jaccard("title", "main_title")
    return _with_anchor_titles(spark, sf_dir).select("title_id", "anchor_id", F.round(value, 4).alias("similarity"))


@query
def l9_anchor_lookup(spark, sf_dir):
    return _with_anchor_titles(spark, sf_dir).select("title_id", "title", "anchor_id", "main_title")


def _history(spark, sf_dir):
    return article_scans.scan_history(samples.clusters(spark, sf_dir), as_of())


def _members(spark, sf_dir):
    return scoring.cluster_members(samples.topics(spark, sf_dir, spread=True))


@query
def l10_history_lookup(spark, sf_dir):
    volumes = _members(spark, sf_dir).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("volume"))
    return scoring.with_history(volumes, _history(spark, sf_dir)).select(
        "cluster_id", "volume", "score", time_text("last_evaluated_at"),
        F.when(F.col("score").isNull(), "fresh").otherwise("compound").alias("mode"),
    )


@query
def l11_missing_pages(spark, sf_dir):
    captured = samples.pages(spark, sf_dir)
    frontier = captured.select("site", F.explode(F.array("page_num", F.col("page_num") + 1)).alias("page_num"))
    return page_scans.missing_pages(frontier.distinct(), captured)


# ---------------------------------------------------------------- aggregations


def _measured(spark, sf_dir):
    articles = samples.clustering_input(spark, sf_dir).withColumn("title", ascii_only("title"))
    return clustering.measure_members(articles, samples.topic_members(spark, sf_dir))


@query
def a1_cluster_report(spark, sf_dir):
    return clustering.cluster_report(_measured(spark, sf_dir)).select(
        "cluster_anchor_db_id", "cluster_master", "volume_count", "latest_update_time", "part",
        F.posexplode("metrics_payload").alias("position", "m"),
    ).select(
        "cluster_anchor_db_id", "cluster_master", "volume_count", "latest_update_time", "part", "position",
        "m.db_serial_number", "m.headline_text", "m.published_time", "m.raw_metrics.*",
    )


@query
def a2_cluster_averages(spark, sf_dir):
    averages = clustering.cluster_averages(_measured(spark, sf_dir))
    return averages.select(
        "anchor_id", "main_title", "avg_levenshtein", "avg_jaccard", "volume", time_text("latest_update_time")
    )


@query
def a3_payload_grouping(spark, sf_dir):
    return scoring.cluster_payloads(_members(spark, sf_dir)).select(
        "cluster_id", "volume_count", "part", F.posexplode("metrics_payload").alias("position", "m")
    ).select(
        "cluster_id", "volume_count", "part", "position", "m.db_serial_number", "m.headline_text",
        F.md5("m.summary_text").alias("summary_digest"), "m.raw_metrics.jaccard_similarity",
    )


def _stored_members(spark, sf_dir):
    return scoring.with_stored_similarity(_members(spark, sf_dir), _measured(spark, sf_dir))


@query
def a4_mean_jaccard(spark, sf_dir):
    cohesion = scoring.topic_cohesion(_stored_members(spark, sf_dir))
    return cohesion.select("cluster_id", F.round("avg_jaccard", 4).alias("avg_jaccard"))


@query
def a5_mean_sentiment(spark, sf_dir):
    mean = scoring.topic_sentiment(_members(spark, sf_dir), samples.lexicon(spark, sf_dir))
    return mean.select("cluster_id", F.round("avg_sentiment", 4).alias("avg_sentiment"))


# ---------------------------------------------------------------- sentiment and scores


@query
def r1_text_choice(spark, sf_dir):
    number = F.col("title_id")
    summary = F.when(number % 3 == 0, F.lit(None)).when(number % 3 == 1, F.lit("")).otherwise(F.col("summary"))
    title = F.when(number % 2 == 0, F.lit("")).otherwise(F.col("title"))
    return samples.articles(spark, sf_dir).select("title_id", S.sentiment_text(summary, title).alias("text"))


@query
def r2_lexicon_sentiment(spark, sf_dir):
    return compound_sentiment(samples.articles(spark, sf_dir, spread=True), samples.lexicon(spark, sf_dir), text="summary")


def _measures(spark, sf_dir):
    return scoring.topic_measures(_members(spark, sf_dir), samples.lexicon(spark, sf_dir))


@query
def r3_volume_saturation(spark, sf_dir):
    volumes = _members(spark, sf_dir).groupBy("cluster_id").agg(F.count(F.lit(1)).alias("volume"))
    return volumes.select("cluster_id", F.round(S.volume_saturation("volume"), 6).alias("saturation"))


@query
def r4_surge(spark, sf_dir):
    value = S.surge("avg_sentiment", "volume", "avg_jaccard")
    return _measures(spark, sf_dir).select("cluster_id", F.round(value, 6).alias("surge"))


@query
def r5_time_decay(spark, sf_dir):
    value = S.decayed("score", "last_evaluated_at", as_of())
    return _history(spark, sf_dir).select("cluster_id", F.round(value, 8).alias("decayed"))


@query
def r6_compound_clamp(spark, sf_dir):
    """Scores with measured cohesion raised, so that some reach the limits."""
    raised = _measures(spark, sf_dir).withColumn("avg_jaccard", F.lit(4.0))
    return scoring.with_final(raised, _history(spark, sf_dir), as_of()).select("cluster_id", F.round("final", 6).alias("score"))


@query
def r7_liveness(spark, sf_dir):
    """Actions for one made-up history per article, evaluated at its own time and without new members' weight."""
    value = (F.col("title_id") % 41 - 20) / 10000.0
    rows = samples.articles(spark, sf_dir).select(F.col("title_id").alias("cluster_id"), value.alias("score"))
    measures = rows.select("cluster_id", F.lit(0).alias("volume"), F.lit(1.0).alias("avg_jaccard"), F.lit(0.0).alias("avg_sentiment"))
    actions = scoring.score_actions(measures, rows.withColumn("last_evaluated_at", as_of()), as_of())
    return actions.select(F.col("cluster_id").alias("title_id"), F.col("calculated_score").alias("score"), "action")


@query
def r8_scoring_job(spark, sf_dir):
    actions = scoring.evaluate_topics(
        _members(spark, sf_dir), samples.lexicon(spark, sf_dir), _history(spark, sf_dir), as_of()
    )
    return actions.select(
        "cluster_id", "calculated_score", "avg_sentiment", "avg_jaccard", time_text("evaluated_at"), "action"
    )


@query
def r9_ranked_topics(spark, sf_dir):
    """Rank current topics by score: the flagship query."""
    actions = scoring.evaluate_topics(
        _members(spark, sf_dir), samples.lexicon(spark, sf_dir), _history(spark, sf_dir), as_of()
    )
    ensure_checkpoint_dir(spark)
    current = tables.apply_actions(samples.clusters_stored(spark, sf_dir), actions).checkpoint()
    ranked = scoring.ranked_topics(current, samples.articles(spark, sf_dir))
    return ranked.select(
        "rank", "cluster_id", "main_title", F.md5("summary").alias("summary_digest"), "score", "volume",
        "avg_jaccard", "avg_sentiment", "sentiment_label", time_text("last_updated"),
    )


# ---------------------------------------------------------------- market and numbers


@query
def m1_percent_change(spark, sf_dir):
    ticks = samples.ticks(spark, sf_dir)
    prices_table = ticks.select(
        "event_id", F.col("symbol").alias("ticker_symbol"), F.col("current").alias("current_price"),
        F.when(F.col("event_id") % 50 == 0, F.lit(0.0)).otherwise(F.col("prev_close")).alias("prev_close_price"),
    )
    change = S.percent_change("current_price", "prev_close_price")
    return prices_table.select("event_id", "ticker_symbol", change.alias("change_pct"))


@query
def m2_price_cards(spark, sf_dir):
    scanned = prices.scan_prices(samples.price_payloads(spark, sf_dir), keep=("event_id",))
    cards = market.price_cards(scanned.withColumn("coin", F.concat_ws("#", "coin", F.col("event_id").cast("string"))))
    return cards


@query
def m3_growth_schedule(spark, sf_dir):
    return market.growth_schedule(samples.plans(spark, sf_dir))


# ---------------------------------------------------------------- streams


def _stream_of(spark, sf_dir, name: str, key: str) -> DataFrame:
    """An input table as a stream of two batches: the lower half of its keys and then the upper one."""
    folder = f"{ensure_checkpoint_dir(spark)}/landing-{uuid.uuid4().hex}"
    rows, files = samples.table(spark, sf_dir, name), int(spark.conf.get("spark.sql.shuffle.partitions"))
    middle = (rows.agg(F.max(key)).first()[0] or 0) // 2
    with Scratch(spark):
        for half in (rows.where(F.col(key) <= middle), rows.where(F.col(key) > middle)):
            half.repartition(files).write.mode("append").option("compression", "zstd").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _batch_time(batch_id: int) -> Column:
    return as_of()


@query
def t1_ticker_stream(spark, sf_dir):
    stream = _stream_of(spark, sf_dir, "events", "event_id")
    store = scratch_store(spark)
    streams.stream_tickers(
        samples.ticker_payloads(stream), store, f"{store.base}/_stream", _batch_time
    ).awaitTermination()
    return jobs.current_tickers(store).select(
        "ticker_symbol", "current_price", "prev_close_price", time_text("updated_at")
    )


@query
def t2_article_stream(spark, sf_dir):
    stream = _stream_of(spark, sf_dir, "pages", "page_id")
    landed = stream.select(samples.host().alias("site"), F.col("page_id").cast("int").alias("page_num"), "html")
    configs = samples.page_configs(spark, sf_dir).withColumns(
        {"strategy": F.lit("html_dom"), "url_template": F.lit("https://{}"), "pages": F.lit(1)}
    )
    store = scratch_store(spark)
    streams.stream_pages_to_articles(
        landed, configs, store, f"{store.base}/_stream", _batch_time
    ).awaitTermination()
    return jobs.all_articles(store).select(
        "title_id", "source_id", "title", "link", "summary", time_text("date_captured")
    )


@query
def t3_topic_stream(spark, sf_dir):
    """Articles arrive in two batches; the topics of the first one are scored twice."""
    store = scratch_store(spark)
    stream = samples.article_rows(_stream_of(spark, sf_dir, "documents", "doc_id"))
    lexicon = samples.lexicon(spark, sf_dir)
    streams.stream_topics(stream, lexicon, store, f"{store.base}/_stream", _batch_time).awaitTermination()
    return jobs.current_clusters(store).select(
        "title_id", "main_title", "avg_jaccard", "volume", "score", "avg_sentiment", time_text("last_updated")
    )
