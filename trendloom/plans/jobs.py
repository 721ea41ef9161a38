"""Batch jobs over the stored tables: ingest, cluster, score, tickers.

=============  ==========================  =========================================================
table          written by                  what is current
=============  ==========================  =========================================================
articles       ingest                      all rows
links          cluster                     per article the link to the largest cluster id
clusters       cluster                     those without a removal among their scores
sentiments     score                       one row per article, computed once
scores         score                       per cluster the last one
ticks          ticker                      per symbol the last one
=============  ==========================  =========================================================

Every job adds rows under a ``run`` of its own and reads without them, so it can be repeated. Articles that
arrive while another job works are untouched: they are open until a link to them exists.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from trendloom import schemas
from trendloom.operators import clean, clustering, extract, scoring, tables
from trendloom.operators.scratch import Scratch
from trendloom.session import ensure_checkpoint_dir
from trendloom.sources import articles as article_scans
from trendloom.sources import configs as config_scans
from trendloom.sources.pages import browser_pages, resolve_attempts
from trendloom.sources.store import TableStore

ARTICLES, LINKS, CLUSTERS, SENTIMENTS, SCORES, TICKS = (
    "articles", "article_links", "clusters", "article_sentiment", "scores", "ticks",
)


def new_run(job: str) -> str:
    """A name for a run outside a stream."""
    return f"{job}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- what is current


def stored_articles(store: TableStore, run: str | None = None) -> DataFrame:
    return store.read(ARTICLES, schemas.ARTICLE_ROWS, run).drop("run")


def current_links(store: TableStore, run: str | None = None) -> DataFrame:
    """``title_id, cluster_id``: the newest topic of each linked article."""
    links = store.read(LINKS, schemas.LINKS, run)
    return links.groupBy("title_id").agg(F.max("cluster_id").alias("cluster_id"))


def all_articles(store: TableStore, run: str | None = None) -> DataFrame:
    """Every article with its topic, null while it waits for one."""
    return stored_articles(store, run).join(current_links(store, run), "title_id", "left").select(
        *schemas.ARTICLES.fieldNames()
    )


def open_articles(store: TableStore, run: str | None = None) -> DataFrame:
    """The articles without a topic."""
    waiting = stored_articles(store).join(store.read(LINKS, schemas.LINKS, run).select("title_id"), "title_id", "left_anti")
    return waiting.withColumn("cluster_id", F.lit(None).cast("long")).select(*schemas.ARTICLES.fieldNames())


def latest_scores(store: TableStore, run: str | None = None) -> DataFrame:
    """The last score of each topic; times first, batches of one time in their order."""
    scores = store.read(SCORES, schemas.SCORES, run)
    last = F.max_by(F.struct("score", "avg_sentiment", "avg_jaccard", "last_updated"), F.struct("last_updated", "batch"))
    return scores.groupBy("cluster_id").agg(
        last.alias("last"), F.max((F.col("action") == "DELETE").cast("int")).alias("dead")
    ).select("cluster_id", "last.*", (F.col("dead") == 1).alias("dead"))


def current_clusters(store: TableStore, run: str | None = None) -> DataFrame:
    """The topics that were not removed, with their last score; ``run`` names scores to leave out."""
    scores = latest_scores(store, run)
    clusters = store.read(CLUSTERS, schemas.CLUSTERS).drop("run")
    scored = clusters.alias("c").join(scores.alias("s"), "cluster_id", "left").where("dead IS NULL OR NOT dead")
    return scored.select(
        *[
            F.coalesce(f"s.{name}", f"c.{name}").alias(name)
            if name in ("score", "avg_sentiment", "avg_jaccard", "last_updated") else F.col(name if name == "cluster_id" else f"c.{name}")
            for name in schemas.CLUSTERS.fieldNames()
        ]
    )


def current_tickers(store: TableStore) -> DataFrame:
    """The last price of each symbol by time, batch and place in the batch."""
    ticks = store.read(TICKS, schemas.TICKS)
    last = F.max_by(F.struct("current_price", "prev_close_price", "updated_at"), F.struct("updated_at", "batch", "seq"))
    return ticks.groupBy("ticker_symbol").agg(last.alias("last")).select("ticker_symbol", "last.*")


# ---------------------------------------------------------------- jobs


def usable_configs(configs: DataFrame) -> DataFrame:
    return config_scans.with_reject_reason(configs).filter("reject_reason IS NULL").drop("reject_reason")


def records_to_articles(store: TableStore, records: DataFrame, as_of: Column, run: str | None = None) -> int:
    """Clean extracted records and append the new titles. One ingest job writes at a time."""
    ensure_checkpoint_dir(store.spark)
    run = run or new_run("ingest")
    arrived = records.select("*", extract.arrival_seq())
    cleaned = clean.clean_records(arrived).checkpoint()
    known = stored_articles(store, run).withColumn("cluster_id", F.lit(None).cast("long"))
    fresh = tables.new_articles(known, cleaned, as_of).drop("cluster_id").checkpoint()
    store.write(ARTICLES, fresh, run)
    return fresh.count()


def ingest_attempts(store: TableStore, attempts: DataFrame, configs: DataFrame, as_of: Column, run: str | None = None) -> int:
    """From capture attempts to new article rows; returns how many were added."""
    configs = usable_configs(configs)
    records = extract.extract_with_fallback(resolve_attempts(attempts), browser_pages(attempts), configs)
    return records_to_articles(store, records, as_of, run)


def ingest_pages(store: TableStore, pages: DataFrame, configs: DataFrame, as_of: Column, run: str | None = None) -> int:
    """From captured pages to new article rows."""
    return records_to_articles(store, extract.extract_records(pages, usable_configs(configs)), as_of, run)


def cluster_open_articles(store: TableStore, full: bool = False, run: str | None = None, **options) -> int:
    """Cluster the articles without a topic among themselves and link them; returns the topics added.

    ``full`` clusters all articles anew: it appends new topics and links every article to them, the
    topics of earlier runs stay. The links are written last, so articles of a broken run stay open.
    """
    run = run or new_run("cluster")
    with Scratch(store.spark) as scratch:
        waiting = scratch.keep(all_articles(store, run) if full else open_articles(store, run))
        # Dealt by id once, so that counts and joins per article need no further shuffle.
        tasks = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
        scanned = article_scans.scan_articles(waiting, only_unassigned=not full).repartition(tasks, "title_id")
        members = clustering.cluster_articles(scanned, **options)
        averages = scratch.keep(clustering.cluster_averages(clustering.measure_members(scanned, members)))
        clusters = scratch.keep(tables.new_clusters(store.read(CLUSTERS, schemas.CLUSTERS, run).drop("run"), averages))
        links = members.join(
            clusters.select(F.col("title_id").alias("anchor_id"), "cluster_id"), "anchor_id"
        ).select("title_id", "cluster_id")
        store.write(CLUSTERS, clusters, run)
        store.write(LINKS, links, run)
        return clusters.count()


def score_new_articles(store: TableStore, lexicon: DataFrame, run: str) -> DataFrame:
    """``title_id, compound`` of all linked articles; only texts that have none yet are read and scored."""
    stored = store.read(SENTIMENTS, schemas.SENTIMENTS, run)
    linked = store.read(LINKS, schemas.LINKS).select("title_id").distinct()
    missing = linked.join(stored.select("title_id"), "title_id", "left_anti")
    texts = stored_articles(store).join(missing, "title_id", "left_semi").select(
        "title_id", F.col("title").alias("headline_text"), F.col("summary").alias("summary_text")
    )
    store.write(SENTIMENTS, scoring.member_sentiment(texts, lexicon), run)
    return store.read(SENTIMENTS, schemas.SENTIMENTS).select("title_id", "compound")


def rescore_topics(
    store: TableStore, lexicon: DataFrame, as_of: Column, jaccard: str = "constant", run: str | None = None, batch: int = 0
) -> DataFrame:
    """Score every current topic, append the actions, and return them.

    ``jaccard='stored'`` uses the measured member cohesion instead of the constant. ``batch`` orders runs
    with the same ``as_of``.
    """
    run = run or new_run("score")
    with Scratch(store.spark):
        compounds = score_new_articles(store, lexicon, run)
        clusters = current_clusters(store, run)
        members = current_links(store).join(clusters.select("cluster_id"), "cluster_id", "left_semi").withColumn(
            "jaccard_similarity", F.lit(scoring.STORED_JACCARD)
        )
        if jaccard == "stored":
            anchors = clusters.select("cluster_id", clusters["title_id"].alias("anchor_id"))
            assigned = members.join(anchors, "cluster_id").select("title_id", "anchor_id")
            measured = clustering.measure_members(article_scans.scan_articles(all_articles(store), only_unassigned=False), assigned)
            members = scoring.with_stored_similarity(members, measured)
        measures = scoring.measures_from_sentiment(members, compounds)
        history = article_scans.scan_history(clusters, as_of)
        actions = scoring.score_actions(measures, history, as_of).checkpoint()
        store.write(
            SCORES,
            actions.select(
                "cluster_id", F.col("calculated_score").alias("score"), "avg_sentiment", "avg_jaccard",
                F.col("evaluated_at").alias("last_updated"), "action", F.lit(batch).cast("long").alias("batch"),
            ),
            run,
        )
        return actions


def update_tickers(
    store: TableStore, ticks: DataFrame, as_of: Column, seq: str | None = None, run: str | None = None, batch: int = 0
) -> None:
    """Append the last ``symbol, current, prev_close`` of each symbol in the batch."""
    rank = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    rows = tables.latest_ticks(ticks.withColumn("_seq", rank), "_seq")
    store.write(
        TICKS,
        rows.select("ticker_symbol", "current_price", "prev_close_price", as_of.alias("updated_at"), F.col("_seq").alias("seq"), F.lit(batch).cast("long").alias("batch")),
        run or new_run("ticker"),
    )
