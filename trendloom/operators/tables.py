"""The next state of the stored tables, computed as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.operators.ordering import keep_first, with_ordinal
from trendloom.session import ensure_checkpoint_dir

# Columns added to older cluster tables, with their default.
SCORE_COLUMNS = {"score": 0.0, "avg_sentiment": 0.0, "avg_jaccard": 0.0}


def _next_id(stored: DataFrame, column: str) -> Column:
    """Largest stored id, 0 for an empty table; a one-row subquery, not a driver round trip."""
    return F.coalesce(stored.agg(F.max(column)).scalar(), F.lit(0).cast("long"))


def new_articles(
    stored: DataFrame,
    records: DataFrame,
    as_of: Column,
    order_by: Sequence[str] = ("site",),
    seq: str = "ingest_seq",
) -> DataFrame:
    """Rows to append: the first record of every title that is not stored yet.

    Records without title or site are skipped. Ids continue after the largest stored id in arrival
    order. Stored titles are first reduced to those the batch mentions, so a large table is scanned but
    not shuffled while the batch fits a broadcast.
    """
    complete = records.na.drop(subset=["site", "headline"])
    fresh = keep_first(complete, ["headline"], [*order_by, seq])
    known = (
        stored.select(F.col("title").alias("headline"))
        .join(fresh.select("headline"), "headline", "left_semi")
    )
    ensure_checkpoint_dir(records.sparkSession)
    # Written once; numbering reads it twice.
    unknown = fresh.join(known, "headline", "left_anti").checkpoint()
    numbered = with_ordinal(unknown, seq, order_by, "_ordinal")
    return numbered.select(
        (_next_id(stored, "title_id") + F.col("_ordinal")).cast("long").alias("title_id"),
        F.col("site").alias("source_id"),
        F.col("headline").alias("title"),
        "link",
        "summary",
        as_of.alias("date_captured"),
        F.lit(None).cast("long").alias("cluster_id"),
    )


def insert_articles(stored: DataFrame, records: DataFrame, as_of: Column, **kwargs) -> DataFrame:
    """The article table after the insert."""
    return stored.unionByName(new_articles(stored, records, as_of, **kwargs))


def new_clusters(stored: DataFrame, averages: DataFrame) -> DataFrame:
    """Cluster rows to append, one per measured cluster, in the order of their anchors."""
    numbered = with_ordinal(averages, "anchor_id", name="_ordinal")
    return numbered.select(
        (_next_id(stored, "cluster_id") + F.col("_ordinal")).cast("long").alias("cluster_id"),
        F.col("main_title"),
        F.col("anchor_id").alias("title_id"),
        "avg_levenshtein",
        "avg_jaccard",
        "volume",
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("double").alias("avg_sentiment"),
        F.col("latest_update_time").alias("last_updated"),
    )


def link_articles(articles: DataFrame, members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Set ``cluster_id`` of every member; other articles keep theirs.

    ``members`` has ``title_id, anchor_id``; ``clusters`` maps the anchor to its new id.
    """
    links = members.select("title_id", "anchor_id").join(
        clusters.select(F.col("title_id").alias("anchor_id"), F.col("cluster_id").alias("_new")), "anchor_id"
    )
    return articles.join(links.select("title_id", "_new"), "title_id", "left").select(
        *[
            F.coalesce("_new", "cluster_id").alias("cluster_id") if name == "cluster_id" else F.col(name)
            for name in articles.columns
        ]
    )


def with_score_columns(clusters: DataFrame) -> DataFrame:
    """Add the score columns an older cluster table lacks."""
    missing = {n: F.lit(v) for n, v in SCORE_COLUMNS.items() if n not in clusters.columns}
    return clusters.withColumns(missing) if missing else clusters


def with_cluster_column(articles: DataFrame) -> DataFrame:
    """Add the ``cluster_id`` column an older article table lacks."""
    if "cluster_id" in articles.columns:
        return articles
    return articles.withColumn("cluster_id", F.lit(None).cast("long"))


def _apply(clusters: DataFrame, actions: DataFrame, purge: bool) -> DataFrame:
    clusters = with_score_columns(clusters)
    changes = actions.select(
        "cluster_id",
        F.col("action").alias("_action"),
        F.col("calculated_score").alias("_score"),
        F.col("avg_sentiment").alias("_sentiment"),
        F.col("avg_jaccard").alias("_jaccard"),
        F.col("evaluated_at").alias("_at"),
    )
    if purge:
        joined = clusters.join(changes, "cluster_id", "left")
        joined = joined.filter(F.col("_action").isNull() | (F.col("_action") != "DELETE"))
    else:
        joined = clusters.join(changes.filter(F.col("_action") == "UPSERT"), "cluster_id", "left")
    new = {"score": "_score", "avg_sentiment": "_sentiment", "avg_jaccard": "_jaccard", "last_updated": "_at"}
    applies = F.col("_action").isNotNull()
    return joined.select(
        *[
            F.when(applies, F.col(new[name])).otherwise(F.col(name)).alias(name) if name in new else F.col(name)
            for name in clusters.columns
        ]
    )


def update_scores(clusters: DataFrame, actions: DataFrame) -> DataFrame:
    """Apply the ``UPSERT`` actions to existing clusters; an unknown id inserts nothing."""
    return _apply(clusters, actions, purge=False)


def purge_clusters(clusters: DataFrame, actions: DataFrame) -> DataFrame:
    """Remove the clusters flagged ``DELETE``; articles keep the id they point at."""
    dead = actions.filter(F.col("action") == "DELETE").select("cluster_id")
    return clusters.join(dead, "cluster_id", "left_anti")


def unlink_purged(articles: DataFrame, actions: DataFrame) -> DataFrame:
    """Optional: null the link of articles whose cluster was purged."""
    dead = actions.filter(F.col("action") == "DELETE").select("cluster_id", F.lit(True).alias("_dead"))
    return articles.join(dead, "cluster_id", "left").select(
        *[
            F.when(F.col("_dead"), F.lit(None)).otherwise(F.col(name)).cast("long").alias(name)
            if name == "cluster_id"
            else F.col(name)
            for name in articles.columns
        ]
    )


def apply_actions(clusters: DataFrame, actions: DataFrame) -> DataFrame:
    """Update and purge with a single join, so the actions are computed once."""
    return _apply(clusters, actions, purge=True)


def upsert_tickers(stored: DataFrame, batch: DataFrame, as_of: Column, seq: str | None = None) -> DataFrame:
    """Latest price per symbol after the batch; all rows of a batch carry one time.

    ``seq`` orders several rows of one symbol within the batch, the last one wins.
    """
    columns = ["ticker_symbol", "current_price", "prev_close_price", "updated_at"]
    rank = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    new = latest_ticks(batch.withColumn("_seq", rank), "_seq").select(
        "ticker_symbol", "current_price", "prev_close_price", as_of.alias("updated_at")
    )
    kept = stored.select(*columns).join(new.select("ticker_symbol"), "ticker_symbol", "left_anti")
    return kept.unionByName(new)


def latest_ticks(batch: DataFrame, seq: str) -> DataFrame:
    """The last price of each symbol of a batch, by hash aggregation; ``seq`` is a BIGINT.

    Rows of one symbol that share the last ``seq`` give the largest price and the largest close among them.
    """
    newest = batch.groupBy("symbol").agg(F.max(seq).alias(seq))
    joined = batch.join(newest, ["symbol", seq], "left_semi")
    return joined.groupBy("symbol").agg(
        F.max("current").alias("current_price"), F.max("prev_close").alias("prev_close_price"), F.max(seq).alias(seq)
    ).select(F.col("symbol").alias("ticker_symbol"), "current_price", "prev_close_price", seq)
