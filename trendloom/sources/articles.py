"""Scans of the article and cluster tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trendloom import schemas


def scan_articles(articles: DataFrame, only_unassigned: bool = True) -> DataFrame:
    """Clustering input ``title_id, title, summary, published_at``.

    By default only articles without a cluster; the filter reaches the Parquet scan. A null summary
    becomes empty.
    """
    if only_unassigned and "cluster_id" in articles.columns:
        articles = articles.filter(F.col("cluster_id").isNull())
    return articles.select(
        "title_id",
        "title",
        F.coalesce("summary", F.lit("")).alias("summary"),
        F.col("date_captured").alias("published_at"),
    )


def scan_history(clusters: DataFrame, as_of: Column) -> DataFrame:
    """Stored scores ``cluster_id, score, last_evaluated_at``.

    Rows without score or time are left out; a time that cannot be read becomes ``as_of``. A table that
    has no score column yet gives no rows.
    """
    needed = {"cluster_id", "score", "last_updated"}
    if not needed <= set(clusters.columns):
        return clusters.sparkSession.createDataFrame([], schemas.HISTORY)
    present = clusters.filter(F.col("score").isNotNull() & F.col("last_updated").isNotNull())
    if dict(clusters.dtypes)["last_updated"] == "string":
        when = F.coalesce(F.try_to_timestamp("last_updated", F.lit("yyyy-MM-dd HH:mm:ss")), as_of)
    else:
        when = F.col("last_updated").cast("timestamp")
    return present.select("cluster_id", F.col("score").cast("double").alias("score"), when.alias("last_evaluated_at"))
