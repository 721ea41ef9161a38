"""Headline clean-up: de-duplication, counts, null filters, keyword search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trendloom.functions.text import normalised_headline
from trendloom.operators.ordering import keep_first


def with_norm(records: DataFrame) -> DataFrame:
    return records.withColumn("norm", normalised_headline("headline"))


def first_headlines(
    records: DataFrame, order: Sequence[str] = ("ingest_seq",), scope: str = "site"
) -> DataFrame:
    """Keep the first record of every normalised headline, per site batch or over all sites.

    Runs before the null filter, so a first copy without a link also removes a later good one.
    """
    keys = ["norm"] if scope == "all" else ["site", "norm"]
    return keep_first(with_norm(records), keys, order)


def dedup_counts(records: DataFrame) -> DataFrame:
    """Per site: records before and after de-duplication, and how many were removed."""
    per_norm = with_norm(records).groupBy("site", "norm").agg(F.count(F.lit(1)).alias("copies"))
    return per_norm.groupBy("site").agg(
        F.sum("copies").alias("before"),
        F.count(F.lit(1)).alias("after"),
        (F.sum("copies") - F.count(F.lit(1))).alias("removed"),
    )


def drop_incomplete(records: DataFrame) -> DataFrame:
    """Drop records without headline or link, and the helper column."""
    return records.drop("norm").na.drop(subset=["headline", "link"])


def clean_records(
    records: DataFrame, order: Sequence[str] = ("ingest_seq",), scope: str = "site"
) -> DataFrame:
    return drop_incomplete(first_headlines(records, order, scope))


def keyword_search(articles: DataFrame, keyword: str = "market") -> DataFrame:
    """Source and title of the articles whose title holds the keyword, newest first."""
    pattern = "%" + keyword.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    return (
        articles.filter(F.col("title").ilike(pattern))
        .orderBy(F.col("date_captured").desc(), F.col("title_id"))
        .select("source_id", "title")
    )


def keyword_preview(articles: DataFrame, keyword: str = "market", rows: int = 5) -> DataFrame:
    return keyword_search(articles, keyword).limit(rows)
