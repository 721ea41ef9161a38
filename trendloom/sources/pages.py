"""Captured pages: landed page tables and the choice between capture attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendloom import schemas

# The capture tiers and the text that marks a refused browser page.
STATIC_TIERS = (1, 2)
BROWSER_TIER = 3
REFUSAL_MARK = "Access Denied"


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """A landed page table in Parquet."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def stream_pages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """New files of a landing folder, as a stream."""
    return spark.readStream.schema(schemas.PAGES).option("maxFilesPerTrigger", max_files).parquet(path)


def is_valid_attempt() -> Column:
    has_body = F.coalesce(F.col("html"), F.lit("")) != ""
    refused = (F.col("tier") == BROWSER_TIER) & F.contains("html", F.lit(REFUSAL_MARK))
    return has_body & ~refused


def resolve_attempts(attempts: DataFrame) -> DataFrame:
    """Per page the earliest-tier attempt that yielded a usable body; pages without one are absent."""
    usable = attempts.filter(is_valid_attempt())
    # The tier is chosen on narrow rows; bodies move once and are sorted nowhere before that.
    best = usable.groupBy("site", "page_num").agg(F.min("tier").alias("tier"))
    return (
        usable.join(best, ["site", "page_num", "tier"], "left_semi")
        .groupBy("site", "page_num", "tier")
        .agg(F.min("html").alias("html"))
    )


def browser_pages(attempts: DataFrame) -> DataFrame:
    """The capture a site falls back to: usable browser-tier attempts only."""
    return resolve_attempts(attempts.filter(F.col("tier") == BROWSER_TIER))


def missing_pages(frontier: DataFrame, captured: DataFrame) -> DataFrame:
    """Frontier pages that have not been captured yet."""
    return frontier.join(captured.select("site", "page_num"), ["site", "page_num"], "left_anti")
