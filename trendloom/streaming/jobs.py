"""Structured Streaming runs of the batch jobs.

Every query is a ``foreachBatch`` over a stream. A batch writes its rows under a run named by the stream, the
id that its checkpoint folder keeps, and its number. A batch that is replayed from the same checkpoint
replaces its own rows; with another checkpoint all data come again as new runs and nothing is skipped.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from trendloom.plans import jobs
from trendloom.sources.prices import scan_tickers
from trendloom.sources.store import TableStore

TICKER_PERIOD = "300 seconds"  # fixed value: pause between two price rounds


def run_stream(
    stream: DataFrame,
    name: str,
    step: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    period: str | None = None,
) -> StreamingQuery:
    """Start ``step`` on every batch; all data present now and then stop unless ``period`` is given."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        step(batch, f"{name}-{query}-{batch_id:010d}", batch_id)

    trigger = {"processingTime": period} if period else {"availableNow": True}
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(on_batch)
        .start()
    )


def keep_running(start: Callable[[], StreamingQuery], pause: float = 60.0, attempts: int | None = None) -> None:
    """Start a query again whenever a round of it fails; ``attempts`` limits how often, for ever if None.

    The failed batch comes again from the checkpoint. Returns when the query ends without an error.
    """
    made = 0
    while True:
        made += 1
        try:
            return start().awaitTermination()
        except Exception:
            if attempts is not None and made >= attempts:
                raise
            time.sleep(pause)


def stream_tickers(
    payloads: DataFrame,
    store: TableStore,
    checkpoint: str,
    as_of: Callable[[int], Column],
    body: str = "body",
    seq: str = "seq",
    period: str | None = None,
) -> StreamingQuery:
    """Keep the latest price per symbol; ``as_of`` gives the time of a batch from its number."""

    def step(batch: DataFrame, run: str, number: int) -> None:
        ticks = scan_tickers(batch, body, keep=(seq,))
        jobs.update_tickers(store, ticks, as_of(number), seq, run, number)

    return run_stream(payloads, "tickers", step, checkpoint, period)


def stream_pages_to_articles(
    pages: DataFrame,
    configs: DataFrame,
    store: TableStore,
    checkpoint: str,
    as_of: Callable[[int], Column],
    period: str | None = None,
) -> StreamingQuery:
    """Extract, clean and append the articles of newly landed pages."""

    def step(batch: DataFrame, run: str, number: int) -> None:
        jobs.ingest_pages(store, batch, configs, as_of(number), run)

    return run_stream(pages, "articles", step, checkpoint, period)


def stream_topics(
    articles: DataFrame,
    lexicon: DataFrame,
    store: TableStore,
    checkpoint: str,
    as_of: Callable[[int], Column],
    period: str | None = None,
    **options,
) -> StreamingQuery:
    """On every new batch: cluster the articles without a topic, then rescore the current topics.

    ``articles`` streams the article rows themselves, which are stored first, or anything else that tells
    of articles stored by another job. The stored scores are an ordinary table, so the stream holds no state.
    """
    rows = set(articles.columns) >= {"title_id", "title", "summary", "date_captured"}

    def step(batch: DataFrame, run: str, number: int) -> None:
        if rows:
            fields = [name for name in jobs.schemas.ARTICLE_ROWS.fieldNames()]
            store.write(jobs.ARTICLES, batch.select(*fields), run)
        jobs.cluster_open_articles(store, run=run, **options)
        jobs.rescore_topics(store, lexicon, as_of(number), run=run, batch=number)

    return run_stream(articles, "topics", step, checkpoint, period)
