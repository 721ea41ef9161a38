"""Column layouts of the stored tables and of the data between jobs."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


SOURCES = _struct(
    ("site_name", T.StringType()),
    ("url_template", T.StringType()),
    ("pages", T.IntegerType()),
    ("strategy", T.StringType()),
    ("script_type", T.StringType()),
    ("schema_type", T.StringType()),
    ("array_key", T.StringType()),
    ("mapping", T.MapType(T.StringType(), T.StringType())),
    ("container_tag", T.StringType()),
    ("container_class", T.StringType()),
    ("headline_tag", T.StringType()),
    ("anchor_position", T.StringType()),
    ("summary_tag", T.StringType()),
    ("date_class", T.StringType()),
)

ATTEMPTS = _struct(
    ("site", T.StringType()),
    ("page_num", T.IntegerType()),
    ("tier", T.IntegerType()),
    ("html", T.StringType()),
)

PAGES = _struct(
    ("site", T.StringType()),
    ("page_num", T.IntegerType()),
    ("html", T.StringType()),
)

RECORDS = _struct(
    ("site", T.StringType()),
    ("page_num", T.IntegerType()),
    ("pos", T.IntegerType()),
    ("headline", T.StringType()),
    ("link", T.StringType()),
    ("summary", T.StringType()),
    ("date", T.StringType()),
)

ARTICLES = _struct(
    ("title_id", T.LongType()),
    ("source_id", T.StringType()),
    ("title", T.StringType()),
    ("link", T.StringType()),
    ("summary", T.StringType()),
    ("date_captured", T.TimestampType()),
    ("cluster_id", T.LongType()),
)

# Stored articles; their topic is a row of LINKS.
ARTICLE_ROWS = T.StructType([f for f in ARTICLES.fields if f.name != "cluster_id"])

LINKS = _struct(("title_id", T.LongType()), ("cluster_id", T.LongType()))

SENTIMENTS = _struct(("title_id", T.LongType()), ("compound", T.DoubleType()))

SCORES = _struct(
    ("cluster_id", T.LongType()),
    ("score", T.DoubleType()),
    ("avg_sentiment", T.DoubleType()),
    ("avg_jaccard", T.DoubleType()),
    ("last_updated", T.TimestampType()),
    ("action", T.StringType()),
    ("batch", T.LongType()),
)

TICKS = _struct(
    ("ticker_symbol", T.StringType()),
    ("current_price", T.DoubleType()),
    ("prev_close_price", T.DoubleType()),
    ("updated_at", T.TimestampType()),
    ("seq", T.LongType()),
    ("batch", T.LongType()),
)

CLUSTERS = _struct(
    ("cluster_id", T.LongType()),
    ("main_title", T.StringType()),
    ("title_id", T.LongType()),
    ("avg_levenshtein", T.DoubleType()),
    ("avg_jaccard", T.DoubleType()),
    ("volume", T.DoubleType()),
    ("score", T.DoubleType()),
    ("avg_sentiment", T.DoubleType()),
    ("last_updated", T.TimestampType()),
)

TICKERS = _struct(
    ("ticker_symbol", T.StringType()),
    ("current_price", T.DoubleType()),
    ("prev_close_price", T.DoubleType()),
    ("updated_at", T.TimestampType()),
)

LEXICON = _struct(("token", T.StringType()), ("valence", T.DoubleType()))

HISTORY = _struct(
    ("cluster_id", T.LongType()),
    ("score", T.DoubleType()),
    ("last_evaluated_at", T.TimestampType()),
)
