"""Adapters that give general-purpose tables the shape of the library's inputs.

All of them are column arithmetic or one aggregation over a whole table, so they grow with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendloom.functions.text import terms
from trendloom.operators.ordering import keep_first
from trendloom.session import use_utc

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
AS_OF = "2024-03-01 00:00:00"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def as_of() -> Column:
    return F.to_timestamp(F.lit(AS_OF))


def time_text(column: str) -> Column:
    return F.date_format(column, TIME_FORMAT).alias(column)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows cost much to process, dealt evenly to the session's shuffle partitions."""
    return table(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- articles


def articles(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Documents as articles: the title is the first line, one article per hour."""
    return article_rows(spread_table(spark, sf_dir, "documents") if spread else table(spark, sf_dir, "documents"))


def article_rows(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("title_id"),
        F.col("source").alias("source_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("link"),
        F.col("text").alias("summary"),
        F.timestamp_seconds(F.lit(EPOCH) + F.col("doc_id") * 3600).alias("date_captured"),
        F.lit(None).cast("long").alias("cluster_id"),
    )


def topics(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Articles with a topic from arithmetic on the id."""
    return articles(spark, sf_dir, spread).withColumn("cluster_id", F.col("title_id") % 50)


def clustering_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles dealt by their id, so that counts and joins per article need no further shuffle."""
    spread = articles(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "title_id")
    return spread.select(
        "title_id", "title", "summary", F.col("date_captured").alias("published_at")
    )


def topic_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``title_id, anchor_id`` of the arithmetic topics."""
    members = topics(spark, sf_dir).select("title_id", "cluster_id")
    anchors = members.groupBy("cluster_id").agg(F.min("title_id").alias("anchor_id"))
    return members.join(anchors, "cluster_id").select("title_id", "anchor_id")


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored topics; every second one has a score, some times are missing or unreadable."""
    base = topics(spark, sf_dir).groupBy("cluster_id").agg(
        F.min_by("title", "title_id").alias("main_title"),
        F.min("title_id").alias("title_id"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )
    stamp = F.date_format(F.timestamp_seconds(F.lit(EPOCH + 31 * 86400) + F.col("cluster_id") * 3600), TIME_FORMAT)
    return base.select(
        "cluster_id",
        "main_title",
        "title_id",
        "volume",
        F.when(F.col("cluster_id") % 2 == 0, (F.col("cluster_id") * 37 % 200 - 100) / 100.0).alias("score"),
        F.when(F.col("cluster_id") % 10 == 4, F.lit("unknown"))
        .when(F.col("cluster_id") % 10 != 8, stamp)
        .alias("last_updated"),
    )


def clusters_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same topics with readable times, as a score update expects them."""
    return clusters(spark, sf_dir).withColumn(
        "last_updated", F.coalesce(F.try_to_timestamp("last_updated", F.lit(TIME_FORMAT)), as_of())
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word list with valences: distinct words of the benchmark texts, valence by arithmetic."""
    tokens = table(spark, sf_dir, "benchmark").select(F.explode(terms("text")).alias("token")).distinct()
    rule = F.length("token") * 7 + F.ascii(F.substring("token", 1, 1))
    return tokens.filter((rule % 3 == 0) & (F.length("token") > 2)).select(
        "token", ((rule % 41 - 20) / 10.0).alias("valence")
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as extracted records, some without headline or link."""
    return articles(spark, sf_dir).select(
        F.col("source_id").alias("site"),
        F.col("title_id").alias("ingest_seq"),
        F.when(F.col("title_id") % 17 != 0, F.col("title")).alias("headline"),
        F.when(F.col("title_id") % 13 != 0, F.col("link")).alias("link"),
        "summary",
        F.lit("Captured").alias("date"),
    )


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the articles, as a table with unique titles."""
    third = articles(spark, sf_dir).filter(F.col("title_id") % 3 == 0)
    return keep_first(third, ["title"], ["title_id"]).select(*third.columns)


# ---------------------------------------------------------------- sources and pages


def source_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored configuration per document source, ``mapping`` as JSON text."""
    sites = table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    json_site = number % 2 == 0

    def only(condition: Column, value: str) -> Column:
        return F.when(condition, F.lit(value))

    return sites.select(
        F.col("source").alias("site_name"),
        F.concat(F.lit("https://news.example/"), F.col("source"), F.lit("/page-{}")).alias("url_template"),
        (F.col("n") % 13).cast("int").alias("pages"),
        F.when(json_site, F.lit("json_script")).otherwise(F.lit("html_dom")).alias("strategy"),
        only(json_site, "application/ld+json").alias("script_type"),
        only(json_site, "ItemList").alias("schema_type"),
        only(json_site, "itemListElement").alias("array_key"),
        only(json_site, '{"headline":"name","link":"url","summary":"description"}').alias("mapping"),
        only(~json_site, "li").alias("container_tag"),
        only(~json_site & (number % 3 == 0), "card").alias("container_class"),
        only(~json_site, "a").alias("headline_tag"),
        only(~json_site & (number % 5 != 0), "parent").alias("anchor_position"),
        only(~json_site, "p").alias("summary_tag"),
    )


def host() -> Column:
    return F.regexp_extract("url", r"^https?://([^/]+)", 1)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as captured pages of their host."""
    return spread_table(spark, sf_dir, "pages").select(
        host().alias("site"), F.col("page_id").cast("int").alias("page_num"), "html", "url"
    )


def script_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one more script that lists articles; some lists are broken or of another type."""
    number = F.col("page_num")
    n, u = number.cast("string"), F.col("url")
    kind = F.when(number % 7 == 0, F.lit("Thing")).otherwise(F.lit("ItemList"))
    middle = F.when(number % 4 == 0, F.lit("7,")).otherwise(F.lit(""))
    body = F.concat(
        F.lit('{"@type":"'), kind, F.lit('","itemListElement":[{"name":"Lead story '), n, F.lit('","url":"'), u,
        F.lit('","description":"first of page '), n, F.lit('"},{"name":null,"url":"'), u, F.lit('"},'), middle,
        F.lit('{"name":"Late story '), n, F.lit('","description":"last"}]'),
        F.when(number % 11 == 0, F.lit("")).otherwise(F.lit("}")),
    )
    script = F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    return pages(spark, sf_dir).withColumn("html", F.concat(script, F.col("html"))).drop("url")


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one more story card that has an anchor around, inside and at its headline."""
    n = F.col("page_num").cast("string")
    card = F.concat(
        F.lit('<div class="card wide"><a href="/around/'), n, F.lit('"><h2>Big <b>story</b> '), n,
        F.lit('<a href="/inside/'), n, F.lit('"> more</a></h2></a><p>Sum <i>of</i> '), n, F.lit("</p></div>"),
    )
    return pages(spark, sf_dir).withColumn("html", F.concat(card, F.col("html"))).drop("url")


def page_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration per host; the strategy follows from the length of the name."""
    sites = pages(spark, sf_dir).select("site").distinct()
    kind = F.length("site") % 3
    json_site, dom_site = kind == 0, kind == 1
    return sites.select(
        F.col("site").alias("site_name"),
        F.when(json_site, "json_script").when(dom_site, "html_dom").otherwise("unknown").alias("strategy"),
        F.lit("application/ld+json").alias("script_type"),
        F.lit("ItemList").alias("schema_type"),
        F.lit("itemListElement").alias("array_key"),
        F.create_map(
            *[F.lit(x) for x in ("headline", "name", "link", "url", "summary", "description")]
        ).alias("mapping"),
        F.lit("li").alias("container_tag"),
        F.lit(None).cast("string").alias("container_class"),
        F.lit("a").alias("headline_tag"),
        F.lit("self").alias("anchor_position"),
        F.lit("p").alias("summary_tag"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three capture attempts per page, some empty, some refused."""
    tiers = pages(spark, sf_dir).withColumn("tier", F.explode(F.sequence(F.lit(1), F.lit(3))))
    number, tier = F.col("page_num"), F.col("tier")
    html = (
        F.when((tier == 1) & (number % 3 == 0), F.lit(None))
        .when((tier == 1) & (number % 5 == 0), F.lit(""))
        .when((tier == 2) & (number % 6 == 0), F.lit(""))
        .when((tier == 3) & (number % 12 == 0), F.concat(F.lit("<h1>Access Denied</h1>"), F.col("html")))
        .otherwise(F.concat(F.col("html"), F.lit("<!-- tier "), tier.cast("string"), F.lit(" -->")))
    )
    return tiers.select("site", "page_num", "tier", html.alias("html"))


# ---------------------------------------------------------------- prices and plans


def previous_close() -> Column:
    return F.col("value") * (64 + F.col("event_id") % 64) / 64.0


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as price rows; the previous close is arithmetic on the id."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("value").alias("current"),
        previous_close().alias("prev_close"),
    )


def ticker_payloads(events: DataFrame) -> DataFrame:
    """Events as JSON ticker batches of one symbol."""
    rates = F.struct(F.col("value").alias("current"), previous_close().alias("prev_close"))
    body = F.to_json(F.create_map("event_type", rates))
    return events.select(F.col("event_id").alias("seq"), body.alias("body"))


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as price responses; every ninth one lacks the change field."""
    change = F.when(F.col("event_id") % 9 != 0, (F.col("event_id") % 2001 - 1000) / 64.0)
    body = F.to_json(
        F.create_map(
            F.concat_ws("_", "event_type", (F.col("user_id") % 7).cast("string")),
            F.struct((F.col("value") * 1000).alias("usd"), change.alias("usd_24h_change")),
        )
    )
    return table(spark, sf_dir, "events").select("event_id", body.alias("body"))


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("plan_id"),
        (F.col("c_custkey") % 1000).alias("monthly"),
        F.col("c_nationkey").alias("rate_pct"),
        F.lit(10).alias("years"),
    )
