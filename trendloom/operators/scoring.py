"""Topic scores: grouping, mean sentiment and cohesion, surge, decay, liveness, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions import scores as S
from trendloom.operators.clustering import PAYLOAD_BITS
from trendloom.operators.ordering import with_ordinal
from trendloom.operators.sentiment import compound_sentiment

# Fixed value: cohesion of members read from the article table.
STORED_JACCARD = 1.0


def cluster_members(articles: DataFrame) -> DataFrame:
    """Members of stored topics, one row each: the flat form of the scoring input."""
    return articles.filter(F.col("cluster_id").isNotNull()).select(
        "cluster_id",
        "title_id",
        F.col("title").alias("headline_text"),
        F.col("summary").alias("summary_text"),
        F.lit(STORED_JACCARD).alias("jaccard_similarity"),
    )


def cluster_payloads(members: DataFrame) -> DataFrame:
    """The nested scoring input, ordered by topic.

    As in the cluster report, the payload of a topic comes in ``part`` rows of bounded size.
    """
    volumes = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("volume_count"))
    parts = (
        members.withColumn("part", F.shiftright("title_id", PAYLOAD_BITS))
        .groupBy("cluster_id", "part")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("title_id").alias("db_serial_number"),
                        "headline_text",
                        "summary_text",
                        F.struct("jaccard_similarity").alias("raw_metrics"),
                    )
                )
            ).alias("metrics_payload")
        )
    )
    return parts.join(volumes, "cluster_id").select(
        "cluster_id", "volume_count", "part", "metrics_payload"
    ).orderBy("cluster_id", "part")


def payload_members(payloads: DataFrame) -> DataFrame:
    """Flat members of nested payloads, whatever produced them."""
    return payloads.select("cluster_id", F.explode("metrics_payload").alias("m")).select(
        "cluster_id",
        F.col("m.db_serial_number").alias("title_id"),
        F.col("m.headline_text").alias("headline_text"),
        F.col("m.summary_text").alias("summary_text"),
        F.col("m.raw_metrics.jaccard_similarity").alias("jaccard_similarity"),
    )


def with_stored_similarity(members: DataFrame, measured: DataFrame) -> DataFrame:
    """Option: use the measured member cohesion instead of the constant."""
    return members.drop("jaccard_similarity").join(
        measured.select("title_id", "jaccard_similarity"), "title_id", "left"
    ).fillna({"jaccard_similarity": STORED_JACCARD})


def _exact_mean(column: str, digits: int) -> Column:
    """Mean of values with few places, summed as whole numbers so that the order does not matter."""
    unit = 10**digits
    return F.sum(F.round(F.col(column) * unit).cast("long")) / (F.count(column) * unit)


def topic_cohesion(members: DataFrame) -> DataFrame:
    """Mean Jaccard per topic, 1.0 if no member has one."""
    return members.groupBy("cluster_id").agg(
        F.coalesce(_exact_mean("jaccard_similarity", 6), F.lit(1.0)).alias("avg_jaccard")
    )


def member_sentiment(members: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``title_id, compound`` on the summary, or the title where there is none."""
    texts = members.select("title_id", S.sentiment_text("summary_text", "headline_text").alias("text"))
    return compound_sentiment(texts, lexicon)


def topic_sentiment(members: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Mean member sentiment per topic, 0.0 if there is none."""
    scored = members.select("cluster_id", "title_id").join(member_sentiment(members, lexicon), "title_id")
    return scored.groupBy("cluster_id").agg(
        F.coalesce(_exact_mean("compound", 4), F.lit(0.0)).alias("avg_sentiment")
    )


def topic_measures(members: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``cluster_id, volume, avg_jaccard, avg_sentiment`` from one pass over the members."""
    return measures_from_sentiment(members, member_sentiment(members, lexicon))


def measures_from_sentiment(members: DataFrame, compound: DataFrame) -> DataFrame:
    """The measures from sentiments that are known already; no text is read."""
    return (
        members.select("cluster_id", "title_id", "jaccard_similarity")
        .join(compound, "title_id")
        .groupBy("cluster_id")
        .agg(
            F.count(F.lit(1)).alias("volume"),
            F.coalesce(_exact_mean("jaccard_similarity", 6), F.lit(1.0)).alias("avg_jaccard"),
            F.coalesce(_exact_mean("compound", 4), F.lit(0.0)).alias("avg_sentiment"),
        )
    )


def with_history(measures: DataFrame, history: DataFrame) -> DataFrame:
    """Stored score and time next to the measures; null for a topic without history."""
    return measures.join(history.select("cluster_id", "score", "last_evaluated_at"), "cluster_id", "left")


def with_final(measures: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """The measures with ``final``: the decayed stored score and the new energy, held within [-1, 1]."""
    base = F.coalesce(S.decayed("score", "last_evaluated_at", as_of), F.lit(0.0))
    energy = S.surge("avg_sentiment", "volume", "avg_jaccard")
    return with_history(measures, history).withColumn("final", S.clamp_unit(base + energy))


def score_actions(measures: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """One action per topic: the new score, or its removal once the score has faded."""
    final = with_final(measures, history, as_of)
    dead = S.is_dead("final")
    return final.select(
        "cluster_id",
        F.when(dead, F.lit(0.0)).otherwise(F.round("final", 4)).alias("calculated_score"),
        F.round("avg_sentiment", 4).alias("avg_sentiment"),
        F.round("avg_jaccard", 4).alias("avg_jaccard"),
        as_of.alias("evaluated_at"),
        F.when(dead, F.lit("DELETE")).otherwise(F.lit("UPSERT")).alias("action"),
    )


def evaluate_topics(members: DataFrame, lexicon: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """The whole scoring job on flat members."""
    return score_actions(topic_measures(members, lexicon), history, as_of)


def ranked_topics(clusters: DataFrame, articles: DataFrame, order: str = "magnitude", limit: int | None = None) -> DataFrame:
    """Ranked view of the scored topics with the summary of their anchor article.

    ``order``: ``magnitude`` sorts by absolute score, ``score`` by the signed one; both descending on
    four places, ties by id. Ranks are counted per score level, so no task sorts all topics; ``limit``
    gives a top-k report.
    """
    strength = F.round(F.abs("score") if order == "magnitude" else F.col("score"), 4)
    scored = clusters.filter(F.col("score").isNotNull()).withColumn("_falling", -strength)
    if limit is not None:
        scored = scored.orderBy("_falling", "cluster_id").limit(limit)
    label = (
        F.when(F.col("avg_sentiment") > 0, F.lit("Positive"))
        .when(F.col("avg_sentiment") < 0, F.lit("Negative"))
        .otherwise(F.lit("Neutral"))
    )
    ranked = with_ordinal(scored, "cluster_id", ["_falling"], "rank")
    return ranked.join(articles.select("title_id", "summary"), "title_id", "left").select(
        "rank", "cluster_id", "main_title", "summary", "score", "volume", "avg_jaccard", "avg_sentiment",
        label.alias("sentiment_label"), "last_updated",
    )
