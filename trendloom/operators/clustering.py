"""Greedy topic clustering as an exact parallel fixpoint.

The rule is sequential: an article joins the topic of its most similar earlier article among the topics
whose anchor is within the time gap, or opens a new topic. A label therefore depends on earlier labels
only. The jobs below repeat until no label changes:

* the pairs of articles above the cosine are found once, in different blocks by the block comparison of
  :func:`~trendloom.operators.similarity.cosine_pairs` and inside a block by
  :func:`~trendloom.operators.similarity.block_neighbours`, and stored; in each round every block whose
  neighbours changed label receives the best topic per article by a join of the stored pairs with the
  labels of the last round, so no cosine is computed twice and no term moves again;
* every block whose input changed applies the rule to its own rows in order, on the stored lists.

A block is final once the blocks before it are, so the result equals the sequential one, and the
rounds are bounded by the longest chain of blocks, not of articles. Nothing is capped or sampled: what
leaves a task is one row per article and block pair.

Copies are folded first. Articles with term counts in one proportion have cosine 1, so a later copy joins the
earliest topic in reach that already holds a copy, and no comparison is needed for it. Only one copy per
time cell enters the comparison; the rest is attached by a join, and copies that find no topic in reach
are moved into the comparison until there are none.

Tables of a step lie in a scratch folder and go when the next step has what it needs, so the rounds hold the labels of
two rounds at most. Labels name their topic by id; its title is joined where it is compared.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from trendloom.functions.edit import exceeds
from trendloom.functions.text import ENGLISH_STOP_WORDS, jaccard, levenshtein_similarity, long_levenshtein_similarity
from trendloom.operators import similarity as sim
from trendloom.operators.scratch import Scratch

MIN_LEVENSHTEIN = 0.0  # fixed value of the topic rule
PAYLOAD_BITS = 10  # a payload row holds members of 2**10 consecutive ids

_LABEL = ("label_id", "label_t")


def cluster_articles(
    articles: DataFrame,
    max_hours_gap: int = sim.MAX_HOURS_GAP,
    min_cosine: float = sim.MIN_COSINE,
    min_levenshtein: float = MIN_LEVENSHTEIN,
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    block_rows: int = sim.BLOCK_ROWS,
) -> DataFrame:
    """``title_id, anchor_id`` for every article; an anchor is the first article of its topic.

    Input ``title_id, title, summary, published_at``; the input order is ``title_id``.
    """
    gap = max_hours_gap * 3600
    with Scratch(articles.sparkSession) as scratch:
        vectors = sim.article_vectors(articles, scratch, stop_words)
        titles = vectors.groupBy(F.col("title_id").alias("label_id")).agg(F.min("title_lower").alias("label_title"))
        titles = scratch.keep(titles)
        cell = F.floor(F.col("t") / max(gap // 4, 1))
        compared = vectors.groupBy("sig", cell.alias("cell")).agg(F.min("title_id").alias("title_id"))
        compared = scratch.keep(compared.select("title_id"))
        total = vectors.count()
        while True:
            labels = _solve(
                vectors.join(compared, "title_id"), titles, scratch, gap, min_cosine, min_levenshtein, block_rows
            )
            if compared.count() == total:
                break
            attached = scratch.keep(_attach_copies(vectors, compared, labels, titles, gap, min_levenshtein))
            open_copies = attached.filter("label_id IS NULL")
            first_open = open_copies.filter("NOT rejected").groupBy("sig", cell).agg(F.min("title_id").alias("title_id"))
            moved = first_open.select("title_id").unionByName(open_copies.filter("rejected").select("title_id"))
            moved = scratch.keep(moved)
            if moved.isEmpty():
                labels = labels.select("title_id", "label_id").unionByName(attached.select("title_id", "label_id"))
                break
            before, compared = compared, scratch.keep(compared.unionByName(moved))
            scratch.drop(before, moved, attached, labels)
        return articles.select("title_id").join(labels.select("title_id", "label_id"), "title_id", "left").select(
            "title_id", F.coalesce("label_id", "title_id").alias("anchor_id")
        ).checkpoint()


def _attach_copies(vectors, compared, labels, titles, gap, min_levenshtein) -> DataFrame:
    """Topic of every copy outside the comparison: the earliest one in reach that holds a copy.

    A null ``label_id`` marks a copy without such a topic; ``rejected`` tells that the title check
    refused the topic found.
    """
    holders = (
        labels.join(vectors.select("title_id", "sig"), "title_id")
        .groupBy("sig", *_LABEL)
        .agg(F.min("title_id").alias("first_id"))
        .withColumn(
            "reach",
            F.explode(
                F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.floor(F.col("label_t") / gap) + d)
            ),
        )
    )
    copies = (
        vectors.select("title_id", "t", "title_lower", "sig")
        .join(compared, "title_id", "left_anti")
        .withColumn("reach", F.floor(F.col("t") / gap))
    )
    in_reach = sim.within_gap(sim.gap_seconds(F.col("t"), F.col("label_t")), gap // 3600) & (F.col("first_id") < F.col("title_id"))
    found = (
        copies.join(holders, ["sig", "reach"])
        .filter(in_reach)
        .groupBy("title_id")
        .agg(F.min(F.struct(*_LABEL)).alias("found"))
    )
    found = found.withColumn("label_id", F.col("found.label_id")).join(titles, "label_id").drop("label_id")
    accepted = levenshtein_similarity("title_lower", "label_title") > min_levenshtein
    return copies.join(found, "title_id", "left").select(
        "title_id",
        "t",
        "sig",
        F.when(F.col("found").isNotNull() & accepted, F.col("found.label_id")).alias("label_id"),
        (F.col("found").isNotNull() & ~F.coalesce(accepted, F.lit(False))).alias("rejected"),
    )


def _solve(vectors, titles, scratch, gap, min_cosine, min_levenshtein, block_rows) -> DataFrame:
    """Labels ``title_id, block, label_id, label_t`` of the compared articles."""
    blocked = scratch.keep(sim.assign_blocks(vectors, gap, block_rows))
    # pairs above the cosine, computed once; each round only joins them with new labels
    neighbours = scratch.keep(sim.cosine_pairs(blocked, gap, min_cosine))
    rows = scratch.keep(sim.block_neighbours(blocked, gap, min_cosine))
    scratch.drop(blocked)
    no_input = F.lit(None)
    start = rows.withColumns(
        {"cosine": no_input.cast("double"), "label_id": no_input.cast("long"),
         "label_t": no_input.cast("long"), "label_title": no_input.cast("string")}
    )
    label_blocks = _block_rule(gap, min_cosine, min_levenshtein)
    schema = "title_id long, block long, label_id long, label_t long"
    labels = scratch.keep(start.groupBy("block").applyInPandas(label_blocks, schema))
    changed = labels.select(F.col("block").alias("block_j")).distinct()
    times, stale = rows.select("title_id", "t"), []
    while True:
        touched = scratch.keep(
            neighbours.join(changed, "block_j", "left_semi").select(F.col("block_i").alias("block")).distinct()
        )
        scratch.drop(*stale)
        if touched.isEmpty():
            scratch.drop(neighbours, rows)
            return labels
        offers = (
            neighbours.join(touched.withColumnRenamed("block", "block_i"), "block_i", "left_semi")
            .join(labels.select(F.col("title_id").alias("match_id"), *_LABEL), "match_id")
            .join(times, "title_id")
            .filter(sim.within_gap(sim.gap_seconds(F.col("t"), F.col("label_t")), gap // 3600))
            .select("title_id", "cosine", *_LABEL)
        )
        offered = sim.best_label(offers, _LABEL).join(titles, "label_id")
        inputs = rows.join(touched, "block", "left_semi").join(offered, "title_id", "left")
        again = scratch.keep(inputs.groupBy("block").applyInPandas(label_blocks, schema))
        old = labels.select("title_id", F.col("label_id").alias("old_id"))
        changed = (
            again.join(old, "title_id")
            .filter("label_id <> old_id")
            .select(F.col("block").alias("block_j"))
            .distinct()
        )
        stale = [labels, again, touched]
        labels = scratch.keep(labels.join(touched, "block", "left_anti").unionByName(again))


def _block_rule(gap: int, min_cosine: float, min_levenshtein: float):
    """Apply the topic rule to one block, in order, next to the best offer from other blocks."""

    def label(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place", ignore_index=True)
        near, cosines = block["near"].map(np.asarray).tolist(), block["cosines"].map(np.asarray).tolist()
        ids, times = block["title_id"].to_numpy(), block["t"].to_numpy()
        titles = block["title_lower"].tolist()
        offered = block["cosine"].fillna(0.0).to_numpy()
        offer_ids = block["label_id"].fillna(-1).astype("int64").to_numpy()
        offer_times = block["label_t"].fillna(0).astype("int64").to_numpy()
        label_ids, label_times, label_titles = ids.copy(), times.copy(), list(titles)
        for i in range(len(block)):
            # Candidates ranked by cosine, then by the age of their topic.
            best, chosen = 0.0, None
            if len(near[i]):
                scores = np.where(np.abs(times[i] - label_times[near[i]]) <= gap, cosines[i], 0.0)
                best = scores.max()
                if best > 0:
                    tied = near[i][scores == best]
                    j = tied[label_ids[tied].argmin()]
                    chosen = label_ids[j], label_times[j], label_titles[j]
            if offered[i] > best or (offered[i] == best > 0 and offer_ids[i] < chosen[0]):
                best, chosen = offered[i], (offer_ids[i], offer_times[i], block["label_title"].iat[i])
            if best > min_cosine and exceeds(chosen[2], titles[i], min_levenshtein):
                label_ids[i], label_times[i], label_titles[i] = chosen
        return pd.DataFrame(
            {
                "title_id": ids, "block": block["block"], "label_id": label_ids, "label_t": label_times,
            }
        )

    return label


# ---------------------------------------------------------------- measures of finished topics


def measure_members(articles: DataFrame, members: DataFrame) -> DataFrame:
    """Every member next to the first title of its topic, with both title similarities, two places."""
    facts = members.join(articles, "title_id")
    # Few topics make a small table, so that no task gets all members of a topic by a shuffle on it.
    used = articles.join(members.select(F.col("anchor_id").alias("title_id")).distinct(), "title_id", "left_semi")
    anchors = used.select(F.col("title_id").alias("anchor_id"), F.col("title").alias("main_title"))
    # Whatever the joins were, the distances are computed on rows dealt out evenly.
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paired = facts.join(anchors, "anchor_id").select("anchor_id", "main_title", "title_id", "title", "published_at")
    return paired.repartition(tasks, "title_id").select(
        "anchor_id",
        "main_title",
        "title_id",
        F.col("title").alias("headline_text"),
        "published_at",
        F.round(long_levenshtein_similarity("main_title", "title"), 2).alias("levenshtein_similarity"),
        F.round(jaccard("main_title", "title"), 2).alias("jaccard_similarity"),
    )


def _mean_of_hundredths(column: str):
    """Mean of two-place values, two places; summed as whole numbers, so the order does not matter."""
    return F.round(F.sum(F.round(F.col(column) * 100).cast("long")) / (F.count(F.lit(1)) * 100), 2)


def cluster_averages(measured: DataFrame) -> DataFrame:
    """One row per topic: title, volume, latest time and mean similarities of the rounded values."""
    return measured.groupBy("anchor_id", "main_title").agg(
        _mean_of_hundredths("levenshtein_similarity").alias("avg_levenshtein"),
        _mean_of_hundredths("jaccard_similarity").alias("avg_jaccard"),
        F.count(F.lit(1)).cast("double").alias("volume"),
        F.max("published_at").alias("latest_update_time"),
    )


def cluster_report(measured: DataFrame) -> DataFrame:
    """The nested report: topic columns and the member payload in member order.

    A topic can hold any number of members, so its payload comes in rows of bounded size: ``part``
    numbers ranges of ids, and reading the parts in order gives the whole payload.
    """
    parts = (
        measured.withColumn("part", F.shiftright("title_id", PAYLOAD_BITS))
        .groupBy("anchor_id", "part")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("title_id").alias("db_serial_number"),
                        "headline_text",
                        F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_time"),
                        F.struct("levenshtein_similarity", "jaccard_similarity").alias("raw_metrics"),
                    )
                )
            ).alias("metrics_payload")
        )
    )
    topics = measured.groupBy("anchor_id", F.col("main_title").alias("cluster_master")).agg(
        F.count(F.lit(1)).alias("volume_count"),
        F.date_format(F.max("published_at"), "yyyy-MM-dd HH:mm:ss").alias("latest_update_time"),
    )
    return parts.join(topics, "anchor_id").select(
        F.col("anchor_id").alias("cluster_anchor_db_id"),
        "cluster_master",
        "volume_count",
        "latest_update_time",
        "part",
        "metrics_payload",
    )
