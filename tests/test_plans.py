"""What the plans must look like, not what they compute."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from trendloom import schemas
from trendloom.operators import clean, similarity
from trendloom.operators.sentiment import compound_sentiment
from trendloom.operators.tables import latest_ticks, new_articles
from trendloom.sources import articles as article_scans
from trendloom.sources import samples
from trendloom.sources.pages import resolve_attempts


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_unassigned_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "articles")
    spark.createDataFrame([], schemas.ARTICLES).write.parquet(path)
    text = plan(article_scans.scan_articles(spark.read.parquet(path)).select("title_id"))
    assert "PushedFilters: [IsNull(cluster_id)]" in text
    assert "ReadSchema: struct<title_id:bigint,cluster_id:bigint>" in text


def below_first_exchange(df):
    """The part of the physical plan that reads the input, up to the first shuffle."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    deepest = max((k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line), key=lambda k: lines[k].index("Exchange"))
    return "\n".join(lines[deepest:])


def test_attempts_and_ticks_are_not_sorted_before_the_shuffle(spark, sf_dir):
    attempts = resolve_attempts(samples.attempts(spark, sf_dir))
    ticks = latest_ticks(samples.ticks(spark, sf_dir), "event_id")
    for df in (attempts, ticks):
        assert "Sort" not in below_first_exchange(df)


def test_numbering_new_articles_has_no_window(spark, sf_dir):
    new = new_articles(samples.stored_articles(spark, sf_dir), samples.records(spark, sf_dir), samples.as_of())
    assert "Window" not in plan(new)


def test_headline_dedup_is_combined_before_the_shuffle(spark, sf_dir):
    text = plan(clean.first_headlines(samples.records(spark, sf_dir)))
    assert "partial_min_by" in text and "Window" not in text


def test_term_counts_are_shuffled_once(spark, sf_dir):
    weights = similarity.tfidf_raw(samples.clustering_input(spark, sf_dir))
    weights.collect()
    assert "ReusedExchange" in weights._jdf.queryExecution().executedPlan().toString()


def test_lexicon_is_broadcast_only_below_the_threshold(spark, sf_dir):
    texts, lexicon = samples.articles(spark, sf_dir), samples.lexicon(spark, sf_dir)
    small = compound_sentiment(texts, lexicon, text="summary")
    assert "BroadcastHashJoin" in plan(small)
    expected = sorted(small.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = compound_sentiment(texts, lexicon, text="summary")
        assert "SortMergeJoin" in plan(large) and sorted(large.collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_blocks_stay_bounded_in_a_hot_hour(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("title_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 3600).alias("t")
    )
    blocked = similarity.assign_blocks(rows, 72 * 3600, block_rows=100)
    sizes = [r["count"] for r in blocked.groupBy("block").count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == 5000


def test_block_pairs_cover_every_pair_in_reach(spark):
    gap = 1000
    rows = spark.range(300).select(F.col("id").alias("title_id"), (F.col("id") * 7919 % 20011).alias("t"))
    blocked = similarity.assign_blocks(rows, gap, block_rows=7).cache()
    pairs = {(r.block_i, r.block_j): r for r in similarity.block_pairs(blocked, gap).collect()}
    facts = [(r.title_id, r.t, r.block) for r in blocked.collect()]
    for i, ti, bi in facts:
        for j, tj, bj in facts:
            if j < i and abs(ti - tj) <= 2 * gap:
                pair = pairs[bi, bj]
                assert pair.i_from <= ti <= pair.i_to and pair.j_from <= tj <= pair.j_to


def test_term_lists_are_made_after_the_shuffle(spark, sf_dir):
    plan = similarity.tfidf_vectors(samples.clustering_input(spark, sf_dir))._jdf.queryExecution().sparkPlan().toString()
    lines = plan.splitlines()
    dealt = next(i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line)
    assert all(i < dealt for i, line in enumerate(lines) if "collect_list" in line)
    assert "raw" not in lines[dealt + 1]
