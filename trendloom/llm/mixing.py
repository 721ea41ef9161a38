"""Mix sources to target weights by hash thresholds, with built-in functions only.

Every document has a fixed hash of its id. Words are summed by source and hash bucket; the running sums
show in which bucket a source's budget ends. Only that bucket is looked at again, with the next bits of
the hash, until all bits are used. A document is taken if its hash is below its source's threshold, so no
row is sorted, a rerun agrees, and the mix for a smaller budget is part of the mix for a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendloom.llm.shared import WORD, cores, written

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
# Bits of the hash looked at in each step, 32 together.
LEVELS = (12, 10, 10)


def document_hash(doc_id: Column) -> Column:
    """32 bits from the document's id."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("mix"), doc_id.cast("string"))), 1, 8), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h) of every row."""
    return docs.select(
        F.col("doc_id").cast("bigint"), F.col("source").cast("string"),
        word_count(F.col("text").cast("string")).alias("size"), document_hash(F.col("doc_id")).alias("h"),
    )


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) with one row per source.

    Sources in code point order, null last, get the weights in turn and share all words by weight. A
    source's target stops at ``most`` times its size. In the order of that limit per weight, the
    sources whose share would pass it come first; the rest shares what they leave.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    table = sizes.select("source", "source_size", weight.alias("weight")).withColumns({
        "cap": F.col("source_size") * most, "total": F.sum("source_size").over(everything),
        "weights": F.sum("weight").over(everything),
    })
    earlier = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    table = table.withColumns({
        "caps_before": F.coalesce(F.sum("cap").over(earlier), F.lit(0)),
        "weights_before": F.coalesce(F.sum("weight").over(earlier), F.lit(0)),
    })
    over = (F.col("total") - F.col("caps_before")).cast("double") * F.col("weight") > F.col("cap").cast("double") * (
        F.col("weights") - F.col("weights_before")
    )
    table = table.withColumn("capped", over)
    left = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    sharing = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * left).cast("double") / sharing
    )
    return table.select("source", "source_size", target.alias("target"))


def mix_plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target, whole, cut), one row per source: take each document ``whole`` times, and once more if its hash is below ``cut``.

    ``rows`` is the result of ``sized``, best from a written table. The hash where the budget ends is
    included if that comes nearer to the target.
    """
    plan = source_targets(rows, weights, most).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    )
    plan = written(plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), cores(rows))
    # (source, prefix, rest): the budget ends among hashes that start with prefix; rest is left there.
    edge = plan.where("budget > 0").select(F.col("source").alias("edge_source"), F.lit(0).cast("bigint").alias("prefix"), F.col("budget").alias("rest"))
    used = 0
    for bits in LEVELS:
        shift = 32 - used - bits
        inside = rows.join(edge, rows["source"].eqNullSafe(edge["edge_source"]) & (F.shiftright(rows["h"], 32 - used) == edge["prefix"]))
        sums = inside.groupBy("edge_source", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.first("rest").alias("rest")
        )
        upto = Window.partitionBy("edge_source").orderBy("bucket")
        sums = sums.withColumn("through", F.sum("words").over(upto))
        sums = sums.withColumn("before", F.col("through") - F.col("words"))
        edge = written(
            sums.where("before < rest and through >= rest")
            .select("edge_source", F.col("bucket").alias("prefix"), (F.col("rest") - F.col("before")).alias("rest"), "words"),
            cores(rows),
        )
        used += bits
    nearer = F.when(F.col("words") - F.col("rest") < F.col("rest"), 1).otherwise(0)
    cuts = edge.select("edge_source", (F.col("prefix") + nearer).alias("cut"))
    return written(
        plan.join(cuts, plan["source"].eqNullSafe(cuts["edge_source"]), "left")
        .select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut")),
        cores(rows),
    )


def taken_times(plan_whole: Column, plan_cut: Column, h: Column) -> Column:
    """How many times the mix takes a document."""
    return plan_whole + F.when(h < plan_cut, 1).otherwise(0)


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted).

    Uses ``doc_id``, ``text`` and ``source`` only. A null text has size 0; null is a source of its own
    and comes last. Rows with the same id are taken or left together. Without words every target is 0.
    An empty table gives no rows.
    """
    rows = written(sized(docs))
    plan = mix_plan(rows, weights, most).withColumnRenamed("source", "plan_source")
    return rows.join(plan, rows["source"].eqNullSafe(plan["plan_source"])).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * taken_times(F.col("whole"), F.col("cut"), F.col("h"))).alias("taken"),
    )


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as many times as it is taken."""
    plan = mix_plan(written(sized(docs)), weights, most).select(
        F.col("source").alias("_mix_source"), F.col("whole").alias("_mix_whole"), F.col("cut").alias("_mix_cut")
    )
    times = taken_times(F.col("_mix_whole"), F.col("_mix_cut"), document_hash(docs["doc_id"]))
    return (
        docs.join(plan, docs["source"].cast("string").eqNullSafe(plan["_mix_source"]))
        .withColumn("_mix_time", F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("bigint"), times))))
        .select(*docs.columns)
    )
