"""Connected components as joins, for links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.shared import cores, written


def components(links: DataFrame, tasks: int | None = None) -> DataFrame:
    """(node, component) for all ends of ``links(a, b)``; a component's name is its smallest node.

    Each round takes the smallest name among a node and its neighbours, then the name that this name
    itself has, so long chains shrink quickly. Every round is written to the shared folder, by ``tasks``
    tasks; links are narrow, so a third of the cores is enough if no number is given.
    """
    pairs = links.select("a", "b").where("a <> b")
    tasks = tasks or max(1, cores(links) // 3)
    both = written(pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), tasks)
    named = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component"))
    while True:
        near = (
            both.join(named.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        hooked = named.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        higher = named.select(F.col("node").alias("component"), F.col("component").alias("higher"))
        after = written(
            hooked.join(higher, "component", "left")
            .select("node", "before", F.least("component", F.coalesce("higher", "component")).alias("component")),
            tasks,
        )
        named = after.select("node", "component")
        if after.where("before <> component").isEmpty():
            return named
