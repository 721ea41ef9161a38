"""First-row selection and row numbering without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trendloom.session import ensure_checkpoint_dir


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in ``order``.

    ``min_by`` is combined before the shuffle, so a key that holds a third of all rows sends one row
    per input task; a ``row_number`` window would sort all of them in a single task.
    """
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key in ``order``; see :func:`keep_first`."""
    return _pick(df, keys, order, F.max_by)


def _pick(df, keys, order, pick) -> DataFrame:
    payload = [name for name in df.columns if name not in keys]
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    picked = df.groupBy(*keys).agg(pick(F.struct(*payload), position).alias("_row"))
    return picked.select(
        *[F.col(name) if name in keys else F.col(f"_row.`{name}`").alias(name) for name in df.columns]
    )


def with_ordinal(
    df: DataFrame, seq: str, order_by: Sequence[str] = (), name: str = "ordinal"
) -> DataFrame:
    """Number the rows 1, 2, ... in the order ``(*order_by, seq)``; ``seq`` is unique within ``order_by``.

    The rows are dealt out by ranges of that order and written with their place in their range. Each range
    then begins where those before it end. One number per range comes to the driver, never a row.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = [*order_by, seq]
    # The place is the range's number in the upper bits and a count from 0 in the lower 33.
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    )
    sizes = placed.groupBy(F.shiftright("_place", 33).alias("_range")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, before = [], 0
    for r in sorted(sizes):
        starts.append((r["_range"], before))
        before += r["n"]
    table = spark.createDataFrame(starts, "_range long, _start long")
    within = F.col("_place") - F.shiftleft(F.col("_range"), 33)
    return (
        placed.withColumn("_range", F.shiftright("_place", 33)).join(table, "_range")
        .withColumn(name, F.col("_start") + within + 1)
        .select(*df.columns, name)
    )
