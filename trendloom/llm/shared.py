"""Helpers of the operators: tables written in the shared folder, and common text expressions."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.session import ensure_checkpoint_dir

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def written(df: DataFrame, tasks: int | None = None, compression: str | None = None) -> DataFrame:
    """Write the rows to the folder that all executors share and read them again.

    What follows depends on the files only, and Spark knows their size when it chooses joins. At most
    ``tasks`` tasks write, for tables whose many partitions would be as many tiny files. ``compression``
    is a Parquet codec in place of the session's.
    """
    spark = df.sparkSession
    df = df.coalesce(tasks) if tasks else df
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame) -> DataFrame:
    """Compute the rows once and keep them in memory and on the executors' disks.

    What an executor loses is computed again from where it came from. The caller ends it with ``unpersist``.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


def row_name(doc_id: Column) -> Column:
    """The id as text, empty for null, so that rows without an id can be joined as well."""
    return F.coalesce(doc_id.cast("bigint").cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, LOWER)
