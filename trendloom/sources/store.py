"""Stored tables that only grow.

A table is a Parquet folder with one partition per run. A run is what one batch of one job writes; it is
written with Spark's own commit and dynamic partition overwrite, so a run that is repeated replaces its own
rows and nothing else. No job rewrites what another one wrote: what is open, linked, current or dead follows
from the appended rows (see ``plans/jobs.py``). Each table has one job that writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RUN = "run"


class TableStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{table}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, table: str, schema: T.StructType, without_run: str | None = None) -> DataFrame:
        """Rows of a table, ``run`` included; no rows if it was never written.

        ``without_run`` leaves out what that run wrote before, so a repeated run sees what it saw first.
        """
        full = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
        if not self._exists(table):
            return self.spark.createDataFrame([], full)
        rows = self.spark.read.schema(full).parquet(f"{self.base}/{table}")
        return rows if without_run is None else rows.where(F.col(RUN) != without_run)

    def write(self, table: str, rows: DataFrame, run: str) -> None:
        """Write what ``run`` adds to a table; an earlier attempt of the same run is replaced."""
        (
            rows.withColumn(RUN, F.lit(run)).write.mode("overwrite").option("compression", "zstd")
            .option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(f"{self.base}/{table}")
        )
