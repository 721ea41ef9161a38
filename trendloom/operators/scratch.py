"""Tables that a job needs only while it runs.

A job of many steps would leave the shuffle files and checkpoints of every step on disk until the driver's JVM
happens to collect garbage. Here each step is written compressed below the shared checkpoint folder, its shuffle
files go as soon as it is written, and the job deletes the table once no step reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trendloom.session import ensure_checkpoint_dir

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables below a folder of its own, which goes at the end of the ``with`` block.

    Frames that are still lazy when the block ends must not read these tables: checkpoint results first.
    Inside the block the session releases the shuffle files of each finished action.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._paths = spark, {}
        self._base = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        self._before = self.spark.conf.get(_RELEASE, None)
        self.spark.conf.set(_RELEASE, "true")
        return self

    def __exit__(self, *error) -> None:
        if self._before is None:
            self.spark.conf.unset(_RELEASE)
        else:
            self.spark.conf.set(_RELEASE, self._before)
        self._delete(self._base)

    def keep(self, rows: DataFrame) -> DataFrame:
        """The rows, written once."""
        path = f"{self._base}/{len(self._paths)}"
        rows.write.option("compression", "zstd").parquet(path)
        kept = self.spark.read.schema(rows.schema).parquet(path)
        self._paths[len(self._paths)] = (kept, path)
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that :meth:`keep` gave and that no step reads any more."""
        for kept, path in self._paths.values():
            if any(kept is table for table in tables):
                self._delete(path)

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
