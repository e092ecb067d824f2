"""Intermediate tables of one job, kept in the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tamarind.session import scratch_path

#: Set while a table is written. Batches that go to Python are bounded by bytes,
#: as rows may be of any length; shuffle files are given up after the write.
DURING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` in the session's settings, put back at the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class Workspace:
    """Writes intermediate tables and deletes those that are no longer read.

    A written table outlives lost executors and cuts the lineage of what
    follows. Shuffle files of a write are given up as soon as it has ended,
    because nothing reads them again.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self._paths: set[str] = set()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        with settings(self.spark, DURING):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths.add(path)
        out._workspace_path = path
        return out

    def only(self, df: DataFrame, name: str) -> DataFrame:
        """Keeps ``df`` and deletes all other tables of this workspace."""
        before = list(self._paths)
        out = self.keep(df, name)
        for path in before:
            self._delete(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that :meth:`keep` returned; they can't be read any more."""
        for df in tables:
            self._delete(df._workspace_path)

    def _delete(self, path: str) -> None:
        if path in self._paths:
            self._paths.remove(path)
            delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system, whatever its scheme."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
