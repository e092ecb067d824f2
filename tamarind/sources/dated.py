"""Dated tables whose partitions are replaced all at once or not at all.

Rows of a write lie in a folder of their own (``load=<id>/create_date=<date>``).
A manifest, a small file that is created once and never changed, says for every
partition which load holds it; readers follow the newest one. A write becomes
visible by its manifest alone, after all its files are there: a job that fails
leaves the former rows, and a job may read the table it is about to replace.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tamarind.session import delete_path

MANIFESTS = "_manifests"  # Spark passes over names that begin with an underscore
TRIES = 20


class DatedTable:
    """A table below ``path``, in partitions of the columns ``by``."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = ("create_date",)):
        self.spark, self.path, self.by = spark, path.rstrip("/"), list(by)
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, *below: str) -> list[str]:
        """Names in a folder, none if it isn't there."""
        at = self._hadoop.Path("/".join((self.path, *below)))
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _read(self, number: str) -> dict[str, str] | None:
        """A manifest: partition to load. None if its writer hasn't come to its end."""
        stream = self._fs.open(self._hadoop.Path(f"{self.path}/{MANIFESTS}/{number}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def state(self) -> tuple[int, dict[str, str]]:
        """Number of the newest manifest and the content of the newest whole one; 0 and nothing if there is none.

        A manifest that isn't whole belongs to a writer between creating and
        closing it: it is waited for, and passed over if it stays so.
        """
        for patience in reversed(range(TRIES)):
            numbers = [n for n in self._names(MANIFESTS) if n.isdigit()]
            found = self._read(numbers[-1]) if numbers else {}
            if found is not None:
                return int(numbers[-1]) if numbers else 0, found
            if patience:
                time.sleep(0.1)
        whole = (x for n in reversed(numbers[:-1]) if (x := self._read(n)) is not None)
        return int(numbers[-1]), next(whole, {})

    def _commit(self, number: int, content: dict[str, str]) -> bool:
        """Creates a manifest; False if another writer has been faster."""
        try:
            stream = self._fs.create(self._hadoop.Path(f"{self.path}/{MANIFESTS}/{number:08d}"), False)
        except Exception as error:  # noqa: BLE001  (py4j wraps what the file system throws)
            if "AlreadyExists" in str(error):
                return False
            raise
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        return True

    def replace(self, rows: DataFrame, clear: Iterable[str] = (), rows_per_file: int = 0) -> None:
        """Replaces the partitions that ``rows`` hold, and empties those of ``clear``
        (as ``create_date=2021-05-01``) that they don't hold.

        Rows of a partition are written by the tasks that hold them; no partition
        is gathered in one task. Loads that neither the new manifest nor the one
        before it names are deleted, so a reader of the former state can finish.
        """
        load = f"load={uuid.uuid4().hex}"
        try:
            rows.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*self.by).parquet(f"{self.path}/{load}")
        except BaseException:
            delete_path(self.spark, f"{self.path}/{load}")
            raise
        held = self._partitions(load, len(self.by))
        if not held:
            delete_path(self.spark, f"{self.path}/{load}")
        for _ in range(TRIES):
            number, before = self.state()
            after = {p: x for p, x in before.items() if p not in set(clear)} | dict.fromkeys(held, load)
            if self._commit(number + 1, after):
                self._tidy({*before.values(), *after.values()})
                return
        raise RuntimeError(f"{self.path}: other writers were faster {TRIES} times")

    def _partitions(self, folder: str, depth: int) -> list[str]:
        if depth == 0:
            return [folder.split("/", 1)[1]]
        return [p for n in self._names(folder) if "=" in n for p in self._partitions(f"{folder}/{n}", depth - 1)]

    def _tidy(self, keep: set[str]) -> None:
        """Deletes loads that were in a manifest and are in none of the last two; a
        load that no manifest has named yet may belong to a writer at work."""
        numbers = [n for n in self._names(MANIFESTS) if n.isdigit()]
        for number in numbers[:-2]:
            for load in set((self._read(number) or {}).values()) - keep:
                delete_path(self.spark, f"{self.path}/{load}")
            delete_path(self.spark, f"{self.path}/{MANIFESTS}/{number}")

    def read(self, schema: StructType) -> DataFrame:
        """The rows of the newest state, one scan whatever the number of loads."""
        _, now = self.state()
        if not now:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{load}/{partition}" for partition, load in sorted(now.items())]
        kinds = {f.name: f.dataType for f in schema.fields}
        found = self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        return found.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in schema.names])
