"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(app: str = "tamarind", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": str(cores) if cores.isdigit() else "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where the session names none and runs on this machine alone is a local
    folder chosen and recorded in the session. On a cluster that is an error:
    each executor would write to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tamarind-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of whatever file system ``path`` names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go as soon as it has ended.

    Otherwise they stay on the executors' disks until the driver happens to
    collect its garbage, so that a job of many large steps holds those of all.
    """
    former = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if former is None else spark.conf.set(_SHUFFLE_CLEANUP, former)


def cut_lineage(df, label: str = "stage", path: str | None = None):
    """Write ``df`` to the shared folder and read it back; to ``path`` if the
    caller deletes it once nothing reads it any more.

    The files outlive lost executors, and every later reader sees the same
    rows and the same partition boundaries.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
