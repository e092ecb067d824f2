"""Stored models with versions and stages, kept in a small table."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.ml.together import together

SCHEMA = "name string, version long, stage string, kind string, path string, metrics map<string,double>"
STAGING, PRODUCTION, ARCHIVED, NONE = "Staging", "Production", "Archived", "None"
PARTS = ("data_preprocess", "ml_model", "bias_adj_model")


def promote_newest(entries: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Stages after the newest version of each name moves to Staging: older
    versions that are neither in Production nor archived become Archived."""
    newest = entries.groupBy("name").agg(F.max("version").alias("__newest"))
    is_new = F.col("version") == F.col("__newest")
    stage = F.when(is_new, F.lit(STAGING)).when(
        F.coalesce("stage", F.lit(NONE)).isin(PRODUCTION, ARCHIVED), F.col("stage")
    ).otherwise(F.lit(ARCHIVED))
    if names is not None:
        stage = F.when(F.col("name").isin(names), stage).otherwise(F.col("stage"))
    return entries.join(newest, "name").withColumn("stage", stage).select(*entries.columns)


class ModelRegistry:
    """Models below one shared folder. Each change writes a whole new state of
    the (small) table; readers take the newest state."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._states = os.path.join(root, "registry")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._states)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _state(self) -> int:
        """Number of the newest complete state, 0 if there is none."""
        path, fs = self._fs()
        if not fs.exists(path):
            return 0
        done = [
            s.getPath()
            for s in fs.listStatus(path)
            if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        ]
        return max([int(p.getName().removeprefix("state=")) for p in done], default=0)

    def entries(self) -> DataFrame:
        n = self._state()
        if n == 0:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(os.path.join(self._states, f"state={n}"))

    def _save(self, entries: DataFrame) -> None:
        path = os.path.join(self._states, f"state={self._state() + 1}")
        entries.coalesce(1).write.mode("overwrite").parquet(path)

    def register(self, name: str, model, kind: str, metrics: dict[str, float] | None = None) -> int:
        """Store a model as the next version of ``name``."""
        return self.register_all([(name, model, kind, metrics)])[0]

    def register_all(self, models: Sequence[tuple]) -> list[int]:
        """Store (name, model, kind, metrics) as the next version of each name; the versions.

        The models are written side by side; the table gets one new state.
        """
        names = [m[0] for m in models]
        if len(set(names)) < len(names):
            raise ValueError("a name is registered twice")
        now = self.entries()
        last = {r["name"]: r["last"] for r in now.where(F.col("name").isin(names)).groupBy("name").agg(F.max("version").alias("last")).collect()}
        versions = [last.get(n, 0) + 1 for n in names]
        paths = [os.path.join(self.root, "models", n, f"v{v}") for n, v in zip(names, versions)]
        together(self.spark, {p: partial(m[1].write().overwrite().save, p) for p, m in zip(paths, models)})
        rows = [
            (name, version, NONE, kind, path, {k: float(v) for k, v in (metrics or {}).items()})
            for (name, _, kind, metrics), version, path in zip(models, versions, paths)
        ]
        self._save(now.unionByName(self.spark.createDataFrame(rows, SCHEMA)))
        return versions

    def promote(self, names: list[str]) -> None:
        self._save(promote_newest(self.entries(), names))

    def set_stage(self, name: str, version: int, stage: str) -> None:
        self.set_stages([(name, version, stage)])

    def set_stages(self, changes: Sequence[tuple[str, int, str]]) -> None:
        """Sets the stage of each (name, version, stage), in one new state."""
        after = F.col("stage")
        for name, version, stage in changes:
            after = F.when((F.col("name") == name) & (F.col("version") == version), F.lit(stage)).otherwise(after)
        self._save(self.entries().withColumn("stage", after))

    def find(self, name: str, stage: str | None = None, version: int | None = None):
        """The row of a pinned version, or of the newest one in a stage."""
        rows = self.entries().where(F.col("name") == name)
        if version is not None:
            rows = rows.where(F.col("version") == int(version))
        else:
            rows = rows.where(F.lower("stage") == (stage or STAGING).lower())
        row = rows.orderBy(F.col("version").desc()).first()
        if row is None:
            raise LookupError(f"no model {name!r} in stage {stage!r}, version {version!r}")
        return row

    def load(self, name: str, stage: str | None = None, version: int | None = None):
        """(model, version)."""
        from pyspark.ml import PipelineModel
        from pyspark.ml.classification import GBTClassificationModel
        from pyspark.ml.regression import GBTRegressionModel, LinearRegression

        kinds = {
            "PipelineModel": PipelineModel,
            "GBTClassificationModel": GBTClassificationModel,
            "GBTRegressionModel": GBTRegressionModel,
            "LinearRegression": LinearRegression,
        }
        row = self.find(name, stage, version)
        return kinds[row["kind"]].load(row["path"]), row["version"]

    def load_segment(self, segment: str, stage: str = STAGING, suffix: str = "", version: int | None = None) -> dict:
        """The three parts of a segment's model, each with its version."""
        return together(self.spark, {p: partial(self.load, f"{segment}_{p}{suffix}", stage, version) for p in PARTS})
