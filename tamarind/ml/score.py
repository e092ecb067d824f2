"""Scoring with registered models."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.ml import learners
from tamarind.ml.registry import STAGING, ModelRegistry
from tamarind.ml.segments import MODEL_VERSION, SEGMENTS, spec
from tamarind.ml.split import COHORT_SLICES
from tamarind.ml.together import together

VERSION_COLUMNS = {
    "data_preprocess": "data_preprocess_model_version",
    "ml_model": "ml_model_version",
    "bias_adj_model": "bias_adj_model_version",
}


def forecast(
    registry: ModelRegistry, data: DataFrame, segment: str, version: str = "base", stage: str = STAGING,
    suffix: str = "", pinned: int | None = None,
) -> DataFrame:
    """Predictions of one segment, with the model's name and part versions."""
    parts = registry.load_segment(segment, stage, suffix, pinned)
    s = spec(segment, version)
    scored = learners.predict(data, s, parts["data_preprocess"][0], parts["ml_model"][0])
    return scored.withColumns(
        {
            "model": F.lit(f"{segment}_{MODEL_VERSION[version]}_{stage}"),
            **{column: F.lit(str(parts[p][1])) for p, column in VERSION_COLUMNS.items()},
        }
    )


def predictions_by_cohort(
    registry: ModelRegistry, features: Mapping[str, DataFrame], suffix: str = "", stage: str = STAGING,
    pinned: int | None = None,
) -> DataFrame:
    """Local and enterprise rows of every segment, each by its own model."""
    jobs = {
        (tag, s): partial(forecast, registry, part(features[s]), s, "base", stage, tag + suffix, pinned)
        for tag, part in COHORT_SLICES.items()
        for s in SEGMENTS
        if s in features
    }
    return reduce(DataFrame.unionByName, together(registry.spark, jobs).values())


def predictions_aov(
    registry: ModelRegistry, features: Mapping[str, DataFrame], version: str, suffix: str = "",
    stage: str = STAGING, pinned: int | None = None,
) -> DataFrame:
    """Order-value predictions of every segment."""
    jobs = {s: partial(forecast, registry, features[s], s, version, stage, suffix, pinned) for s in SEGMENTS if s in features}
    return reduce(DataFrame.unionByName, together(registry.spark, jobs).values())
