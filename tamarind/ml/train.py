"""Training runs: fit, validate, register and promote."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date
from tamarind.ml import learners, metrics
from tamarind.ml.registry import ModelRegistry
from tamarind.ml.segments import DATE_ACTIVATION, DATE_SPLIT, SEGMENTS, SegmentSpec, specs
from tamarind.ml.split import COHORT_SLICES, split_by_date
from tamarind.ml.together import together
from tamarind.session import cut_lineage

# Days before the test date at which training, dev and test rows end.
COHORT_CUTS = (30 * 4, 30, 0)
AOV_CUTS = (30 * 7, 30 * 6, 30 * 5)


def cut_dates(test_date: DateLike, days: tuple[int, int, int]) -> tuple[dt.date, dt.date, dt.date]:
    today = as_date(test_date)
    return tuple(today - dt.timedelta(days=d) for d in days)


@dataclass(frozen=True, eq=False, repr=False)
class Job:
    """A segment's model to be trained on ``data``, registered under names that end with ``suffix``."""

    segment: str
    spec: SegmentSpec
    data: DataFrame
    suffix: str = ""

    def __repr__(self) -> str:
        return self.segment + self.suffix


def train_jobs(
    registry: ModelRegistry, jobs: Sequence[Job], cuts: tuple[DateLike, DateLike, DateLike],
    by_activation: bool = False, report: bool = True,
) -> dict[Job, DataFrame]:
    """Train all ``jobs``, register their parts and move them to Staging; the
    test predictions of each.

    A job fits twice, with early stopping on its training rows and on training
    and dev rows together; the latter model is kept and predicts the test rows.
    All fits run side by side, then all measurements, then all writes of models;
    the registry gets one new state. The overall bias and R squared of the test
    rows are stored with each part, and with ``report`` the correlations of the
    first fit on its training and dev rows and of the kept one on the test rows.
    """
    spark = registry.spark
    written = together(spark, {job: partial(cut_lineage, job.data, "training-rows") for job in jobs})  # trees read the rows many times
    parts = {
        job: split_by_date(data, DATE_SPLIT[job.spec.version], *cuts, activation_col=DATE_ACTIVATION, by_activation=by_activation)
        for job, data in written.items()
    }
    fits = together(
        spark,
        {(job, "first"): partial(learners.fit_segment, job.spec, rows, dev) for job, (rows, dev, _) in parts.items()}
        | {(job, "kept"): partial(learners.refit, job.spec, rows, dev) for job, (rows, dev, _) in parts.items()},
    )

    def predictions(job: Job, name: str) -> DataFrame:
        which = {"train": 0, "dev": 1, "test": 2}[name]
        fitted = fits[job, "kept" if name == "test" else "first"]
        return cut_lineage(learners.predict_with_actual(fitted, parts[job][which]), f"{name}-predictions")

    names = ("train", "dev", "test") if report else ("test",)
    seen = together(spark, {(job, n): partial(predictions, job, n) for job in jobs for n in names})

    def measured(job: Job, name: str) -> dict[str, float | None]:
        found = metrics.agreement(seen[job, name]).first() if report else metrics.error_sums(seen[job, name]).first()
        logged = {k: found[k] for k in ("bias", "r2")} if name == "test" else {}
        return logged | ({f"{name}_{k}": found[k] for k in ("pearson", "spearman", "kendall", "bias")} if report else {})

    found = together(spark, {key: partial(measured, *key) for key in seen})
    models = []
    for job in jobs:
        logged = {k: v for n in names for k, v in found[job, n].items() if v is not None}
        logged["trees"] = fits[job, "kept"].learner.getNumTrees
        logged["best_trees"] = fits[job, "first"].learner.getNumTrees
        for part, model in (
            ("data_preprocess", fits[job, "kept"].preprocess), ("ml_model", fits[job, "kept"].learner), ("bias_adj_model", learners.bias_model()),
        ):
            models.append((f"{job.segment}_{part}{job.suffix}", model, type(model).__name__, logged))
    registry.register_all(models)
    registry.promote([name for name, *_ in models])
    return {job: seen[job, "test"] for job in jobs}


def _all(tested: Mapping[Job, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tested.values())


def train_run(
    registry: ModelRegistry,
    datasets: Mapping[str, DataFrame],
    segment_specs: Mapping[str, SegmentSpec],
    cuts: tuple[DateLike, DateLike, DateLike],
    suffix: str = "",
    by_activation: bool = False,
    report: bool = True,
) -> DataFrame:
    """Train one model per segment (:func:`train_jobs`); all test predictions."""
    jobs = [Job(segment, segment_specs[segment], data, suffix) for segment, data in datasets.items()]
    return _all(train_jobs(registry, jobs, cuts, by_activation, report))


def train_cohort(
    registry: ModelRegistry, datasets: Mapping[str, DataFrame], test_date: DateLike, suffix: str = "",
    report: bool = True, **trees,
) -> DataFrame:
    """Local and enterprise models of all segments."""
    every = specs("base", **trees)
    jobs = [Job(s, every[s], part(datasets[s]), tag + suffix) for tag, part in COHORT_SLICES.items() for s in SEGMENTS if s in datasets]
    tested = train_jobs(registry, jobs, cut_dates(test_date, COHORT_CUTS), True, report)
    return _all({job: rows.withColumn("slice", F.lit(job.suffix.removesuffix(suffix).strip("_"))) for job, rows in tested.items()})


def train_aov(
    registry: ModelRegistry, datasets: Mapping[str, DataFrame], test_date: DateLike, version: str,
    suffix: str = "", report: bool = True, **trees,
) -> DataFrame:
    """Order-value models of all segments; no cohort slices."""
    return train_run(
        registry, datasets, specs(version, **trees), cut_dates(test_date, AOV_CUTS), suffix, False, report
    )
