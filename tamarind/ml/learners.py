"""Boosted trees per segment: fit, early stop, refit, predict."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.ml.preprocess import FEATURES, fit_preprocess
from tamarind.ml.segments import MODEL_VERSION, SEED, SegmentSpec
from tamarind.session import shared_dir

PATIENCE = 10  # trees without gain on the dev rows after which no more are wanted
TASK_ROWS = 50_000  # a fit's rows in one task; small segments are few tasks
NODE_IDS = 1_000_000  # rows from which a row's node is remembered from level to level


@dataclass
class FittedSegment:
    spec: SegmentSpec
    preprocess: PipelineModel
    learner: object
    curve: list[float] = field(default_factory=list)  # loss on the dev rows by number of trees, from one on


def learner(spec: SegmentSpec, rows: int = NODE_IDS):
    """A regressor, or a classifier where the label is 0 or 1, for about ``rows`` rows."""
    settings = dict(spec.trees)
    if rows >= NODE_IDS:
        settings |= dict(cacheNodeIds=True, checkpointInterval=10)
    kind = GBTClassifier if spec.binary else GBTRegressor
    return kind(featuresCol=FEATURES, labelCol=spec.label, seed=SEED, **settings)


def _prepared(df: DataFrame, spec: SegmentSpec) -> DataFrame:
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.where(F.col(spec.label).isNotNull()).withColumn(spec.label, F.col(spec.label).cast("double"))


def best_prefix(curve: Sequence[float], patience: int = PATIENCE) -> int:
    """How many trees to keep: those up to the least loss that is seen before
    ``patience`` trees in a row bring none below it. At least one."""
    best = 0
    for i, loss in enumerate(curve):
        if loss < curve[best]:
            best = i
        if i - best >= patience:
            break
    return best + 1


def first_trees(model, n: int):
    """``model`` with its first ``n`` trees; each tree was grown on the rest of those before it."""
    if n >= model.getNumTrees:
        return model
    whole, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(whole.trees()[:n], model.treeWeights[:n])):
        trees[i], weights[i] = tree, float(weight)
    package = "classification" if isinstance(model, GBTClassificationModel) else "regression"
    kind = getattr(getattr(gateway.jvm.org.apache.spark.ml, package), type(model).__name__)
    return type(model)(kind(whole.uid(), trees, weights, whole.numFeatures()).copy(whole.extractParamMap()))


def losses(model, rows: DataFrame) -> list[float]:
    """Loss on prepared ``rows`` by number of trees: squared error, or the logistic
    loss of a classifier. One pass over the rows for all numbers."""
    if isinstance(model, GBTClassificationModel):
        return model.evaluateEachIteration(rows)
    return model.evaluateEachIteration(rows, "squared")


def fit_segment(spec: SegmentSpec, train: DataFrame, dev: DataFrame | None = None, patience: int = PATIENCE) -> FittedSegment:
    """Fit on ``train``; with ``dev`` keep the trees up to the best loss there,
    looking ``patience`` trees ahead. Without rows in ``dev`` all trees stay.

    Growing doesn't go on where the first ``2 * patience`` trees show that it
    has ended; else all trees are grown, those first ones among them.
    """
    train = _prepared(train, spec)
    prep = fit_preprocess(train, spec.num, spec.cat)
    rows = train.count()
    ready = prep.transform(train).select(spec.label, FEATURES).coalesce(max(1, -(-rows // TASK_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)
    held = None if dev is None else prep.transform(_prepared(dev, spec)).select(spec.label, FEATURES)
    grower = learner(spec, rows)
    most = grower.getMaxIter()
    try:
        if held is None or held.isEmpty():
            return FittedSegment(spec, prep, grower.fit(ready))
        for trees in sorted({min(2 * patience, most), most}):
            model = grower.fit(ready, {grower.maxIter: trees})
            curve = losses(model, held)
            best = best_prefix(curve, patience)
            if len(curve) - best >= patience:
                break
        return FittedSegment(spec, prep, first_trees(model, best), curve)
    finally:
        ready.unpersist()


def refit(spec: SegmentSpec, train: DataFrame, dev: DataFrame) -> FittedSegment:
    return fit_segment(spec, train.unionByName(dev, allowMissingColumns=True))


def predicted(binary: bool) -> Column:
    """The prediction, or the probability of the positive class."""
    return vector_to_array("probability")[1] if binary else F.col("prediction")


def predict(
    df: DataFrame, spec: SegmentSpec, preprocess: PipelineModel, model, output: str = "pred", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Passthrough columns and the prediction."""
    scored = model.transform(preprocess.transform(df))
    return scored.select(*spec.passthrough, *keep, predicted(spec.binary).alias(output))


def predict_with_actual(fitted: FittedSegment, df: DataFrame) -> DataFrame:
    """Predictions next to the label, with the model's name and version."""
    s = fitted.spec
    return predict(df, s, fitted.preprocess, fitted.learner, keep=(s.label,)).select(
        *s.passthrough, "pred", F.col(s.label).cast("double").alias("actual"),
        F.lit(s.segment).alias("model"), F.lit(MODEL_VERSION[s.version]).alias("model_version"),
    )


def linear_adjustment(dev: DataFrame, test: DataFrame) -> DataFrame:
    """``pred_adj``: the straight line of actual over pred on ``dev``, applied
    to ``test``."""
    line = dev.agg(
        F.regr_slope("actual", "pred").alias("slope"), F.regr_intercept("actual", "pred").alias("intercept")
    )
    slope, intercept = line.select("slope").scalar(), line.select("intercept").scalar()
    return test.withColumn("pred_adj", slope * F.col("pred") + intercept)


def bias_model() -> LinearRegression:
    """The straight-line adjustment, stored unfitted next to each model."""
    return LinearRegression(featuresCol=FEATURES, labelCol="actual", predictionCol="pred_adj")
