"""Early stopping with patience, jobs side by side, and whole training and scoring runs on small tables."""

import random
import threading

import pytest
from pyspark.sql import functions as F

import queryset.catalog  # noqa: F401  (registers all queries)
from queryset.base import QUERIES
from tamarind.ml import learners, metrics, registry, score, segments, train
from tamarind.ml.preprocess import FEATURES
from tamarind.ml.segments import SegmentSpec
from tamarind.ml.together import together
from tamarind.session import cut_lineage

TREES = (("maxIter", 16), ("maxDepth", 2), ("stepSize", 0.3), ("maxBins", 32))


def spec(segment="ac", binary=False):
    label = "aov_first_148_days_high" if binary else "total_subtotal_month"
    return SegmentSpec(segment, "base", ("x", "z"), ("c",), label, binary, TREES)


def noisy(spark, n=300, seed=1):
    """A curve of x with noise, over 200 days; ``cohort`` 0 and 1."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        x = rng.uniform(0, 10)
        y = 10 * (x - 5) ** 2 + rng.gauss(0, 8)
        rows.append((f"m{i}", i % 200, 5, x, rng.random(), rng.choice("ab"), y, int(y > 80), i % 2))
    df = spark.createDataFrame(rows, "match_id string, n int, age_month long, x double, z double, c string, total_subtotal_month double, aov_first_148_days_high long, cohort long")
    return df.withColumn("min_active_date", F.expr("date_add(DATE '2020-01-01', n)")).withColumn("activation_date", F.col("min_active_date"))


def test_best_prefix_waits():
    assert learners.best_prefix([5, 4, 3, 4, 4, 2], patience=3) == 6  # two trees without gain, then a better one
    assert learners.best_prefix([5, 4, 3, 4, 4, 4, 2], patience=3) == 3  # three without gain: what follows is not seen
    assert learners.best_prefix([5, 5, 5], patience=10) == 1
    assert learners.best_prefix([3, 2, 1], patience=1) == 3


@pytest.mark.parametrize("binary", [False, True])
def test_early_stop_keeps_the_best_trees(spark, binary):
    s, data = spec(binary=binary), noisy(spark)
    fit, dev = data.where("n < 140"), data.where("n >= 140")
    fitted = learners.fit_segment(s, fit, dev, patience=6)
    kept, curve = fitted.learner.getNumTrees, fitted.curve
    assert kept == learners.best_prefix(curve, 6) > 1
    assert len(curve) in (12, 16) and curve[kept - 1] == min(curve[: kept + 6])
    whole = learners.fit_segment(s, fit)
    assert whole.learner.getNumTrees == 16
    # The kept trees are the first of the whole model, and they give the loss that was read off the curve.
    cut = learners.first_trees(whole.learner, kept)
    ready = learners._prepared(dev, s)
    ready = fitted.preprocess.transform(ready).select(s.label, FEATURES)
    assert learners.losses(cut, ready) == pytest.approx(curve[:kept])
    a, b = (learners.predict(dev, s, fitted.preprocess, m).orderBy("match_id").collect() for m in (cut, fitted.learner))
    assert [r.pred for r in a] == pytest.approx([r.pred for r in b])
    if not binary:
        rows = learners.predict_with_actual(fitted, dev)
        error = rows.agg(F.avg(F.pow(F.col("pred") - F.col("actual"), 2))).first()[0]
        assert error == pytest.approx(curve[kept - 1])


def test_early_stop_ends_where_nothing_helps(spark):
    """Labels of pure noise: growth ends after the first look, long before all trees."""
    data = noisy(spark).withColumn("total_subtotal_month", F.rand(3))
    fitted = learners.fit_segment(spec(), data.where("n < 140"), data.where("n >= 140"), patience=5)
    assert len(fitted.curve) == 10 and fitted.learner.getNumTrees <= 5
    empty = learners.fit_segment(spec(), data, data.where("false"))
    assert empty.learner.getNumTrees == 16 and empty.curve == []


def test_cut_models_are_stored_and_read(spark, tmp_path):
    model = learners.fit_segment(spec(), noisy(spark)).learner
    cut, reg = learners.first_trees(model, 7), registry.ModelRegistry(spark, str(tmp_path / "models"))
    assert reg.register_all([("a", cut, "GBTRegressionModel", {"r2": 0.5}), ("b", model, "GBTRegressionModel", None)]) == [1, 1]
    assert reg.register("a", model, "GBTRegressionModel") == 2
    back, version = reg.load("a", version=1)
    assert (back.getNumTrees, version, back.getFeaturesCol()) == (7, 1, FEATURES)
    with pytest.raises(ValueError):
        reg.register_all([("a", cut, "GBTRegressionModel", None)] * 2)
    reg.set_stages([("a", 1, "Production"), ("b", 1, "Archived")])
    assert {(e.name, e.version): e.stage for e in reg.entries().collect()} == {("a", 1): "Production", ("a", 2): "None", ("b", 1): "Archived"}


def test_together(spark):
    barrier = threading.Barrier(3, timeout=30)

    def job(n):
        barrier.wait()  # ends only if all three run at once
        return spark.range(n).count()

    assert together(spark, {n: lambda n=n: job(n) for n in (3, 1, 2)}) == {3: 3, 1: 1, 2: 2}
    assert together(spark, {}) == {}
    with pytest.raises(ZeroDivisionError):
        together(spark, {1: lambda: 1 / 0, 2: lambda: 2})


def test_cohort_run_end_to_end(spark, tmp_path, monkeypatch):
    """Two slices of two segments: fits, reports, registry, stages, loading and scoring, nothing stubbed."""
    monkeypatch.setattr(train, "specs", lambda version="base", **trees: {s: spec(s) for s in ("ac", "da")})
    monkeypatch.setattr(score, "spec", lambda s, version: spec(s))
    data = {"ac": noisy(spark, 400), "da": noisy(spark, 400, seed=2)}
    reg = registry.ModelRegistry(spark, str(tmp_path / "models"))
    tested = train.train_cohort(reg, data, "2020-07-10", "_t")
    assert {(r.model, r.slice) for r in tested.collect()} == {(s, c) for s in ("ac", "da") for c in ("local", "ent")}
    assert metrics.error_sums(tested).first().r2 > 0.5
    entries = reg.entries().collect()
    assert {(e.name, e.version, e.stage) for e in entries} == {
        (f"{s}_{part}_{c}_t", 1, "Staging") for s in data for c in ("local", "ent") for part in registry.PARTS
    }
    for e in entries:
        assert {"bias", "r2", "train_pearson", "dev_kendall", "test_spearman", "trees", "best_trees"} <= set(e.metrics)
        assert 1 < e.metrics["best_trees"] <= 16 == e.metrics["trees"]
    new = {s: rows.drop("total_subtotal_month") for s, rows in data.items()}
    scored = score.predictions_by_cohort(reg, new, "_t")
    assert scored.count() == 800 and scored.where("pred IS NULL").count() == 0
    got = {r.match_id: r.pred for r in scored.where("model LIKE 'ac%'").collect()}
    local = reg.load_segment("ac", suffix="_local_t")
    want = learners.predict(new["ac"].where("cohort = 0"), spec(), local["data_preprocess"][0], local["ml_model"][0]).collect()
    assert want and all(got[r.match_id] == pytest.approx(r.pred) for r in want)


FITS = [n for n in QUERIES if n.startswith(("l02_", "l03_", "l06_", "l08_refit", "l10_train", "l12_", "l13_", "l14_", "l15_", "a15_"))]


@pytest.mark.parametrize("name", FITS)
def test_registered_fits_cover_every_segment_with_real_settings(spark, name, monkeypatch):
    """What the registered jobs fit, on stand-ins for rows, models and metrics."""
    from types import SimpleNamespace

    from queryset import models

    rows = noisy(spark, 8).select("match_id", "min_active_date", "activation_date", "age_month", "cohort")
    predicted = rows.select("match_id", "activation_date", F.lit(1.0).alias("pred"), F.lit(2.0).alias("actual"))
    fits, sets = [], {}

    def fit(spec, train, dev=None, patience=10):
        fits.append(spec)
        return learners.FittedSegment(spec, None, SimpleNamespace(getNumTrees=1), [1.0])

    class Sets(models.AovSets):
        def __init__(self, t, *versions, scored=False):
            self.sets = {(use, v, s): rows for use in ("train", "score") for v in versions for s in segments.SEGMENTS}

    def forecast(reg, data, segment, version="base", stage="Staging", suffix="", pinned=None):
        sets.setdefault((segment, version), []).append(suffix)
        return predicted.withColumns({"model": F.lit(segment), **{c: F.lit("1") for c in score.VERSION_COLUMNS.values()}})

    fake = SimpleNamespace(spark=spark, register_all=lambda m: None, promote=lambda n: None, set_stages=lambda c: None,
                           entries=lambda: spark.createDataFrame([], registry.SCHEMA))
    found = spark.createDataFrame([(0.1,) * 5], "pearson double, spearman double, kendall double, bias double, r2 double")
    monkeypatch.setattr(models, "_registry", lambda t: fake)
    monkeypatch.setattr(models, "AovSets", Sets)
    monkeypatch.setattr(models, "training_rows", lambda t, s: rows)
    monkeypatch.setattr(models, "_trained_on", lambda t: {s: rows for s in segments.SEGMENTS})
    monkeypatch.setattr(models, "_scored", lambda t, *days: {(d, s): rows for d in days for s in segments.SEGMENTS})
    monkeypatch.setattr(models, "cut_lineage", lambda df, label="": df)
    monkeypatch.setattr(train, "cut_lineage", lambda df, label="": df)
    monkeypatch.setattr(learners, "fit_segment", fit)
    monkeypatch.setattr(learners, "predict_with_actual", lambda f, df: predicted.withColumn("model", F.lit(f.spec.segment)))
    monkeypatch.setattr(metrics, "agreement", lambda df: found)
    monkeypatch.setattr(score, "forecast", forecast)
    table = SimpleNamespace(deliveries=rows)
    table.written = lambda *names: table
    QUERIES[name](table)
    assert fits and all(s == segments.spec(s.segment, s.version) for s in fits)
    if name.startswith("l02_"):
        return
    versions = {s.version for s in fits}
    assert {(s.segment, s.version) for s in fits} == {(s, v) for s in segments.SEGMENTS for v in versions}
    if name == "l15_predictions_aov":
        assert versions == {"v0", "v1", "v2"} == {v for _, v in sets}
    if name.startswith(("l12_", "l15_", "a15_")):
        each = {"l15_predictions_by_cohort": 2, "a15_backfill_predictions": 3}.get(name, 1)
        assert {s for s, _ in sets} == set(segments.SEGMENTS) and all(len(v) == each for v in sets.values())


def test_measurements_side_by_side_do_not_wait_for_each_other(spark):
    """Scalar subqueries inside scalar subqueries, of more measurements than the session has subquery threads (16), never end."""
    rows = cut_lineage(noisy(spark, 60).selectExpr("x AS pred", "total_subtotal_month AS actual"), "points")
    measured = metrics.agreement(rows)
    assert "scalar-subquery" not in measured._jdf.queryExecution().toString()
    found = together(spark, {n: metrics.agreement(rows).first for n in range(20)}, at_once=20)
    assert {r.rows for r in found.values()} == {60} and len({round(r.kendall, 9) for r in found.values()}) == 1


def test_order_value_sets_share_their_lookbacks(spark, monkeypatch):
    """Search lookbacks are found once for each kind of merchants, whatever the number of versions and segments."""
    from queryset import models
    from queryset.views import GivenTables

    kinds = []
    whole = models.search.training_lookbacks
    monkeypatch.setattr(models.search, "training_lookbacks", lambda t, kind: kinds.append(kind) or whole(t, kind))
    monkeypatch.setattr(models, "_aov_labelled", lambda t, kind: (getattr(t, f"aov_label_{kind}"), None))
    t = GivenTables(spark, "/root/testdata/sf0.001")
    sets = models.AovSets(t, "v0", "v2").of("train", "v2")
    assert sorted(kinds) == ["danp", "nn"]
    for s, rows in sets.items():
        alone = models.assembly.aov_training_set(t, s, "v2", models.q_assembly.AOV_AFTER)
        assert rows.columns == alone.columns and rows.exceptAll(alone).isEmpty() and alone.exceptAll(rows).isEmpty()
