"""Preparation, learners, registry and agreement measures."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tamarind.ml import learners, metrics, preprocess, registry, score, segments, train
from tamarind.ml.segments import SegmentSpec


def test_preparation(spark):
    df = spark.createDataFrame(
        [(1.0, "a", None), (None, "b", None), (4.0, "b", None), (1.0, None, None)], "x double, c string, e double"
    )
    model = preprocess.fit_preprocess(df, ["x", "e"], ["c"])
    assert preprocess.feature_names(model, ["x", "e"], ["c"]) == ["x", "c_a", "c_b"]
    new = spark.createDataFrame([(None, "zz", None), (4.0, None, 1.0)], "x double, c string, e double")
    got = [r[0] for r in model.transform(new).select(vector_to_array("features")).collect()]
    filled = np.array([1.0, 2.0, 4.0, 1.0])
    assert got[0] == [0.0, 0.0, 0.0]  # mean, and an all-zero block for the unknown category
    assert got[1] == pytest.approx([(4 - 2) / filled.std(), 0.0, 1.0])


SPEC = SegmentSpec(
    "ac", "base", ("x", "z"), ("c",), "total_subtotal_month", False,
    (("maxIter", 15), ("maxDepth", 3), ("stepSize", 0.3)),
)


def _linear(spark, n=400):
    rng = random.Random(8)
    start = dt.date(2020, 1, 1)
    rows = []
    for i in range(n):
        x = rng.uniform(0, 10)
        c = rng.choice(["a", "b"])
        d = start + dt.timedelta(days=i % 200)
        rows.append((f"m{i}", d, d, 5, x, rng.random(), c, 10 * x + (20 if c == "b" else 0)))
    return spark.createDataFrame(
        rows, "match_id string, activation_date date, min_active_date date, age_month long, x double, z double, c string, total_subtotal_month double"
    )


def test_trees_learn_and_models_are_staged(spark, tmp_path, monkeypatch):
    data = _linear(spark)
    reg = registry.ModelRegistry(spark, str(tmp_path / "models"))
    cuts = ("2020-04-30", "2020-05-31", "2020-07-31")
    for _ in range(2):
        tested = train.train_run(reg, {"ac": data}, {"ac": SPEC}, cuts, "_t")
    r = metrics.error_sums(tested).first()
    assert r.rows > 50 and r.r2 > 0.9 and abs(r.bias) < 0.1
    stages = {(e.name, e.version): e.stage for e in reg.entries().collect()}
    assert stages[("ac_ml_model_t", 1)] == "Archived" and stages[("ac_ml_model_t", 2)] == "Staging"
    assert len(stages) == 6
    logged = reg.find("ac_ml_model_t").metrics
    assert logged["dev_kendall"] > 0.8 and "train_spearman" in logged

    monkeypatch.setattr(score, "spec", lambda *a, **k: SPEC)
    out = score.forecast(reg, data, "ac", stage="staging", suffix="_t").first()
    assert (out.model, out.ml_model_version) == ("ac_V3_5_staging", "2")
    assert score.forecast(reg, data, "ac", suffix="_t", pinned=1).first().ml_model_version == "1"
    with pytest.raises(LookupError):
        reg.find("ac_ml_model_t", "Production")


def test_classifier_gives_a_probability(spark):
    data = _linear(spark, 200).withColumn("is_premium", (F.col("x") > 5).cast("long"))
    spec = SegmentSpec("ac", "v1", ("x",), (), "is_premium", True, (("maxIter", 5), ("maxDepth", 2)))
    fitted = learners.fit_segment(spec, data)
    rows = learners.predict_with_actual(fitted, data).toPandas()
    assert rows.pred.between(0, 1).all()
    assert rows[rows.actual == 1].pred.mean() > 0.8 and rows[rows.actual == 0].pred.mean() < 0.2


def test_production_and_archived_versions_keep_their_stage(spark):
    rows = [("m", 1, "Production"), ("m", 2, "Archived"), ("m", 3, "Staging"), ("m", 4, "None"), ("o", 1, "None")]
    entries = spark.createDataFrame(rows, "name string, version long, stage string")
    got = {(r.name, r.version): r.stage for r in registry.promote_newest(entries, ["m"]).collect()}
    assert [got[("m", v)] for v in (1, 2, 3, 4)] == ["Production", "Archived", "Archived", "Staging"]
    assert got[("o", 1)] == "None"


def _tau(x, y):
    sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    return (sx * sy).sum() / np.sqrt((sx**2).sum() * (sy**2).sum())


@pytest.mark.parametrize("small_cells", [False, True])
def test_rank_correlations_with_heavy_ties(spark, monkeypatch, small_cells):
    if small_cells:  # several levels, and values that fill cells on their own
        monkeypatch.setattr(metrics, "GROUP_POINTS", 40)
        monkeypatch.setattr(metrics, "CELLS", 5)
    rng = np.random.default_rng(9)
    x = np.where(rng.random(700) < 0.34, 0.0, rng.integers(-20, 300, 700)).astype(float)
    y = np.where(rng.random(700) < 0.34, 5.0, x + rng.normal(0, 80, 700).round(0))
    df = spark.createDataFrame(pd.DataFrame({"actual": x, "pred": y}))
    got = metrics.agreement(df).first()
    assert got.kendall == pytest.approx(_tau(x, y), abs=1e-9)
    ranks = pd.Series(x).rank().corr(pd.Series(y).rank())
    assert got.spearman == pytest.approx(ranks, abs=1e-9)
    assert got.pearson == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)
    assert got.r2 == pytest.approx(1 - ((x - y) ** 2).sum() / ((x - x.mean()) ** 2).sum())
    assert got.bias == pytest.approx(y.sum() / x.sum() - 1)


def test_no_group_of_pairs_exceeds_its_bound(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(metrics, "GROUP_POINTS", 60)
    monkeypatch.setattr(metrics, "CELLS", 6)
    whole = metrics.cut_lineage

    def watched(df, label="stage"):
        out = whole(df, label)
        if label == "group-sizes":
            sizes.append([r.n for r in out.collect()])
        return out

    monkeypatch.setattr(metrics, "cut_lineage", watched)
    rng = np.random.default_rng(12)
    x = rng.permutation(900).astype(float)
    y = np.where(rng.random(900) < 0.3, 7.0, x * rng.choice([-1.0, 1.0], 900))
    w = rng.integers(1, 5, 900)
    pts = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "w": w}))
    got = metrics.concordant_pairs(pts).first().concordant
    rising = (x[:, None] < x[None, :]) & (y[:, None] < y[None, :])
    assert got == (np.outer(w, w) * rising).sum()
    assert len(sizes) > 2 and max(sizes[-1]) <= 60 and max(sizes[1]) < max(sizes[0]) == 900


def test_constant_predictions_have_no_correlation(spark):
    got = metrics.agreement(spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "actual double, pred double")).first()
    assert got.pearson is None and got.spearman is None and got.kendall is None


def test_rising_pairs():
    rng = np.random.default_rng(10)
    c, y, w = rng.integers(0, 9, 60), rng.integers(0, 9, 60).astype(float), rng.integers(1, 4, 60)
    want = sum(w[a] * w[b] for a in range(60) for b in range(60) if c[a] < c[b] and y[a] < y[b])
    assert metrics.weighted_rising_pairs(c, y, w) == want


def test_feature_lists_have_no_duplicates():
    for version in segments.LABELS:
        for s in segments.specs(version).values():
            assert len(set(s.num + s.cat)) == len(s.num) + len(s.cat)


def test_cut_dates():
    assert train.cut_dates("2021-12-31", train.AOV_CUTS) == (dt.date(2021, 6, 4), dt.date(2021, 7, 4), dt.date(2021, 8, 3))
