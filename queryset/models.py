"""Preparation, training, registry, scoring and agreement.

Every fit has the settings of its segment in ``tamarind.ml.segments``.
"""

from __future__ import annotations

import datetime as dt
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryset import assembly as q_assembly
from queryset.assembly import HISTORY
from queryset.base import CHECKS, DAY, DAYS, query
from queryset.features import CORE, LATEST_DANP
from queryset.labels import DANP_AGE, END, FROM, START
from queryset.population import SNAPSHOTS
from tamarind.ml import learners, metrics, preprocess, registry, score, segments, split, train
from tamarind.ml.together import together
from tamarind.plans import assembly, labels, scoring_features, search, vendor
from tamarind.plans.assembly import Dataset
from tamarind.session import cut_lineage, scratch_path, shuffles_dropped
from tamarind.sources import publish

COHORT_DAY = "1998-07-15"
AOV_DAY = "1998-12-15"
AOV_VERSIONS = ("v0", "v1", "v2")
CUTS = ("1998-06-30", "1998-10-31", "1999-03-31")

# Preparation -----------------------------------------------------------------

STAT_NUM = ["reviews_mes", "rating_factus", "sales_chdus"]
STAT_CAT = ["cohort_encoded", "price_yelp_encoded", "cohort"]


def _stat_sql() -> str:
    num = [
        f"""SELECT '{c}' AS column_name, 'num' AS kind, count(*) AS "rows", count({c}) AS present, avg({c}) AS mean,
 sqrt(var_pop({c}) * count({c}) / count(*)) AS std, CAST(NULL AS VARCHAR) AS most_frequent FROM {{vendor_features}}"""
        for c in STAT_NUM
    ]
    cat = [
        f"""SELECT '{c}', 'cat', (SELECT count(*) FROM {{vendor_features}}), (SELECT count({c}) FROM {{vendor_features}}), NULL, NULL,
 (SELECT CAST({c} AS VARCHAR) FROM {{vendor_features}} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
        for c in STAT_CAT
    ]
    return "\nUNION ALL\n".join(num + cat)


@query("l01_preparation_statistics", _stat_sql())
def _(t):
    return preprocess.column_statistics(t.vendor_features, STAT_NUM, STAT_CAT)


def _prepared_sql() -> str:
    """Scaled numbers, and a one in one slot of each category: a missing value takes the mean or the most
    frequent value; numbers that are all alike are scaled by 1."""
    stats = ", ".join(
        f"avg({c}) AS m_{c}, coalesce(nullif(sqrt(var_pop({c}) * count({c}) / count(*)), 0), 1) AS s_{c}" for c in STAT_NUM
    )
    slots = " + ".join([str(len(STAT_NUM)), *[f"count(DISTINCT {c})" for c in STAT_CAT]])
    total = " + ".join([*[f"(coalesce({c}, m_{c}) - m_{c}) / s_{c}" for c in STAT_NUM], str(len(STAT_CAT))])
    return f"SELECT match_id, slots, {total} AS total FROM {{vendor_features}}, (SELECT {stats}, {slots} AS slots FROM {{vendor_features}})"


@query("l01_prepared_features", _prepared_sql())
def _(t):
    model = preprocess.fit_preprocess(t.vendor_features, STAT_NUM, STAT_CAT)
    from pyspark.ml.functions import vector_to_array

    return model.transform(t.vendor_features).select(
        "match_id", F.size(vector_to_array(preprocess.FEATURES)).alias("slots"),
        F.aggregate(vector_to_array(preprocess.FEATURES), F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


# Training sets ---------------------------------------------------------------


def training_rows(t, segment: str):
    if segment == "nn":
        return q_assembly.nn_training(t)
    return q_assembly.danp_training(t, segment)


def _aov_labelled(t, kind: str):
    """Order-value labels of net new merchants or of the others, with the features of the daily table."""
    if kind == "nn":
        feats, labelled = scoring_features.nn_features(t, DAY, aov=True), t.aov_label_nn
    else:
        feats, labelled = scoring_features.danp_features(t, DAY, True, HISTORY, SNAPSHOTS), t.aov_label_danp
    feats = cut_lineage(feats, "features")
    extra = [c for c in feats.columns if c not in labelled.columns]
    rows = labelled.join(feats.select("match_id", *extra).dropDuplicates(["match_id"]), "match_id", "left")
    return cut_lineage(rows, "aov-labels"), feats


def aov_rows(t, segment: str, version: str):
    """Order-value training rows of one segment."""
    t, kind = t.written("deliveries"), "nn" if segment == "nn" else "danp"
    frames = {f"aov_label_{kind}": _aov_labelled(t, kind)[0]}
    return assembly.aov_training_set(t.with_frames(**frames), segment, version, q_assembly.AOV_AFTER)


def _spark(t):
    return t.deliveries.sparkSession


FACTS = ("deliveries", "store_requests")  # views that the sets of all segments scan again and again


def _trained_on(t) -> dict[str, DataFrame]:
    """The training rows of each segment, written once; both kinds of known merchants share their labels."""
    t = t.written(*FACTS)
    vendors = vendor.vendor_table(t)
    built = together(
        _spark(t),
        {
            "nn": lambda: cut_lineage(q_assembly.nn_training(t, vendors), "training"),
            "danp": lambda: cut_lineage(labels.danp_monthly_label(t, START, END, FROM), "labels"),
        },
    )
    found = _looked_back(t, "danp")
    known = together(_spark(t), {s: partial(_known_rows, t, s, built["danp"], found, vendors) for s in segments.SEGMENTS if s != "nn"})
    return {s: known.get(s, built["nn"]) for s in segments.SEGMENTS}


def _known_rows(t, segment: str, labelled: DataFrame, found: DataFrame, vendors: DataFrame) -> DataFrame:
    return cut_lineage(assembly.training_set(t, segment, labelled, found=found, vendors=vendors), "training")


def _looked_back(t, kind: str) -> DataFrame:
    """Search lookbacks of the merchants to train on, written once for all sets that join them."""
    return cut_lineage(search.training_lookbacks(t, kind), "lookbacks")


class AovSets:
    """Order-value training and scoring sets of all versions and segments, from
    labels and features that are built once."""

    def __init__(self, t, *versions: str, scored: bool = False):
        self.t = t = t.written(*FACTS)
        kinds = {"nn": "nn", "ac": "danp", "da": "danp"}
        both = ("nn", "danp")
        self.vendors = vendor.vendor_table(t)
        first = {(kind, "rows"): partial(_aov_labelled, t, kind) for kind in both} | {(kind, "found"): partial(_looked_back, t, kind) for kind in both}
        first = together(_spark(t), first)
        self.built = {kind: first[kind, "rows"] for kind in both}
        frames = t.with_frames(**{f"aov_label_{kind}": rows for kind, (rows, _) in self.built.items()})
        jobs = {("train", v, s): partial(self._training, frames, s, v, first[kinds[s], "found"]) for v in versions for s in segments.SEGMENTS}
        if scored:
            found = together(_spark(t), {kind: partial(self._found, kind) for kind in self.built})
            jobs |= {("score", v, s): partial(self._scoring, v, s, kinds[s], found) for v in versions for s in segments.SEGMENTS}
        self.sets = together(_spark(t), jobs)

    def _found(self, kind: str) -> DataFrame:
        return cut_lineage(search.daily_table(self.t, self.built[kind][1], [DAY]), "search")

    def _training(self, frames, segment: str, version: str, found: DataFrame) -> DataFrame:
        return cut_lineage(assembly.aov_training_set(frames, segment, version, q_assembly.AOV_AFTER, found=found, vendors=self.vendors), "training")

    def _scoring(self, version: str, segment: str, kind: str, found: dict) -> DataFrame:
        return cut_lineage(assembly.aov_scoring_set(self.t, segment, version, DAY, self.built[kind][1], found[kind], vendors=self.vendors), "scoring")

    def of(self, use: str, version: str) -> dict[str, DataFrame]:
        return {s: self.sets[use, version, s] for s in segments.SEGMENTS}


def _scored(t, *days: str) -> dict[tuple[str, str], DataFrame]:
    """The scoring set of each day and segment, written once; both kinds of known merchants share their
    features, and all days and segments what was searched and the vendors' features."""
    t = t.written(*FACTS)
    vendors = vendor.vendor_table(t)

    def shared(kind: str) -> tuple[DataFrame, DataFrame]:
        rows, found = q_assembly.scoring_inputs(t, kind, False, *days)
        return rows, cut_lineage(found, "search")

    inputs = together(_spark(t), {kind: partial(shared, kind) for kind in ("nn", "danp")})
    jobs = {
        (d, s): partial(_scoring_rows, t, s, d, (*inputs["nn" if s == "nn" else "danp"], vendors)) for d in days for s in segments.SEGMENTS
    }
    return together(_spark(t), jobs)


def _scoring_rows(t, segment: str, day: str, inputs: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    return cut_lineage(q_assembly.scoring_of(t, segment, None, day, *inputs), "scoring")


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _registry(t) -> registry.ModelRegistry:
    spark = t.deliveries.sparkSession
    return registry.ModelRegistry(spark, scratch_path(spark, "models"))


# Loaders ---------------------------------------------------------------------


def _loaded_sql(name: str, columns: list[str]) -> str:
    cols = ", ".join(columns)
    return f"SELECT {cols} FROM (\n{CHECKS[name]}\n) loaded"


for _segment in segments.SEGMENTS:
    _spec = segments.spec(_segment)

    @query(
        f"l16_load_training_{_segment}",
        _loaded_sql(f"k35_training_set_{_segment}", _spec.training_columns),
    )
    def _(t, segment=_segment, columns=tuple(_spec.training_columns)):
        return Dataset(
            segment, lambda: training_rows(t, segment), list(columns), ["min_active_date", "activation_date"]
        ).load()

    @query(
        f"l16_load_scoring_{_segment}",
        _loaded_sql(f"k36_scoring_set_{_segment}", _spec.scoring_columns),
    )
    def _(t, segment=_segment, columns=tuple(_spec.scoring_columns)):
        return Dataset(segment, lambda: q_assembly.scoring(t, segment), list(columns)).load()


def _aov_loaded_sql(segment: str, version: str) -> str:
    """Labels first, so that of columns which both have theirs are taken."""
    cols = [f"strftime({c}, '%Y-%m-%d') AS {c}" if c == "activation_date" else c for c in segments.spec(segment, version).training_columns]
    return f"SELECT {', '.join(cols)} FROM (\n{q_assembly.aov_training_sql(segment, version, 'labelled')}\n) loaded"


def _aov_steps(segment: str) -> dict[str, str]:
    """The features of the test day by merchant, next to its labels."""
    kind = "nn" if segment == "nn" else "danp"
    steps = q_assembly.nn_steps(True) if kind == "nn" else q_assembly.danp_steps(True)
    labelled = f"""SELECT l.*, r.* FROM {{aov_label_{kind}}} l
LEFT JOIN (SELECT DISTINCT ON (match_id) * FROM {kind}_rows ORDER BY match_id) r ON r.match_id = l.match_id"""
    return {**steps, "labelled": labelled, **q_assembly.SEARCHED[kind], **q_assembly.VENDOR}


for _version in AOV_VERSIONS:
    for _segment in segments.SEGMENTS:

        # The loader of ac goes by the version alone.
        @query(
            f"l16_load_aov_{_version}" + ("" if _segment == "ac" else f"_{_segment}"),
            _aov_loaded_sql(_segment, _version),
            **_aov_steps(_segment),
        )
        def _(t, segment=_segment, version=_version):
            s = segments.spec(segment, version)
            return Dataset(
                segment, lambda: aov_rows(t, segment, version), s.training_columns, ["activation_date"]
            ).load()


# Models and their columns ----------------------------------------------------


def _contract_sql(segment: str) -> str:
    s = segments.spec(segment)
    items = [
        f"struct_pack(segment := '{segment}', column_name := '{c}', kind := '{kind}', place := {n}, \"rows\" := n, present := n_{c})"
        for kind, columns in (("num", s.num), ("cat", s.cat), ("label", [s.label]))
        for n, c in enumerate(columns, 1)
    ]
    counts = ", ".join(f"count({c}) AS n_{c}" for c in [*s.num, *s.cat, s.label])
    loaded = CHECKS[f"k35_training_set_{segment}"]
    return f"SELECT unnest([{', '.join(items)}], recursive := true) FROM (SELECT count(*) AS n, {counts} FROM (\n{loaded}\n) loaded) counted"


for _segment in segments.SEGMENTS:

    @query(f"l17_feature_lists_{_segment}", _contract_sql(_segment))
    def _(t, segment=_segment):
        return preprocess.column_contract(training_rows(t, segment), segments.spec(segment))


@query(
    "l04_model_map",
    "\nUNION ALL\n".join(
        f"""SELECT '{s}' AS segment, '{s}_V3_5' AS model, '{segments.spec(s).label}' AS label, {len(segments.spec(s).num)} AS numbers,
 {len(segments.spec(s).cat)} AS categories, count(*) AS "rows", count({segments.spec(s).label}) AS labelled
FROM (\n{CHECKS[f"k35_training_set_{s}"]}\n) loaded"""
        for s in segments.SEGMENTS
    ),
)
def _(t):
    return preprocess.model_map({segments.spec(s): rows for s, rows in _trained_on(t).items()})


# Fitting ---------------------------------------------------------------------


for _segment in segments.SEGMENTS:

    @query(f"l02_fit_and_predict_{_segment}")
    def _(t, segment=_segment):
        rows = cut_lineage(training_rows(t, segment), "training")
        s = segments.spec(segment)
        fitted = learners.fit_segment(s, rows)
        return learners.predict_with_actual(fitted, rows)


for _version in AOV_VERSIONS:

    @query(f"l03_aov_{_version}_fit_and_predict")
    def _(t, version=_version):
        rows = AovSets(t, version).of("train", version)
        fits = together(_spark(t), {s: partial(learners.fit_segment, segments.spec(s, version), r) for s, r in rows.items()})
        return _union(learners.predict_with_actual(fits[s], r) for s, r in rows.items())


def _split_sql(test: str) -> str:
    d1, d2, d3 = (f"DATE '{d}'" for d in train.cut_dates(COHORT_DAY, train.COHORT_CUTS))
    return f"""SELECT 'train' AS part, store_id, age_month, min_active_date FROM aged WHERE min_active_date <= {d1}
UNION ALL SELECT 'dev', store_id, age_month, min_active_date FROM aged WHERE min_active_date > {d1} AND min_active_date <= {d2}
UNION ALL SELECT 'test', store_id, age_month, min_active_date FROM aged WHERE {test.format(d2=d2, d3=d3)}"""


def _split(t, by_activation: bool):
    rows = labels.danp_sales_by_age(t, START, END, FROM)
    parts = split.split_by_date(
        rows, "min_active_date", *train.cut_dates(COHORT_DAY, train.COHORT_CUTS),
        activation_col="reactivation_timestamp", by_activation=by_activation,
    )
    named = [
        p.select(F.lit(n).alias("part"), "store_id", "age_month", "min_active_date")
        for n, p in zip(("train", "dev", "test"), parts)
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


SPLIT_STEPS = dict(core=CORE, latest=LATEST_DANP, aged=DANP_AGE)


@query("l05_split_by_date", _split_sql("min_active_date > {d2} AND min_active_date <= {d3}"), **SPLIT_STEPS)
def _(t):
    return _split(t, False)


@query(
    "l05_split_by_activation",
    _split_sql("reactivation_timestamp > {d2} AND reactivation_timestamp <= {d3} AND age_month = 5"),
    **SPLIT_STEPS,
)
def _(t):
    return _split(t, True)


@query("l06_fit_with_early_stop")
def _(t):
    parts = {s: split.split_by_date(rows, "min_active_date", *CUTS) for s, rows in _trained_on(t).items()}
    fits = together(_spark(t), {s: partial(learners.fit_segment, segments.spec(s), fit, dev) for s, (fit, dev, _) in parts.items()})
    out = []
    for s, fitted in fits.items():
        kept = fitted.learner.getNumTrees
        facts = {"trees": kept, "grown": len(fitted.curve), "dev_loss": fitted.curve[kept - 1] if fitted.curve else None}
        rows = learners.predict_with_actual(fitted, parts[s][1])
        out.append(rows.select("match_id", "pred", "model", *[F.lit(v).cast("double" if k == "dev_loss" else "long").alias(k) for k, v in facts.items()]))
    return _union(out)


DEV_DAYS = dt.date(1998, 5, 1)
POINTS = "SELECT match_id, pred_date, tam_value_pred AS pred, tam_value_actual AS actual FROM {decile_metrics}"


@query(
    "l08_linear_adjustment",
    f"""SELECT match_id, pred_date, pred, actual, slope * pred + intercept AS pred_adj FROM points,
 (SELECT regr_slope(actual, pred) AS slope, regr_intercept(actual, pred) AS intercept FROM points WHERE pred_date < DATE '{DEV_DAYS}')
WHERE pred_date >= DATE '{DEV_DAYS}'""",
    points=POINTS,
)
def _(t):
    points = t.decile_metrics.select(
        "match_id", "pred_date", F.col("tam_value_pred").alias("pred"), F.col("tam_value_actual").alias("actual")
    )
    dev = points.where(F.col("pred_date") < F.lit(DEV_DAYS))
    return learners.linear_adjustment(dev, points.where(F.col("pred_date") >= F.lit(DEV_DAYS)))


@query("l08_refit_and_predict")
def _(t):
    parts = {s: split.split_by_date(rows, "min_active_date", *CUTS) for s, rows in _trained_on(t).items()}
    fits = together(_spark(t), {s: partial(learners.refit, segments.spec(s), fit, dev) for s, (fit, dev, _) in parts.items()})
    return _union(learners.predict_with_actual(fits[s], test) for s, (_, _, test) in parts.items())


# Agreement -------------------------------------------------------------------


@query(
    "l09_agreement",
    """SELECT count(*) AS "rows", sum(pred) / sum(actual) - 1 AS bias,
 1 - sum((actual - pred) * (actual - pred)) / (var_pop(actual) * count(*)) AS r2, corr(actual, pred) AS pearson,
 (SELECT corr(ra, rp) FROM (SELECT rank() OVER (ORDER BY actual) + (count(*) OVER (PARTITION BY actual) - 1) / 2.0 AS ra,
    rank() OVER (ORDER BY pred) + (count(*) OVER (PARTITION BY pred) - 1) / 2.0 AS rp FROM points)) AS spearman,
 (SELECT sum(sign(a.actual - b.actual) * sign(a.pred - b.pred))
    / sqrt(CAST(sum(abs(sign(a.actual - b.actual))) AS DOUBLE) * CAST(sum(abs(sign(a.pred - b.pred))) AS DOUBLE))
  FROM points a, points b) AS kendall
FROM points""",
    points=POINTS,
)
def _(t):
    return metrics.agreement(t.decile_metrics, "tam_value_pred", "tam_value_actual")


# Registry, training and scoring runs -----------------------------------------

ENTRIES = """SELECT concat(c_mktsegment, '_ml_model') AS name, c_custkey AS version,
 CASE c_custkey % 4 WHEN 0 THEN 'Staging' WHEN 1 THEN 'Production' WHEN 2 THEN 'Archived' ELSE 'None' END AS stage FROM {customer}"""


@query(
    "l10_stage_transition",
    """SELECT name, version, CASE WHEN version = max(version) OVER (PARTITION BY name) THEN 'Staging'
 WHEN stage IN ('Production', 'Archived') THEN stage ELSE 'Archived' END AS stage FROM entries""",
    entries=ENTRIES,
)
def _(t):
    stage = F.element_at(
        F.array(*[F.lit(s) for s in ("Staging", "Production", "Archived", "None")]), (F.col("c_custkey") % 4 + 1).cast("int")
    )
    entries = t.raw("customer").select(
        F.concat("c_mktsegment", F.lit("_ml_model")).alias("name"), F.col("c_custkey").alias("version"), stage.alias("stage")
    )
    return registry.promote_newest(entries)


@query("l10_train_and_register")
def _(t):
    reg = _registry(t)
    train.train_run(reg, _trained_on(t), segments.specs(), CUTS, "_test")
    found = F.col("metrics")
    return reg.entries().select(
        "name", "version", "stage", found["r2"].alias("r2"), found["dev_spearman"].alias("dev_spearman"),
        found["dev_kendall"].alias("dev_kendall"),
    )


def _trained_and_scored(t, train_on, *days: str):
    """A registry with what ``train_on`` (registry, training rows) leaves there, and the scoring sets;
    the sets are built while the models grow, after the training rows: both read all facts, and side
    by side they would hold twice the shuffles."""
    with shuffles_dropped(_spark(t)):
        reg, t = _registry(t), t.written(*FACTS)
        rows = _trained_on(t)
        jobs = {"models": lambda: train_on(reg, rows), "sets": lambda: _scored(t, *days)}
        return reg, together(_spark(t), jobs)["sets"]


@query("l12_forecast_sales")
def _(t):
    reg, sets = _trained_and_scored(t, lambda reg, rows: train.train_run(reg, rows, segments.specs(), CUTS, "_test"), DAY)
    reg.set_stages([(f"{s}_ml_model_test", 1, registry.PRODUCTION) for s in segments.SEGMENTS])
    jobs = {s: partial(score.forecast, reg, sets[DAY, s], s, suffix="_test", pinned=1) for s in segments.SEGMENTS}
    return _union(together(_spark(t), jobs).values())


@query("l13_train_cohort")
def _(t):
    reg = _registry(t)
    train.train_cohort(reg, _trained_on(t), COHORT_DAY, "_test")
    return reg.entries().select("name", "version", "stage", F.col("metrics")["bias"].alias("bias"))


for _version in AOV_VERSIONS:

    @query(f"l14_train_aov_{_version}")
    def _(t, version=_version):
        return train.train_aov(_registry(t), AovSets(t, version).of("train", version), AOV_DAY, version, "_test")


@query("l15_predictions_by_cohort")
def _(t):
    reg, sets = _trained_and_scored(t, lambda reg, rows: train.train_cohort(reg, rows, COHORT_DAY, "_test"), DAY)
    return score.predictions_by_cohort(reg, {s: sets[DAY, s] for s in segments.SEGMENTS}, "_test")


@query("l15_predictions_aov")
def _(t):
    with shuffles_dropped(_spark(t)):
        sets = AovSets(t, *AOV_VERSIONS, scored=True)

    def predictions(version: str) -> DataFrame:
        reg = _registry(t)
        train.train_aov(reg, sets.of("train", version), AOV_DAY, version, "_test")
        return score.predictions_aov(reg, sets.of("score", version), version, "_test")

    return _union(together(_spark(t), {v: partial(predictions, v) for v in AOV_VERSIONS}).values())


@query("a15_backfill_predictions")
def _(t):
    reg, sets = _trained_and_scored(t, lambda reg, rows: train.train_run(reg, rows, segments.specs(), CUTS, "_test"), *DAYS)

    def scorer(day):
        jobs = {s: partial(score.forecast, reg, sets[day.isoformat(), s], s, suffix="_test") for s in segments.SEGMENTS}
        return _union(together(_spark(t), jobs).values())

    root = scratch_path(_spark(t), "predictions")
    return publish.publish_predictions(scorer, DAYS, f"{root}-raw", f"{root}-deduped")[1]
