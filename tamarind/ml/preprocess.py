"""Imputation, scaling and encoding as one fitted, storable pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tamarind.ml.segments import MODEL_VERSION, SegmentSpec

FEATURES = "features"


def column_statistics(df: DataFrame, num: Sequence[str], cat: Sequence[str]) -> DataFrame:
    """One row per column: rows, values present, mean and standard deviation
    after mean imputation (numeric), most frequent value (categorical).

    One aggregate over all columns, and one of the categorical values, which are
    counted per (column, value). The deviation divides by the number of rows; the
    smallest value wins among equally frequent ones.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in num:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n_{c}"), F.avg(x).alias(f"m_{c}"), F.var_pop(x).alias(f"v_{c}")]
    aggs += [F.count(c).alias(f"n_{c}") for c in cat]
    wide = df.agg(*aggs)
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    items = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit("num").alias("kind"), F.col("rows"), F.col(f"n_{c}").alias("present"),
            F.col(f"m_{c}").alias("mean"),
            F.sqrt(F.col(f"v_{c}") * F.col(f"n_{c}") / F.col("rows")).alias("std"),
        )
        for c in num
    ] + [
        F.struct(
            F.lit(c).alias("column_name"), F.lit("cat").alias("kind"), F.col("rows"), F.col(f"n_{c}").alias("present"),
            none_d.alias("mean"), none_d.alias("std"),
        )
        for c in cat
    ]
    out = wide.select(F.inline(F.array(*items)))
    if not cat:
        return out.withColumn("most_frequent", none_s)
    return out.join(_most_frequent(df, cat), "column_name", "left")


def column_contract(df: DataFrame, spec: SegmentSpec) -> DataFrame:
    """One row per column that a segment's model reads or predicts: its kind, its
    place in the list, and how many of the rows hold a value. One aggregate; a
    column that ``df`` lacks is an error when the plan is built.
    """
    kinds = {"num": spec.num, "cat": spec.cat, "label": (spec.label,)}
    listed = [(kind, n, c) for kind, columns in kinds.items() for n, c in enumerate(columns, 1)]
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{i}") for i, (_, _, c) in enumerate(listed)])
    items = [
        F.struct(
            F.lit(spec.segment).alias("segment"), F.lit(c).alias("column_name"), F.lit(kind).alias("kind"),
            F.lit(n).cast("long").alias("place"), F.col("rows"), F.col(f"n_{i}").alias("present"),
        )
        for i, (kind, n, c) in enumerate(listed)
    ]
    return wide.select(F.inline(F.array(*items)))


def model_map(rows: Mapping[SegmentSpec, DataFrame]) -> DataFrame:
    """One row per model: its segment, name, label, numbers of columns, and the
    training rows it has, with and without a label."""
    maps = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.count(s.label).alias("labelled")).select(
            F.lit(s.segment).alias("segment"), F.lit(f"{s.segment}_{MODEL_VERSION[s.version]}").alias("model"),
            F.lit(s.label).alias("label"), F.lit(len(s.num)).alias("numbers"), F.lit(len(s.cat)).alias("categories"),
            "rows", "labelled",
        )
        for s, df in rows.items()
    ]
    return reduce(DataFrame.unionByName, maps)


def _most_frequent(df: DataFrame, cat: Sequence[str]) -> DataFrame:
    """(column_name, most_frequent): numbers that are as frequent are compared as numbers."""
    values = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
            (F.col(c).cast("double") if isinstance(df.schema[c].dataType, NumericType) else F.lit(None).cast("double")).alias("number"),
        )
        for c in cat
    ]
    counts = df.select(F.inline(F.array(*values))).where("value IS NOT NULL").groupBy("column_name", "value", "number").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("less"), F.col("number"), F.col("value")))
    return counts.groupBy("column_name").agg(first["value"].alias("most_frequent"))


def fit_preprocess(df: DataFrame, num: Sequence[str], cat: Sequence[str]) -> PipelineModel:
    """Fit the preparation of ``num`` and ``cat`` into one feature vector.

    Columns without any value are left out. Unknown categories become an
    all-zero block.
    """
    stats = {r["column_name"]: r for r in column_statistics(df, num, cat).collect()}  # one row per column
    kept_num = [c for c in num if stats[c]["present"]]
    kept_cat = [c for c in cat if stats[c]["present"]]
    parts = ["*"]
    for c in kept_num:
        mean, std = stats[c]["mean"], stats[c]["std"] or 1.0
        parts.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {mean!r}D) - ({mean!r}D)) / {std!r}D AS `num_{c}`")
    for c in kept_cat:
        common = stats[c]["most_frequent"].replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"coalesce(CAST(`{c}` AS STRING), '{common}') AS `cat_{c}`")
    stages = [SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")]
    if kept_cat:
        stages += [
            StringIndexer(
                inputCols=[f"cat_{c}" for c in kept_cat], outputCols=[f"idx_{c}" for c in kept_cat],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"idx_{c}" for c in kept_cat], outputCols=[f"hot_{c}" for c in kept_cat]
            ),
        ]
    stages.append(
        VectorAssembler(
            inputCols=[f"num_{c}" for c in kept_num] + [f"hot_{c}" for c in kept_cat], outputCol=FEATURES
        )
    )
    return Pipeline(stages=stages).fit(df)


def feature_names(model: PipelineModel, num: Sequence[str], cat: Sequence[str]) -> list[str]:
    """Names of the slots of the feature vector."""
    inputs = model.stages[-1].getInputCols()
    names = [c.removeprefix("num_") for c in inputs if c.startswith("num_") and c[4:] in num]
    if len(model.stages) > 2:
        indexer = model.stages[1]
        for column, values in zip(indexer.getInputCols(), indexer.labelsArray):
            if column[4:] in cat:
                names += [f"{column[4:]}_{v}" for v in values]
    return names
