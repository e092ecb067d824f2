"""A corpus from raw documents to token files, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; what it returns is written
as Parquet and read back as the next stage's ``docs``. All but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamarind.llm.decontaminate import drop_contaminated
from tamarind.llm.mixing import mixture
from tamarind.llm.near_dup import drop_near_duplicates
from tamarind.llm.token_table import token_digests, write_tokens
from tamarind.llm.toxicity import drop_toxic
from tamarind.session import cut_lineage, scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, doesn't reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return drop_near_duplicates(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have shares by the root of their size, shuffled."""
    return mixture(docs).select(*[f"`{c}`" for c in docs.columns])


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shuffled order of the mixture; a digest of each written document."""
    path = scratch_path(spark, "pipeline-tokens")
    write_tokens(docs, path, ordered=False)
    return token_digests(spark, path)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: A fitted classifier decides in the first stage, which SQL can't express;
#: tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
