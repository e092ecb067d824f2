"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tamarind.llm.workspace import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, comp): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates the large-star and the small-star step until the edges no longer
    change; a few rounds suffice, about the logarithm of the longest path. Each
    step is an aggregate that combines before its shuffle and a join that Spark
    can split, so a node with very many edges is no single task's work. Nulls
    and loops are left out; no edges give no rows.
    """
    def counted(df: DataFrame) -> tuple[DataFrame, dict]:
        """Written edges, and what tells two sets of them apart, gathered while they are written."""
        mark = Observation()
        seen = df.observe(mark, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
        return work.keep(seen, "edges"), mark.get

    now, mark = counted(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while mark != seen and mark["n"]:
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = work.keep(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        seen, before = mark, now
        now, mark = counted(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        work.drop(before, large)
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(roots)
