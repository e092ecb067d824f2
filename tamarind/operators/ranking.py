"""Ranks within groups, without ordering a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.session import cut_lineage


def in_ranges(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` dealt out in even ranges of ``order``, with the number of its range
    as ``__part``. Written once, so that counts and ranks see the same ranges."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id())
    return cut_lineage(dealt, "ranges")


def rank_descending(df: DataFrame, group: Sequence[str], value: str, ties: Sequence[str]) -> DataFrame:
    """Add ``__rank`` (1 = largest) and ``__size`` of the group.

    NULL ranks as the largest; ``ties`` decide between equal values. Rows are
    dealt out by ranges of group, value and ties, so that a value that repeats is
    cut by its ties and no range grows beyond its share. Ranges are counted
    first, then each row is ordered inside its own range only. The ranges are
    written when the plan is built.
    """
    order = [F.col(value).desc_nulls_first(), *[F.col(t).asc() for t in ties]]
    # Groups are matched as one struct, so NULL group columns are values too.
    cells = in_ranges(df, *[F.col(g).asc() for g in group], *order).withColumn("__group", F.struct(*[F.col(g) for g in group]))
    place = ["__group", "__part"]
    whole = Window.partitionBy("__group")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.groupBy(*place).agg(F.count(F.lit(1)).alias("__n")).select(
        *place,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole).alias("__size"),
    )
    inside = Window.partitionBy(*place).orderBy(*order)
    return (
        cells.join(offsets, place)
        .withColumn("__rank", F.col("__before") + F.row_number().over(inside))
        .drop("__group", "__part", "__before")
    )


def ntile_of(rank: Column, size: Column, tiles: int) -> Column:
    """The tile of a rank: sizes differ by at most one, larger tiles first."""
    small = F.floor(size / tiles)
    large = size - small * tiles
    edge = large * (small + 1)
    return (
        F.when(rank <= edge, F.floor((rank - 1) / (small + 1)) + 1)
        .otherwise(large + F.floor((rank - edge - 1) / F.nullif(small, F.lit(0))) + 1)
        .cast("long")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key; Spark drops all but the leading rows of a key
    before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
