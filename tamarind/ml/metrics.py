"""Agreement of predictions with actual values, over rows of any number."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.functions.exprs import ratio
from tamarind.operators.ranking import in_ranges
from tamarind.session import cut_lineage

CELLS = 256  # about the number of rank cells per axis into which a group of points is cut
GROUP_POINTS = 1 << 18  # points whose pairs one task counts


def error_sums(df: DataFrame, pred: str = "pred", actual: str = "actual") -> DataFrame:
    """Bias, R squared (actual as reference) and Pearson correlation, one row."""
    rows = df.where(F.col(pred).isNotNull() & F.col(actual).isNotNull())
    p, a = F.col(pred).cast("double"), F.col(actual).cast("double")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        (ratio(F.sum(p), F.sum(a)) - 1).alias("bias"),
        (1 - ratio(F.sum((a - p) * (a - p)), F.var_pop(a) * F.count(a))).alias("r2"),
        ratio(F.covar_pop(a, p), F.stddev_pop(a) * F.stddev_pop(p)).alias("pearson"),
    )


def _side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The columns of frames of one row each in one row.

    They are joined: a scalar subquery holds one of the session's few subquery
    threads while it waits for those inside it, so measurements that run at the
    same time would wait for each other without end.
    """
    for other in others:
        first = first.crossJoin(other)
    return first


def value_ranks(df: DataFrame, col: str, weight: str, group: str | None = None) -> DataFrame:
    """Per different value (of each group): the number of rows below it (``below``)
    and its own (``own``). Values are ordered inside even ranges only."""
    place = [group, col] if group else [col]
    values = in_ranges(df.groupBy(*place).agg(F.sum(weight).alias("own")), *[F.col(c).asc() for c in place])
    parts = values.groupBy("__part").agg(F.sum("own").alias("n"))
    # A row for each partition of a shuffle.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("__part").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.join(offsets, "__part").select(
        *place, "own", (F.col("offset") + F.coalesce(F.sum("own").over(inside), F.lit(0))).alias("below")
    )
    if not group:
        return ranked
    # Ranks of all groups in a row become those of each group.
    starts = ranked.groupBy(group).agg(F.min("below").alias("start"))
    return ranked.join(starts, group).select(*place, "own", (F.col("below") - F.col("start")).alias("below"))


def _points(df: DataFrame, x: str, y: str) -> DataFrame:
    """Different (x, y) pairs with their number of rows."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return rows.groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).agg(
        F.count(F.lit(1)).alias("w")
    )


def spearman(df: DataFrame, x: str = "actual", y: str = "pred") -> DataFrame:
    """Correlation of average ranks, one row."""
    pts = cut_lineage(_points(df, x, y), "points")
    rank = F.col("below") + (F.col("own") + 1) / 2
    rx = value_ranks(pts, "x", "w").select("x", rank.alias("rx"))
    ry = value_ranks(pts, "y", "w").select("y", rank.alias("ry"))
    r, w = pts.join(rx, "x").join(ry, "y"), F.col("w")
    n, sx, sy = F.sum(w), F.sum(w * F.col("rx")), F.sum(w * F.col("ry"))
    cov = F.sum(w * F.col("rx") * F.col("ry")) - sx * sy / n
    vx = F.sum(w * F.col("rx") * F.col("rx")) - sx * sx / n
    vy = F.sum(w * F.col("ry") * F.col("ry")) - sy * sy / n
    return r.agg(ratio(cov, F.sqrt(vx * vy)).alias("spearman"))


def weighted_rising_pairs(cell: np.ndarray, y: np.ndarray, w: np.ndarray) -> int:
    """Sum of ``w_a * w_b`` over pairs with a smaller cell and a smaller y.

    One vectorised pass per binary digit of the y rank: rows that agree in all
    higher digits meet, and the smaller ones before each row are summed.
    """
    order = np.lexsort((-y, cell))  # equal cells in falling y never count
    rank = np.unique(y[order], return_inverse=True)[1].astype(np.int64)
    weight = w[order].astype(np.int64)
    total = 0
    for digit in range(int(rank.max(initial=0)).bit_length()):
        head, bit = rank >> (digit + 1), (rank >> digit) & 1
        grouped = np.argsort(head, kind="stable")
        h, b, ww = head[grouped], bit[grouped], weight[grouped]
        low = np.cumsum(np.where(b == 0, ww, 0))
        starts = np.r_[True, h[1:] != h[:-1]]
        base = np.where(starts, low - np.where(b == 0, ww, 0), 0)
        low -= np.maximum.accumulate(base)
        total += int(np.sum(np.where(b == 1, ww * low, 0)))
    return total


def _rising_in_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pairs = weighted_rising_pairs(pdf["c"].to_numpy(), pdf["v"].to_numpy(), pdf["w"].to_numpy())
    return pd.DataFrame({"pairs": [float(pairs)]})


def _cells(points: DataFrame, axis: str) -> DataFrame:
    """The rank cell of each value of ``axis`` in its group (g), and whether the value fills it alone."""
    size = F.ceil(F.col("total") / CELLS)
    alone = F.col("own") > size
    cell = 2 * F.floor(F.col("below") / size) + F.when(alone, 1).otherwise(0)
    totals = points.groupBy("g").agg(F.sum("w").alias("total"))
    return value_ranks(points, axis, "w", "g").join(totals, "g").select(
        "g", axis, cell.cast("long").alias(f"cell_{axis}"), alone.alias(f"alone_{axis}")
    )


def concordant_pairs(pts: DataFrame) -> DataFrame:
    """Number of pairs of the points (x, y, w) with larger x and larger y, one row.

    Level by level. A group of more than ``GROUP_POINTS`` points is cut into rank
    cells on both axes. Pairs in different cells on both axes follow from the
    counts of its grid, which has a fixed number of cells. Pairs that share an x
    cell, and pairs that share a y cell but no x cell, make smaller groups of their
    own, which the next level cuts or counts; a value that fills a cell alone has
    no such pairs. Each level makes groups smaller by ``CELLS / 2`` at least and
    holds a point twice at most for each level before it; groups that are small
    enough are counted in one task each.
    """
    width = 2 * (CELLS + 1)
    points = pts.select(F.lit(0).cast("long").alias("g"), F.col("x").alias("c"), F.col("y").alias("v"), "w")
    counted = []
    while True:
        sizes = cut_lineage(points.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "group-sizes")
        large = sizes.where(F.col("n") > GROUP_POINTS).select("g")
        small = points.join(sizes.where(F.col("n") <= GROUP_POINTS).select("g"), "g")
        counted.append(small.groupBy("g").applyInPandas(_rising_in_group, "pairs double"))
        if not large.head(1):
            break
        wide = cut_lineage(points.join(large, "g"), "large-groups")
        placed = wide.join(_cells(wide, "c"), ["g", "c"]).join(_cells(wide, "v"), ["g", "v"])
        placed = cut_lineage(placed, "cells")
        x_cell, y_cell = F.col("cell_c"), F.col("cell_v")
        grid = placed.groupBy("g", "cell_c", "cell_v").agg(F.sum("w").alias("w"))
        grid = grid.select("g", x_cell.cast("double").alias("c"), y_cell.cast("double").alias("v"), "w")
        counted.append(grid.groupBy("g").applyInPandas(_rising_in_group, "pairs double"))
        # A group's number names the cells it came from: no two have the same.
        in_x = placed.where(~F.col("alone_c")).select(
            ((F.col("g") * width + x_cell) * 2).alias("g"), "c", "v", "w"
        )
        in_y = placed.where(~F.col("alone_v")).select(
            ((F.col("g") * width + y_cell) * 2 + 1).alias("g"), x_cell.cast("double").alias("c"), "v", "w"
        )
        points = cut_lineage(in_x.unionByName(in_y).groupBy("g", "c", "v").agg(F.sum("w").alias("w")), "groups")
    every = counted[0]
    for part in counted[1:]:
        every = every.unionByName(part)
    return every.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("concordant"))


def kendall(df: DataFrame, x: str = "actual", y: str = "pred") -> DataFrame:
    """Kendall's tau-b, one row."""
    pts = cut_lineage(_points(df, x, y), "points")
    rows = pts.agg(F.sum("w")).first()[0] or 0

    n = F.col("n").cast("double")

    def tied(counts: DataFrame, name: str) -> DataFrame:
        return counts.agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0)).alias(name))

    tx = tied(pts.groupBy("x").agg(F.sum("w").alias("n")), "tx")
    ty = tied(pts.groupBy("y").agg(F.sum("w").alias("n")), "ty")
    txy = tied(pts.select(F.col("w").alias("n")), "txy")
    every = F.lit(float(rows) * (rows - 1) / 2)
    rising = _side_by_side(concordant_pairs(pts), tx, ty, txy)
    falling = every - F.col("tx") - F.col("ty") + F.col("txy") - F.col("concordant")
    scale = F.sqrt((every - F.col("tx")) * (every - F.col("ty")))
    return rising.select(ratio(F.col("concordant") - falling, scale).alias("kendall"))


def agreement(df: DataFrame, pred: str = "pred", actual: str = "actual") -> DataFrame:
    """All measures in one row."""
    return _side_by_side(error_sums(df, pred, actual), spearman(df, actual, pred), kendall(df, actual, pred))
