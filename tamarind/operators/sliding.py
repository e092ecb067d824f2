"""Totals and distinct counts of sliding windows, for many dates at once.

A fact of a day serves a run of the requested dates: those whose window holds
its day. Instead of repeating the fact for each of them, its amounts are added
where the run begins and taken away behind its end; running sums over the dates
then give every window. For distinct counts the days of one (key, id) are turned
into runs that don't overlap, a one where a run begins and a minus one behind
it. So a fact makes two rows at most, however long the window and however many
the dates, and they combine by (key, date) before they are shuffled.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date


def served_runs(spark: SparkSession, dates: Sequence[dt.date], lo: int, hi: int, day: str) -> DataFrame:
    """(day, first, last): the run of dates, by their place in ``dates``, whose
    windows ``[t+lo, t+hi]`` hold the day. One row for each day of all windows."""
    rows = []
    for d in (dates[0] + dt.timedelta(days=k) for k in range(lo, (dates[-1] - dates[0]).days + hi + 1)):
        first, last = bisect_left(dates, d - dt.timedelta(days=hi)), bisect_right(dates, d - dt.timedelta(days=lo)) - 1
        if first <= last:
            rows.append((d, first, last))
    return spark.createDataFrame(rows, f"{day} date, __first int, __last int")


def _both_ends(first: Column, behind: Column) -> Column:
    """Rows for the beginning of a run and for the place behind its end."""
    begin = F.struct(first.alias("at"), F.lit(1).alias("sign"))
    return F.explode(F.array(begin, F.struct(behind.alias("at"), F.lit(-1).alias("sign")))).alias("__end")


def sliding_totals(
    facts: DataFrame,
    keys: Sequence[str],
    dates: Iterable[DateLike],
    lo: int,
    hi: int,
    sums: Mapping[str, Column],
    distinct: Mapping[str, tuple[str, Column | None]],
    day: str = "active_date",
    as_name: str = "create_date",
) -> DataFrame:
    """One row per (keys, date) with a fact in ``[date+lo, date+hi]``.

    ``sums`` are amounts by name, whole numbers so that sums are exact; a window
    without a value has NULL. ``distinct`` counts different non-null ids of a
    column, of all facts or of those a condition holds for. NULL keys are a
    group. The table of days and the dates are bounded by the dates asked for.
    """
    wanted = sorted({as_date(d) for d in dates})
    if not wanted:
        raise ValueError("no dates requested")
    bounded = facts.where(
        F.col(day).between(F.lit(wanted[0] + dt.timedelta(days=lo)), F.lit(wanted[-1] + dt.timedelta(days=hi)))
    )
    runs = F.broadcast(served_runs(facts.sparkSession, wanted, lo, hi, day))  # at most a row for each day

    daily = bounded.groupBy(*keys, day).agg(
        *[F.sum(c).alias(f"s_{n}") for n, c in sums.items()], *[F.count(c).alias(f"c_{n}") for n, c in sums.items()]
    )
    amounts = [f"{kind}_{n}" for n in sums for kind in "sc"]
    ends = daily.join(runs, day).select(*keys, *amounts, _both_ends(F.col("__first"), F.col("__last") + 1))
    sign = F.col("__end.sign")
    events = ends.select(
        *keys, F.col("__end.at").alias("__at"), sign.cast("long").alias("rows"), *[(F.col(a) * sign).alias(a) for a in amounts]
    )
    for name, (of, condition) in distinct.items():
        rows = bounded.where(F.col(of).isNotNull() if condition is None else F.col(of).isNotNull() & condition)
        # Days are told apart first, so that a hot id is a row for each of its days. Both ends of the
        # runs ascend with the days: what a day adds begins behind the run before it.
        order = Window.partitionBy(*keys, of).orderBy(day)
        begin = F.greatest(F.col("__first"), F.coalesce(F.lag("__last").over(order) + 1, F.lit(0)))
        placed = rows.select(*dict.fromkeys([*keys, of, day])).distinct().join(runs, day).withColumn("__begin", begin)
        ends = placed.where("__begin <= __last").select(*keys, _both_ends(F.col("__begin"), F.col("__last") + 1))
        events = events.unionByName(
            ends.select(*keys, F.col("__end.at").alias("__at"), sign.cast("long").alias(f"d_{name}")), allowMissingColumns=True
        )
    measures = ["rows", *amounts, *[f"d_{n}" for n in distinct]]
    line = events.groupBy(*keys, "__at").agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    order = Window.partitionBy(*keys).orderBy("__at")  # no longer than the list of dates
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    line = line.select(
        *keys, "__at", F.lead("__at", 1, len(wanted)).over(order).alias("__next"), *[F.sum(m).over(upto).alias(m) for m in measures]
    )
    held = line.where((F.col("rows") > 0) & (F.col("__at") < F.col("__next")))
    held = held.withColumn("__place", F.explode(F.sequence(F.col("__at"), F.col("__next") - 1)))
    listed = F.array(*[F.lit(d) for d in wanted])
    return held.select(
        *keys,
        F.element_at(listed, F.col("__place") + 1).alias(as_name),
        *[F.when(F.col(f"c_{n}") > 0, F.col(f"s_{n}")).alias(n) for n in sums],
        *[F.col(f"d_{n}").alias(n) for n in distinct],
    )
