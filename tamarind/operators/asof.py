"""Point-in-time joins.

A lookback join ("facts of this key up to n days before this anchor") has an
equality on the key and a range on the date. Joined on the key alone, one hot
key lands in one task and meets every anchor of that key. Here both sides also
carry a time slot, so the join is an equality on (key, slot): a hot key is
spread over its slots and a fact only meets anchors whose window touches its
slot. The exact range is checked after the join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.functions.exprs import as_date, in_days
from tamarind.operators.keyed import spread_join


def slot_days(lo: int, hi: int) -> int:
    """Slot width: about a quarter of the window, at least a day."""
    return max(1, (hi - lo + 1) // 4)


def pair_in_window(
    anchors: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    anchor_col: str,
    fact_col: str,
    lo: int,
    hi: int,
    spread_by: str | None = None,
) -> DataFrame:
    """Inner pairs of anchors and facts with equal keys and
    ``anchor + lo <= fact date <= anchor + hi`` (days, both ends included).

    Column names other than the keys must not collide. For facts that were not
    reduced beforehand, ``spread_by`` names a column whose hash cuts each heavy
    (key, slot) into as many parts as its rows need; anchors of other slots are
    not repeated.
    """
    width = slot_days(lo, hi)
    day = F.unix_date(F.col(anchor_col).cast("date"))
    first = F.floor((day + lo) / width)
    last = F.floor((day + hi) / width)
    slotted = anchors.where(F.col(anchor_col).isNotNull()).withColumn(
        "__slot", F.explode(F.sequence(first, last))
    )
    # The anchors' first and last day bound the facts, so that dated partitions are pruned.
    at = F.col(anchor_col).cast("date")
    earliest = anchors.agg(F.date_add(F.min(at), lo)).scalar()
    latest = anchors.agg(F.date_add(F.max(at), hi)).scalar()
    facts = facts.where(F.col(fact_col).cast("date").between(earliest, latest))
    placed = facts.withColumn(
        "__slot", F.floor(F.unix_date(F.col(fact_col).cast("date")) / width)
    )
    on = [*keys, "__slot"]
    pairs = slotted.join(placed, on) if spread_by is None else spread_join(placed, slotted, on, spread_by)
    return pairs.where(in_days(F.col(fact_col).cast("date"), anchor_col, lo, hi)).drop("__slot")


def day_map(
    spark: SparkSession, dates: Iterable[dt.date | str], lo: int, hi: int, day_col: str, as_name: str
) -> DataFrame:
    """(day, test date) pairs: which requested dates a fact of a day serves."""
    wanted = sorted({as_date(d) for d in dates})
    rows = [(d + dt.timedelta(days=k), d) for d in wanted for k in range(lo, hi + 1)]
    return spark.createDataFrame(rows, f"{day_col} date, {as_name} date")


def serve_dates(
    facts: DataFrame,
    dates: Iterable[dt.date | str],
    day_col: str,
    lo: int,
    hi: int,
    as_name: str = "create_date",
) -> DataFrame:
    """Give each fact row the requested dates whose window ``[t+lo, t+hi]``
    holds its day; all dates of a backfill in one pass over the facts."""
    wanted = [as_date(d) for d in dates]
    if not wanted:
        raise ValueError("no dates requested")
    from_day = min(wanted) + dt.timedelta(days=lo)
    to_day = max(wanted) + dt.timedelta(days=hi)
    bounded = facts.where(F.col(day_col).between(F.lit(from_day), F.lit(to_day)))
    if len(set(wanted)) == 1:
        return bounded.withColumn(as_name, F.lit(wanted[0]))
    return bounded.join(day_map(facts.sparkSession, wanted, lo, hi, day_col, as_name), day_col)
