"""Reads of dated loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_load(df: DataFrame, load_col: str = "create_date") -> DataFrame:
    """Rows of the newest load.

    The newest date is an uncorrelated scalar subquery: it runs first and its
    value then prunes partitions of ``load_col``.
    """
    newest = df.agg(F.max(load_col)).scalar()
    return df.where(F.col(load_col) == newest)


def at_last_day(df: DataFrame, day_col: str, of: DataFrame | None = None) -> DataFrame:
    """Rows on the last day found in ``of`` (by default in ``df`` itself)."""
    source = df if of is None else of
    return df.where(F.col(day_col) == source.agg(F.max(day_col)).scalar())
