"""Scalar expressions shared by all jobs. Everything stays inside codegen."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str
DateLike = dt.date | str

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*$")


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d: DateLike) -> dt.date:
    """Python date from an ISO string or a date."""
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def date_lit(d: DateLike) -> Column:
    return F.lit(as_date(d))


def checked_name(name: str) -> str:
    """An identifier that may be placed in SQL text; anything else is refused."""
    if not _NAME.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def is_true(c: ColumnLike) -> Column:
    """``c IS NOT DISTINCT FROM true``."""
    return F.coalesce(as_col(c).cast("boolean"), F.lit(False))


def is_false(c: ColumnLike) -> Column:
    """``c IS NOT DISTINCT FROM false``."""
    return ~F.coalesce(as_col(c).cast("boolean"), F.lit(True))


def flag(c: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")


def nz(c: ColumnLike, default=0) -> Column:
    return F.coalesce(as_col(c), F.lit(default))


def ratio(n: ColumnLike, d: ColumnLike) -> Column:
    """``n / d``, NULL where the divisor is 0 or NULL."""
    return as_col(n).cast("double") / F.nullif(as_col(d).cast("double"), F.lit(0.0))


def safe_ratio(n: ColumnLike, d: ColumnLike, default: float = 0.0) -> Column:
    """``n / d`` with a default for a missing or zero divisor."""
    return F.coalesce(ratio(n, d), F.lit(default))


def dollars(cents: ColumnLike) -> Column:
    """Integer cents as a double amount.

    Sums run over integer cents first, so results do not depend on the order
    in which partitions arrive.
    """
    return as_col(cents).cast("double") / F.lit(100.0)


def plus_days(d: ColumnLike, n: int) -> Column:
    return F.date_add(as_col(d).cast("date"), n)


def day_diff(start: ColumnLike, end: ColumnLike) -> Column:
    """Calendar days crossed from ``start`` to ``end``."""
    return F.datediff(as_col(end).cast("date"), as_col(start).cast("date")).cast("long")


def month_diff(start: ColumnLike, end: ColumnLike) -> Column:
    """Month boundaries crossed from ``start`` to ``end`` (Jan 31 to Feb 1 is 1)."""
    a, b = as_col(start), as_col(end)
    return (12 * (F.year(b) - F.year(a)) + F.month(b) - F.month(a)).cast("long")


def toward_zero(x: ColumnLike) -> Column:
    """Drop the fraction."""
    c = as_col(x)
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("double")


def local_day(ts: ColumnLike, zone: ColumnLike) -> Column:
    """Calendar day of a UTC wall-clock timestamp in a per-row zone."""
    shifted = F.convert_timezone(F.lit("UTC"), as_col(zone), as_col(ts).cast("timestamp_ntz"))
    return shifted.cast("date")


def in_days(d: ColumnLike, anchor: ColumnLike, lo: int, hi: int) -> Column:
    """``anchor + lo <= d <= anchor + hi`` in days, both ends included."""
    return as_col(d).between(plus_days(anchor, lo), plus_days(anchor, hi))


def present(*cols: ColumnLike) -> Column:
    """How many of the columns are not NULL."""
    total = F.lit(0).cast("long")
    for c in cols:
        total = total + flag(as_col(c).isNotNull())
    return total
