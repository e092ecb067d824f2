"""Grouped measures that stay even under hot keys.

Distinct counts never meet in one aggregate (which would replicate every row
once per distinct column). Each distinct count is two plain aggregates: first
on (group, id), which hashes a hot group over many tasks, then on the group.
Facts are reduced to (key, day, id) before any window is attached, so a fact
that serves many windows is repeated in its reduced form only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tamarind.functions.exprs import DateLike, flag, is_true
from tamarind.operators.keyed import join_null_safe
from tamarind.operators.sliding import sliding_totals
from tamarind.session import cut_lineage

Attach = Callable[[DataFrame], DataFrame]


def day_store_parts(facts: DataFrame, keys: Sequence[str], day: str = "active_date") -> DataFrame:
    """Additive measures of deliveries per (key, day, store)."""
    partner = is_true("is_partner")
    return facts.groupBy(*keys, day, "store_id").agg(
        F.sum("subtotal").alias("cents"),
        F.count("delivery_id").alias("orders"),
        F.sum(flag(partner)).alias("partner_rows"),
        F.sum(F.when(partner, F.col("subtotal"))).alias("partner_cents"),
        F.sum("fee").alias("fee_cents"),
        F.count("fee").alias("fee_rows"),
    )


def distinct_per(rows: DataFrame, group: Sequence[str], id_col: str, name: str) -> DataFrame:
    """Number of different non-null ids per group."""
    return (
        rows.where(F.col(id_col).isNotNull())
        .select(*group, id_col)
        .distinct()
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias(name))
    )


def delivery_totals(
    facts: DataFrame,
    keys: Sequence[str],
    attach: Attach,
    group: Sequence[str],
    ids: Sequence[str] = (),
    day: str = "active_date",
    days: bool = False,
) -> DataFrame:
    """Totals of deliveries per window group.

    ``attach`` adds the window columns to a (key, day, ...) frame. ``ids`` are
    further columns to count distinctly, as ``n_<id>``; ``days`` adds the
    number of days with a delivery as ``n_days``.
    """
    sums = ["cents", "orders", "partner_rows", "partner_cents", "fee_cents", "fee_rows"]
    parts = attach(day_store_parts(facts, keys, day))
    per_store = parts.groupBy(*group, "store_id").agg(*[F.sum(c).alias(c) for c in sums])
    out = per_store.groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("store_id").alias("stores"),
        F.sum(flag((F.col("partner_rows") > 0) & F.col("store_id").isNotNull())).alias("partner_stores"),
    )
    extra = {i: f"n_{i}" for i in ids}
    if days:
        extra[day] = "n_days"
    for col, name in extra.items():
        reduced = facts.where(F.col(col).isNotNull()).select(*dict.fromkeys([*keys, day, col])).distinct()
        counted = distinct_per(attach(reduced), group, col, name)
        out = join_null_safe(out, counted, group).withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out


def delivery_windows(
    facts: DataFrame,
    keys: Sequence[str],
    dates: Iterable[DateLike],
    lo: int,
    hi: int,
    ids: Sequence[str] = (),
    day: str = "active_date",
    as_name: str = "create_date",
) -> DataFrame:
    """The columns of :func:`delivery_totals` for the windows ``[date+lo, date+hi]``
    of many dates, without repeating a delivery for each of them."""
    partner = is_true("is_partner")
    sums = {
        "cents": F.col("subtotal"),
        "orders": flag(F.col("delivery_id").isNotNull()),
        "partner_rows": flag(partner),
        "partner_cents": F.when(partner, F.col("subtotal")),
        "fee_cents": F.col("fee"),
        "fee_rows": flag(F.col("fee").isNotNull()),
    }
    distinct = {"stores": ("store_id", None), "partner_stores": ("store_id", partner), **{f"n_{i}": (i, None) for i in ids}}
    return sliding_totals(facts, keys, dates, lo, hi, sums, distinct, day, as_name)


BIN_VALUES = 1 << 17  # different values of a bin that one task may order
SPLIT = 1024  # parts into which a larger bin is cut


def _bin(value: Column) -> Column:
    """Order-preserving coarse bin, at most 1/64 of an octave wide."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log2(1 + F.abs(v)) * 64)).cast("long")


def _sub_bin(value: Column, least: Column, most: Column) -> Column:
    """One of ``SPLIT`` even parts of the span from ``least`` to ``most``; rises
    with the value, and the two ends never share a part."""
    share = (value.cast("double") - least) / F.nullif(most - least, F.lit(0.0))
    return F.least(F.coalesce(F.floor(share * SPLIT), F.lit(0)), F.lit(SPLIT - 1)).cast("long")


def weighted_medians(
    dist: DataFrame, keys: Sequence[str], value: str, counts: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Exact medians per key from a distribution (key, value, counts).

    One median per count column; NULL keys are keys, NULL values play no part.
    The middle ranks are located in a histogram of coarse bins. A bin that holds
    one and has too many different values is cut into even parts of its own span,
    which are counted in turn, until what holds the middle ranks is small; a
    level leaves behind all values of the other bins. Values are ordered only per
    (key, small bin), so no task's work grows with the values of a key, however
    dense. The levels are written when the plan is built.
    """
    rows = cut_lineage(dist.where(F.col(value).isNotNull()).select(*keys, value, *counts), "distribution")
    none = {f"__before_{c}": F.lit(0).cast("long") for c in counts}
    binned = rows.withColumns({"__node": F.lit(0).cast("long"), "__bin": _bin(F.col(value)), **none})
    low = {c: F.floor((F.col(f"__all_{c}") + 1) / 2) for c in counts}
    high = {c: F.floor((F.col(f"__all_{c}") + 2) / 2) for c in counts}
    first = True
    while True:
        node = [*keys, "__node"]
        inside = Window.partitionBy(*node)
        before = inside.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
        # Of the first level, the counts of all bins are those of the key.
        bins = binned.groupBy(*node, "__bin").agg(
            F.count(F.lit(1)).alias("__values"),
            F.min(F.col(value).cast("double")).alias("__least"),
            F.max(F.col(value).cast("double")).alias("__most"),
            *[F.sum(c).alias(c) for c in counts],
            *[F.min(f"__before_{c}").alias(f"__upto_{c}") for c in counts],
            *[F.lit(None).cast("long").alias(f"__all_{c}") if first else F.min(f"__all_{c}").alias(f"__all_{c}") for c in counts],
        )
        located = bins.select(
            *node, "__bin", "__values", "__least", "__most",
            *[F.col(c).alias(f"__in_{c}") for c in counts],
            *[(F.col(f"__upto_{c}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(f"__before_{c}") for c in counts],
            *[F.coalesce(f"__all_{c}", F.sum(c).over(inside)).alias(f"__all_{c}") for c in counts],
        )
        holds = F.lit(False)
        for c in counts:
            upto = F.col(f"__before_{c}") + F.col(f"__in_{c}")
            holds = holds | ((F.col(f"__all_{c}") > 0) & (F.col(f"__before_{c}") < high[c]) & (upto >= low[c]))
        # A bin of one level is a node of the next.
        place = F.dense_rank().over(Window.partitionBy(*keys).orderBy("__node", "__bin")).cast("long")
        located = located.where(holds).withColumn("__next", place).drop(*[f"__in_{c}" for c in counts])
        located = cut_lineage(located, "bins")
        middle = join_null_safe(binned.select(*node, "__bin", value, *counts), located, [*node, "__bin"], "inner")
        if not located.where((F.col("__values") > BIN_VALUES) & (F.col("__least") < F.col("__most"))).head(1):
            break
        cut = F.when(F.col("__values") > BIN_VALUES, _sub_bin(F.col(value), F.col("__least"), F.col("__most"))).otherwise(F.lit(0))
        binned = cut_lineage(
            middle.select(
                *keys, value, *counts, F.col("__next").alias("__node"), cut.cast("long").alias("__bin"),
                *[f"__before_{c}" for c in counts], *[f"__all_{c}" for c in counts],
            ),
            "middle",
        )
        first = False

    in_bin = Window.partitionBy(*keys, "__node", "__bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = middle.withColumns({f"__run_{c}": F.col(f"__before_{c}") + F.sum(c).over(in_bin) for c in counts})

    def at(rank: dict[str, Column], c: str) -> Column:
        reached = (F.col(f"__all_{c}") > 0) & (F.col(f"__run_{c}") >= rank[c])
        return F.min(F.when(reached, F.col(value).cast("double")))

    return ranked.groupBy(*keys).agg(
        *[((at(low, c) + at(high, c)) / 2).alias(n) for c, n in zip(counts, names)]
    )


def running_totals(
    steps: DataFrame, keys: Sequence[str], day: str, sums: Sequence[str], anchors: DataFrame, anchor: str
) -> DataFrame:
    """Totals of all steps up to and including each anchor day.

    ``steps`` is reduced to one row per (key, day) first, so an ordered group
    holds days, not facts.
    """
    daily = steps.groupBy(*keys, day).agg(*[F.sum(c).alias(c) for c in sums])
    line = daily.select(*keys, F.col(day).alias("__day"), F.lit(0).alias("__kind"), *sums).unionByName(
        anchors.select(
            *keys,
            F.col(anchor).alias("__day"),
            F.lit(1).alias("__kind"),
            *[F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in sums],
        )
    )
    upto = (
        Window.partitionBy(*keys).orderBy("__day", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        line.withColumns({c: F.sum(c).over(upto) for c in sums})
        .where(F.col("__kind") == 1)
        .select(*keys, F.col("__day").alias(anchor), *sums)
    )
