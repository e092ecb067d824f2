"""Sales, reach and partner share of submarkets and starting points."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import day_diff, dollars, safe_ratio, as_date, plus_days
from tamarind.operators.asof import pair_in_window
from tamarind.operators.keyed import join_null_safe, with_defaults
from tamarind.operators.rollup import delivery_totals, delivery_windows
from tamarind.sources.tables import Tables

# grain -> (delivery key, registry key, column prefix)
GRAINS = {
    "submarket": ("submarket_id", "sub_id", "submarket"),
    "starting_point": ("starting_point_id", "sp_id", "sp"),
}

# Windows in days relative to the anchor, both ends included.
WEEK_BEFORE = (-7, -1)
MONTH_TO_ACTIVATION = (-27, 0)  # half-open 28 days ending on the activation day
MONTH_BEFORE_SCORING = (-29, -1)


def _stat_columns(prefix: str, with_aov: bool = False) -> dict[str, Column]:
    cols = {
        f"{prefix}_total_sales": dollars("cents"),
        f"{prefix}_total_orders": F.col("orders"),
    }
    if with_aov:
        cols[f"{prefix}_aov"] = safe_ratio(dollars("cents"), "orders")
    return cols | {
        f"{prefix}_live_stores": F.col("stores"),
        f"{prefix}_num_consumers": F.col("n_creator_id"),
        f"{prefix}_delivery_partner_percent": safe_ratio("partner_rows", "orders"),
        f"{prefix}_store_partner_percent": safe_ratio("partner_stores", "stores"),
        f"{prefix}_sales_per_partner": safe_ratio(dollars("partner_cents"), "partner_stores"),
    }


def _week_columns(tables: Tables, totals: DataFrame, grain: str, date_col: str) -> DataFrame:
    key, registry_key, prefix = GRAINS[grain]
    known = (
        tables.registry_filtered.where(F.col(registry_key).isNotNull())
        .select(F.col(registry_key).alias(key), "id")
        .distinct()
        .groupBy(key)
        .agg(F.count("id").cast("double").alias("known"))
    )
    stats = _stat_columns(prefix)
    return totals.join(known, key, "left").select(
        key,
        date_col,
        F.col("known").alias(f"{prefix}_total_stores"),
        *[c.alias(n) for n, c in stats.items()],
        safe_ratio("partner_stores", "known").alias(f"{prefix}_store_partner_percent_overall"),
    )


def week_stats(tables: Tables, dates: Iterable, grain: str = "submarket") -> DataFrame:
    """Stats of the seven days before each date, with the share of all
    registered merchants that are live partners."""
    key = GRAINS[grain][0]
    totals = delivery_windows(tables.core, [key], dates, *WEEK_BEFORE, ids=["creator_id"])
    return _week_columns(tables, totals, grain, "create_date")


def week_stats_at(tables: Tables, anchors: DataFrame, grain: str, date_col: str) -> DataFrame:
    """The same stats for the (place, date) pairs of ``anchors`` only, as
    ``create_date``; the dates never leave the cluster."""
    key = GRAINS[grain][0]
    wanted = anchors.select(key, F.col(date_col).alias("create_date")).where(F.col(key).isNotNull()).distinct()
    totals = delivery_totals(
        tables.core,
        [key],
        lambda df: pair_in_window(wanted, df, [key], "create_date", "active_date", *WEEK_BEFORE),
        [key, "create_date"],
        ids=["creator_id"],
    )
    return _week_columns(tables, totals, grain, "create_date")


def stats_at_activation(
    tables: Tables, activations: DataFrame, grain: str, activation: str = "store_activation_date"
) -> DataFrame:
    """Stats of the 28 days up to each activation, one row per (key, activation)."""
    key, _, prefix = GRAINS[grain]
    anchors = activations.select(key, activation).distinct()
    totals = delivery_totals(
        tables.core,
        [key],
        lambda df: pair_in_window(anchors, df, [key], activation, "active_date", *MONTH_TO_ACTIVATION),
        [key, activation],
        ids=["creator_id"],
    )
    names = _stat_columns(prefix)
    stats = totals.select(key, activation, *[c.alias(n) for n, c in names.items()])
    zero = {n: 0 for n in names if n != f"{prefix}_total_sales"}
    return with_defaults(join_null_safe(anchors, stats, [key, activation]), zero)


def stats_for_scoring(
    tables: Tables, dates: Iterable, grain: str, with_aov: bool = False
) -> DataFrame:
    """Stats of days t-29 .. t-1 for each test date, one row per (key, date)."""
    key, _, prefix = GRAINS[grain]
    totals = delivery_windows(tables.core, [key], dates, *MONTH_BEFORE_SCORING, ids=["creator_id"])
    return totals.select(
        key, "create_date", *[c.alias(n) for n, c in _stat_columns(prefix, with_aov).items()]
    )


def first_delivery(tables: Tables) -> DataFrame:
    return tables.core.groupBy("submarket_id").agg(F.min("active_date").alias("first_day"))


def age_at_activation(tables: Tables, activations: DataFrame, activation: str = "store_activation_date") -> DataFrame:
    """Days from a submarket's first delivery to each activation."""
    anchors = activations.select("submarket_id", activation).distinct()
    return anchors.join(first_delivery(tables), "submarket_id", "left").select(
        "submarket_id", activation, day_diff("first_day", activation).alias("submarket_days_since_first_delivery")
    )


def age_for_scoring(tables: Tables, date) -> DataFrame:
    """Days from a submarket's first delivery to two days before the test date."""
    return first_delivery(tables).select(
        "submarket_id",
        day_diff("first_day", plus_days(F.lit(as_date(date)), -2)).alias("submarket_days_since_first_delivery"),
    )
