"""What the store's business did before an anchor date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import dollars, ratio, safe_ratio
from tamarind.operators.asof import pair_in_window
from tamarind.operators.keyed import with_defaults
from tamarind.operators.rollup import delivery_totals, running_totals
from tamarind.sources.tables import Tables

HISTORY_DAYS = 180


def _within(tables: Tables, anchors: DataFrame, at: str, history_days: int) -> DataFrame:
    return delivery_totals(
        tables.core,
        ["business_id"],
        lambda df: pair_in_window(anchors, df, ["business_id"], at, "active_date", -history_days, 0),
        ["business_id", at],
        ids=["delivery_id"],
        days=True,
    ).select("business_id", at, "stores", F.col("n_delivery_id").alias("deliveries"), "cents", F.col("n_days").alias("days"))


def _ever(tables: Tables, anchors: DataFrame, at: str) -> DataFrame:
    """All history up to the anchor, from first-seen days and running sums: an
    id counts from the first day it is seen."""
    core = tables.core.where(F.col("business_id").isNotNull())
    key = "business_id"

    def first_seen(id_col: str, name: str) -> DataFrame:
        seen = core.where(F.col(id_col).isNotNull()).groupBy(key, id_col).agg(F.min("active_date").alias("day"))
        return seen.groupBy(key, "day").agg(F.count(F.lit(1)).alias(name))

    money = core.groupBy(key, F.col("active_date").alias("day")).agg(F.sum("subtotal").alias("cents"))
    steps = (
        money.withColumn("days", F.lit(1).cast("long"))
        .unionByName(first_seen("store_id", "stores"), allowMissingColumns=True)
        .unionByName(first_seen("delivery_id", "deliveries"), allowMissingColumns=True)
    )
    return running_totals(steps, [key], "day", ["stores", "deliveries", "cents", "days"], anchors, at)


def business_before(
    tables: Tables, population: DataFrame, at: str, history_days: int | None = HISTORY_DAYS
) -> DataFrame:
    """One row per different (business_id, anchor date); ``history_days=None``
    takes everything before the anchor. Without business or date there is
    nothing before it, but the row stays."""
    keys = ["business_id", at]
    anchors = population.select(*keys).distinct()
    known = anchors.where(F.col("business_id").isNotNull() & F.col(at).isNotNull())
    if history_days is None:
        totals = _ever(tables, known, at)
    else:
        totals = _within(tables, known, at, history_days)
    out = with_defaults(
        anchors.join(totals, keys, "left"), {"stores": 0, "deliveries": 0, "days": 0}
    )
    return out.select(
        *keys,
        F.col("stores").alias("num_stores_business_before"),
        F.col("deliveries").alias("num_orders_business_before"),
        ratio("deliveries", "stores").alias("num_orders_per_store_business_before"),
        safe_ratio(dollars("cents"), "stores").alias("avg_subtotal_per_store_business_before"),
        dollars("cents").alias("total_subtotal_business_before"),
        safe_ratio(dollars("cents"), "days").alias("total_subtotal_per_active_date_business_before"),
    )
