"""Live sales of chains and the adjustment of predictions towards them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import is_true, ratio
from tamarind.operators.sliding import sliding_totals
from tamarind.sources.tables import Tables

MONTH = (-28, -1)
GRAINS = {
    "starting_point": ["sub_id", "sp_id", "restaurant_name"],
    "submarket": ["sub_id", "restaurant_name"],
    "global": ["restaurant_name"],
}


def chain_sales(tables: Tables, dates: Iterable, grain: str) -> DataFrame:
    """Partner sales per partner store over t-28 .. t-1. NULL without partner sales."""
    keys = GRAINS[grain]
    # A row per store and day meets the chain list, not each delivery; the list may name a store twice.
    daily = tables.core.groupBy("store_id", "active_date").agg(
        F.sum(F.when(is_true("is_partner"), F.col("subtotal"))).alias("cents"),
        F.max(is_true("is_partner")).alias("partner"),
    )
    listed = tables.enterprise_merchants.where(F.col("store_id").isNotNull())
    totals = sliding_totals(
        daily.join(listed, "store_id"), keys, dates, *MONTH,
        {"cents": F.col("cents")}, {"stores": ("store_id", F.col("partner"))}, as_name="created_date",
    )
    return totals.select(*keys, "created_date", ratio(F.col("cents") / 100, "stores").alias("l28d_avg_sales"))


def adjust_predictions(
    tables: Tables, predictions: DataFrame, by_point: DataFrame, by_sub: DataFrame, overall: DataFrame
) -> DataFrame:
    """Half the prediction, half the closest known chain sales.

    The three sales tables hold one row per chain and date; joined on both.
    """
    place = tables.registry.select(
        F.col("id").alias("match_id"), F.col("restaurant_name").alias("__name"), "sub_id", "sp_id"
    )
    raw = predictions.join(place, "match_id", "left")

    def sales(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        return df.select(
            *keys, F.col("restaurant_name").alias("__name"), F.col("created_date").alias("create_date"),
            F.col("l28d_avg_sales").alias(name),
        )

    out = (
        raw.join(sales(by_point, "l28d_avg_sales", ["sub_id", "sp_id"]), ["__name", "sub_id", "sp_id", "create_date"], "left")
        .join(sales(by_sub, "sub_l28d_avg_sales", ["sub_id"]), ["__name", "sub_id", "create_date"], "left")
        .join(sales(overall, "global_l28d_avg_sales", []), ["__name", "create_date"], "left")
    )
    known = F.coalesce("l28d_avg_sales", "sub_l28d_avg_sales", "global_l28d_avg_sales", "pred")
    return out.select(
        *[F.col(c) for c in predictions.columns],
        "l28d_avg_sales",
        "sub_l28d_avg_sales",
        "global_l28d_avg_sales",
        (0.5 * F.col("pred") + 0.5 * known).alias("pred_ent_adj"),
    )
