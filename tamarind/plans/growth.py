"""How a starting point changed between deactivation and (re)activation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import dollars, ratio, safe_ratio
from tamarind.operators.asof import pair_in_window
from tamarind.operators.keyed import with_defaults
from tamarind.operators.rollup import delivery_totals
from tamarind.session import cut_lineage
from tamarind.sources.tables import Tables

WEEK_TO_ANCHOR = (-6, 0)  # half-open seven days ending on the anchor
SCORING_FEE = 2.25  # fixed fee of the later week when scoring


def point_totals(tables: Tables, population: DataFrame, *at: str) -> DataFrame:
    """Totals of the population's starting points in the seven days up to each
    day of the columns ``at``, per (starting point, ``week_end``).

    A week that ends a deactivation and one that ends an activation are the same
    to the fact, so all columns are served by one pass over it. Of several
    columns the totals are written once, for all that read them.
    """
    place = ["starting_point_id", "week_end"]
    wanted = None
    for col in at:
        days = population.select("starting_point_id", F.col(col).alias("week_end"))
        wanted = days if wanted is None else wanted.unionByName(days)
    anchors = wanted.where(F.col("starting_point_id").isNotNull() & F.col("week_end").isNotNull()).distinct()
    week = delivery_totals(
        tables.core,
        ["starting_point_id"],
        lambda df: pair_in_window(anchors, df, ["starting_point_id"], "week_end", "active_date", *WEEK_TO_ANCHOR),
        place,
        ids=["creator_id", "delivery_id"],
    )
    return cut_lineage(week, "point-weeks") if len(at) > 1 else week


def point_week(
    tables: Tables,
    population: DataFrame,
    at: str,
    suffix: str,
    fixed_fee: float | None = None,
    partner_default: bool = True,
    extra: tuple[str, ...] = (),
    totals: DataFrame | None = None,
) -> DataFrame:
    """Stats of the store's starting point in the seven days up to ``at``.

    Computed once per (starting point, date) and handed back to the stores;
    ``totals`` are those of :func:`point_totals` where several weeks share them.
    One row per (store, starting point, date, extra columns); plain sums count
    once per population row of these.
    """
    place = ["starting_point_id", at]
    week = (point_totals(tables, population, at) if totals is None else totals).withColumnRenamed("week_end", at)
    stores = population.groupBy("store_id", *place, *extra).agg(F.count(F.lit(1)).alias("copies"))
    share = ratio("partner_rows", "orders")
    out = stores.join(week, place, "left").select(
        "store_id",
        *place,
        *extra,
        F.col("n_delivery_id").alias(f"num_orders_sp_7days_{suffix}"),
        dollars(F.col("cents") * F.col("copies")).alias(f"total_subtotal_sp_7days_{suffix}"),
        (
            F.lit(fixed_fee) if fixed_fee is not None
            else F.col("fee_cents") / F.nullif(F.col("fee_rows"), F.lit(0)) / 100
        ).alias(f"avg_fee_sp_7days_{suffix}"),
        (F.coalesce(share, F.lit(0.0)) if partner_default else share).alias(f"pct_partner_sp_7days_{suffix}"),
        F.col("stores").alias(f"num_stores_sp_7days_{suffix}"),
        F.col("n_creator_id").alias(f"num_consumers_sp_7days_{suffix}"),
    )
    return with_defaults(out, {f"num_{c}_sp_7days_{suffix}": 0 for c in ("orders", "stores", "consumers")})


def point_growth(
    before: DataFrame, after: DataFrame, deactivated: str, activated: str, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Relative growth between the two weeks, where deactivation precedes activation."""

    def grown(name: str):
        b, a = F.col(f"{name}_before"), F.col(f"{name}_after")
        return safe_ratio(a - b, b)

    pairs = before.join(after, ["store_id", "starting_point_id", *extra]).where(F.col(deactivated) < F.col(activated))
    return pairs.withColumns(
        {
            "total_subtotal_scaler_sp": 1.0 + grown("total_subtotal_sp_7days"),
            "num_orders_growth_sp": grown("num_orders_sp_7days"),
            "num_stores_growth_sp": grown("num_stores_sp_7days"),
            "num_consumers_growth_sp": grown("num_consumers_sp_7days"),
            "pct_partner_change_sp": F.col("pct_partner_sp_7days_after") - F.col("pct_partner_sp_7days_before"),
            "avg_fee_change_sp": F.col("avg_fee_sp_7days_after") - F.col("avg_fee_sp_7days_before"),
        }
    )


GROWTH = [
    "total_subtotal_scaler_sp",
    "num_orders_growth_sp",
    "num_stores_growth_sp",
    "num_consumers_growth_sp",
    "pct_partner_change_sp",
    "avg_fee_change_sp",
]
