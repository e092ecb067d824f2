"""A store's own history before its last deactivation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import dollars, flag, in_days, is_false, is_true, safe_ratio
from tamarind.operators.asof import pair_in_window
from tamarind.operators.keyed import spread_join, with_defaults
from tamarind.operators.rollup import weighted_medians
from tamarind.session import cut_lineage
from tamarind.sources.tables import Tables

HISTORY_DAYS = 180
# The windows are longer than their names: 10 and 31 days.
SHORT_FIRST = -9  # "7days"
LONG_FIRST = -30  # "28days"


def _pairs(anchors: DataFrame, core: DataFrame, key: str, at: str, history_days: int | None) -> DataFrame:
    if history_days is None:
        out = spread_join(core, anchors, [key], by="delivery_id").where(F.col("active_date") <= F.col(at))
    else:
        out = pair_in_window(anchors, core, [key], at, "active_date", -history_days, 0, spread_by="delivery_id")
    return out.withColumns(
        {
            "short": in_days(F.col("active_date"), at, SHORT_FIRST, 0),
            "long": in_days(F.col("active_date"), at, LONG_FIRST, 0),
        }
    )


def before_deactivation(
    tables: Tables,
    population: DataFrame,
    key: str = "store_id",
    at: str = "most_recent_deactivation_timestamp",
    history_days: int | None = HISTORY_DAYS,
    fill_zero: bool = True,
    with_aov: bool = False,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """One row per (store, deactivation, extra columns) of the population.

    Plain sums count once per population row with that store and date, as the
    join they describe does. Rows without store or date have no orders and stay.
    ``fill_zero`` replaces missing amounts by 0 (scoring); training keeps them NULL.
    """
    keys = [key, at]
    anchors = population.groupBy(*keys, *extra).agg(F.count(F.lit(1)).alias("copies"))
    core = tables.core.select(
        F.col("store_id").alias(key), "active_date", "delivery_id", "subtotal", "fee", "commission_rate",
        "is_partner", "is_first_order",
    )
    # Four groupings read the pairs; they are written once instead of scanning
    # the deliveries four times.
    known = anchors.select(*keys).where(F.col(key).isNotNull() & F.col(at).isNotNull()).distinct()
    pairs = cut_lineage(_pairs(known, core, key, at, history_days), "store-orders")
    first, partner = is_true("is_first_order"), is_true("is_partner")

    # Orders and fees, by delivery.
    spans = {"": F.lit(True), "_7days": F.col("short"), "_28days": F.col("long")}
    per_delivery = pairs.groupBy(*keys, "delivery_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(flag(first)).alias("first_rows"),
        F.sum(flag(partner)).alias("partner_rows"),
        *[F.max(flag(c)).alias(f"o{s}") for s, c in spans.items()],
        *[F.max(flag(c & first)).alias(f"f{s}") for s, c in spans.items() if s],
        *[F.max(flag(c & partner)).alias(f"p{s}") for s, c in spans.items() if s],
        *[F.sum(F.when(c, F.col("fee"))).alias(f"fee{s}") for s, c in spans.items()],
        *[F.sum(flag(c & F.col("fee").isNotNull())).alias(f"feen{s}") for s, c in spans.items()],
    )
    named = F.col("delivery_id").isNotNull()
    orders = per_delivery.groupBy(*keys).agg(
        F.sum("first_rows").alias("first_rows"),
        F.sum("partner_rows").alias("partner_rows"),
        F.sum("rows").alias("rows"),
        *[F.sum(F.when(named, F.col(f"o{s}")).otherwise(0)).alias(f"num_orders{s}_before") for s in spans],
        *[F.sum(F.when(named, F.col(f"f{s}")).otherwise(0)).alias(f"num_first_ordercarts{s}_before") for s in spans if s],
        *[F.sum(F.when(named, F.col(f"p{s}")).otherwise(0)).alias(f"num_partner_delivs{s}_before") for s in spans if s],
        *[(F.sum(f"fee{s}") / F.nullif(F.sum(f"feen{s}"), F.lit(0)) / 100).alias(f"avg_fee{s}_before") for s in spans],
    )

    # Active days.
    per_day = pairs.select(*keys, "active_date", "short", "long").distinct()
    days = per_day.groupBy(*keys).agg(
        F.count("active_date").alias("num_days_active_before"),
        F.sum(flag(F.col("short"))).alias("num_days_active_7days_before"),
        F.sum(flag(F.col("long"))).alias("num_days_active_28days_before"),
    )

    # Order values: everything follows from their distribution.
    def distribution(value: str) -> DataFrame:
        return pairs.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(flag(F.col("short"))).alias("n_7days"),
            F.sum(flag(F.col("long"))).alias("n_28days"),
        )

    def mean(value: str, s: str):
        total = F.sum(F.col(value) * F.col(f"n{s}"))
        return total / F.nullif(F.sum(f"n{s}"), F.lit(0))

    amounts = distribution("subtotal")
    sums = amounts.groupBy(*keys).agg(
        *[dollars(mean("subtotal", s)).alias(f"avg_subtotal{s}_before") for s in spans],
        *[
            F.sum(F.when(F.col(f"n{s}") > 0, F.col("subtotal") * F.col(f"n{s}"))).alias(f"cents{s}")
            for s in spans
        ],
        dollars(F.max("subtotal")).alias("max_subtotal_before"),
    )
    medians = weighted_medians(
        amounts, keys, "subtotal", [f"n{s}" for s in spans], [f"median_cents{s}" for s in spans]
    )
    rates = distribution("commission_rate")
    late = ["_7days", "_28days"]
    rate_means = rates.groupBy(*keys).agg(
        *[mean("commission_rate", s).alias(f"avg_commission_rate{s}_before") for s in late]
    )
    rate_medians = weighted_medians(
        rates, keys, "commission_rate", [f"n{s}" for s in late],
        [f"median_commission_rate{s}_before" for s in late],
    )

    out = anchors
    for part in (orders, days, sums, medians, rate_means, rate_medians):
        out = out.join(part, keys, "left")
    copies = F.col("copies")
    total = dollars(F.col("cents") * copies)
    result = {
        "num_orders_before": F.coalesce("num_orders_before", F.lit(0)),
        "num_days_active_before": F.coalesce("num_days_active_before", F.lit(0)),
        "avg_fee_before": F.col("avg_fee_before"),
        "avg_subtotal_before": F.col("avg_subtotal_before"),
        "total_subtotal_before": total,
        "median_subtotal_before": dollars("median_cents"),
        "max_subtotal_before": F.col("max_subtotal_before"),
        "num_first_ordercarts_before": F.coalesce(F.col("first_rows") * copies, F.lit(0)),
        "pct_partner_delivs_before": safe_ratio("partner_rows", "rows"),
    }
    for s in late:
        # The short total stays in cents; the long one is an amount.
        cents = F.col(f"cents{s}") * copies
        result |= {
            f"num_days_active{s}_before": F.coalesce(f"num_days_active{s}_before", F.lit(0)),
            f"avg_subtotal{s}_before": F.col(f"avg_subtotal{s}_before"),
            f"num_orders{s}_before": F.coalesce(f"num_orders{s}_before", F.lit(0)),
            f"avg_fee{s}_before": F.col(f"avg_fee{s}_before"),
            f"median_subtotal{s}_before": dollars(f"median_cents{s}"),
            f"total_subtotal{s}_before": cents.cast("double") if s == "_7days" else dollars(cents),
            f"avg_commission_rate{s}_before": F.col(f"avg_commission_rate{s}_before"),
            f"median_commission_rate{s}_before": F.col(f"median_commission_rate{s}_before"),
            f"num_first_ordercarts{s}_before": F.coalesce(f"num_first_ordercarts{s}_before", F.lit(0)),
            f"num_partner_delivs{s}_before": F.coalesce(f"num_partner_delivs{s}_before", F.lit(0)),
        }
    if with_aov:
        result["aov_before"] = safe_ratio(total, "num_orders_before")
    out = out.select(*keys, *extra, *[c.alias(n) for n, c in result.items()])
    if fill_zero:
        keep_null = {
            "avg_fee_before", "avg_commission_rate_7days_before", "median_commission_rate_7days_before",
        }
        out = with_defaults(out, {n: 0 for n in result if n not in keep_null})
    return out


def nonpartner_history(tables: Tables, since) -> DataFrame:
    """Per store: non-partner orders, and the first and last orders of each kind."""
    rows = tables.core.where(F.col("active_date") >= F.lit(since))
    return rows.groupBy("store_id").agg(
        F.sum(flag(is_false("is_partner"))).alias("total_nonpartner_orders_lifetime"),
        F.min("created_at").alias("first_lifetime_order"),
        F.max(F.when(is_false("is_partner"), F.col("created_at"))).alias("last_np_order"),
        F.min(F.when(is_true("is_partner"), F.col("created_at"))).alias("first_partner_order"),
    )


def per_active_day(total: str, days: str):
    return safe_ratio(total, days)
