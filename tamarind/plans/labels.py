"""Sales labels by month of age, and the fifth-month validation labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import (
    DateLike,
    as_date,
    day_diff,
    dollars,
    is_true,
    local_day,
    month_diff,
    plus_days,
    safe_ratio,
)
from tamarind.operators.asof import pair_in_window
from tamarind.operators.keyed import keys_seen_once
from tamarind.operators.snapshot import latest_load
from tamarind.plans import business, geography, growth, requests, store_stats
from tamarind.plans.population import without_fraud
from tamarind.sources.tables import Tables

ACTIVATED_FROM = dt.date(2018, 10, 1)
HISTORY_FROM = dt.date(2014, 1, 1)
VERIFIED_LEVEL = 2
FIRST_28, FIRST_30 = 27, 29  # last day of the first 28 and 30 days
FIFTH_MONTH = (120, 148)


def requestable(vendor: str = "vendor_1_id"):
    return F.when(F.col(vendor).isNotNull(), F.lit("requestable")).otherwise(F.lit("not_requestable"))


def monthly_sales(
    tables: Tables, anchors: DataFrame, group: list[str], activated: str, start: DateLike, end: DateLike,
    activated_from: DateLike,
) -> DataFrame:
    """Sales per (group, age in months) for ages of one month and more.

    Age depends on the sales month only, so deliveries are first summed per
    store and month.
    """
    months = (
        tables.core.where(F.col("active_date").between(F.lit(as_date(start)), F.lit(as_date(end))))
        .groupBy("store_id", F.trunc("active_date", "month").alias("sales_month"))
        .agg(F.sum("subtotal").alias("cents"), F.min("active_date").alias("first_day"))
    )
    rows = anchors.where(F.col(activated) >= F.lit(as_date(activated_from))).join(months, "store_id")
    aged = rows.withColumn("age_month", month_diff(activated, "sales_month")).where(F.col("age_month") >= 1)
    return aged.groupBy(*group, "age_month").agg(
        F.max(activated).alias(activated),
        F.min("first_day").alias("min_active_date"),
        dollars(F.sum("cents")).alias("total_subtotal_month"),
    )


def nn_sales_by_age(tables: Tables, start, end, activated_from=ACTIVATED_FROM) -> DataFrame:
    return monthly_sales(
        tables, latest_load(tables.label_nn), ["store_id", "restaurant_name", "match_id"],
        "store_activation_date", start, end, activated_from,
    )


def nn_monthly_label(tables: Tables, start: DateLike, end: DateLike, activated_from=ACTIVATED_FROM) -> DataFrame:
    """Net-new training rows: one per merchant and month of age, with features
    as of activation."""
    act = "store_activation_date"
    anchors = latest_load(tables.label_nn)
    sales = nn_sales_by_age(tables, start, end, activated_from).drop("store_id", "restaurant_name")
    asked = anchors.select("match_id", "store_id", act).distinct().join(
        requests.request_features(tables, anchors, act, requests.TRAIN), ["match_id", act]
    )
    asked = asked.drop("store_id", act, "first_request_requested_at", "last_request_requested_at")
    mx = tables.registry.select(F.col("id").alias("match_id"), F.col("vendor_1_id").alias("mx_vendor"))
    merchants = anchors.select(
        "match_id", "store_id", "restaurant_name", "starting_point_id", "submarket_id",
        F.col(act).alias("__act"), "first_partner_order_date",
    )
    sp = geography.stats_at_activation(tables, anchors, "starting_point").withColumnRenamed(act, "__act")
    sub = geography.stats_at_activation(tables, anchors, "submarket").withColumnRenamed(act, "__act")
    age = geography.age_at_activation(tables, anchors).withColumnRenamed(act, "__act")
    rows = (
        sales.join(merchants, "match_id", "left")
        .join(mx, "match_id", "left")
        .join(sp, ["starting_point_id", "__act"], "left")
        .join(sub, ["submarket_id", "__act"], "left")
        .join(age, ["submarket_id", "__act"], "left")
        .join(asked, "match_id", "left")
    )
    stats = [c for c in [*sp.columns, *age.columns, *sub.columns] if c.startswith(("sp_", "submarket_")) and c != "submarket_id"]
    out = rows.select(
        "match_id", "store_id", "restaurant_name", "starting_point_id", "submarket_id", "age_month", act,
        "min_active_date", "total_subtotal_month", requestable("mx_vendor").alias("requestable"),
        "first_partner_order_date",
        F.month("__act").cast("long").alias("activation_month"),
        F.year("__act").cast("long").alias("activation_year"),
        "num_requests_l84days", "num_requests_l28days", "num_requests_all_time",
        requests.per_day().alias("num_request_per_day"),
        "avg_subtotal_from_consumer_request", "num_delivery_to_requests_ratio",
        safe_ratio("num_requests_l28days", "sp_num_consumers").alias("requests_to_sp_consumers_ratio"),
        safe_ratio("num_requests_l28days", "sp_total_sales").alias("requests_to_sp_sales_ratio"),
        *dict.fromkeys(stats),
        F.lit(as_date(end)).alias("create_date"),
    )
    return without_fraud(out, tables)


def danp_sales_by_age(tables: Tables, start, end, activated_from=ACTIVATED_FROM) -> DataFrame:
    return monthly_sales(
        tables, latest_load(tables.label_danp), ["store_id", "most_recent_deactivation_timestamp"],
        "reactivation_timestamp", start, end, activated_from,
    )


def danp_monthly_label(
    tables: Tables, start: DateLike, end: DateLike, activated_from=ACTIVATED_FROM
) -> DataFrame:
    """Training rows of deactivated and active non-partner merchants."""
    dea, act = "most_recent_deactivation_timestamp", "reactivation_timestamp"
    anchors = latest_load(tables.label_danp)
    sales = danp_sales_by_age(tables, start, end, activated_from)
    described = anchors.select(
        "store_id", dea, "match_id", F.col("store_name").alias("platform_store_name"), "starting_point_id",
        "business_id", F.col(act).alias("__act"), "merchant_type", "reactivation_month", "reactivation_year",
        "deactivation_month", "deactivation_year", "num_days_deactive", "num_days_since_reactivation",
    )
    mx = tables.registry.where(F.col("store_id").isNotNull()).select(
        "store_id", F.col("vendor_1_id"), F.col("restaurant_name").alias("external_store_name")
    )
    stats = store_stats.before_deactivation(
        tables, anchors, at=dea, fill_zero=False, extra=("match_id", act)
    ).drop("match_id", act)
    firm = business.business_before(tables, anchors, act).withColumnRenamed(act, "__act")
    weeks = growth.point_totals(tables, anchors, dea, act)
    before = growth.point_week(tables, anchors, dea, "before", partner_default=False, totals=weeks)
    after = growth.point_week(tables, anchors, act, "after", totals=weeks)
    grown = growth.point_growth(before, after, dea, act).select(
        "store_id", "starting_point_id", F.col(act).alias("__act"), *growth.GROWTH
    )
    place = tables.starting_points.select(F.col("id").alias("starting_point_id"), "submarket_id")
    asked = (
        anchors.select("match_id", "store_id", act)
        .distinct()
        .join(requests.request_features(tables, anchors, act, requests.TRAIN), ["match_id", act])
        .drop("store_id", act, "first_request_requested_at", "last_request_requested_at")
    )
    rows = (
        sales.join(described, ["store_id", dea], "left")
        .join(mx, "store_id", "left")
        .join(stats, ["store_id", dea], "left")
        .join(firm, ["business_id", "__act"], "left")
        .join(grown, ["store_id", "starting_point_id", "__act"], "left")
        .join(place, "starting_point_id", "left")
        .join(asked, "match_id", "left")
        .where(F.col("num_days_active_before") > 0)
    )
    out = rows.select(
        "store_id", "age_month", "min_active_date", "match_id", "vendor_1_id", "platform_store_name",
        "external_store_name", "starting_point_id", "business_id", "submarket_id",
        requestable().alias("requestable"), dea, act, "merchant_type",
        "num_orders_before", "num_days_active_before", "avg_fee_before", "avg_fee_28days_before",
        "avg_subtotal_before", "median_subtotal_before", "max_subtotal_before", "total_subtotal_before",
        store_stats.per_active_day("total_subtotal_before", "num_days_active_before").alias("total_subtotal_per_active_date_before"),
        store_stats.per_active_day("num_orders_before", "num_days_active_before").alias("num_orders_per_active_date_before"),
        "num_first_ordercarts_before", "pct_partner_delivs_before", "num_orders_7days_before",
        "num_days_active_7days_before", "avg_fee_7days_before", "avg_subtotal_7days_before",
        "median_subtotal_7days_before", "total_subtotal_7days_before", "num_first_ordercarts_7days_before",
        "num_days_active_28days_before", "total_subtotal_28days_before", "num_orders_28days_before",
        "num_stores_business_before", "num_orders_business_before", "num_orders_per_store_business_before",
        "avg_subtotal_per_store_business_before", "total_subtotal_business_before",
        "total_subtotal_per_active_date_business_before",
        "reactivation_month", "reactivation_year", "deactivation_month", "deactivation_year",
        "num_days_deactive", "num_days_since_reactivation", *growth.GROWTH,
        "avg_commission_rate_7days_before", "median_commission_rate_7days_before",
        safe_ratio("num_partner_delivs_7days_before", "num_orders_7days_before").alias("pct_partner_delivs_7days_before"),
        "total_subtotal_month", "num_requests_l84days", "num_requests_l28days", "num_requests_all_time",
        requests.per_day().alias("num_request_per_day"), "num_delivery_to_requests_ratio",
        "avg_subtotal_from_consumer_request", F.lit(as_date(end)).alias("create_date"),
    )
    return without_fraud(out, tables)


def unique_merchant_dates(tables: Tables) -> DataFrame:
    """Verified dates of stores that have exactly one different record."""
    cols = ["store_id", "last_np_live_day", "activation_date", "level_verification"]
    once = keys_seen_once(tables.merchant_dates.select(*cols).distinct(), "store_id")
    return once.where(F.col("level_verification") == VERIFIED_LEVEL)


def partner_stores(tables: Tables, as_of: DateLike) -> DataFrame:
    """Status rows of stores that were live partners a week before ``as_of``."""
    return tables.store_status.where(
        (F.col("date_stamp") == plus_days(F.lit(as_date(as_of)), -7))
        & is_true("active_bop")
        & is_true("partner_bop")
    )


def first_orders(tables: Tables, since: dt.date = HISTORY_FROM) -> DataFrame:
    """Local day of the first order and the first partner order per (store, starting point)."""
    day = local_day("created_at", "timezone")
    return (
        tables.core.where(F.col("created_at") > F.lit(since).cast("timestamp_ntz"))
        .groupBy("store_id", "starting_point_id")
        .agg(
            F.min(day).alias("first_order_date"),
            F.min(F.when(is_true("is_partner"), day)).alias("first_partner_order_date"),
        )
    )


def nn_activations(tables: Tables, as_of: DateLike, since: dt.date = HISTORY_FROM) -> DataFrame:
    """Partner stores that were net new, with a proxy activation date."""
    mx = tables.registry.where(F.col("store_id").isNotNull()).select(
        "store_id", F.col("id").alias("match_id"), F.col("restaurant_name").alias("mx_name")
    )
    partners = (
        partner_stores(tables, as_of)
        .join(mx, "store_id")
        .where(F.col("match_id").isNotNull())
        .select(
            "store_id", "match_id", F.coalesce("mx_name", "business_name").alias("restaurant_name"),
            F.col("sp_id").alias("starting_point_id"), F.col("sub_id").alias("submarket_id"),
        )
        .distinct()
    )
    dates = unique_merchant_dates(tables).select("store_id", "activation_date")
    first = first_orders(tables, since).drop("starting_point_id")
    return (
        partners.join(dates, "store_id", "left")
        .join(first, "store_id")
        .withColumn("store_activation_date", F.coalesce("activation_date", "first_partner_order_date"))
        .where(F.col("first_order_date") == F.col("first_partner_order_date"))
        .where(F.col("store_activation_date").isNotNull())
        .drop("activation_date")
    )


def _daily_cents(tables: Tables) -> DataFrame:
    return tables.core.groupBy("store_id", "active_date").agg(F.sum("subtotal").alias("cents"))


def nn_fifth_month(tables: Tables, as_of: DateLike, since: dt.date = HISTORY_FROM) -> DataFrame:
    """Net-new validation label: sales of the first 28 and 30 days and of days
    120 to 148 after activation."""
    act = "store_activation_date"
    stores = nn_activations(tables, as_of, since)
    group = ["store_id", "restaurant_name", "match_id"]
    pairs = pair_in_window(
        stores.select(*group, act), _daily_cents(tables), ["store_id"], act, "active_date", 0, FIFTH_MONTH[1]
    )
    age = day_diff(act, "active_date")
    target = pairs.groupBy(*group).agg(
        F.sum(F.when(age <= FIRST_28, F.col("cents"))).alias("c28"),
        F.sum(F.when(age <= FIRST_30, F.col("cents"))).alias("c30"),
        F.sum(F.when(age.between(*FIFTH_MONTH), F.col("cents"))).alias("c5"),
    )
    per_group = stores.select(*group).distinct().join(target, group, "left")
    # Sales come back by store, as stores may carry several merchant ids.
    sales = per_group.select(
        "store_id",
        *[
            F.coalesce(dollars(c), F.lit(0.0)).alias(f"total_subtotal_first_{n}_days")
            for c, n in (("c28", "28"), ("c30", "30"), ("c5", "120_148"))
        ],
    )
    mx = tables.registry.select(F.col("id").alias("match_id"), "vendor_1_id")
    rows = stores.join(mx, "match_id", "left").join(sales, "store_id")
    out = rows.select(
        "match_id", "vendor_1_id", "store_id", "restaurant_name", "starting_point_id", "submarket_id",
        requestable().alias("requestable"), "first_partner_order_date", act,
        F.month(act).cast("long").alias("activation_month"), F.year(act).cast("long").alias("activation_year"),
        "total_subtotal_first_28_days", "total_subtotal_first_30_days", "total_subtotal_first_120_148_days",
        F.lit(as_date(as_of)).alias("create_date"),
    )
    return without_fraud(out, tables)


def danp_fifth_month(tables: Tables, as_of: DateLike, since: dt.date = HISTORY_FROM) -> DataFrame:
    """Validation label of reactivated merchants, with their type."""
    dea, act = "most_recent_deactivation_timestamp", "reactivation_timestamp"
    mx = tables.registry.where(F.col("store_id").isNotNull()).select(
        "store_id", F.col("id").alias("match_id"), "vendor_1_id",
        F.col("restaurant_name").alias("external_store_name"),
    )
    dates = unique_merchant_dates(tables).where(F.col("activation_date").isNotNull())
    since_days = day_diff(act, plus_days(F.lit(as_date(as_of)), -8))
    stores = (
        partner_stores(tables, as_of)
        .join(dates, "store_id")
        .join(mx, "store_id")
        .select(
            "store_id", "match_id", F.col("store_name").alias("platform_store_name"), "business_id",
            F.col("sp_id").alias("starting_point_id"), F.col("last_np_live_day").alias(dea),
            F.col("activation_date").alias(act), "vendor_1_id", "external_store_name",
        )
        .withColumn("num_days_since_reactivation", since_days)
        .where(F.col("num_days_since_reactivation") > 28)
    )
    lifetime = store_stats.nonpartner_history(tables, since).select("store_id", "total_nonpartner_orders_lifetime")
    # A core delivery on or before the deactivation day is required.
    opened = tables.core.groupBy("store_id").agg(F.min("active_date").alias("first_day"))
    pairs = pair_in_window(
        stores.select("store_id", act).distinct(), _daily_cents(tables), ["store_id"], act, "active_date", *FIFTH_MONTH
    )
    target = pairs.groupBy("store_id", act).agg(
        dollars(F.sum("cents")).alias("total_subtotal_first_120_148_days")
    )
    place = tables.starting_points.select(F.col("id").alias("starting_point_id"), "submarket_id")
    gap = day_diff(dea, act)
    others = F.coalesce("total_nonpartner_orders_lifetime", F.lit(0))
    kind = (
        F.when(gap.between(0, 28), F.lit("active_np"))
        .when((gap > 28) & (others != 0), F.lit("deactivated_np"))
        .when(others == 0, F.lit("net_new"))
    )
    rows = (
        stores.join(lifetime, "store_id", "left")
        .join(opened, "store_id")
        .where(F.col("first_day") <= F.col(dea))
        .join(target, ["store_id", act], "left")
        .join(place, "starting_point_id", "left")
    )
    out = rows.select(
        "store_id", "match_id", "vendor_1_id", "platform_store_name", "external_store_name", "starting_point_id",
        "business_id", "submarket_id", requestable().alias("requestable"), dea, act, kind.alias("merchant_type"),
        F.month(act).cast("long").alias("reactivation_month"), F.year(act).cast("long").alias("reactivation_year"),
        F.month(dea).cast("long").alias("deactivation_month"), F.year(dea).cast("long").alias("deactivation_year"),
        gap.alias("num_days_deactive"), "num_days_since_reactivation", "total_subtotal_first_120_148_days",
        F.lit(as_date(as_of)).alias("create_date"),
    )
    return without_fraud(out, tables)
