"""Daily feature rows of the merchants to score."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date, day_diff, plus_days, safe_ratio
from tamarind.plans import business, geography, growth, requests, search, store_stats
from tamarind.plans.labels import HISTORY_FROM, requestable
from tamarind.plans.population import SNAPSHOTS_AFTER, known_merchants_on, net_new_merchants_on
from tamarind.session import cut_lineage
from tamarind.sources.tables import Tables

MAX_GAP_DAYS = 364


def _dates(dates: DateLike | Iterable[DateLike]) -> list[dt.date]:
    return [as_date(dates)] if isinstance(dates, str | dt.date) else sorted({as_date(d) for d in dates})


def danp_features(
    tables: Tables,
    dates: DateLike | Iterable[DateLike],
    aov: bool = False,
    history_from: dt.date = HISTORY_FROM,
    snapshots_after: dt.date = SNAPSHOTS_AFTER,
) -> DataFrame:
    """Features of deactivated and active non-partner merchants for one or more test dates.

    All dates share one plan: a row of the population carries its date, and each
    fact is read once whatever their number. The order-value variant looks back over the whole history, adds the average
    order value, requires an active day and leaves out the country.
    """
    dea, act, on = "most_recent_deactivation_timestamp", "activation_date", "create_date"
    days_wanted = _dates(dates)
    # Every feature job below starts from the population: find it once.
    people = known_merchants_on(tables, days_wanted, snapshots_after).where(day_diff(dea, act) <= MAX_GAP_DAYS)
    people = cut_lineage(people, "known-merchants")
    days = None if aov else store_stats.HISTORY_DAYS
    stats = store_stats.before_deactivation(tables, people, at=dea, history_days=days, with_aov=aov, extra=(on,))
    firm = business.business_before(tables, people, act, None if aov else business.HISTORY_DAYS)
    weeks = growth.point_totals(tables, people, dea, act)
    before = growth.point_week(tables, people, dea, "before", extra=(on,), totals=weeks)
    after = growth.point_week(tables, people, act, "after", fixed_fee=growth.SCORING_FEE, extra=(on,), totals=weeks)
    grown = growth.point_growth(before, after, dea, act, (on,)).select(
        "store_id", "starting_point_id", act, on, *growth.GROWTH
    )
    lifetime = store_stats.nonpartner_history(tables, history_from)
    asked = requests.scoring_requests(tables, people.select("match_id").distinct(), days_wanted)
    searched = search.mean_daily_count(tables, days_wanted, "danp")
    place = tables.starting_points.select(
        F.col("id").alias("starting_point_id"), F.col("submarket_id").alias("sp_submarket_id")
    )
    listed = tables.registry.where(F.col("vendor_1_id").isNotNull()).select(
        "vendor_1_id", F.col("id").alias("listed_id")
    )
    gap = day_diff("last_np_order", "first_partner_order")
    nonpartner = F.col("total_nonpartner_orders_lifetime")
    kind = (
        F.when(gap.between(0, 28), F.lit("nonpartner_partner_conversion"))
        .when(nonpartner > 0, F.lit("nonpartner_deactivated_partner"))
        .when(nonpartner == 0, F.lit("partner_deactivated_partner"))
        .otherwise(F.lit("other"))
    )
    rows = (
        people.join(lifetime, "store_id", "left")
        .join(searched, ["match_id", on], "left")
        .join(stats, ["store_id", dea, on], "left")
        .join(firm, ["business_id", act], "left")
        .join(grown, ["store_id", "starting_point_id", act, on], "left")
        .join(place, "starting_point_id", "left")
        .join(asked, ["match_id", on], "left")
        .join(listed, "vendor_1_id", "left")
    )
    if aov:
        rows = rows.where(F.col("num_days_active_before") > 0)
    else:
        rows = rows.join(
            tables.regions.withColumnRenamed("submarket_id", "sp_submarket_id"), "sp_submarket_id", "left"
        )
    extra = ["aov_before"] if aov else []
    country = [] if aov else [F.col("country_id"), F.lit(0).cast("long").alias("rar_not_shown")]
    return rows.select(
        "store_id", "name", F.coalesce("match_id", "listed_id").alias("match_id"), "vendor_1_id",
        "starting_point_id", F.col("sp_submarket_id").alias("submarket_id"),
        requestable().alias("requestable"), dea, kind.alias("merchant_type"),
        "num_orders_before", "num_days_active_before", *extra, "avg_fee_before", "avg_subtotal_before",
        "median_subtotal_before", "max_subtotal_before", "total_subtotal_before",
        store_stats.per_active_day("total_subtotal_before", "num_days_active_before").alias("total_subtotal_per_active_date_before"),
        store_stats.per_active_day("num_orders_before", "num_days_active_before").alias("num_orders_per_active_date_before"),
        "num_first_ordercarts_before", "pct_partner_delivs_before", "num_orders_7days_before",
        "num_days_active_7days_before", "avg_fee_7days_before", "avg_subtotal_7days_before",
        "median_subtotal_7days_before", "total_subtotal_7days_before", "num_first_ordercarts_7days_before",
        "num_days_active_28days_before", "total_subtotal_28days_before", "num_orders_28days_before",
        "num_stores_business_before", "num_orders_business_before", "num_orders_per_store_business_before",
        "avg_subtotal_per_store_business_before", "total_subtotal_business_before",
        "total_subtotal_per_active_date_business_before", *growth.GROWTH,
        "avg_commission_rate_7days_before", "median_commission_rate_7days_before",
        safe_ratio("num_partner_delivs_7days_before", "num_orders_7days_before").alias("pct_partner_delivs_7days_before"),
        "num_requests_l84days", "num_requests_l28days", "num_requests_all_time",
        requests.per_day().alias("num_request_per_day"), "avg_subtotal_from_consumer_request",
        "num_delivery_to_requests_ratio",
        F.coalesce("avg_search_count_84_days_before", F.lit(0.0)).alias("avg_search_count_84_days_before"),
        F.month(act).cast("long").alias("reactivation_month"), F.year(act).cast("long").alias("reactivation_year"),
        F.month(dea).cast("long").alias("deactivation_month"), F.year(dea).cast("long").alias("deactivation_year"),
        "merchant_type_prod", on, *country,
    )


def nn_features(tables: Tables, dates: DateLike | Iterable[DateLike], aov: bool = False) -> DataFrame:
    """Features of net-new merchants for one or more test dates, in one plan."""
    on, days_wanted = "create_date", _dates(dates)
    people = cut_lineage(net_new_merchants_on(tables, days_wanted), "net-new-merchants")
    yesterday = plus_days(F.col(on), -1)
    asked = requests.scoring_requests(tables, people.select("match_id").distinct(), days_wanted)
    searched = search.mean_daily_count(tables, days_wanted, "nn")
    sp = geography.stats_for_scoring(tables, days_wanted, "starting_point", with_aov=aov)
    sub = geography.stats_for_scoring(tables, days_wanted, "submarket", with_aov=aov)
    rows = (
        people.join(searched, ["match_id", on], "left")
        .join(asked, ["match_id", on], "left")
        .join(sp, ["starting_point_id", on], "left")
        .join(sub, ["submarket_id", on], "left")
    )
    country = []
    if not aov:
        rows = rows.join(tables.regions, "submarket_id", "left")
        country = [F.col("country_id"), F.lit(0).cast("long").alias("rar_not_shown")]
    stats = [c for c in [*sp.columns, *sub.columns] if c not in ("starting_point_id", "submarket_id", on)]
    return rows.select(
        "match_id", "store_name", "vendor_1_id", "starting_point_id", "submarket_id",
        requestable().alias("requestable"),
        F.month(yesterday).cast("long").alias("activation_month"),
        F.year(yesterday).cast("long").alias("activation_year"),
        "first_request_requested_at", "last_request_requested_at", "num_requests_l84days",
        "num_requests_l28days", "num_requests_all_time", requests.per_day().alias("num_request_per_day"),
        "avg_subtotal_from_consumer_request", "num_delivery_to_requests_ratio", *stats,
        F.coalesce("avg_search_count_84_days_before", F.lit(0.0)).alias("avg_search_count_84_days_before"),
        on, *country,
    )
