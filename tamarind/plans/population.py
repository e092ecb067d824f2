"""Who is scored: registry filters, deactivated, active and net-new merchants."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date, is_true, local_day, plus_days
from tamarind.operators.keyed import without_keys
from tamarind.operators.snapshot import latest_load
from tamarind.session import cut_lineage
from tamarind.sources.tables import Tables

FRAUD = "Fraudulent Store"
DEFAULT_ZONE = "US/Pacific"
SNAPSHOTS_AFTER = dt.date(2018, 10, 15)  # daily status snapshots are kept since then
EXCLUDED_REASON = 1

DATED = "create_date"

POPULATION = [
    "match_id", "store_id", "vendor_1_id", "vendor_2_id", "name", "business_id", "starting_point_id",
    "submarket_id", "most_recent_deactivation_timestamp", "activation_date", "merchant_type_prod",
]


def on_dates(df: DataFrame, dates: Iterable[DateLike]) -> DataFrame:
    """Each row once for every test date, named ``create_date``. What doesn't
    depend on the date is computed before, once for all of them."""
    wanted = sorted({as_date(d) for d in dates})
    if not wanted:
        raise ValueError("no dates requested")
    return df.withColumn(DATED, F.explode(F.array(*[F.lit(d) for d in wanted])))


def without_fraud(df: DataFrame, tables: Tables, key: str = "store_id") -> DataFrame:
    """Drop rows of stores closed for fraud; rows without a store stay."""
    fraud = tables.stores.where(F.col("last_deactivation_reason") == FRAUD)
    return without_keys(df, key, fraud, "store_id")


def open_registry(tables: Tables, drop_fraud: bool = True) -> DataFrame:
    """Filtered registry without stores that are live partners."""
    live = tables.stores.where(is_true("is_active") & is_true("is_partner"))
    rows = without_keys(tables.registry_filtered, "store_id", live, "store_id")
    return without_fraud(rows, tables) if drop_fraud else rows


def _described(rows: DataFrame, tables: Tables) -> DataFrame:
    """Registry rows with the store and external listing filling their gaps."""
    stores = tables.stores.select(
        "store_id", F.col("name").alias("d_name"), "business_id", F.col("starting_point_id").alias("d_sp"),
        F.col("submarket_id").alias("d_sub"), "market_id", F.lit(True).alias("d_known"),
    )
    listed = tables.external_stores.select(
        "store_id", "external_id", F.col("starting_point_id").alias("e_sp")
    )
    return (
        rows.join(stores, "store_id", "left")
        .join(listed, "store_id", "left")
        .select(
            F.col("id").alias("match_id"),
            "store_id",
            F.coalesce("vendor_1_id", "external_id").alias("vendor_1_id"),
            "vendor_2_id",
            F.coalesce("restaurant_name", "d_name").alias("name"),
            "business_id",
            F.coalesce("sp_id", "d_sp", "e_sp").alias("starting_point_id"),
            F.coalesce("sub_id", "d_sub").alias("submarket_id"),
            "market_id",
        )
    )


def last_deactivations(tables: Tables) -> DataFrame:
    """The latest deactivation of each store, as the struct ``d``."""
    # A maximum of structs combines before the shuffle.
    return tables.store_deactivations.groupBy("store_id").agg(F.max(F.struct("created_at", "id", "reason_id")).alias("d"))


def deactivated_merchants(tables: Tables, closings: DataFrame | None = None) -> DataFrame:
    """Inactive merchants with a core delivery, and the local day of their last
    sign of life. ``closings`` are :func:`last_deactivations` that several jobs share."""
    rows = open_registry(tables).where(~F.coalesce("is_active", F.lit(False)) & F.col("store_id").isNotNull())
    last = tables.core.groupBy("store_id", F.col("starting_point_id").alias("o_sp")).agg(
        F.max("created_at").alias("last_order"),
        F.max(F.col("active_date").cast("timestamp_ntz")).alias("last_day"),
    )
    closed = (last_deactivations(tables) if closings is None else closings).select("store_id", F.col("d.created_at").alias("closed_at"))
    left = tables.deact_react.groupBy("store_id").agg(F.max("most_recent_deact").alias("left_at"))
    zones = tables.markets.select(F.col("id").alias("market_id"), "timezone")
    group = [
        "match_id", "store_id", "vendor_1_id", "vendor_2_id", "name", "business_id", "starting_point_id",
        "submarket_id",
    ]
    joined = (
        _described(rows, tables)
        .join(last, "store_id")
        .join(closed, "store_id", "left")
        .join(left, "store_id", "left")
        .join(zones, "market_id", "left")
        .withColumn("starting_point_id", F.coalesce("starting_point_id", "o_sp"))
    )
    at = F.coalesce(F.max("last_order"), F.max("closed_at"), F.max("last_day"), F.max("left_at"))
    zone = F.coalesce(F.max("timezone"), F.lit(DEFAULT_ZONE))
    return (
        joined.groupBy(*group)
        .agg(at.alias("__at"), zone.alias("__zone"))
        .select(*group, local_day("__at", "__zone").alias("most_recent_deactivation_date"))
    )


def active_nonpartners_on(tables: Tables, dates: Iterable[DateLike]) -> DataFrame:
    """Active merchants that are not partners, for every date; deactivation is
    set to the day before."""
    rows = open_registry(tables).where(is_true("is_active") & ~F.coalesce("is_partner", F.lit(False)))
    return on_dates(_described(rows, tables).drop("market_id"), dates).withColumn(
        "most_recent_deactivation_date", plus_days(F.col(DATED), -1)
    )


def active_nonpartners(tables: Tables, date: DateLike) -> DataFrame:
    return active_nonpartners_on(tables, [date]).drop(DATED)


def last_nonpartner_days_on(
    tables: Tables, dates: Iterable[DateLike], snapshots_after: dt.date = SNAPSHOTS_AFTER,
    closings: DataFrame | None = None,
) -> DataFrame:
    """Closed stores with the last day they were live as non-partners, for every
    date. Status and deactivations are reduced once; a date only decides which
    of the found days lie at least a week back. ``closings`` as for
    :func:`deactivated_merchants`."""
    closed = tables.stores.where(~F.col("is_active")).select("store_id")
    live = (
        tables.store_status.where(
            is_true("active_eop")
            & F.col("partner_eop").eqNullSafe(F.lit(False))
            & (F.col("date_stamp") > F.lit(snapshots_after))
        )
        .groupBy("store_id")
        .agg(F.max("date_stamp").alias("last_live"))
    )
    newest = (last_deactivations(tables) if closings is None else closings).select(
        "store_id", F.col("d.created_at").cast("date").alias("deactivated_on"), "d.reason_id"
    )
    known = (
        closed.join(live, "store_id", "left")
        .join(newest, "store_id", "left")
        .where(F.col("reason_id").isNull() | (F.col("reason_id") != EXCLUDED_REASON))
    )
    limit = plus_days(F.col(DATED), -7)
    seen = F.coalesce("last_np_live_date", "deactivated_on")
    return (
        on_dates(known, dates)
        .withColumn("last_np_live_date", F.when(F.col("last_live") < limit, F.col("last_live")))
        .where(seen.isNull() | (seen < limit))
        .select("store_id", F.coalesce("deactivated_on", "last_np_live_date").alias("last_np_live_day"), DATED)
    )


def last_nonpartner_days(
    tables: Tables, date: DateLike, snapshots_after: dt.date = SNAPSHOTS_AFTER
) -> DataFrame:
    return last_nonpartner_days_on(tables, [date], snapshots_after).drop(DATED)


def activated_after_danp_on(tables: Tables, dates: Iterable[DateLike]) -> DataFrame:
    """Merchants reactivated after a test date; in a backfill they were still
    to be scored."""
    kind = F.when(F.col("merchant_type") == "active_np", F.lit("active")).when(
        F.col("merchant_type") == "deactivated_np", F.lit("deactivated")
    )
    return (
        on_dates(latest_load(tables.label_danp).drop(DATED), dates)
        .where(F.col("reactivation_timestamp") > F.col(DATED))
        .select(
            "match_id",
            "store_id",
            "vendor_1_id",
            F.lit(None).cast("string").alias("vendor_2_id"),
            F.col("external_store_name").alias("name"),
            "business_id",
            "starting_point_id",
            "submarket_id",
            "most_recent_deactivation_timestamp",
            plus_days(F.col(DATED), -1).alias("activation_date"),
            kind.alias("merchant_type_prod"),
            DATED,
        )
    )


def activated_after_danp(tables: Tables, date: DateLike) -> DataFrame:
    return activated_after_danp_on(tables, [date]).drop(DATED)


def activated_after_nn_on(tables: Tables, dates: Iterable[DateLike]) -> DataFrame:
    """Merchants activated on or after a test date."""
    return (
        on_dates(latest_load(tables.label_nn).drop(DATED), dates)
        .where(F.col("store_activation_date") >= F.col(DATED))
        .select(
            F.col("match_id").alias("id"),
            F.col("store_activation_date").alias("activation_date"),
            F.col("starting_point_id").alias("sp_id"),
            F.col("submarket_id").alias("sub_id"),
            "vendor_1_id",
            "restaurant_name",
            DATED,
        )
    )


def activated_after_nn(tables: Tables, date: DateLike) -> DataFrame:
    return activated_after_nn_on(tables, [date]).drop(DATED)


def known_merchants_on(
    tables: Tables, dates: Iterable[DateLike], snapshots_after: dt.date = SNAPSHOTS_AFTER
) -> DataFrame:
    """Deactivated and active non-partner merchants to score on each date, without copies."""
    dates = list(dates)
    yesterday = plus_days(F.col(DATED), -1)
    closings = cut_lineage(last_deactivations(tables), "closings")  # one row per store, for both jobs
    gone = (
        on_dates(deactivated_merchants(tables, closings), dates)
        .join(last_nonpartner_days_on(tables, dates, snapshots_after, closings), ["store_id", DATED], "left")
        .withColumn(
            "most_recent_deactivation_timestamp",
            F.coalesce("most_recent_deactivation_date", "last_np_live_day"),
        )
        .withColumns({"activation_date": yesterday, "merchant_type_prod": F.lit("deactivated")})
    )
    active = active_nonpartners_on(tables, dates).withColumns(
        {
            "most_recent_deactivation_timestamp": F.col("most_recent_deactivation_date"),
            "activation_date": yesterday,
            "merchant_type_prod": F.lit("active"),
        }
    )
    later = activated_after_danp_on(tables, dates)
    parts = [df.select(*POPULATION, DATED) for df in (gone, active, later)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def known_merchants(
    tables: Tables, date: DateLike, snapshots_after: dt.date = SNAPSHOTS_AFTER
) -> DataFrame:
    return known_merchants_on(tables, [date], snapshots_after).drop(DATED)


def net_new_merchants_on(tables: Tables, dates: Iterable[DateLike]) -> DataFrame:
    """Merchants never scored as known ones, for every date.

    Inactive ones always qualify; the check against earlier known merchants
    applies to active non-partners only.
    """
    earlier = (
        tables.prior_danp_inputs.where(F.col("match_id").isNotNull())
        .select(F.col("match_id").alias("id"))
        .distinct()
        .withColumn("__scored", F.lit(True))
    )
    rows = open_registry(tables, drop_fraud=False).join(earlier, "id", "left")
    inactive = ~F.coalesce("is_active", F.lit(False))
    nonpartner = ~F.coalesce("is_partner", F.lit(False))
    unseen = F.col("__scored").isNull() & F.col("id").isNotNull()
    dates = list(dates)

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("id").alias("match_id"), F.col("restaurant_name").alias("store_name"), "vendor_1_id",
            F.col("sp_id").alias("starting_point_id"), F.col("sub_id").alias("submarket_id"), DATED,
        )

    picked = shaped(on_dates(rows.where(inactive | (nonpartner & unseen)), dates))
    return picked.unionByName(shaped(activated_after_nn_on(tables, dates))).distinct()


def net_new_merchants(tables: Tables, date: DateLike) -> DataFrame:
    return net_new_merchants_on(tables, [date]).drop(DATED)
