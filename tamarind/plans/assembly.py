"""Training and scoring sets per segment: nn, ac and da."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date
from tamarind.operators.snapshot import latest_load
from tamarind.plans import search, vendor
from tamarind.sources.tables import Tables

KIND = {"ac": "active_np", "da": "deactivated_np"}  # label tables
KIND_SCORED = {"ac": "active", "da": "deactivated"}  # feature tables
AOV_ACTIVATED_AFTER = dt.date(2018, 10, 27)
HIGH_ORDER_VALUE = 40
SCORED_AGE = 4  # months ahead

BASE_REVIEWS = list(vendor.AVERAGES)
BASE_CATEGORIES = list(vendor.ENCODED)
# The order-value models were built before one vendor was added.
AOV_REVIEWS = [c for c in BASE_REVIEWS if not c.endswith("_al")]
AOV_CATEGORIES = [c for c in BASE_CATEGORIES if c != "price_al"]

GEO_RATES = ["sales_per_partner", "store_partner_percent", "delivery_partner_percent"]


def _with_sales_calendar(df: DataFrame) -> DataFrame:
    day = F.col("min_active_date")
    return df.withColumns(
        {
            "sales_month": F.month(day).cast("long"),
            "sales_quarter": F.quarter(day).cast("long"),
            "sales_year": F.year(day).cast("long"),
        }
    )


def _with_country(df: DataFrame, tables: Tables) -> DataFrame:
    """Country of the submarket, and the constant flag that goes with it."""
    have = df.drop("country_id", "rar_not_shown")
    return have.join(tables.regions, "submarket_id", "left").withColumn(
        "rar_not_shown", F.lit(0).cast("long")
    )


def training_set(
    tables: Tables,
    segment: str,
    labels: DataFrame,
    sub_week: DataFrame | None = None,
    sp_week: DataFrame | None = None,
    dedupe: bool = False,
    found: DataFrame | None = None,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """Sales model training rows from the newest load of a monthly label table.

    ``sub_week`` and ``sp_week`` are the dated seven-day stats, needed for net
    new merchants only. ``found`` are the search lookbacks of
    :func:`search.training_lookbacks` and ``vendors`` the :func:`vendor.vendor_table`
    where several sets share them.
    """
    rows = latest_load(labels)
    if found is None:
        found = search.training_lookbacks(tables, "nn" if segment == "nn" else "danp")
    if segment == "nn":
        act = "store_activation_date"
        sub = sub_week.select(
            "submarket_id", F.col("create_date").alias(act), *[f"submarket_{c}" for c in GEO_RATES]
        )
        sp = sp_week.select(
            "starting_point_id", F.col("create_date").alias(act), *[f"sp_{c}" for c in GEO_RATES]
        )
        base = _with_sales_calendar(_with_country(rows, tables)).select(
            "match_id", "store_id", "submarket_id", "starting_point_id", act,
            F.col(act).alias("activation_date"), "total_subtotal_month", "requestable",
            "num_requests_l28days", "avg_subtotal_from_consumer_request", "min_active_date",
            F.year(act).cast("long").alias("activation_year"), F.month(act).cast("long").alias("activation_month"),
            "sales_month", "sales_quarter", "sales_year", "age_month", "country_id", "rar_not_shown",
        )
        base = (
            base.join(sub, ["submarket_id", act], "left")
            .join(sp, ["starting_point_id", act], "left")
            .drop("submarket_id", "starting_point_id", act)
        )
    else:
        kept = rows.where(F.col("merchant_type") == KIND[segment])
        base = _with_sales_calendar(_with_country(kept, tables)).withColumn(
            "activation_date", F.col("reactivation_timestamp")
        )
    out = base.join(found, "match_id", "left")
    return vendor.join_vendor(out, tables, BASE_REVIEWS, BASE_CATEGORIES, dedupe, vendors)


def scoring_set(
    tables: Tables,
    segment: str,
    date: DateLike,
    features: DataFrame,
    search_features: DataFrame,
    sub_week: DataFrame | None = None,
    sp_week: DataFrame | None = None,
    dedupe: bool = False,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """Sales model scoring rows of one test date, four months ahead."""
    day = F.lit(as_date(date))
    rows = features.where(F.col("create_date") == day)
    found = search_features.where(F.col("create_date") == day).drop("create_date")
    if segment == "nn":
        sub = sub_week.where(F.col("create_date") == day).select(
            "submarket_id", *[F.col(f"submarket_{c}").alias(f"w_submarket_{c}") for c in GEO_RATES]
        )
        sp = sp_week.where(F.col("create_date") == day).select(
            "starting_point_id", *[F.col(f"sp_{c}").alias(f"w_sp_{c}") for c in GEO_RATES]
        )
        base = (
            rows.join(sub, "submarket_id", "left")
            .join(sp, "starting_point_id", "left")
            .select(
                "match_id", "store_name", "vendor_1_id", "starting_point_id", "submarket_id", "requestable",
                "activation_month", "activation_year", "first_request_requested_at", "last_request_requested_at",
                "num_requests_l84days", "num_requests_l28days", "num_requests_all_time", "num_request_per_day",
                "avg_subtotal_from_consumer_request", "num_delivery_to_requests_ratio", "create_date",
                "country_id", "rar_not_shown",
                *[F.col(f"w_{p}_{c}").alias(f"{p}_{c}") for p in ("submarket", "sp") for c in GEO_RATES],
            )
        )
    else:
        base = rows.where(F.col("merchant_type_prod") == KIND_SCORED[segment])
    out = vendor.join_vendor(base.join(found, "match_id", "left"), tables, BASE_REVIEWS, BASE_CATEGORIES, dedupe, vendors)
    later = F.add_months(day, SCORED_AGE)
    return out.withColumns(
        {
            "age_month": F.lit(SCORED_AGE).cast("long"),
            "sales_year": F.year(later).cast("long"),
            "sales_month": F.month(later).cast("long"),
            "activation_date": day,
        }
    )


def aov_training_set(
    tables: Tables,
    segment: str,
    version: str,
    activated_after: DateLike = AOV_ACTIVATED_AFTER,
    dedupe: bool = False,
    found: DataFrame | None = None,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """Order-value training rows.

    v0 labels an average order value of at least 40; v1 takes the premium flag
    and v2 the value per order of the store, both by inner join. ``found`` are the
    search lookbacks and ``vendors`` the vendors' features where several sets share them.
    """
    act = "store_activation_date" if segment == "nn" else "reactivation_timestamp"
    rows = latest_load(tables.aov_label_nn if segment == "nn" else tables.aov_label_danp)
    rows = rows.where(F.col("total_subtotal_first_120_148_days") >= 0)
    rows = rows.where(F.col(act) > F.lit(as_date(activated_after)))
    if segment != "nn":
        rows = rows.where(F.col("merchant_type") == KIND[segment])
    rows = rows.withColumn("activation_date", F.col(act))
    if version == "v0":
        high = F.col("aov_first_148_days") >= HIGH_ORDER_VALUE
        rows = rows.withColumn("aov_first_148_days_high", F.when(high, 1).otherwise(0).cast("long"))
    elif version == "v1":
        rows = rows.join(
            tables.premium_flags.select("store_id", F.col("premium").alias("is_premium")), "store_id"
        )
    elif version == "v2":
        rows = rows.join(tables.order_values, "store_id")
    else:
        raise ValueError(f"unknown version {version!r}")
    if found is None:
        found = search.training_lookbacks(tables, "nn" if segment == "nn" else "danp")
    return vendor.join_vendor(
        rows.join(found, "match_id", "left"), tables, AOV_REVIEWS, AOV_CATEGORIES, dedupe, vendors
    )


def aov_scoring_set(
    tables: Tables,
    segment: str,
    version: str,
    date: DateLike,
    features: DataFrame,
    search_features: DataFrame,
    dedupe: bool = False,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """Order-value scoring rows. v1 keeps merchants with search features only."""
    day = F.lit(as_date(date))
    rows = features.where(F.col("create_date") == day)
    if segment != "nn":
        rows = rows.where(F.col("merchant_type_prod") == KIND_SCORED[segment])
    found = search_features.where(F.col("create_date") == day).drop("create_date")
    how = "inner" if version == "v1" else "left"
    out = vendor.join_vendor(rows.join(found, "match_id", how), tables, AOV_REVIEWS, AOV_CATEGORIES, dedupe, vendors)
    return out.withColumn("activation_date", day)


@dataclass(frozen=True)
class Dataset:
    """A named frame builder with its column contract."""

    name: str
    build: Callable[[], DataFrame]
    selected: Sequence[str]
    date_cols: Sequence[str] = field(default=())

    def __post_init__(self):
        twice = sorted({c for c in self.selected if list(self.selected).count(c) > 1})
        if twice:
            raise ValueError(f"duplicate selected columns: {twice}")

    def load(self) -> DataFrame:
        """Lower-case names, ISO strings for the listed dates, selected columns only."""
        df = self.build()
        df = df.toDF(*[c.lower() for c in df.columns])
        dated = {c: F.date_format(c, "yyyy-MM-dd") for c in self.date_cols}
        return df.withColumns(dated).select(*self.selected) if dated else df.select(*self.selected)
