"""Logical tables: declared schemas, physical locations, normalised scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# One line per logical table. Money is integer cents; two-valued columns are
# booleans whatever the source holds (1/0, 'true', true).
SCHEMAS: dict[str, str] = {
    "deliveries": "delivery_id long, store_id long, business_id long, starting_point_id long, "
    "submarket_id long, creator_id long, active_date date, created_at timestamp_ntz, timezone string, "
    "subtotal long, fee long, commission_rate double, is_partner boolean, is_core boolean, "
    "is_first_order boolean",
    "stores": "store_id long, name string, business_name string, business_id long, starting_point_id long, "
    "submarket_id long, market_id long, is_active boolean, is_partner boolean, activated_at timestamp_ntz, "
    "last_deactivation_reason string, order_protocol string, creation_method string",
    "registry": "id string, store_id long, vendor_1_id string, vendor_2_id string, restaurant_name string, "
    "street string, lat double, lng double, sp_id long, sub_id long, national double, is_active boolean, "
    "is_partner boolean, directory_id string, panel_id string, existence_score double, country string",
    "registry_filtered": "id string, store_id long, vendor_1_id string, vendor_2_id string, "
    "restaurant_name string, sp_id long, sub_id long, is_active boolean, is_partner boolean",
    "registry_checks": "mx_id string, place_id string, is_valid_restaurant boolean, permanently_closed long",
    "store_status": "date_stamp date, store_id long, store_name string, business_name string, business_id long, "
    "sp_id long, sp_name string, sub_id long, sub_name string, active_bop boolean, active_eop boolean, "
    "partner_bop boolean, partner_eop boolean",
    "store_deactivations": "id long, store_id long, created_at timestamp_ntz, reason_id long, notes string",
    "deact_react": "store_id long, most_recent_deact timestamp_ntz",
    "external_stores": "store_id long, external_id string, starting_point_id long, cuisine_type string",
    "markets": "id long, timezone string",
    "starting_points": "id long, submarket_id long",
    "regions": "submarket_id long, country_id long",
    "store_requests": "mx_id string, consumer_id long, requested_at timestamp_ntz",
    "search_counts": "store_id string, search_date date, query_count double, store_count double",
    "merchant_dates": "store_id long, last_np_live_day date, activation_date date, level_verification long",
    "vendor_features": "match_id string, store_id long, reviews_mes double, reviews_yelp double, "
    "rating_mes double, rating_yelp double, rating_factus double, sales_chdus double, stars_al double, "
    "reviews_al double, cohort_encoded long, cohort string, sales_chd_agg_encoded long, "
    "years_in_business_encoded long, price_yelp_encoded long, price_mes_encoded long, "
    "price_factus_encoded long, price_al_encoded long, number_of_units_encoded long, dayparts_encoded long, "
    "average_check_encoded long, average_check_amt_encoded long, credit_score_rating_encoded long",
    "label_nn": "match_id string, store_id long, restaurant_name string, vendor_1_id string, "
    "starting_point_id long, submarket_id long, store_activation_date date, first_partner_order_date date, "
    "actual double, create_date date",
    "label_danp": "store_id long, match_id string, vendor_1_id string, store_name string, "
    "external_store_name string, business_id long, starting_point_id long, submarket_id long, "
    "most_recent_deactivation_timestamp date, reactivation_timestamp date, merchant_type string, "
    "reactivation_month long, reactivation_year long, deactivation_month long, deactivation_year long, "
    "num_days_deactive long, num_days_since_reactivation long, actual double, create_date date",
    "prior_danp_inputs": "match_id string",
    "enterprise_merchants": "sub_id long, sp_id long, restaurant_name string, store_id long",
    "business_groups": "id long, is_active boolean, is_test boolean, business_group_type string",
    "business_group_links": "business_id long, business_group_id long",
    "poor_activations": "match_id string",
    "premium_flags": "store_id long, premium long",
    "order_values": "store_id long, subtotal_per_order double",
    "aov_label_nn": "match_id string, store_id long, requestable string, starting_point_id long, "
    "submarket_id long, store_activation_date date, activation_year long, aov_first_148_days double, "
    "total_subtotal_first_120_148_days double, create_date date",
    "aov_label_danp": "match_id string, store_id long, merchant_type string, reactivation_timestamp date, "
    "most_recent_deactivation_timestamp date, aov_first_148_days double, "
    "total_subtotal_first_120_148_days double, create_date date",
    "predictions": "match_id string, activation_date date, pred double, model string, "
    "data_preprocess_model_version string, ml_model_version string, bias_adj_model_version string, "
    "create_date date",
    "decile_metrics": "match_id string, pred_date date, tam_value_pred double, tam_value_actual double, "
    "decile_rank_pred long, decile_rank_actual long",
}


# Feature rows kept whole: further columns of the source pass through.
OPEN = {"aov_label_nn", "aov_label_danp"}


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def normalise(df: DataFrame, schema: StructType, keep_rest: bool = False) -> DataFrame:
    """Lower-case names, reject duplicates and missing columns, cast to the
    declared types. A pure projection: pruning and pushdown pass through."""
    names = [c.lower() for c in df.columns]
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice:
        raise ValueError(f"duplicate columns: {twice}")
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    have = dict(zip(names, df.dtypes))
    out = []
    for f in schema:
        source, kind = have[f.name]
        c = F.col(f"`{source}`")
        out.append(c if kind == f.dataType.simpleString() else c.cast(f.dataType).alias(f.name))
    declared = {f.name for f in schema}
    rest = [F.col(f"`{have[n][0]}`").alias(n) for n in names if n not in declared] if keep_rest else []
    return df.select(*[c.alias(f.name) for c, f in zip(out, schema)], *rest)


class Tables:
    """Logical names bound to frames. ``tables.deliveries`` is the normalised scan."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        unknown = sorted(set(frames) - set(SCHEMAS))
        if unknown:
            raise KeyError(f"unknown logical tables: {unknown}")
        self._frames = dict(frames)
        self._scans: dict[str, DataFrame] = {}

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> "Tables":
        """Bind logical names to catalog tables."""
        return cls({k: spark.table(v) for k, v in names.items()})

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> "Tables":
        """Bind logical names to files."""
        return cls({k: spark.read.format(fmt).load(p) for k, p in paths.items()})

    def with_frames(self, **frames: DataFrame) -> "Tables":
        return Tables({**self._frames, **frames})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self._scans:
            if name not in self._frames:
                raise KeyError(f"table {name!r} is not bound")
            self._scans[name] = normalise(self._frames[name], schema_of(name), name in OPEN)
        return self._scans[name]

    @property
    def core(self) -> DataFrame:
        """Deliveries that count."""
        return self.deliveries.where(F.col("is_core"))
