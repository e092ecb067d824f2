"""Feature lists and learner settings per segment and model version."""

from __future__ import annotations

from dataclasses import dataclass

# Feature columns, labels and learner settings of the models.

_BASE_NUM = {
    "ac": """
        avg_fee_before
        total_search_count_84_days_before
        total_search_count_28_days_before
        total_search_count_14_days_before
        avg_subtotal_before
        avg_subtotal_per_store_business_before
        num_consumers_growth_sp
        num_days_active_28days_before
        num_orders_28days_before
        num_orders_per_active_date_before
        total_subtotal_28days_before
        total_subtotal_7days_before
        total_subtotal_per_active_date_before
        total_subtotal_per_active_date_business_before
        reviews_mes
        ratings_mes
        reviews_yelp
        rating_yelp
        rating_factus
        stars_al
        reviews_al
        sales_chdus
        age_month
    """.split(),
    "da": """
        total_search_count_84_days_before
        total_search_count_28_days_before
        total_search_count_14_days_before
        num_requests_l28days
        avg_fee_before
        avg_subtotal_before
        avg_subtotal_per_store_business_before
        deactivation_month
        deactivation_year
        num_consumers_growth_sp
        num_first_ordercarts_before
        num_orders_28days_before
        num_orders_per_active_date_before
        total_subtotal_28days_before
        total_subtotal_per_active_date_before
        total_subtotal_per_active_date_business_before
        total_subtotal_scaler_sp
        reviews_mes
        ratings_mes
        reviews_yelp
        rating_yelp
        rating_factus
        stars_al
        reviews_al
        sales_chdus
        age_month
    """.split(),
    "nn": """
        total_search_count_84_days_before
        total_search_count_28_days_before
        total_search_count_14_days_before
        num_requests_l28days
        avg_subtotal_from_consumer_request
        submarket_sales_per_partner
        submarket_store_partner_percent
        submarket_delivery_partner_percent
        sp_delivery_partner_percent
        sp_sales_per_partner
        sp_store_partner_percent
        reviews_mes
        ratings_mes
        reviews_yelp
        rating_yelp
        rating_factus
        stars_al
        reviews_al
        sales_chdus
        age_month
    """.split(),
}
_BASE_VENDOR_CAT = """
    sales_chd_agg cohort years_in_business price_yelp price_mes price_factus price_al number_of_units
    dayparts average_check average_check_amt credit_score_rating country_id rar_not_shown
""".split()
_BASE_CAT = {
    "ac": ["reactivation_year", "sales_month", "sales_year", *_BASE_VENDOR_CAT],
    "da": ["requestable", "reactivation_year", "sales_month", "sales_year", *_BASE_VENDOR_CAT],
    "nn": ["requestable", "activation_year", "sales_month", "sales_year", *_BASE_VENDOR_CAT],
}

_AOV_NUM = {
    "ac": """
        aov_before
        avg_fee_before
        avg_search_count_84_days_before_null_excluded
        total_search_count_84_days_before
        avg_search_count_28_days_before_null_excluded
        total_search_count_28_days_before
        avg_search_count_14_days_before_null_excluded
        total_search_count_14_days_before
        avg_subtotal_before
        avg_subtotal_per_store_business_before
        num_consumers_growth_sp
        num_days_active_28days_before
        num_orders_28days_before
        num_orders_per_active_date_before
        reactivation_month
        reactivation_year
        total_subtotal_28days_before
        total_subtotal_7days_before
        total_subtotal_per_active_date_before
        total_subtotal_per_active_date_business_before
        reviews_mes
        ratings_mes
        reviews_yelp
        rating_yelp
        rating_factus
        sales_chdus
    """.split(),
    "da": """
        avg_search_count_84_days_before_null_excluded
        total_search_count_84_days_before
        avg_search_count_28_days_before_null_excluded
        total_search_count_28_days_before
        avg_search_count_14_days_before_null_excluded
        total_search_count_14_days_before
        num_requests_l28days
        aov_before
        avg_fee_before
        avg_subtotal_before
        avg_subtotal_per_store_business_before
        deactivation_month
        deactivation_year
        num_consumers_growth_sp
        num_first_ordercarts_before
        num_orders_28days_before
        num_orders_per_active_date_before
        reactivation_month
        reactivation_year
        total_subtotal_28days_before
        total_subtotal_per_active_date_before
        total_subtotal_per_active_date_business_before
        total_subtotal_scaler_sp
        reviews_mes
        ratings_mes
        reviews_yelp
        rating_yelp
        rating_factus
        sales_chdus
    """.split(),
    "nn": """
        avg_search_count_84_days_before_null_excluded
        total_search_count_84_days_before
        avg_search_count_28_days_before_null_excluded
        total_search_count_28_days_before
        avg_search_count_14_days_before_null_excluded
        total_search_count_14_days_before
        num_requests_l28days
        activation_year
        avg_subtotal_from_consumer_request
        submarket_sales_per_partner
        submarket_store_partner_percent
        submarket_delivery_partner_percent
        submarket_aov
        sp_delivery_partner_percent
        sp_sales_per_partner
        sp_store_partner_percent
        sp_aov
        reviews_mes
        ratings_mes
        reviews_yelp
        rating_yelp
        rating_factus
        sales_chdus
    """.split(),
}
_AOV_VENDOR_CAT = """
    sales_chd_agg cohort years_in_business price_yelp price_mes price_factus number_of_units dayparts
    average_check average_check_amt credit_score_rating
""".split()
_AOV_CAT = {
    "ac": _AOV_VENDOR_CAT,
    "da": ["requestable", *_AOV_VENDOR_CAT],
    "nn": ["requestable", *_AOV_VENDOR_CAT],
}

LABELS = {
    "base": "total_subtotal_month",
    "v0": "aov_first_148_days_high",
    "v1": "is_premium",
    "v2": "subtotal_per_order",
}
MODEL_VERSION = {"base": "V3_5", "v0": "V0", "v1": "V1", "v2": "V2"}
PASSTHROUGH = ("match_id", "activation_date")
DATE_SPLIT = {"base": "min_active_date", "v0": "activation_date", "v1": "activation_date", "v2": "activation_date"}
DATE_ACTIVATION = "activation_date"
SEGMENTS = ("nn", "ac", "da")

_TREES = {
    "ac": dict(maxIter=108, stepSize=0.1, maxDepth=6, maxBins=180, subsamplingRate=1.0),
    "nn": dict(maxIter=100, stepSize=0.1, maxDepth=5, maxBins=256, subsamplingRate=0.8),
    "da": dict(maxIter=98, stepSize=0.1, maxDepth=5, maxBins=120, subsamplingRate=1.0),
}
SEED = 42


@dataclass(frozen=True)
class SegmentSpec:
    """What a segment's model reads, predicts and how it is grown."""

    segment: str
    version: str
    num: tuple[str, ...]
    cat: tuple[str, ...]
    label: str
    binary: bool
    trees: tuple[tuple[str, object], ...]
    passthrough: tuple[str, ...] = PASSTHROUGH

    @property
    def training_columns(self) -> list[str]:
        split = [DATE_SPLIT[self.version]]
        return list(dict.fromkeys([*self.num, *self.cat, *self.passthrough, self.label, *split]))

    @property
    def scoring_columns(self) -> list[str]:
        return list(dict.fromkeys([*self.num, *self.cat, *self.passthrough]))


def spec(segment: str, version: str = "base", **overrides) -> SegmentSpec:
    """The settings of a segment's model; keyword arguments replace tree
    settings, for instance ``maxIter``."""
    num = (_BASE_NUM if version == "base" else _AOV_NUM)[segment]
    cat = (_BASE_CAT if version == "base" else _AOV_CAT)[segment]
    return SegmentSpec(
        segment, version, tuple(num), tuple(cat), LABELS[version], version in ("v0", "v1"),
        tuple({**_TREES[segment], **overrides}.items()),
    )


def specs(version: str = "base", **overrides) -> dict[str, SegmentSpec]:
    return {s: spec(s, version, **overrides) for s in SEGMENTS}
