"""Vendor-supplied review, rating, price and category features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.session import cut_lineage
from tamarind.sources.tables import Tables

# output column -> source column
AVERAGES = {
    "reviews_mes": "reviews_mes",
    "reviews_yelp": "reviews_yelp",
    "ratings_mes": "rating_mes",
    "rating_yelp": "rating_yelp",
    "rating_factus": "rating_factus",
    "sales_chdus": "sales_chdus",
    "stars_al": "stars_al",
    "reviews_al": "reviews_al",
}
ENCODED = [
    "cohort",
    "sales_chd_agg",
    "years_in_business",
    "price_yelp",
    "price_mes",
    "price_factus",
    "price_al",
    "number_of_units",
    "dayparts",
    "average_check",
    "average_check_amt",
    "credit_score_rating",
]


def review_averages(tables: Tables) -> DataFrame:
    """Averages per (match_id, store_id)."""
    return tables.vendor_features.groupBy("match_id", "store_id").agg(
        *[F.avg(src).alias(out) for out, src in AVERAGES.items()]
    )


def category_maxima(tables: Tables) -> DataFrame:
    """Encoded categories per (match_id, store_id), and the raw cohort."""
    return tables.vendor_features.groupBy("match_id", "store_id").agg(
        *[F.max(f"{c}_encoded").alias(c) for c in ENCODED], F.max("cohort").alias("cohort_raw")
    )


def vendor_table(tables: Tables) -> DataFrame:
    """Both groups of features per (match_id, store_id), written once for all sets that join them."""
    rows = tables.vendor_features.groupBy("match_id", "store_id").agg(
        *[F.avg(src).alias(out) for out, src in AVERAGES.items()], *[F.max(f"{c}_encoded").alias(c) for c in ENCODED]
    )
    return cut_lineage(rows, "vendor-features")


def join_vendor(
    df: DataFrame, tables: Tables, averages: list[str], categories: list[str], dedupe: bool = False,
    vendors: DataFrame | None = None,
) -> DataFrame:
    """Attach both groups of features by ``match_id``.

    They are grouped by merchant and store but joined by merchant, so a
    merchant with two store ids yields several rows; ``dedupe`` keeps one value
    per merchant instead. ``vendors`` is a :func:`vendor_table` that several sets
    share.
    """
    reviews = (review_averages(tables) if vendors is None else vendors).select("match_id", *averages)
    cats = (category_maxima(tables) if vendors is None else vendors).select("match_id", *categories)
    if dedupe:
        reviews = reviews.groupBy("match_id").agg(*[F.avg(c).alias(c) for c in averages])
        cats = cats.groupBy("match_id").agg(*[F.max(c).alias(c) for c in categories])
    return df.join(reviews, "match_id", "left").join(cats, "match_id", "left")
