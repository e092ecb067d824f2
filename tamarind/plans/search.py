"""Search demand per merchant."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.functions.exprs import in_days, ratio
from tamarind.operators.asof import pair_in_window, serve_dates
from tamarind.operators.snapshot import latest_load
from tamarind.sources.tables import Tables

# Length named in the column -> first day before the end of the window. The
# windows hold one day more than their names say.
SPANS = {84: 84, 28: 28, 14: 14}
TRAIN_END = -1  # windows end the day before activation
SCORE_END = -2  # windows end two days before the test date

# Daily mean over about 84 days, (first, last) day relative to the test date.
MEAN_WINDOW = {"danp": (-84, -1), "nn": (-86, -2)}


def daily_counts(tables: Tables) -> DataFrame:
    """Search count per (store_id, search_date); ``store_id`` holds match ids."""
    return (
        tables.search_counts.where(F.col("store_id").isNotNull())
        .groupBy("store_id", "search_date")
        .agg(F.sum(ratio("query_count", "store_count")).alias("search_count"))
    )


def _lookbacks(pairs: DataFrame, group: list[str], anchor: str, end: int) -> DataFrame:
    """All nested windows from one pass over the widest one. A merchant with
    no day in a window has NULLs there, one whose days hold no count zeros."""
    aggs = []
    for span, first in SPANS.items():
        inside = in_days(F.col("search_date"), anchor, end - first, end)
        held = F.when(inside, F.col("search_count"))
        some = F.count(F.when(inside, F.lit(1))) > 0
        aggs += [
            F.when(some, F.coalesce(F.avg(held), F.lit(0.0))).alias(f"avg_search_count_{span}_days_before_null_excluded"),
            F.when(some, F.coalesce(F.sum(held), F.lit(0.0))).alias(f"total_search_count_{span}_days_before"),
        ]
    return pairs.groupBy(*group).agg(*aggs)


def activations_of(labels: DataFrame, activation: str) -> DataFrame:
    """Last activation per merchant in the newest load."""
    return (
        latest_load(labels)
        .groupBy("match_id")
        .agg(F.max(activation).alias("activation"))
        .where(F.col("match_id").isNotNull())
    )


def training_lookbacks(tables: Tables, segment: str) -> DataFrame:
    """Per merchant, windows ending the day before activation."""
    if segment == "nn":
        anchors = activations_of(tables.label_nn, "store_activation_date")
    else:
        anchors = activations_of(tables.label_danp, "reactivation_timestamp")
    facts = daily_counts(tables).withColumnRenamed("store_id", "match_id")
    widest = max(SPANS.values())
    pairs = pair_in_window(
        anchors, facts, ["match_id"], "activation", "search_date", TRAIN_END - widest, TRAIN_END
    )
    return _lookbacks(pairs, ["match_id"], "activation", TRAIN_END)


def scoring_lookbacks(tables: Tables, dates: Iterable) -> DataFrame:
    """Per (merchant, test date), windows ending two days before it."""
    widest = max(SPANS.values())
    served = serve_dates(daily_counts(tables), dates, "search_date", SCORE_END - widest, SCORE_END)
    return _lookbacks(
        served.withColumnRenamed("store_id", "match_id"), ["match_id", "create_date"], "create_date", SCORE_END
    )


def daily_table(tables: Tables, feature_rows: DataFrame, dates: Iterable) -> DataFrame:
    """Search features for each merchant in that day's feature rows."""
    wanted = list(dates)
    rows = feature_rows.select("match_id", "create_date")
    return rows.join(scoring_lookbacks(tables, wanted), ["match_id", "create_date"], "left")


def mean_daily_count(tables: Tables, dates: Iterable, segment: str) -> DataFrame:
    """Mean daily search count per (merchant, test date)."""
    served = serve_dates(daily_counts(tables), dates, "search_date", *MEAN_WINDOW[segment])
    return (
        served.groupBy(F.col("store_id").alias("match_id"), "create_date")
        .agg(F.avg("search_count").alias("avg_search_count_84_days_before"))
        .withColumn(
            "avg_search_count_84_days_before", F.coalesce("avg_search_count_84_days_before", F.lit(0.0))
        )
    )
