"""Rank balance and calibration of past predictions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date, flag, plus_days, ratio
from tamarind.operators.asof import serve_dates
from tamarind.operators.sliding import sliding_totals
from tamarind.sources.tables import Tables

ROLLING = (-83, 0)  # days up to and including the activation date
ALL_COHORTS = ("Enterprise", "Mid-Market", "Local")
ALL_COUNTRIES = (1, 2, 5)
VIRTUAL_BRAND = "JUST WINGS"


def business_cohorts(tables: Tables) -> DataFrame:
    """Enterprise or Mid-Market per business; Enterprise wins. Businesses not
    listed are Local."""
    groups = tables.business_groups.where(
        F.col("is_active") & ~F.col("is_test") & F.col("business_group_type").isin("ENTERPRISE", "MID_MARKET")
    ).select(F.col("id").alias("business_group_id"), "business_group_type")
    rank = F.when(F.col("business_group_type") == "ENTERPRISE", 2).otherwise(1)
    return (
        tables.business_group_links.join(groups, "business_group_id")
        .groupBy("business_id")
        .agg(F.max(rank).alias("r"))
        .select("business_id", F.when(F.col("r") == 2, F.lit("Enterprise")).otherwise(F.lit("Mid-Market")).alias("cohort"))
    )


def store_cohorts(tables: Tables) -> DataFrame:
    return tables.stores.join(business_cohorts(tables), "business_id", "left").select(
        "store_id", "business_id", F.coalesce("cohort", F.lit("Local")).alias("cohort")
    )


def rolling_grain(deciles: DataFrame) -> DataFrame:
    """Every (activation date, day) of the 84 days up to each activation date."""
    acts = (
        deciles.where(F.col("decile_rank_pred").isNotNull())
        .select(plus_days("pred_date", 1).alias("activation_date"))
        .distinct()
    )
    days = F.sequence(plus_days("activation_date", ROLLING[0]), F.col("activation_date"))
    return acts.withColumn("dm_date", F.explode(days))


def daily_rows(
    tables: Tables,
    deciles: DataFrame,
    activation_dates: Iterable[DateLike],
    keep: Sequence[str],
    countries: Sequence[int] = ALL_COUNTRIES,
    cohorts: Sequence[str] = ALL_COHORTS,
    exclude_poor_activation: bool = False,
) -> DataFrame:
    """Different evaluation rows per day, with their cohort; no row is repeated
    for the windows it lies in. Only days inside the windows asked for are read."""
    wanted = [as_date(d) for d in activation_dates]
    day = plus_days("pred_date", 1)
    from_day, to_day = (F.lit(d + dt.timedelta(days=k)) for d, k in zip((min(wanted), max(wanted)), ROLLING))
    ranked = deciles.where(F.col("decile_rank_pred").isNotNull() & day.between(from_day, to_day)).withColumn("dm_date", day)
    mx = tables.registry.where(
        F.col("store_id").isNotNull() & ~F.upper("restaurant_name").like(f"%{VIRTUAL_BRAND}%")
    ).select(F.col("id").alias("match_id"), "store_id", "sub_id")
    placed = tables.regions.where(F.col("country_id").isin(*countries)).select(
        F.col("submarket_id").alias("sub_id")
    )
    poor = tables.poor_activations.where(F.col("match_id").isNotNull()).select("match_id").distinct()
    out = (
        ranked.join(mx, "match_id")
        .join(store_cohorts(tables).select("store_id", "cohort"), "store_id")
        .where(F.col("cohort").isin(*cohorts))
        .join(placed, "sub_id", "left_semi")
    )
    if exclude_poor_activation:
        out = out.join(poor, "match_id", "left_anti")
    # The poor-activation flag is the same for all rows of a merchant, so it
    # does not change which rows differ.
    return out.select("dm_date", "store_id", "sub_id", "match_id", "cohort", *keep).distinct()


def _predicted_days(deciles: DataFrame) -> DataFrame:
    """Activation dates that have predictions themselves."""
    ranked = deciles.where(F.col("decile_rank_pred").isNotNull())
    return ranked.select(plus_days("pred_date", 1).alias("activation_date")).distinct()


def rolling_rows(
    tables: Tables, deciles: DataFrame, activation_dates: Iterable[DateLike], keep: Sequence[str], **options
) -> DataFrame:
    """:func:`daily_rows` for each activation date whose window holds their day;
    the activation date itself must have predictions."""
    dates = list(activation_dates)
    rows = serve_dates(daily_rows(tables, deciles, dates, keep, **options), dates, "dm_date", *ROLLING, as_name="activation_date")
    rows = rows.join(_predicted_days(deciles), "activation_date", "left_semi")
    return rows.select("activation_date", "dm_date", "store_id", "sub_id", "match_id", "cohort", *keep)


def rank_balance(
    tables: Tables, deciles: DataFrame, activation_dates: Iterable[DateLike], **options
) -> DataFrame:
    """Absolute decile error per (cell-wise different) merchant, of all windows
    by running sums over the days."""
    dates = list(activation_dates)
    ranks = ["decile_rank_pred", "decile_rank_actual"]
    rows = daily_rows(tables, deciles, dates, [*ranks, "tam_value_pred", "tam_value_actual"], **options)
    rows = rows.withColumns({"all": F.lit(1), "seen": F.struct(*ranks, "match_id")})
    error = F.abs(F.col("decile_rank_pred") - F.col("decile_rank_actual"))
    totals = sliding_totals(
        rows, ["all"], dates, *ROLLING, {"tot_balance_score": error}, {"tot_store_cnt": ("seen", None)}, "dm_date", "activation_date"
    )
    return (
        totals.join(_predicted_days(deciles), "activation_date", "left_semi")
        .select(
            "activation_date", "tot_store_cnt", "tot_balance_score",
            F.round(ratio("tot_balance_score", "tot_store_cnt"), 2).alias("normalized_balance_score"),
        )
        .orderBy("activation_date")
    )


def calibration_by_decile(
    tables: Tables, deciles: DataFrame, activation_dates: Iterable[DateLike], **options
) -> DataFrame:
    """Average actual and predicted size, error and weight of each predicted decile.

    Amounts are added up as decimals of nine places, so that running sums leave
    no rest behind.
    """
    dates = list(activation_dates)
    sizes = ["tam_value_actual", "tam_value_pred"]
    rows = daily_rows(tables, deciles, dates, ["decile_rank_pred", *sizes], **options)
    sums = {c: F.col(c).cast("decimal(28,9)") for c in sizes} | {f"n_{c}": flag(F.col(c).isNotNull()) for c in sizes}
    totals = sliding_totals(
        rows.withColumn("week", F.trunc("dm_date", "week")), ["decile_rank_pred"], dates, *ROLLING, sums,
        {"rolling_weeks_cnt": ("week", None)}, "dm_date", "activation_date",
    )
    means = totals.join(_predicted_days(deciles), "activation_date", "left_semi").select(
        "activation_date", "decile_rank_pred",
        *[ratio(F.col(c).cast("double"), f"n_{c}").alias(f"avg_{c}") for c in sizes], "rolling_weeks_cnt",
    )
    # Ten rows per activation date from here on.
    per_date = Window.partitionBy("activation_date")
    return means.withColumns(
        {
            "decile_weight": ratio("avg_tam_value_actual", F.sum("avg_tam_value_actual").over(per_date)),
            "avg_rolling_cpe": F.abs(
                ratio(F.col("avg_tam_value_actual") - F.col("avg_tam_value_pred"), "avg_tam_value_actual")
            ),
        }
    )


def weighted_calibration_error(
    tables: Tables, deciles: DataFrame, activation_dates: Iterable[DateLike], **options
) -> DataFrame:
    by_decile = calibration_by_decile(tables, deciles, activation_dates, **options)
    return (
        by_decile.groupBy("activation_date")
        .agg((F.sum(F.col("avg_rolling_cpe") * F.col("decile_weight")) * 100).alias("weighted_cpe"))
        .orderBy("activation_date")
    )

