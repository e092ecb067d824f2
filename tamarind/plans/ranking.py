"""From predictions and live sales to ranked market sizes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.functions.exprs import DateLike, as_date, dollars, flag, is_true, nz, plus_days, present
from tamarind.operators.asof import serve_dates
from tamarind.operators.keyed import join_null_safe
from tamarind.operators.ranking import first_per_key, ntile_of, rank_descending
from tamarind.operators.snapshot import at_last_day, latest_load
from tamarind.sources.tables import Tables

LIVE = "live sales"
VERSIONS = ["data_preprocess_model_version", "ml_model_version", "bias_adj_model_version"]

# Cuisine types and name parts that are not ranked.
EXCLUDED_CUISINES = [
    "Scenic Lookout", "Grocery Store", "Food Court", "Gay Bar", "Butcher", "Liquor Store",
    "Indie Movie Theater", "Convenience Store", "Rental Car Location", "Pedestrian Plaza", "Nail Salon",
    "Office", "Snack Place", "Park", "Gym / Fitness Center", "Building", "Big Box Store", "Tech Startup",
    "Shopping Mall", "Bar", "Chocolate Shop", "Event Space",
]
EXCLUDED_NAME_PARTS = ["TEST", "BUFFET", "CATERING", "MARRIOT", "HILTON", "EMBASSY SUITE"]
EXCLUDED_PROTOCOL = "DRIVE"
EXCLUDED_CREATION = "DRIVE_AUTO_ONBOARDING"

TAM_COLUMNS = [
    "match_id", "store_id", "vendor_1_id", "vendor_2_id", "merchant_name", "national", "submarket_id",
    "starting_point_id", "is_active", "is_partner", "tam_value", "model_id", "dte",
]


def dedupe_predictions(predictions: DataFrame, adjusted: bool | None = None) -> DataFrame:
    """One row per (merchant, create_date): mean prediction, largest version
    strings. Rows without a merchant are dropped; the adjusted prediction is
    averaged where the column exists."""
    has_adj = "pred_adj" in predictions.columns if adjusted is None else adjusted
    means = ["pred", "pred_adj"] if has_adj else ["pred"]
    return (
        predictions.where(F.col("match_id").isNotNull())
        .groupBy("match_id", "create_date")
        .agg(
            *[F.avg(c).alias(c) for c in means],
            *[F.max(c).alias(c) for c in [*VERSIONS, "model"]],
        )
    )


Dates = DateLike | Iterable[DateLike]


def _days(dates: Dates) -> list[dt.date]:
    return [as_date(dates)] if isinstance(dates, str | dt.date) else sorted({as_date(d) for d in dates})


def predictions_with_actuals(
    tables: Tables,
    predictions: DataFrame,
    dates: Dates,
    danp_labels: DataFrame,
    nn_labels: DataFrame,
    actual: str = "actual",
    pred: str = "pred",
    model: str = "model",
    factor: float = 1.0,
) -> DataFrame:
    """Predictions of one or more dates next to the sales of merchants activated
    the day after; without sales the prediction stands in."""
    days = _days(dates)

    def seen(labels: DataFrame, activated: str) -> DataFrame:
        day = plus_days(F.col(activated), -1)
        return (
            latest_load(labels)
            .where(day.isin(days) & F.col(actual).isNotNull())
            .select("store_id", "match_id", F.col(activated).alias("at"), F.col(actual).alias("value"), day.alias("create_date"))
        )

    both = seen(danp_labels, "reactivation_timestamp").unionByName(seen(nn_labels, "store_activation_date"))
    actuals = (
        both.distinct()
        .groupBy("store_id", "match_id", "create_date")
        .agg(F.max("at").alias("activation_date_actual"), F.avg("value").alias("actual"))
        .drop("store_id")
    )
    mx = tables.registry.select(
        F.col("id").alias("match_id"), F.col("restaurant_name").alias("external_store_name"), "store_id",
        "vendor_1_id", "vendor_2_id", F.col("sub_id").alias("submarket_id"),
        F.col("sp_id").alias("starting_point_id"),
    )
    names = tables.stores.select("store_id", F.col("name").alias("platform_store_name"))
    scored = (
        predictions.where(F.col("create_date").isin(days))
        .select(
            "match_id", *VERSIONS, (F.col(pred) * F.lit(float(factor))).alias(pred),
            F.col(model).alias("model_id"), "create_date",
        )
        .join(mx, "match_id", "left")
        .join(names, "store_id", "left")
    )
    return scored.join(actuals, ["match_id", "create_date"], "left").select(
        "activation_date_actual",
        F.coalesce("actual", pred).alias("actual"),
        "match_id", "external_store_name", "store_id", "vendor_1_id", "vendor_2_id", "platform_store_name",
        "submarket_id", "starting_point_id", *VERSIONS, pred, "model_id", "create_date",
    )


#: The prediction or test date that a row of a dated table belongs to.
ON = "on_date"


def recent_activity_on(tables: Tables, dates: Iterable[DateLike]) -> DataFrame:
    """Status rows of the 19 days before each date, flagged if the store was
    active (or an active partner) in any of its last seven rows of these days."""
    rows = serve_dates(tables.store_status, dates, "date_stamp", -19, -1, ON)
    partner = (is_true("partner_eop") & is_true("active_eop")) | (
        is_true("partner_bop") & is_true("active_bop")
    )
    active = is_true("active_eop") | is_true("active_bop")
    last7 = Window.partitionBy("store_id", ON).orderBy("date_stamp").rowsBetween(-6, 0)
    return rows.select(
        "date_stamp", "store_id", "business_id", "sp_id", "sp_name", "sub_id", "sub_name",
        F.max(flag(partner)).over(last7).alias("active_partner"),
        F.max(flag(active)).over(last7).alias("active"), ON,
    )


def recent_activity(tables: Tables, date: DateLike) -> DataFrame:
    return recent_activity_on(tables, [date]).drop(ON)


def _at_last_days(activity: DataFrame) -> DataFrame:
    """Rows on the last day of the activity, or of each of its dates."""
    if ON not in activity.columns:
        return at_last_day(activity, "date_stamp")
    last = activity.groupBy(ON).agg(F.max("date_stamp").alias("date_stamp"))  # a row for each date
    return activity.join(F.broadcast(last), [ON, "date_stamp"])


def live_partners(activity: DataFrame) -> DataFrame:
    return _at_last_days(activity).where(F.col("active_partner") == 1)


def live_nonpartners(activity: DataFrame) -> DataFrame:
    return _at_last_days(activity).where((F.col("active") == 1) & (F.col("active_partner") == 0))


def live_sales_on(tables: Tables, dates: Iterable[DateLike], activity: DataFrame | None = None) -> DataFrame:
    """Live partners of each date with their partner sales of the 28 days before."""
    days = list(dates)
    stores = live_partners(recent_activity_on(tables, days) if activity is None else activity)
    mx = tables.registry.where(F.col("store_id").isNotNull()).select(
        "store_id", F.col("id").alias("match_id"), "vendor_1_id", "vendor_2_id",
        F.col("restaurant_name").alias("merchant_name"), "national",
    )
    partner = tables.core.where(is_true("is_partner")).select(
        "store_id", "subtotal", "created_at", F.col("created_at").cast("date").alias("created_day")
    )
    sold = (
        serve_dates(partner, days, "created_day", -29, -1, ON)
        .where(F.col("created_at") <= plus_days(F.col(ON), -1).cast("timestamp_ntz"))
        .groupBy("store_id", ON)
        .agg(F.sum("subtotal").alias("cents"))
    )
    return (
        stores.join(mx, "store_id", "left")
        .join(sold, ["store_id", ON], "left")
        .select(
            "match_id", "store_id", "vendor_1_id", "vendor_2_id", "merchant_name", "national",
            F.col("sub_id").alias("submarket_id"), F.col("sp_id").alias("starting_point_id"),
            F.col("active").alias("is_active"), F.col("active_partner").alias("is_partner"),
            F.coalesce(dollars("cents"), F.lit(0.0)).alias("tam_value"), F.lit(LIVE).alias("model_id"),
            plus_days(F.col(ON), -1).alias("dte"), ON,
        )
    )


def live_sales(tables: Tables, date: DateLike) -> DataFrame:
    return live_sales_on(tables, [date]).drop(ON)


def valid_leads(tables: Tables, pred_date: DateLike) -> DataFrame:
    return valid_leads_on(tables, {as_date(pred_date): as_date(pred_date)}).select("id")


def valid_leads_on(tables: Tables, pred_dates: Mapping[dt.date, dt.date]) -> DataFrame:
    """(id, on_date) of registry entries fit for ranking; ``pred_dates`` are the
    prediction dates by test date.

    The groups are: activated later, or live non-partner, or a good directory
    score and not closed, or (a low score or none, plausible, not closed) where
    the score floor, the consensus and the completeness rules guard the last
    alternative only.
    """
    checks = tables.registry_checks.where(F.col("place_id").isNotNull()).select(
        F.col("mx_id").alias("id"), "is_valid_restaurant", "permanently_closed"
    )
    stores = tables.stores.select(
        "store_id", F.col("is_active").alias("s_active"), F.col("is_partner").alias("s_partner"), "activated_at"
    )
    m = tables.registry.join(checks, "id", "left").join(stores, "store_id", "left")
    score, country = F.col("existence_score"), F.col("country")
    in_country = country.isNotNull()
    no_entry = F.col("directory_id").isNull()
    not_closed = nz("permanently_closed") == 0
    valid = F.col("is_valid_restaurant")
    sources = present("vendor_1_id", "vendor_2_id", "store_id", "directory_id", "panel_id")

    activated_later = F.col("activated_at") > F.col("pred_date").cast("timestamp_ntz")
    live_nonpartner = F.col("s_active") & ~F.col("s_partner")
    good_score = (score >= 0.6) & in_country & not_closed
    low_score = ((score < 0.6) & in_country) | no_entry
    plausible = low_score & (valid.isNull() | valid) & not_closed
    above_floor = ((score > 0) & in_country) | no_entry
    consensus = (valid & not_closed) | (sources > 1) | (score > 0.5)
    complete = F.lit(True)
    for c in ("restaurant_name", "street", "lat", "lng", "sp_id"):
        complete = complete & F.col(c).isNotNull()
    kept = (
        activated_later
        | live_nonpartner
        | good_score
        | (plausible & above_floor & consensus & complete)
    )
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias(ON), F.lit(p).alias("pred_date")) for d, p in sorted(pred_dates.items())]))
    dated = m.withColumn("__pair", pairs).withColumns({ON: F.col(f"__pair.{ON}"), "pred_date": F.col("__pair.pred_date")})
    return dated.where(kept).select("id", ON).distinct()


def off_platform(
    tables: Tables,
    predictions_full: DataFrame,
    date: DateLike,
    pred_date: DateLike,
    value: str,
    activity: DataFrame | None = None,
    status_as_of: str = "table_max",
) -> DataFrame:
    dates = {as_date(date): as_date(pred_date)}
    return off_platform_on(tables, predictions_full, dates, value, activity, status_as_of).drop(ON)


def off_platform_on(
    tables: Tables,
    predictions_full: DataFrame,
    pred_dates: Mapping[dt.date, dt.date],
    value: str,
    activity: DataFrame | None = None,
    status_as_of: str = "table_max",
) -> DataFrame:
    """One predicted market size per valid merchant and test date; ``pred_dates``
    are the prediction dates by test date.

    ``status_as_of='table_max'`` reads the activity flags on the last day of
    the whole status table (0 in back-dated runs); ``'window_max'`` on the last
    day before the date.
    """
    recent = recent_activity_on(tables, pred_dates) if activity is None else activity
    last = at_last_day(recent, "date_stamp", tables.store_status) if status_as_of == "table_max" else _at_last_days(recent)
    flags = last.select("store_id", ON, F.col("active").alias("z_active"), F.col("active_partner").alias("z_partner"))
    stores = tables.stores.select("store_id", F.col("name").alias("s_name"), "order_protocol", "creation_method")
    listed = tables.external_stores.select(F.col("external_id").alias("vendor_1_id"), "cuisine_type")
    mx = tables.registry.select(F.col("id").alias("match_id"), "national")
    ids = valid_leads_on(tables, pred_dates).withColumnRenamed("id", "match_id")
    served = F.array(*[F.struct(F.lit(d).alias(ON), F.lit(p).alias("pred_date")) for d, p in sorted(pred_dates.items())])
    of_date = F.filter(served, lambda x: x["pred_date"] == F.col("create_date"))
    rows = (
        predictions_full.withColumn(ON, F.explode(F.transform(of_date, lambda x: x[ON])))
        .join(ids, ["match_id", ON], "left_semi")
        .join(stores, "store_id", "left")
        .join(listed, "vendor_1_id", "left")
        .join(flags, ["store_id", ON], "left")
        .join(mx, "match_id", "left")
        .withColumn("merchant_name", F.coalesce("external_store_name", "s_name"))
    )

    def not_listed(c: str, values: Sequence[str]):
        return F.col(c).isNull() | ~F.col(c).isin(*values)

    rows = rows.where(
        not_listed("order_protocol", [EXCLUDED_PROTOCOL])
        & not_listed("creation_method", [EXCLUDED_CREATION])
        & not_listed("cuisine_type", EXCLUDED_CUISINES)
    )
    for part in EXCLUDED_NAME_PARTS:
        rows = rows.where(~F.col("merchant_name").like(f"%{part}%"))
    amount = F.col(value)
    shaped = rows.select(
        "match_id", "store_id", "vendor_1_id", "vendor_2_id", "merchant_name", "national", "submarket_id",
        "starting_point_id", nz("z_active").alias("is_active"), nz("z_partner").alias("is_partner"),
        F.when(amount < 0, F.lit(0.0)).otherwise(amount).alias("tam_value"), "model_id",
        plus_days(F.col(ON), -1).alias("dte"), ON,
    )
    order = [F.col("tam_value").desc_nulls_last(), F.col("store_id"), F.col("model_id")]
    return first_per_key(shaped, ["match_id", ON], order)


def market_size(
    tables: Tables,
    predictions_full: DataFrame,
    date: DateLike,
    pred_date: DateLike,
    value: str = "pred",
    status_as_of: str = "table_max",
) -> DataFrame:
    return market_size_on(tables, predictions_full, {as_date(date): as_date(pred_date)}, value, status_as_of).drop(ON)


def market_size_on(
    tables: Tables,
    predictions_full: DataFrame,
    pred_dates: Mapping[dt.date, dt.date],
    value: str = "pred",
    status_as_of: str = "table_max",
) -> DataFrame:
    """Live partners without a prediction, and all off-platform merchants, of
    every test date in one plan; ``pred_dates`` are the prediction dates by test date."""
    recent = recent_activity_on(tables, pred_dates)
    off = off_platform_on(tables, predictions_full, pred_dates, value, recent, status_as_of)
    live = live_sales_on(tables, pred_dates, recent).join(off.select("match_id", ON), ["match_id", ON], "left_anti")
    return live.select(*TAM_COLUMNS, ON).unionByName(off.select(*TAM_COLUMNS, ON))


def decile_rank(
    tam: DataFrame,
    value: str = "tam_value",
    partition_by: Sequence[str] = ("dte", "submarket_id"),
    include_partner: bool = True,
) -> DataFrame:
    """Deciles of the market size within each partition, largest first."""
    rows = tam if include_partner else tam.where(F.col("model_id") != LIVE)
    ranked = rank_descending(rows, list(partition_by), value, ["match_id", "store_id"])
    tile = ntile_of(F.col("__rank"), F.col("__size"), 10).alias("decile_rank")
    extra = [c for c in ("pred_date", "create_date") if c in tam.columns]
    return ranked.select("match_id", "store_id", "submarket_id", value, tile, *extra).distinct()


def combine_ranks(
    actual: DataFrame, predicted: DataFrame, predictions_full: DataFrame,
    suffixes: tuple[str, str] = ("_actual", "_pred"), dated: bool = False,
) -> DataFrame:
    """Actual and predicted deciles side by side, for merchants that did
    activate. Rows without a submarket match each other. ``dated``: both hold
    several prediction dates, in ``pred_date``."""
    on = ["pred_date"] if dated else []
    keys = ["match_id", "submarket_id", *on]

    def tagged(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(c + suffix) for c in df.columns if c not in keys])

    sides = join_null_safe(tagged(actual, suffixes[0]), tagged(predicted, suffixes[1]), keys, "inner")
    raw = predictions_full.where(F.col("activation_date_actual").isNotNull()).select(
        "match_id", F.col("create_date").alias("pred_date"), "model_id", *VERSIONS
    )
    return join_null_safe(raw, sides, ["match_id", *on], "inner")
