"""Consumer requests for merchants, and what the requesters ordered before.

A request meets every earlier order of its consumer. Joining the two facts
would grow with the square of a consumer's activity. Only three numbers per
request are needed, all running totals over the consumer's own time line: the
sum and the count of earlier order rows, and the number of deliveries first
seen earlier. Deliveries seen before one request of a consumer are also seen
before that consumer's later requests, so the distinct deliveries of a
(merchant, consumer) pair are the largest of those numbers, and those of a
merchant are their sum (a delivery has one creator).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarind.functions.exprs import as_date, day_diff, flag, plus_days, safe_ratio, toward_zero
from tamarind.operators.keyed import spread_join, with_defaults
from tamarind.session import cut_lineage, delete_path, scratch_path
from tamarind.sources.tables import Tables

# (cutoff, 84-day window, 28-day window): requests strictly before anchor +
# cutoff count; windows are inclusive timestamps at midnight.
TRAIN = (0, (-84, -1), (-28, -1))
SCORE = (-1, (-85, -1), (-29, -1))

_RUNNING = ["prior_cents", "prior_rows", "prior_deliveries"]


def _midnight(anchor: str, days: int):
    return plus_days(anchor, days).cast("timestamp_ntz")


def with_prior_orders(requests: DataFrame, core: DataFrame) -> DataFrame:
    """Each request with running totals of its consumer's earlier orders.

    Two levels: totals of whole days before, and the order within the day. An
    ordered group holds one consumer's days or one consumer-day, so a consumer
    with a large share of all rows is still spread over many tasks.
    """
    askers = requests.select(F.col("consumer_id").alias("creator_id")).where("creator_id IS NOT NULL").distinct()
    orders = (
        core.where((F.col("subtotal") > 0) & F.col("created_at").isNotNull())
        .select("creator_id", "delivery_id", "created_at", "subtotal")
        .join(askers, "creator_id", "left_semi")
    )
    first = Window.partitionBy("creator_id", "delivery_id").orderBy("created_at")
    marked = orders.withColumn(
        "seen_first", (F.row_number().over(first) == 1) & F.col("delivery_id").isNotNull()
    )
    steps = marked.select(
        F.col("creator_id").alias("consumer_id"),
        F.col("created_at").alias("at"),
        F.lit(1).alias("kind"),
        F.col("subtotal").alias("prior_cents"),
        F.lit(1).cast("long").alias("prior_rows"),
        flag(F.col("seen_first")).alias("prior_deliveries"),
        F.lit(None).cast("string").alias("mx_id"),
    )
    # Requests without a consumer have no earlier orders; they need no window.
    nobody = requests.where("consumer_id IS NULL").select(
        "mx_id", "consumer_id", "requested_at", *[F.lit(0).cast("long").alias(c) for c in _RUNNING]
    )
    # A request sorts before orders of the same instant: only earlier ones count.
    asks = requests.where("consumer_id IS NOT NULL").select(
        "consumer_id",
        F.col("requested_at").alias("at"),
        F.lit(0).alias("kind"),
        *[F.lit(0).cast("long").alias(c) for c in _RUNNING],
        "mx_id",
    )
    line = steps.unionByName(asks).withColumn("day", F.col("at").cast("date"))
    in_day = (
        Window.partitionBy("consumer_id", "day")
        .orderBy("at", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    within = line.withColumns({c: F.sum(c).over(in_day) for c in _RUNNING}).where("kind = 0")
    earlier = (
        Window.partitionBy("consumer_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    )
    days = line.groupBy("consumer_id", "day").agg(*[F.sum(c).alias(c) for c in _RUNNING])
    before = days.select(
        "consumer_id", "day", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"b_{c}") for c in _RUNNING]
    )
    known = within.join(before, ["consumer_id", "day"], "left").select(
        "mx_id",
        "consumer_id",
        F.col("at").alias("requested_at"),
        *[(F.col(c) + F.coalesce(f"b_{c}", F.lit(0))).alias(c) for c in _RUNNING],
    )
    return known.unionByName(nobody)


def request_features(tables: Tables, anchors: DataFrame, anchor: str, windows: tuple) -> DataFrame:
    """One row per (match_id, anchor). Merchants without requests have zero
    counts and NULL times.

    The requests, what came before them and the totals are written one after the
    other when the plan is built, and only the totals stay: none of the steps
    holds the shuffles of another, and the requests are found once.
    """
    spark = anchors.sparkSession
    cutoff, l84, l28 = windows
    keys = ["match_id", anchor]
    wanted = anchors.select(*keys).distinct()
    # Nothing from the last cutoff on counts, nor do requests for other merchants.
    end = wanted.agg(F.max(anchor).alias("last")).select(_midnight("last", cutoff)).scalar()
    asked_for = wanted.select(F.col("match_id").alias("mx_id")).distinct()
    requests = tables.store_requests.where(F.col("requested_at") < end).join(asked_for, "mx_id", "left_semi")
    asked_at, prior_at = scratch_path(spark, "requests"), scratch_path(spark, "prior-orders")
    requests = cut_lineage(requests, path=asked_at)
    prior = cut_lineage(with_prior_orders(requests, tables.core.where(F.col("created_at") < end)), path=prior_at)
    prior = prior.withColumnRenamed("mx_id", "match_id")
    pairs = spread_join(prior, wanted, ["match_id"], by="consumer_id").where(
        F.col("requested_at") < _midnight(anchor, cutoff)
    )
    held = {
        name: F.col("requested_at").between(_midnight(anchor, lo), _midnight(anchor, hi))
        for name, (lo, hi) in {"l84": l84, "l28": l28}.items()
    }
    per_consumer = pairs.groupBy(*keys, "consumer_id").agg(
        F.min("requested_at").alias("first_at"),
        F.max("requested_at").alias("last_at"),
        F.sum("prior_cents").alias("cents"),
        F.sum("prior_rows").alias("rows"),
        F.max("prior_deliveries").alias("deliveries"),
        *[F.max(flag(c)).alias(n) for n, c in held.items()],
    )
    asked = F.col("consumer_id").isNotNull()
    totals = per_consumer.groupBy(*keys).agg(
        F.min("first_at").alias("first_request_requested_at"),
        F.max("last_at").alias("last_request_requested_at"),
        F.count("consumer_id").alias("num_requests_all_time"),
        F.sum(F.when(asked, F.col("cents"))).alias("cents"),
        F.sum(F.when(asked, F.col("rows"))).alias("rows"),
        F.sum(F.when(asked, F.col("deliveries"))).alias("deliveries"),
        F.sum(F.when(asked, F.col("l84"))).alias("num_requests_l84days"),
        F.sum(F.when(asked, F.col("l28"))).alias("num_requests_l28days"),
    )
    stats = totals.select(
        *keys,
        "first_request_requested_at",
        "last_request_requested_at",
        day_diff("first_request_requested_at", "last_request_requested_at").alias("days_btw_first_and_last_request"),
        "num_requests_all_time",
        toward_zero(F.col("cents") / F.nullif(F.col("rows"), F.lit(0))).alias("avg_subtotal_from_consumer_request"),
        safe_ratio("deliveries", "num_requests_all_time").alias("num_delivery_to_requests_ratio"),
        "num_requests_l84days",
        "num_requests_l28days",
    )
    stats = cut_lineage(stats, "request-totals")
    for path in (asked_at, prior_at):
        delete_path(spark, path)
    counts = ["num_requests_all_time", "num_delivery_to_requests_ratio", "num_requests_l84days", "num_requests_l28days"]
    return with_defaults(wanted.join(stats, keys, "left"), {c: 0 for c in counts})


def scoring_requests(tables: Tables, merchants: DataFrame, dates: Iterable) -> DataFrame:
    """Request features of the merchants as of each test date."""
    wanted = [as_date(d) for d in dates]
    if len(wanted) == 1:
        anchors = merchants.select("match_id").withColumn("create_date", F.lit(wanted[0]))
    else:
        anchors = merchants.select("match_id").withColumn(
            "create_date", F.explode(F.array(*[F.lit(d) for d in wanted]))
        )
    return request_features(tables, anchors, "create_date", SCORE)


def per_day():
    """Distinct requesters per day between the first and the last request."""
    return safe_ratio("num_requests_all_time", "days_btw_first_and_last_request")
