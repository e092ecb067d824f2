"""Filters, joins, aggregates, windows, set operations and functions (B to H)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from queryset.base import DAY, query
from queryset.features import CORE, LATEST_DANP, LATEST_NN
from queryset.labels import LOCAL_DAY, ONCE
from tamarind.functions import exprs as X
from tamarind.ml.split import enterprise_rows, local_rows
from tamarind.operators import asof, keyed, ranking, rollup, snapshot
from tamarind.plans import labels, population, ranking as tam, vendor

D = dt.date.fromisoformat(DAY)


# Projections, filters, predicates --------------------------------------------


@query("b01_projection", "SELECT store_id, subtotal / 100.0 AS amount, 2.25 AS fixed_fee, 0 AS rar_not_shown FROM {deliveries}")
def _(t):
    return t.deliveries.select(
        "store_id", X.dollars("subtotal").alias("amount"), F.lit(2.25).alias("fixed_fee"),
        F.lit(0).alias("rar_not_shown"),
    )


@query("b02_star_expansion", "SELECT d.*, s.name AS platform_store_name FROM {label_danp} d LEFT JOIN {stores} s ON s.store_id = d.store_id")
def _(t):
    names = t.stores.select("store_id", F.col("name").alias("platform_store_name"))
    return t.label_danp.alias("d").join(names, "store_id", "left").select("d.*", "platform_store_name")


@query(
    "b03_staged_aliases",
    """SELECT *, sum(live) OVER (PARTITION BY store_id ORDER BY date_stamp) AS live_so_far
FROM (SELECT store_id, date_stamp, CASE WHEN active_eop = 1 OR active_bop = 1 THEN 1 ELSE 0 END AS live FROM {store_status})""",
)
def _(t):
    so_far = Window.partitionBy("store_id").orderBy("date_stamp")
    live = X.flag(X.is_true("active_eop") | X.is_true("active_bop"))
    return (
        t.store_status.select("store_id", "date_stamp", live.alias("live"))
        .withColumn("live_so_far", F.sum("live").over(so_far))
    )


@query(
    "b04_filter_on_alias",
    "SELECT * FROM (SELECT match_id, coalesce(restaurant_name, 'none') AS shown FROM {label_nn}) WHERE shown LIKE 'CHAIN 1%'",
)
def _(t):
    named = t.label_nn.select("match_id", F.coalesce("restaurant_name", F.lit("none")).alias("shown"))
    return named.where(F.col("shown").like("CHAIN 1%"))


@query(
    "b05_filter_on_aggregate",
    "SELECT store_id, max(date_stamp) AS last_day FROM {store_status} GROUP BY 1 HAVING max(date_stamp) < DATE '2001-10-25'",
)
def _(t):
    last = t.store_status.groupBy("store_id").agg(F.max("date_stamp").alias("last_day"))
    return last.where(F.col("last_day") < F.lit(dt.date(2001, 10, 25)))


@query(
    "b06_date_ranges",
    f"SELECT delivery_id, store_id, active_date FROM core WHERE active_date BETWEEN DATE '{DAY}' - 7 AND DATE '{DAY}' - 1",
    core=CORE,
)
def _(t):
    return t.core.where(X.in_days(F.col("active_date"), F.lit(D), -7, -1)).select("delivery_id", "store_id", "active_date")


@query(
    "b07_in_lists",
    "SELECT * FROM {external_stores} WHERE cuisine_type IS NULL OR cuisine_type NOT IN ('Bar', 'Food Court', 'Office')",
)
def _(t):
    listed = F.col("cuisine_type").isin(*tam.EXCLUDED_CUISINES)
    return t.external_stores.where(F.col("cuisine_type").isNull() | ~listed)


@query(
    "b08_name_patterns",
    "SELECT store_id, name FROM {stores} WHERE name NOT LIKE '%7%' AND upper(name) LIKE 'SUPPLIER#%'",
)
def _(t):
    return t.stores.where(~F.col("name").like("%7%") & F.upper("name").like("SUPPLIER#%")).select("store_id", "name")


@query("b09_null_tests", "SELECT id FROM {registry} WHERE street IS NOT NULL AND sp_id IS NULL")
def _(t):
    return t.registry.where(F.col("street").isNotNull() & F.col("sp_id").isNull()).select("id")


@query(
    "b10_null_safe_equality",
    "SELECT is_partner IS NOT DISTINCT FROM true AS partner, is_partner IS NOT DISTINCT FROM false AS nonpartner, count(*) AS n FROM {deliveries} GROUP BY 1, 2",
)
def _(t):
    return t.deliveries.groupBy(
        X.is_true("is_partner").alias("partner"), X.is_false("is_partner").alias("nonpartner")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b11_precedence",
    "SELECT id FROM {registry} WHERE is_active IS NOT TRUE OR is_partner IS NOT TRUE AND vendor_1_id IS NOT NULL AND sp_id IS NOT NULL",
)
def _(t):
    inactive, nonpartner = ~X.is_true("is_active"), ~X.is_true("is_partner")
    guarded = nonpartner & F.col("vendor_1_id").isNotNull() & F.col("sp_id").isNotNull()
    return t.registry.where(inactive | guarded).select("id")


@query(
    "b12_poor_activation_toggle",
    "SELECT 'kept' AS toggle, match_id FROM {decile_metrics} UNION ALL "
    "SELECT 'dropped', match_id FROM {decile_metrics} WHERE match_id NOT IN (SELECT match_id FROM {poor_activations})",
)
def _(t):
    def rows(exclude_poor: bool):
        df = t.decile_metrics.select("match_id")
        return keyed.without_keys(df, "match_id", t.poor_activations, "match_id") if exclude_poor else df

    parts = [rows(x).select(F.lit(n).alias("toggle"), "match_id") for n, x in (("kept", False), ("dropped", True))]
    return parts[0].unionByName(parts[1])


@query(
    "b13_cohort_slices",
    """SELECT CASE WHEN cohort = 0 THEN 'local' ELSE 'ent' END AS slice, cohort, count(*) AS n
FROM (SELECT match_id, max(cohort_encoded) AS cohort FROM {vendor_features} GROUP BY 1) GROUP BY 1, 2""",
)
def _(t):
    cohorts = vendor.category_maxima(t).groupBy("match_id").agg(F.max("cohort").alias("cohort"))
    sliced = local_rows(cohorts).withColumn("slice", F.lit("local")).unionByName(
        enterprise_rows(cohorts).withColumn("slice", F.lit("ent"))
    )
    return sliced.groupBy("slice", "cohort").agg(F.count(F.lit(1)).alias("n"))


# Joins -----------------------------------------------------------------------


@query("c01_inner_join", "SELECT d.delivery_id, e.restaurant_name FROM core d JOIN {enterprise_merchants} e ON e.store_id = d.store_id", core=CORE)
def _(t):
    return t.core.select("store_id", "delivery_id").join(
        t.enterprise_merchants.select("store_id", "restaurant_name"), "store_id"
    ).drop("store_id")


@query("c02_left_join", "SELECT r.id, s.name FROM {registry} r LEFT JOIN {stores} s ON s.store_id = r.store_id")
def _(t):
    return t.registry.join(t.stores.select("store_id", "name"), "store_id", "left").select("id", "name")


@query(
    "c03_left_join_composite",
    "SELECT d.store_id, d.create_date, n.actual AS other FROM {label_danp} d LEFT JOIN {label_nn} n ON n.match_id = d.match_id AND n.create_date = d.create_date",
)
def _(t):
    other = t.label_nn.select("match_id", "create_date", F.col("actual").alias("other"))
    return t.label_danp.join(other, ["match_id", "create_date"], "left").select("store_id", "create_date", "other")


@query(
    "c04_left_join_literal_range",
    f"SELECT s.store_id, count(d.delivery_id) AS n FROM {{stores}} s LEFT JOIN core d ON d.store_id = s.store_id AND d.active_date BETWEEN DATE '{DAY}' - 3 AND DATE '{DAY}' GROUP BY 1",
    core=CORE,
)
def _(t):
    recent = t.core.where(X.in_days(F.col("active_date"), F.lit(D), -3, 0)).groupBy("store_id").agg(F.count("delivery_id").alias("n"))
    return keyed.with_defaults(t.stores.select("store_id").join(recent, "store_id", "left"), {"n": 0})


LATEST_ANCHOR = "SELECT store_id, most_recent_deactivation_timestamp AS a FROM latest"


def _anchors(t):
    return snapshot.latest_load(t.label_danp).select("store_id", F.col("most_recent_deactivation_timestamp").alias("a"))


def _orders(t):
    return t.core.select("store_id", "delivery_id", "active_date")


@query(
    "c05_interval_join",
    "SELECT a.store_id, a, delivery_id, active_date FROM anchors a JOIN core d ON d.store_id = a.store_id AND active_date BETWEEN a - 30 AND a",
    core=CORE, latest=LATEST_DANP, anchors=LATEST_ANCHOR,
)
def _(t):
    return asof.pair_in_window(_anchors(t), _orders(t), ["store_id"], "a", "active_date", -30, 0)


@query(
    "c06_half_open_join",
    "SELECT a.store_id, a, delivery_id, active_date FROM anchors a JOIN core d ON d.store_id = a.store_id AND active_date <= a AND active_date > a - 28",
    core=CORE, latest=LATEST_DANP, anchors=LATEST_ANCHOR,
)
def _(t):
    return asof.pair_in_window(_anchors(t), _orders(t), ["store_id"], "a", "active_date", -27, 0)


@query(
    "c07_unbounded_asof",
    """SELECT a.store_id, a, sum(subtotal) AS cents, count(*) AS n FROM anchors a JOIN core d ON d.store_id = a.store_id
 AND active_date <= a GROUP BY 1, 2""",
    core=CORE, latest=LATEST_DANP, anchors=LATEST_ANCHOR,
)
def _(t):
    steps = t.core.select("store_id", "active_date", F.col("subtotal").alias("cents"), F.lit(1).cast("long").alias("n"))
    totals = rollup.running_totals(steps, ["store_id"], "active_date", ["cents", "n"], _anchors(t), "a")
    return totals.where(F.col("n").isNotNull())


@query(
    "c08_forward_window",
    """SELECT a.store_id, a, sum(subtotal) FILTER (WHERE active_date <= a + 27) / 100.0 AS first_28,
 sum(subtotal) FILTER (WHERE active_date BETWEEN a + 120 AND a + 148) / 100.0 AS fifth_month
FROM anchors a JOIN core d ON d.store_id = a.store_id AND active_date BETWEEN a AND a + 148 GROUP BY 1, 2""",
    core=CORE, latest=LATEST_DANP, anchors=LATEST_ANCHOR,
)
def _(t):
    facts = t.core.select("store_id", "active_date", "subtotal")
    pairs = asof.pair_in_window(_anchors(t), facts, ["store_id"], "a", "active_date", 0, 148)
    age = X.day_diff("a", "active_date")
    return pairs.groupBy("store_id", "a").agg(
        X.dollars(F.sum(F.when(age <= 27, F.col("subtotal")))).alias("first_28"),
        X.dollars(F.sum(F.when(age.between(120, 148), F.col("subtotal")))).alias("fifth_month"),
    )


@query(
    "c09_requests_after_orders",
    """SELECT r.consumer_id, r.requested_at, r.mx_id, coalesce(sum(subtotal), 0) AS prior_cents, count(o.delivery_id) AS prior_rows,
 count(DISTINCT o.delivery_id) AS prior_deliveries
FROM (SELECT *, row_number() OVER () AS rn FROM {store_requests}) r
LEFT JOIN core o ON o.creator_id = r.consumer_id AND r.requested_at > o.created_at AND o.subtotal > 0 GROUP BY r.rn, 1, 2, 3""",
    core=CORE,
)
def _(t):
    from tamarind.plans.requests import with_prior_orders

    return with_prior_orders(t.store_requests, t.core)


@query(
    "c10_before_after_pairs",
    """SELECT b.store_id, b.deact, a.react FROM (SELECT store_id, most_recent_deactivation_timestamp AS deact FROM latest) b
JOIN (SELECT store_id, reactivation_timestamp AS react FROM latest) a ON a.store_id = b.store_id AND b.deact < a.react""",
    latest=LATEST_DANP,
)
def _(t):
    rows = snapshot.latest_load(t.label_danp)
    before = rows.select("store_id", F.col("most_recent_deactivation_timestamp").alias("deact"))
    after = rows.select("store_id", F.col("reactivation_timestamp").alias("react"))
    return before.join(after, "store_id").where(F.col("deact") < F.col("react"))


@query(
    "c11_calendar_window",
    """SELECT a, dm_date, count(match_id) AS n FROM (SELECT a, CAST(unnest(generate_series(a - 83, a, INTERVAL 1 DAY)) AS DATE) AS dm_date
  FROM (SELECT DISTINCT pred_date + 1 AS a FROM {decile_metrics})) g
LEFT JOIN {decile_metrics} d ON d.pred_date + 1 = g.dm_date GROUP BY 1, 2""",
)
def _(t):
    acts = t.decile_metrics.select(X.plus_days("pred_date", 1).alias("a")).distinct()
    grain = acts.withColumn("dm_date", F.explode(F.sequence(X.plus_days("a", -83), F.col("a"))))
    daily = t.decile_metrics.groupBy(X.plus_days("pred_date", 1).alias("dm_date")).agg(F.count("match_id").alias("n"))
    return keyed.with_defaults(grain.join(daily, "dm_date", "left"), {"n": 0})


@query(
    "c12_anti_join",
    "SELECT r.* FROM {registry_filtered} r LEFT JOIN (SELECT * FROM {stores} WHERE is_active = 1 AND is_partner = 1) a ON a.store_id = r.store_id WHERE a.store_id IS NULL",
)
def _(t):
    return population.open_registry(t, drop_fraud=False)


@query(
    "c13_not_in_or_null",
    "SELECT id, store_id FROM {registry} WHERE store_id NOT IN (SELECT store_id FROM {stores} WHERE last_deactivation_reason = 'Fraudulent Store') OR store_id IS NULL",
)
def _(t):
    return population.without_fraud(t.registry, t).select("id", "store_id")


@query(
    "c14_not_in_guarded",
    "SELECT id, store_id FROM {registry} WHERE store_id NOT IN (SELECT store_id FROM {premium_flags} WHERE store_id IS NOT NULL)",
)
def _(t):
    return keyed.not_in_keys(t.registry, "store_id", t.premium_flags, "store_id").select("id", "store_id")


@query("c15_semi_join", "SELECT id FROM {registry} WHERE id IN (SELECT match_id FROM {poor_activations})")
def _(t):
    keys = t.poor_activations.select(F.col("match_id").alias("id"))
    return t.registry.join(keys, "id", "left_semi").select("id")


@query(
    "c16_distinct_keys_first",
    """SELECT k.starting_point_id, k.store_activation_date, count(delivery_id) AS orders
FROM (SELECT DISTINCT starting_point_id, store_activation_date FROM latest) k LEFT JOIN core d
 ON d.starting_point_id = k.starting_point_id AND active_date <= k.store_activation_date AND active_date > k.store_activation_date - 28 GROUP BY 1, 2""",
    core=CORE, latest=LATEST_NN,
)
def _(t):
    keys = ["starting_point_id", "store_activation_date"]
    anchors = snapshot.latest_load(t.label_nn).select(*keys).distinct()
    daily = t.core.groupBy("starting_point_id", "active_date").agg(F.count("delivery_id").alias("orders"))
    pairs = asof.pair_in_window(anchors, daily, keys[:1], keys[1], "active_date", -27, 0)
    found = pairs.groupBy(*keys).agg(F.sum("orders").alias("orders"))
    return keyed.with_defaults(anchors.join(found, keys, "left"), {"orders": 0})


@query(
    "c17_null_matching_merge",
    """SELECT a.match_id, a.sp_id, a.national AS national_a, b.national AS national_b FROM {registry} a
JOIN {registry} b ON a.id = b.id AND a.sp_id IS NOT DISTINCT FROM b.sp_id""".replace("a.match_id", "a.id AS match_id"),
)
def _(t):
    side = t.registry.select(F.col("id").alias("match_id"), "sp_id", "national")
    left = side.withColumnRenamed("national", "national_a")
    right = side.withColumnRenamed("national", "national_b")
    return keyed.join_null_safe(left, right, ["match_id", "sp_id"], "inner")


# Aggregates ------------------------------------------------------------------


@query(
    "d01_grouped_aggregates",
    """SELECT submarket_id, sum(subtotal) AS s, avg(subtotal) AS a, min(active_date) AS mn, max(active_date) AS mx,
 count(is_partner) AS known, count(*) AS n FROM {deliveries} GROUP BY 1""",
)
def _(t):
    return t.deliveries.groupBy("submarket_id").agg(
        F.sum("subtotal").alias("s"), F.avg("subtotal").alias("a"), F.min("active_date").alias("mn"),
        F.max("active_date").alias("mx"), F.count("is_partner").alias("known"), F.count(F.lit(1)).alias("n"),
    )


@query(
    "d02_several_distinct_counts",
    "SELECT submarket_id, count(DISTINCT store_id) AS stores, count(DISTINCT creator_id) AS consumers, count(DISTINCT active_date) AS days FROM core GROUP BY 1",
    core=CORE,
)
def _(t):
    out = None
    for col, name in (("store_id", "stores"), ("creator_id", "consumers"), ("active_date", "days")):
        part = rollup.distinct_per(t.core, ["submarket_id"], col, name)
        out = part if out is None else out.join(part, "submarket_id")
    return out


@query(
    "d03_conditional_aggregates",
    "SELECT store_id, sum(subtotal) FILTER (WHERE is_partner) AS p, avg(fee) FILTER (WHERE NOT is_partner) AS np FROM {deliveries} GROUP BY 1",
)
def _(t):
    return t.deliveries.groupBy("store_id").agg(
        F.sum(F.when(X.is_true("is_partner"), F.col("subtotal"))).alias("p"),
        F.avg(F.when(X.is_false("is_partner"), F.col("fee"))).alias("np"),
    )


@query(
    "d04_conditional_distinct",
    "SELECT submarket_id, count(DISTINCT store_id) FILTER (WHERE is_partner) AS partner_stores FROM core GROUP BY 1",
    core=CORE,
)
def _(t):
    per_store = t.core.groupBy("submarket_id", "store_id").agg(F.max(X.flag(X.is_true("is_partner"))).alias("p"))
    return per_store.groupBy("submarket_id").agg(F.sum("p").alias("partner_stores"))


@query(
    "d05_median",
    "SELECT submarket_id, median(subtotal) AS all_orders, median(subtotal) FILTER (WHERE is_partner) AS partner_orders FROM core GROUP BY 1",
    core=CORE,
)
def _(t):
    dist = t.core.groupBy("submarket_id", "subtotal").agg(
        F.count(F.lit(1)).alias("n"), F.sum(X.flag(X.is_true("is_partner"))).alias("p")
    )
    return rollup.weighted_medians(dist, ["submarket_id"], "subtotal", ["n", "p"], ["all_orders", "partner_orders"])


@query(
    "d06_guarded_ratio",
    "SELECT store_id, coalesce(sum(subtotal) FILTER (WHERE is_partner) / nullif(count(*) FILTER (WHERE is_partner AND subtotal > 9000000), 0), 0) AS r FROM core GROUP BY 1",
    core=CORE,
)
def _(t):
    partner = X.is_true("is_partner")
    return t.core.groupBy("store_id").agg(
        X.safe_ratio(
            F.sum(F.when(partner, F.col("subtotal"))), F.sum(X.flag(partner & (F.col("subtotal") > 9000000)))
        ).alias("r")
    )


@query(
    "d07_two_level_aggregate",
    "SELECT store_id, avg(cents) AS mean_day FROM (SELECT store_id, active_date, sum(subtotal) AS cents FROM core GROUP BY 1, 2) GROUP BY 1",
    core=CORE,
)
def _(t):
    daily = t.core.groupBy("store_id", "active_date").agg(F.sum("subtotal").alias("cents"))
    return daily.groupBy("store_id").agg(F.avg("cents").alias("mean_day"))


@query("d08_group_by_names", "SELECT store_id, business_id, count(*) AS n FROM {deliveries} GROUP BY store_id, business_id")
def _(t):
    return t.deliveries.groupBy("store_id", "business_id").agg(F.count(F.lit(1)).alias("n"))


@query("d09_distinct", "SELECT DISTINCT store_id, sp_id, sub_id FROM {store_status}")
def _(t):
    return t.store_status.select("store_id", "sp_id", "sub_id").distinct()


@query("d10_having", "SELECT store_id, count(*) AS n FROM core GROUP BY 1 HAVING count(*) > 300", core=CORE)
def _(t):
    return t.core.groupBy("store_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 300)


@query("d11_keys_seen_once", ONCE)
def _(t):
    return labels.unique_merchant_dates(t)


@query(
    "d12_mean_and_max_version",
    "SELECT match_id, avg(pred) AS pred, max(ml_model_version) AS ml_model_version FROM {predictions} WHERE match_id IS NOT NULL GROUP BY 1",
)
def _(t):
    rows = t.predictions.where(F.col("match_id").isNotNull())
    return rows.groupBy("match_id").agg(F.avg("pred").alias("pred"), F.max("ml_model_version").alias("ml_model_version"))


# Windows, sorts, sets --------------------------------------------------------


@query(
    "e01_last_seven_rows",
    "SELECT store_id, date_stamp, sum(active_eop) OVER (PARTITION BY store_id ORDER BY date_stamp ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS last7 FROM {store_status}",
)
def _(t):
    w = Window.partitionBy("store_id").orderBy("date_stamp").rowsBetween(-6, 0)
    return t.store_status.select("store_id", "date_stamp", F.sum(X.flag(X.is_true("active_eop"))).over(w).alias("last7"))


@query(
    "e02_share_of_total",
    "SELECT submarket_id, sum(subtotal) AS s, sum(subtotal) * 1.0 / sum(sum(subtotal)) OVER (PARTITION BY submarket_id % 3) AS share FROM core GROUP BY 1",
    core=CORE,
)
def _(t):
    sales = t.core.groupBy("submarket_id").agg(F.sum("subtotal").alias("s"))
    total = F.sum("s").over(Window.partitionBy(F.col("submarket_id") % 3))
    return sales.select("submarket_id", "s", X.ratio("s", total).alias("share"))


@query(
    "e03_latest_per_key",
    "SELECT DISTINCT ON (store_id) store_id, id, created_at, reason_id FROM {store_deactivations} ORDER BY store_id, created_at DESC, id DESC",
)
def _(t):
    rows = t.store_deactivations.select("store_id", "id", "created_at", "reason_id")
    return ranking.first_per_key(rows, ["store_id"], [F.col("created_at").desc(), F.col("id").desc()])


@query(
    "e04_largest_per_key",
    "SELECT DISTINCT ON (match_id) match_id, pred, model FROM {predictions} WHERE match_id IS NOT NULL ORDER BY match_id, pred DESC NULLS LAST, create_date, model",
)
def _(t):
    rows = t.predictions.where(F.col("match_id").isNotNull())
    order = [F.col("pred").desc_nulls_last(), F.col("create_date"), F.col("model")]
    return ranking.first_per_key(rows, ["match_id"], order).select("match_id", "pred", "model")


@query(
    "e05_ntile",
    "SELECT match_id, create_date, ntile(10) OVER (PARTITION BY create_date ORDER BY pred DESC NULLS FIRST, match_id NULLS FIRST) AS tile FROM p",
    p="SELECT match_id, create_date, max(CASE WHEN pred < 0 THEN 0 ELSE pred END) AS pred FROM {predictions} WHERE match_id IS NOT NULL GROUP BY 1, 2",
)
def _(t):
    pred = F.when(F.col("pred") < 0, 0.0).otherwise(F.col("pred"))
    rows = t.predictions.where(F.col("match_id").isNotNull()).groupBy("match_id", "create_date").agg(F.max(pred).alias("pred"))
    ranked = ranking.rank_descending(rows, ["create_date"], "pred", ["match_id"])
    return ranked.select("match_id", "create_date", ranking.ntile_of(F.col("__rank"), F.col("__size"), 10).alias("tile"))


@query(
    "f01_top_per_key",
    "SELECT DISTINCT ON (submarket_id) submarket_id, store_id, cents FROM (SELECT submarket_id, store_id, sum(subtotal) AS cents FROM core GROUP BY 1, 2) ORDER BY submarket_id, cents DESC, store_id",
    core=CORE,
)
def _(t):
    sales = t.core.groupBy("submarket_id", "store_id").agg(F.sum("subtotal").alias("cents"))
    return ranking.first_per_key(sales, ["submarket_id"], [F.col("cents").desc(), F.col("store_id")])


@query("f02_final_order", "SELECT pred_date, count(*) AS n FROM {decile_metrics} GROUP BY 1 ORDER BY 1")
def _(t):
    return t.decile_metrics.groupBy("pred_date").agg(F.count(F.lit(1)).alias("n")).orderBy("pred_date")


@query("f03_no_inner_order", "SELECT store_id, count(*) AS n FROM (SELECT * FROM {store_status} ORDER BY date_stamp) GROUP BY 1")
def _(t):
    return t.store_status.groupBy("store_id").agg(F.count(F.lit(1)).alias("n"))


@query("g01_union_distinct", "SELECT store_id FROM {label_nn} UNION SELECT store_id FROM {label_danp} UNION SELECT store_id FROM {registry}")
def _(t):
    parts = [df.select("store_id") for df in (t.label_nn, t.label_danp, t.registry)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@query("g02_union_all", "SELECT store_id FROM {label_nn} UNION ALL SELECT store_id FROM {label_danp}")
def _(t):
    return t.label_nn.select("store_id").unionByName(t.label_danp.select("store_id"))


@query(
    "g03_concat_missing_columns",
    "SELECT match_id, store_activation_date, CAST(NULL AS VARCHAR) AS merchant_type FROM {label_nn} UNION ALL SELECT match_id, NULL, merchant_type FROM {label_danp}",
)
def _(t):
    nn = t.label_nn.select("match_id", "store_activation_date")
    return nn.unionByName(t.label_danp.select("match_id", "merchant_type"), allowMissingColumns=True)


# Scalar functions ------------------------------------------------------------


@query(
    "h01_add_days_and_months",
    "SELECT store_id, activation_date - 85 AS minus_85, CAST(activation_date + INTERVAL 4 MONTH AS DATE) AS plus_4_months FROM {merchant_dates}",
)
def _(t):
    return t.merchant_dates.select(
        "store_id", X.plus_days("activation_date", -85).alias("minus_85"),
        F.add_months("activation_date", 4).alias("plus_4_months"),
    )


@query(
    "h02_day_difference",
    "SELECT mx_id, date_diff('day', min(requested_at), max(requested_at)) AS days FROM {store_requests} GROUP BY 1",
)
def _(t):
    span = X.day_diff(F.min("requested_at"), F.max("requested_at"))
    return t.store_requests.groupBy("mx_id").agg(span.alias("days"))


@query(
    "h03_month_difference",
    f"SELECT DISTINCT active_date, date_diff('month', DATE '{DAY}' - 1, active_date) AS months FROM {{deliveries}}",
)
def _(t):
    return t.deliveries.select("active_date").distinct().withColumn("months", X.month_diff(F.lit(D - dt.timedelta(1)), "active_date"))


@query(
    "h04_truncation",
    "SELECT DISTINCT active_date, CAST(date_trunc('week', active_date) AS DATE) AS week, CAST(date_trunc('day', created_at) AS DATE) AS d FROM {deliveries}",
)
def _(t):
    return t.deliveries.select(
        "active_date", F.trunc("active_date", "week").alias("week"), F.date_trunc("day", "created_at").cast("date").alias("d")
    ).distinct()


@query("h05_date_parts", "SELECT DISTINCT active_date, month(active_date) AS m, quarter(active_date) AS q, year(active_date) AS y FROM {deliveries}")
def _(t):
    day = F.col("active_date")
    return t.deliveries.select(day, F.month(day).alias("m"), F.quarter(day).alias("q"), F.year(day).alias("y")).distinct()


@query(
    "h06_casts_to_date",
    "SELECT DISTINCT CAST(created_at AS DATE) AS d, CAST(created_at AS DATE) + 1 AS next_day, CAST('1998-06-01' AS DATE) AS literal FROM {deliveries}",
)
def _(t):
    d = F.to_date("created_at")
    return t.deliveries.select(
        d.alias("d"), F.date_add(d, 1).alias("next_day"), F.to_date(F.lit("1998-06-01")).alias("literal")
    ).distinct()


@query("h07_local_day", f"SELECT DISTINCT timezone, created_at, {LOCAL_DAY} AS local_day FROM {{deliveries}}")
def _(t):
    return t.deliveries.select("timezone", "created_at", X.local_day("created_at", "timezone").alias("local_day")).distinct()


@query("h08_timestamps_without_zone", "SELECT store_id, min(CAST(created_at AS TIMESTAMP)) AS first_order FROM {deliveries} GROUP BY 1")
def _(t):
    return t.deliveries.groupBy("store_id").agg(F.min(F.to_timestamp_ntz(F.col("created_at").cast("string"))).alias("first_order"))


@query("h09_as_of_date", f"SELECT store_id, DATE '{DAY}' - activation_date AS age FROM {{merchant_dates}}")
def _(t):
    return t.merchant_dates.select("store_id", X.day_diff("activation_date", F.lit(D)).alias("age"))


@query(
    "h10_null_handling",
    "SELECT id, coalesce(store_id, -1) AS a, coalesce(existence_score, 0) AS b, nullif(sub_id, 3) AS c FROM {registry}",
)
def _(t):
    return t.registry.select(
        "id", X.nz("store_id", -1).alias("a"), F.ifnull("existence_score", F.lit(0.0)).alias("b"),
        F.nullif("sub_id", F.lit(3)).alias("c"),
    )


@query(
    "h11_searched_case",
    "SELECT match_id, create_date, model, CASE WHEN pred < 0 THEN 0 WHEN pred > 9000 THEN 9000 ELSE pred END AS clamped FROM {predictions}",
)
def _(t):
    p = F.col("pred")
    clamped = F.when(p < 0, 0.0).when(p > 9000, 9000.0).otherwise(p)
    return t.predictions.select("match_id", "create_date", "model", clamped.alias("clamped"))


@query("h12_rounding", "SELECT id, abs(lat) AS a, round(lat, 2) AS r, trunc(lat) AS t FROM {registry}")
def _(t):
    return t.registry.select("id", F.abs("lat").alias("a"), F.round("lat", 2).alias("r"), X.toward_zero("lat").alias("t"))


@query("h13_division", "SELECT store_id, delivery_id, fee / nullif(commission_rate, 0) AS q FROM {deliveries}")
def _(t):
    return t.deliveries.select("store_id", "delivery_id", X.ratio("fee", "commission_rate").alias("q"))


@query("h14_upper", "SELECT id, upper(restaurant_name) AS name FROM {registry}")
def _(t):
    return t.registry.select("id", F.upper("restaurant_name").alias("name"))


@query(
    "h15_number_of_sources",
    """SELECT id, (vendor_1_id IS NOT NULL)::INT + (vendor_2_id IS NOT NULL)::INT + (store_id IS NOT NULL)::INT
 + (directory_id IS NOT NULL)::INT + (panel_id IS NOT NULL)::INT AS number_sources FROM {registry}""",
)
def _(t):
    return t.registry.select("id", X.present("vendor_1_id", "vendor_2_id", "store_id", "directory_id", "panel_id").alias("number_sources"))


@query(
    "h16_flags_and_sales_month",
    "SELECT store_id, date_stamp, CASE WHEN active_eop = 1 AND partner_eop = 1 THEN 1 ELSE 0 END AS both_flags, month(date_stamp + INTERVAL 4 MONTH) AS sales_month FROM {store_status}",
)
def _(t):
    both = X.flag(X.is_true("active_eop") & X.is_true("partner_eop"))
    return t.store_status.select(
        "store_id", "date_stamp", both.alias("both_flags"), F.month(F.add_months("date_stamp", 4)).alias("sales_month")
    )


