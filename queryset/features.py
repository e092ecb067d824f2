"""Search, vendor, geography, chain, request and store-history features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from queryset.base import DAY, DAYS, query
from tamarind.operators.snapshot import latest_load
from tamarind.plans import business, enterprise, geography, growth, requests, search, store_stats, vendor

CORE = "SELECT * FROM {deliveries} WHERE is_core"
DATES = "SELECT * FROM (VALUES " + ", ".join(f"(DATE '{d}')" for d in DAYS) + ") v(t)"
LATEST_NN = "SELECT * FROM {label_nn} WHERE create_date = (SELECT max(create_date) FROM {label_nn})"
LATEST_DANP = "SELECT * FROM {label_danp} WHERE create_date = (SELECT max(create_date) FROM {label_danp})"
DAILY = (
    "SELECT store_id AS m, search_date AS d, sum(query_count / store_count) AS n "
    "FROM {search_counts} WHERE store_id IS NOT NULL GROUP BY 1, 2"
)


@query("k01_daily_search_count", "SELECT m AS store_id, d AS search_date, n AS search_count FROM daily", daily=DAILY)
def _(t):
    return search.daily_counts(t)


def _spans(end: int, anchor: str) -> str:
    parts = []
    for span in (84, 28, 14):
        held = f"FILTER (WHERE d BETWEEN {anchor} - {span - end} AND {anchor} - {-end})"
        some = f"CASE WHEN count(*) {held} > 0 THEN"
        parts.append(f"{some} coalesce(avg(n) {held}, 0) END AS avg_search_count_{span}_days_before_null_excluded")
        parts.append(f"{some} coalesce(sum(n) {held}, 0) END AS total_search_count_{span}_days_before")
    return ", ".join(parts)


def _train_spans() -> str:
    return f"""SELECT m AS match_id, {_spans(-1, 'a')}
FROM daily JOIN acts ON acts.id = daily.m AND d BETWEEN a - 85 AND a - 1 GROUP BY m"""


ACTS_DANP = "SELECT match_id AS id, max(reactivation_timestamp) AS a FROM latest GROUP BY 1"
ACTS_NN = "SELECT match_id AS id, max(store_activation_date) AS a FROM latest GROUP BY 1"


@query("k02_search_lookbacks_danp", _train_spans(), daily=DAILY, latest=LATEST_DANP, acts=ACTS_DANP)
def _(t):
    return search.training_lookbacks(t, "danp")


@query("k02_search_lookbacks_nn", _train_spans(), daily=DAILY, latest=LATEST_NN, acts=ACTS_NN)
def _(t):
    return search.training_lookbacks(t, "nn")


SCORED = f"""SELECT m AS match_id, t AS create_date, {_spans(-2, 't')}
FROM daily JOIN dates ON d BETWEEN t - 86 AND t - 2 GROUP BY 1, 2"""


@query("k03_search_lookbacks_scoring", SCORED, daily=DAILY, dates=DATES)
def _(t):
    return search.scoring_lookbacks(t, DAYS)


@query(
    "k04_search_features_daily",
    "SELECT p.match_id, t AS create_date, s.* EXCLUDE (match_id, create_date) "
    "FROM (SELECT DISTINCT id AS match_id FROM {registry}) p CROSS JOIN dates "
    "LEFT JOIN scored s ON s.match_id = p.match_id AND s.create_date = t",
    daily=DAILY, dates=DATES, scored=SCORED,
)
def _(t):
    days = F.explode(F.array(*[F.lit(dt.date.fromisoformat(d)) for d in DAYS]))
    rows = t.registry.select(F.col("id").alias("match_id")).distinct().withColumn("create_date", days)
    return search.daily_table(t, rows, DAYS)


def _mean(first: int, last: int) -> str:
    return (
        "SELECT m AS match_id, t AS create_date, avg(n) AS avg_search_count_84_days_before "
        f"FROM daily JOIN dates ON d BETWEEN t - {first} AND t - {last} GROUP BY 1, 2"
    )


@query("k05_mean_daily_search_danp", _mean(84, 1), daily=DAILY, dates=DATES)
def _(t):
    return search.mean_daily_count(t, DAYS, "danp")


@query("k05_mean_daily_search_nn", _mean(86, 2), daily=DAILY, dates=DATES)
def _(t):
    return search.mean_daily_count(t, DAYS, "nn")


REVIEWS = "SELECT match_id, store_id, " + ", ".join(
    f"avg({src}) AS {out}" for out, src in vendor.AVERAGES.items()
) + " FROM {vendor_features} GROUP BY 1, 2"
CATEGORIES = "SELECT match_id, store_id, max(cohort) AS cohort_raw, " + ", ".join(
    f"max({c}_encoded) AS {c}" for c in vendor.ENCODED
) + " FROM {vendor_features} GROUP BY 1, 2"


@query("k06_review_averages", REVIEWS)
def _(t):
    return vendor.review_averages(t)


@query("k06_category_maxima", CATEGORIES)
def _(t):
    return vendor.category_maxima(t)


def geo_columns(p: str, aov: bool = False) -> str:
    sql = f"""sum(subtotal) / 100.0 AS {p}_total_sales, count(delivery_id) AS {p}_total_orders,
 count(DISTINCT store_id) AS {p}_live_stores, count(DISTINCT creator_id) AS {p}_num_consumers,
 coalesce(count(*) FILTER (WHERE is_partner) / nullif(count(delivery_id), 0), 0) AS {p}_delivery_partner_percent,
 coalesce(count(DISTINCT store_id) FILTER (WHERE is_partner) / nullif(count(DISTINCT store_id), 0), 0) AS {p}_store_partner_percent,
 coalesce(sum(subtotal) FILTER (WHERE is_partner) / 100.0 / nullif(count(DISTINCT store_id) FILTER (WHERE is_partner), 0), 0) AS {p}_sales_per_partner"""
    if aov:
        sql += f", coalesce(sum(subtotal) / 100.0 / nullif(count(delivery_id), 0), 0) AS {p}_aov"
    return sql


def week_sql(key: str, reg: str, p: str) -> str:
    return f"""SELECT {key}, t AS create_date, CAST(max(known.n) AS DOUBLE) AS {p}_total_stores, {geo_columns(p)},
 coalesce(count(DISTINCT store_id) FILTER (WHERE is_partner) / max(known.n), 0) AS {p}_store_partner_percent_overall
FROM core JOIN dates ON active_date BETWEEN t - 7 AND t - 1
LEFT JOIN (SELECT {reg} AS k, count(DISTINCT id) AS n FROM {{registry_filtered}} GROUP BY 1) known ON known.k = {key}
GROUP BY 1, 2"""


@query("k07_submarket_l7d", week_sql("submarket_id", "sub_id", "submarket"), core=CORE, dates=DATES)
def _(t):
    return geography.week_stats(t, DAYS, "submarket")


@query("k08_starting_point_l7d", week_sql("starting_point_id", "sp_id", "sp"), core=CORE, dates=DATES)
def _(t):
    return geography.week_stats(t, DAYS, "starting_point")


def chain_sql(keys: str) -> str:
    cols = ", ".join(f"e.{k}" for k in keys.split())
    return f"""SELECT {cols}, t AS created_date,
 sum(subtotal) FILTER (WHERE is_partner) / 100.0 / nullif(count(DISTINCT e.store_id) FILTER (WHERE is_partner), 0) AS l28d_avg_sales
FROM core d JOIN dates ON active_date BETWEEN t - 28 AND t - 1
JOIN {{enterprise_merchants}} e ON e.store_id = d.store_id GROUP BY {cols}, t"""


for _grain, _keys in enterprise.GRAINS.items():

    @query(f"k09_enterprise_l28d_{_grain}", chain_sql(" ".join(_keys)), core=CORE, dates=DATES)
    def _(t, grain=_grain):
        return enterprise.chain_sales(t, DAYS, grain)


def activation_geo_sql(key: str, p: str) -> str:
    return f"""SELECT a.{key}, a.act AS store_activation_date, {geo_columns(p)}
FROM (SELECT DISTINCT {key}, store_activation_date AS act FROM latest) a
LEFT JOIN core ON core.{key} = a.{key} AND active_date <= act AND active_date > act - 28 GROUP BY 1, 2"""


@query("k10_starting_point_at_activation", activation_geo_sql("starting_point_id", "sp"), core=CORE, latest=LATEST_NN)
def _(t):
    return geography.stats_at_activation(t, latest_load(t.label_nn), "starting_point")


@query("k11_submarket_at_activation", activation_geo_sql("submarket_id", "submarket"), core=CORE, latest=LATEST_NN)
def _(t):
    return geography.stats_at_activation(t, latest_load(t.label_nn), "submarket")


def scoring_geo_sql(key: str, p: str, aov: bool = False) -> str:
    return f"""SELECT {key}, t AS create_date, {geo_columns(p, aov)}
FROM core JOIN dates ON active_date BETWEEN t - 29 AND t - 1 GROUP BY 1, 2"""


@query("k12_starting_point_scoring", scoring_geo_sql("starting_point_id", "sp"), core=CORE, dates=DATES)
def _(t):
    return geography.stats_for_scoring(t, DAYS, "starting_point")


@query("k12_submarket_scoring", scoring_geo_sql("submarket_id", "submarket"), core=CORE, dates=DATES)
def _(t):
    return geography.stats_for_scoring(t, DAYS, "submarket")


AGE_SQL = """SELECT a.submarket_id, act AS store_activation_date,
 date_diff('day', (SELECT min(active_date) FROM core WHERE core.submarket_id = a.submarket_id), act) AS submarket_days_since_first_delivery
FROM (SELECT DISTINCT submarket_id, store_activation_date AS act FROM latest) a"""


@query("k13_submarket_age_training", AGE_SQL, core=CORE, latest=LATEST_NN)
def _(t):
    return geography.age_at_activation(t, latest_load(t.label_nn))


@query(
    "k13_submarket_age_scoring",
    f"SELECT submarket_id, date_diff('day', min(active_date), DATE '{DAY}' - 2) AS submarket_days_since_first_delivery FROM core GROUP BY 1",
    core=CORE,
)
def _(t):
    return geography.age_for_scoring(t, DAY)


def requests_sql(cutoff: int, l84: tuple, l28: tuple) -> str:
    """Over ``people(match_id, a)``: requests joined with every earlier order."""

    def held(w):
        return f"count(DISTINCT r.consumer_id) FILTER (WHERE r.requested_at BETWEEN a - {-w[0]} AND a - {-w[1]})"

    return f"""SELECT p.match_id, a, min(r.requested_at) AS first_request_requested_at,
 max(r.requested_at) AS last_request_requested_at,
 date_diff('day', min(r.requested_at), max(r.requested_at)) AS days_btw_first_and_last_request,
 count(DISTINCT r.consumer_id) AS num_requests_all_time, trunc(avg(o.subtotal)) AS avg_subtotal_from_consumer_request,
 coalesce(count(DISTINCT o.delivery_id) / nullif(count(DISTINCT r.consumer_id), 0), 0) AS num_delivery_to_requests_ratio,
 {held(l84)} AS num_requests_l84days, {held(l28)} AS num_requests_l28days
FROM people p LEFT JOIN {{store_requests}} r ON r.mx_id = p.match_id AND r.requested_at < a - {-cutoff}
LEFT JOIN core o ON o.creator_id = r.consumer_id AND r.requested_at > o.created_at AND o.subtotal > 0
GROUP BY 1, 2"""


@query(
    "k14_requests_training_nn",
    "SELECT * RENAME (a AS store_activation_date) FROM asked",
    core=CORE, latest=LATEST_NN,
    people="SELECT DISTINCT match_id, store_activation_date AS a FROM latest",
    asked=requests_sql(*requests.TRAIN),
)
def _(t):
    return requests.request_features(t, latest_load(t.label_nn), "store_activation_date", requests.TRAIN)


@query(
    "k14_requests_training_danp",
    "SELECT * RENAME (a AS reactivation_timestamp) FROM asked",
    core=CORE, latest=LATEST_DANP,
    people="SELECT DISTINCT match_id, reactivation_timestamp AS a FROM latest",
    asked=requests_sql(*requests.TRAIN),
)
def _(t):
    return requests.request_features(t, latest_load(t.label_danp), "reactivation_timestamp", requests.TRAIN)


@query(
    "k14_requests_scoring",
    "SELECT * RENAME (a AS create_date) FROM asked",
    core=CORE, dates=DATES,
    people="SELECT id AS match_id, t AS a FROM {registry} CROSS JOIN dates",
    asked=requests_sql(*requests.SCORE),
)
def _(t):
    return requests.scoring_requests(t, t.registry.select(F.col("id").alias("match_id")), DAYS)


def store_sql(zero: bool, history: int | None = 180, aov: bool = False, group: str = "p.store_id, p.dea") -> str:
    """Over ``people(store_id, dea, ..)``."""
    window = "active_date <= p.dea" if history is None else f"active_date BETWEEN p.dea - {history} AND p.dea"

    def z(expr: str, to_zero: bool = True) -> str:
        return f"coalesce({expr}, 0)" if zero and to_zero else expr

    cols = [
        "count(DISTINCT delivery_id) AS num_orders_before",
        "count(DISTINCT active_date) AS num_days_active_before",
        "avg(fee) / 100.0 AS avg_fee_before",
        z("avg(subtotal) / 100.0") + " AS avg_subtotal_before",
        z("sum(subtotal) / 100.0") + " AS total_subtotal_before",
        z("median(subtotal) / 100.0") + " AS median_subtotal_before",
        z("max(subtotal) / 100.0") + " AS max_subtotal_before",
        "count(*) FILTER (WHERE is_first_order) AS num_first_ordercarts_before",
        "count(*) FILTER (WHERE is_partner) / nullif(count(*), 0) AS pct_partner_delivs_before",
    ]
    if aov:
        cols.append("coalesce(sum(subtotal) / 100.0 / nullif(count(DISTINCT delivery_id), 0), 0) AS aov_before")
    for name, first in (("7days", 9), ("28days", 30)):
        on = f"active_date BETWEEN p.dea - {first} AND p.dea"
        f = f"FILTER (WHERE {on})"
        cents = "sum(subtotal) " + f
        cols += [
            f"count(DISTINCT active_date) {f} AS num_days_active_{name}_before",
            z(f"avg(subtotal) {f} / 100.0") + f" AS avg_subtotal_{name}_before",
            f"count(DISTINCT delivery_id) {f} AS num_orders_{name}_before",
            z(f"avg(fee) {f} / 100.0") + f" AS avg_fee_{name}_before",
            z(f"median(subtotal) {f} / 100.0") + f" AS median_subtotal_{name}_before",
            z(f"CAST({cents} AS DOUBLE)" if name == "7days" else f"{cents} / 100.0") + f" AS total_subtotal_{name}_before",
            z(f"avg(commission_rate) {f}", name == "28days") + f" AS avg_commission_rate_{name}_before",
            z(f"median(commission_rate) {f}", name == "28days") + f" AS median_commission_rate_{name}_before",
            f"count(DISTINCT delivery_id) FILTER (WHERE {on} AND is_first_order) AS num_first_ordercarts_{name}_before",
            f"count(DISTINCT delivery_id) FILTER (WHERE {on} AND is_partner) AS num_partner_delivs_{name}_before",
        ]
    return f"""SELECT {group}, {', '.join(cols)}
FROM people p LEFT JOIN core ON core.store_id = p.store_id AND {window} GROUP BY {group}"""


PEOPLE_DANP = "SELECT *, most_recent_deactivation_timestamp AS dea FROM latest"


@query(
    "k15_store_stats_training",
    "SELECT * RENAME (dea AS most_recent_deactivation_timestamp) FROM s",
    core=CORE, latest=LATEST_DANP, people=PEOPLE_DANP,
    s=store_sql(False, group="p.store_id, p.dea, p.match_id, p.reactivation_timestamp"),
)
def _(t):
    return store_stats.before_deactivation(
        t, latest_load(t.label_danp), fill_zero=False, extra=("match_id", "reactivation_timestamp")
    )


# The scoring population may hold a store and date several times.
REPEATED = "SELECT *, most_recent_deactivation_timestamp AS dea FROM {label_danp}"


@query(
    "k15_store_stats_scoring",
    "SELECT * RENAME (dea AS most_recent_deactivation_timestamp) FROM s",
    core=CORE, people=REPEATED, s=store_sql(True),
)
def _(t):
    return store_stats.before_deactivation(t, t.label_danp)


@query(
    "k15_store_stats_all_history",
    "SELECT * RENAME (dea AS most_recent_deactivation_timestamp) FROM s",
    core=CORE, people=REPEATED, s=store_sql(True, None, True),
)
def _(t):
    return store_stats.before_deactivation(t, t.label_danp, history_days=None, with_aov=True)


def business_sql(history: int | None = 180) -> str:
    """Over ``firms(business_id, a)``."""
    window = "active_date <= a" if history is None else f"active_date BETWEEN a - {history} AND a"
    return f"""SELECT f.business_id, a, count(DISTINCT store_id) AS num_stores_business_before,
 count(DISTINCT delivery_id) AS num_orders_business_before,
 count(DISTINCT delivery_id) / nullif(count(DISTINCT store_id), 0) AS num_orders_per_store_business_before,
 coalesce(sum(subtotal) / 100.0 / nullif(count(DISTINCT store_id), 0), 0) AS avg_subtotal_per_store_business_before,
 sum(subtotal) / 100.0 AS total_subtotal_business_before,
 coalesce(sum(subtotal) / 100.0 / nullif(count(DISTINCT active_date), 0), 0) AS total_subtotal_per_active_date_business_before
FROM firms f LEFT JOIN core ON core.business_id = f.business_id AND {window} GROUP BY 1, 2"""


FIRMS_DEA = "SELECT DISTINCT business_id, most_recent_deactivation_timestamp AS a FROM {label_danp}"
FIRMS_REACT = "SELECT DISTINCT business_id, reactivation_timestamp AS a FROM {label_danp}"


@query(
    "k16_business_before_deactivation_all_history",
    "SELECT * RENAME (a AS most_recent_deactivation_timestamp) FROM b",
    core=CORE, firms=FIRMS_DEA, b=business_sql(None),
)
def _(t):
    return business.business_before(t, t.label_danp, "most_recent_deactivation_timestamp", None)


@query(
    "k16_business_before_reactivation",
    "SELECT * RENAME (a AS reactivation_timestamp) FROM b",
    core=CORE, firms=FIRMS_REACT, b=business_sql(),
)
def _(t):
    return business.business_before(t, t.label_danp, "reactivation_timestamp")


def point_sql(at: str, suffix: str, fee: str = "avg(fee) / 100.0", share_zero: bool = True) -> str:
    """Over ``people(store_id, starting_point_id, <at>)``; ``at`` is the output name."""
    share = "count(*) FILTER (WHERE is_partner) / nullif(count(delivery_id), 0)"
    if share_zero:
        share = f"coalesce({share}, 0)"
    return f"""SELECT p.store_id, p.starting_point_id, p.{at}, count(DISTINCT delivery_id) AS num_orders_sp_7days_{suffix},
 sum(subtotal) / 100.0 AS total_subtotal_sp_7days_{suffix}, {fee} AS avg_fee_sp_7days_{suffix},
 {share} AS pct_partner_sp_7days_{suffix}, count(DISTINCT core.store_id) AS num_stores_sp_7days_{suffix},
 count(DISTINCT creator_id) AS num_consumers_sp_7days_{suffix}
FROM people p LEFT JOIN core ON core.starting_point_id = p.starting_point_id
 AND active_date <= p.{at} AND active_date > p.{at} - 7 GROUP BY 1, 2, 3"""


DEA, REACT = "most_recent_deactivation_timestamp", "reactivation_timestamp"
ALL_DANP = "SELECT * FROM {label_danp}"


@query("k17_starting_point_before_deactivation", point_sql(DEA, "before"), core=CORE, people=ALL_DANP)
def _(t):
    return growth.point_week(t, t.label_danp, DEA, "before")


@query("k18_starting_point_before_reactivation", point_sql(REACT, "after"), core=CORE, people=ALL_DANP)
def _(t):
    return growth.point_week(t, t.label_danp, REACT, "after")


@query("k18_starting_point_fixed_fee", point_sql(REACT, "after", "2.25"), core=CORE, people=ALL_DANP)
def _(t):
    return growth.point_week(t, t.label_danp, REACT, "after", fixed_fee=growth.SCORING_FEE)


def growth_sql(dea: str, act: str) -> str:
    """Over ``before`` and ``after``."""

    def g(n: str) -> str:
        return f"coalesce(({n}_after - {n}_before) / nullif({n}_before * 1.0, 0), 0)"

    return f"""SELECT b.*, a.* EXCLUDE (store_id, starting_point_id),
 1.0 + {g('total_subtotal_sp_7days')} AS total_subtotal_scaler_sp, {g('num_orders_sp_7days')} AS num_orders_growth_sp,
 {g('num_stores_sp_7days')} AS num_stores_growth_sp, {g('num_consumers_sp_7days')} AS num_consumers_growth_sp,
 pct_partner_sp_7days_after - pct_partner_sp_7days_before AS pct_partner_change_sp,
 avg_fee_sp_7days_after - avg_fee_sp_7days_before AS avg_fee_change_sp
FROM before b JOIN after a ON a.store_id = b.store_id AND a.starting_point_id = b.starting_point_id AND b.{dea} < a.{act}"""


@query(
    "k19_starting_point_growth",
    growth_sql(DEA, REACT),
    core=CORE, people=ALL_DANP,
    before=point_sql(DEA, "before", share_zero=False), after=point_sql(REACT, "after"),
)
def _(t):
    weeks = growth.point_totals(t, t.label_danp, DEA, REACT)
    before = growth.point_week(t, t.label_danp, DEA, "before", partner_default=False, totals=weeks)
    after = growth.point_week(t, t.label_danp, REACT, "after", totals=weeks)
    return growth.point_growth(before, after, DEA, REACT)


def nonpartner_sql(since: str) -> str:
    return f"""SELECT store_id, count(*) FILTER (WHERE is_partner = false) AS total_nonpartner_orders_lifetime,
 min(created_at) AS first_lifetime_order, max(created_at) FILTER (WHERE is_partner = false) AS last_np_order,
 min(created_at) FILTER (WHERE is_partner) AS first_partner_order
FROM core WHERE active_date >= DATE '{since}' GROUP BY 1"""


HISTORY = dt.date(1996, 1, 1)


@query("k20_nonpartner_history", nonpartner_sql("1996-01-01"), core=CORE)
def _(t):
    return store_stats.nonpartner_history(t, HISTORY)
