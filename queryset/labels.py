"""Monthly sales labels and fifth-month labels."""

from __future__ import annotations

import datetime as dt

from queryset.base import query
from queryset.features import (
    AGE_SQL,
    CORE,
    DEA,
    LATEST_DANP,
    LATEST_NN,
    REACT,
    activation_geo_sql,
    business_sql,
    growth_sql,
    nonpartner_sql,
    point_sql,
    requests_sql,
    store_sql,
)
from tamarind.plans import labels, requests

START, END = "1998-01-01", "1999-03-31"
FROM = dt.date(1997, 1, 1)
AS_OF = "1998-06-08"
SINCE = dt.date(1998, 1, 1)  # of the first-order jobs

NOT_FRAUD = "(store_id IS NULL OR store_id NOT IN (SELECT store_id FROM {stores} WHERE last_deactivation_reason = 'Fraudulent Store'))"


def age_sql(keys: str, act: str) -> str:
    """Over ``latest`` and ``core``."""
    cols = ", ".join(f"f.{k}" for k in keys.split())
    return f"""SELECT {cols}, date_diff('month', f.{act}, active_date) AS age_month, max(f.{act}) AS {act},
 min(active_date) AS min_active_date, sum(subtotal) / 100.0 AS total_subtotal_month
FROM latest f JOIN core ON core.store_id = f.store_id AND active_date BETWEEN DATE '{START}' AND DATE '{END}'
WHERE f.{act} >= DATE '1997-01-01' GROUP BY {cols}, date_diff('month', f.{act}, active_date)
HAVING date_diff('month', f.{act}, active_date) >= 1"""


NN_AGE = age_sql("store_id restaurant_name match_id", "store_activation_date")
DANP_AGE = age_sql("store_id " + DEA, REACT)


@query("k28_nn_sales_by_age", "SELECT * FROM aged", core=CORE, latest=LATEST_NN, aged=NN_AGE)
def _(t):
    return labels.nn_sales_by_age(t, START, END, FROM)


@query("k29_danp_sales_by_age", "SELECT * FROM aged", core=CORE, latest=LATEST_DANP, aged=DANP_AGE)
def _(t):
    return labels.danp_sales_by_age(t, START, END, FROM)


PER_DAY = "coalesce(num_requests_all_time / nullif(days_btw_first_and_last_request, 0), 0) AS num_request_per_day"

NN_LABEL = f"""SELECT f.match_id, f.store_id, f.restaurant_name, f.starting_point_id, f.submarket_id, g.age_month,
 g.store_activation_date, g.min_active_date, g.total_subtotal_month,
 CASE WHEN mx.vendor_1_id IS NULL THEN 'not_requestable' ELSE 'requestable' END AS requestable, f.first_partner_order_date,
 month(f.store_activation_date) AS activation_month, year(f.store_activation_date) AS activation_year,
 num_requests_l84days, num_requests_l28days, num_requests_all_time, {PER_DAY},
 avg_subtotal_from_consumer_request, num_delivery_to_requests_ratio,
 coalesce(num_requests_l28days / nullif(sp_num_consumers, 0), 0) AS requests_to_sp_consumers_ratio,
 coalesce(num_requests_l28days / nullif(sp_total_sales, 0), 0) AS requests_to_sp_sales_ratio,
 sp.* EXCLUDE (starting_point_id, store_activation_date), ag.submarket_days_since_first_delivery,
 sub.* EXCLUDE (submarket_id, store_activation_date), DATE '{END}' AS create_date
FROM aged g LEFT JOIN latest f ON f.match_id = g.match_id LEFT JOIN {{registry}} mx ON mx.id = f.match_id
LEFT JOIN sp ON sp.starting_point_id = f.starting_point_id AND sp.store_activation_date = f.store_activation_date
LEFT JOIN sub ON sub.submarket_id = f.submarket_id AND sub.store_activation_date = f.store_activation_date
LEFT JOIN ag ON ag.submarket_id = f.submarket_id AND ag.store_activation_date = f.store_activation_date
LEFT JOIN asked r ON r.match_id = f.match_id
WHERE {NOT_FRAUD.replace('store_id IS NULL', 'f.store_id IS NULL').replace('store_id NOT IN', 'f.store_id NOT IN')}"""

NN_STEPS = dict(
    core=CORE,
    latest=LATEST_NN,
    aged=NN_AGE,
    people="SELECT DISTINCT match_id, store_activation_date AS a FROM latest",
    asked=requests_sql(*requests.TRAIN),
    sp=activation_geo_sql("starting_point_id", "sp"),
    sub=activation_geo_sql("submarket_id", "submarket"),
    ag=AGE_SQL,
    nn_label=NN_LABEL,
)


@query("k28_nn_monthly_label", "SELECT * FROM nn_label", **NN_STEPS)
def _(t):
    return labels.nn_monthly_label(t, START, END, FROM)


STORE_COLS = """num_orders_before, num_days_active_before, avg_fee_before, avg_subtotal_before, median_subtotal_before,
 max_subtotal_before, total_subtotal_before,
 coalesce(total_subtotal_before / nullif(num_days_active_before, 0), 0) AS total_subtotal_per_active_date_before,
 coalesce(num_orders_before / nullif(num_days_active_before, 0), 0) AS num_orders_per_active_date_before,
 num_first_ordercarts_before, pct_partner_delivs_before, num_orders_7days_before, num_days_active_7days_before,
 avg_fee_7days_before, avg_subtotal_7days_before, median_subtotal_7days_before, total_subtotal_7days_before,
 num_first_ordercarts_7days_before, num_days_active_28days_before, total_subtotal_28days_before, num_orders_28days_before,
 num_stores_business_before, num_orders_business_before, num_orders_per_store_business_before,
 avg_subtotal_per_store_business_before, total_subtotal_business_before, total_subtotal_per_active_date_business_before,
 total_subtotal_scaler_sp, num_orders_growth_sp, num_stores_growth_sp, num_consumers_growth_sp, pct_partner_change_sp,
 avg_fee_change_sp, avg_commission_rate_7days_before, median_commission_rate_7days_before,
 coalesce(num_partner_delivs_7days_before / nullif(num_orders_7days_before, 0), 0) AS pct_partner_delivs_7days_before,
 num_requests_l84days, num_requests_l28days, num_requests_all_time, avg_subtotal_from_consumer_request,
 num_delivery_to_requests_ratio"""

DANP_LABEL = f"""SELECT g.store_id, g.age_month, g.min_active_date, f.match_id, mx.vendor_1_id, f.store_name AS platform_store_name,
 mx.restaurant_name AS external_store_name, f.starting_point_id, f.business_id, p.submarket_id,
 CASE WHEN mx.vendor_1_id IS NULL THEN 'not_requestable' ELSE 'requestable' END AS requestable, g.{DEA}, g.{REACT},
 f.merchant_type, f.reactivation_month, f.reactivation_year, f.deactivation_month, f.deactivation_year, f.num_days_deactive,
 f.num_days_since_reactivation, avg_fee_28days_before, {STORE_COLS}, {PER_DAY}, g.total_subtotal_month, DATE '{END}' AS create_date
FROM aged g LEFT JOIN latest f ON f.store_id = g.store_id AND f.{DEA} = g.{DEA}
LEFT JOIN {{registry}} mx ON mx.store_id = g.store_id
LEFT JOIN own ON own.store_id = g.store_id AND own.dea = g.{DEA}
LEFT JOIN firm ON firm.business_id = f.business_id AND firm.a = f.{REACT}
LEFT JOIN grown ON grown.store_id = g.store_id AND grown.starting_point_id = f.starting_point_id AND grown.{REACT} = f.{REACT}
LEFT JOIN {{starting_points}} p ON p.id = f.starting_point_id
LEFT JOIN (SELECT l.store_id, asked.* FROM (SELECT DISTINCT match_id, store_id, {REACT} AS a FROM latest) l
  JOIN asked ON asked.match_id = l.match_id AND asked.a = l.a) r ON r.match_id = f.match_id
WHERE num_days_active_before > 0 AND {NOT_FRAUD.replace('store_id IS NULL', 'g.store_id IS NULL').replace('store_id NOT IN', 'g.store_id NOT IN')}"""

DANP_STEPS = dict(
    core=CORE,
    latest=LATEST_DANP,
    aged=DANP_AGE,
    firms=f"SELECT DISTINCT business_id, {REACT} AS a FROM latest",
    firm=business_sql(),
    people=f"SELECT *, {DEA} AS dea, {REACT} AS a FROM latest",
    own=store_sql(False, group=f"p.store_id, p.dea, p.match_id, p.{REACT}"),
    before=point_sql(DEA, "before", share_zero=False),
    after=point_sql(REACT, "after"),
    grown=growth_sql(DEA, REACT),
    asked=requests_sql(*requests.TRAIN),
    danp_label=DANP_LABEL,
)


@query("k29_danp_monthly_label", "SELECT * FROM danp_label", **DANP_STEPS)
def _(t):
    return labels.danp_monthly_label(t.written("deliveries"), START, END, FROM)


ONCE = """SELECT DISTINCT * FROM {merchant_dates} WHERE store_id IN
 (SELECT store_id FROM (SELECT DISTINCT * FROM {merchant_dates}) GROUP BY 1 HAVING count(*) = 1) AND level_verification = 2"""


@query("k30_unique_merchant_dates", ONCE)
def _(t):
    return labels.unique_merchant_dates(t)


LOCAL_DAY = "CAST(timezone(timezone, timezone('UTC', CAST(created_at AS TIMESTAMP))) AS DATE)"
FIRST_ORDERS = f"""SELECT store_id, starting_point_id, min({LOCAL_DAY}) AS first_order_date,
 min({LOCAL_DAY}) FILTER (WHERE is_partner) AS first_partner_order_date
FROM core WHERE created_at > TIMESTAMP '1998-01-01 00:00:00' GROUP BY 1, 2"""


@query("k30_first_orders", FIRST_ORDERS, core=CORE)
def _(t):
    return labels.first_orders(t, SINCE)


WEEK_AGO = f"SELECT * FROM {{store_status}} WHERE date_stamp = DATE '{AS_OF}' - 7 AND active_bop = 1 AND partner_bop = 1"
NN_ACTS = """SELECT p.*, first_order_date, first_partner_order_date,
 coalesce(o.activation_date, first_partner_order_date) AS store_activation_date
FROM (SELECT DISTINCT w.store_id, mx.id AS match_id, coalesce(mx.restaurant_name, w.business_name) AS restaurant_name,
        w.sp_id AS starting_point_id, w.sub_id AS submarket_id
      FROM week_ago w JOIN {registry} mx ON mx.store_id = w.store_id) p
LEFT JOIN once o ON o.store_id = p.store_id JOIN first_orders f ON f.store_id = p.store_id
WHERE first_order_date = first_partner_order_date AND coalesce(o.activation_date, first_partner_order_date) IS NOT NULL"""
FIFTH_NN = f"""SELECT f.match_id, mx.vendor_1_id, f.store_id, f.restaurant_name, f.starting_point_id, f.submarket_id,
 CASE WHEN mx.vendor_1_id IS NULL THEN 'not_requestable' ELSE 'requestable' END AS requestable, f.first_partner_order_date,
 f.store_activation_date, month(f.store_activation_date) AS activation_month, year(f.store_activation_date) AS activation_year,
 s.* EXCLUDE (store_id), DATE '{AS_OF}' AS create_date
FROM acts f LEFT JOIN {{registry}} mx ON mx.id = f.match_id JOIN (
  SELECT a.store_id, a.restaurant_name AS rn, a.match_id AS mi,
   coalesce(sum(subtotal) FILTER (WHERE active_date <= store_activation_date + 27), 0) / 100.0 AS total_subtotal_first_28_days,
   coalesce(sum(subtotal) FILTER (WHERE active_date <= store_activation_date + 29), 0) / 100.0 AS total_subtotal_first_30_days,
   coalesce(sum(subtotal) FILTER (WHERE active_date BETWEEN store_activation_date + 120 AND store_activation_date + 148), 0) / 100.0
     AS total_subtotal_first_120_148_days
  FROM acts a LEFT JOIN core ON core.store_id = a.store_id AND active_date >= store_activation_date GROUP BY 1, 2, 3) s
 ON s.store_id = f.store_id
WHERE {NOT_FRAUD.replace('store_id IS NULL', 'f.store_id IS NULL').replace('store_id NOT IN', 'f.store_id NOT IN')}"""
FIFTH_STEPS = dict(core=CORE, once=ONCE, first_orders=FIRST_ORDERS, week_ago=WEEK_AGO, acts=NN_ACTS)


@query("k30_nn_activations", "SELECT * FROM acts", **FIFTH_STEPS)
def _(t):
    return labels.nn_activations(t, AS_OF, SINCE)


@query("k30_nn_fifth_month", FIFTH_NN.replace("s.* EXCLUDE (store_id)", "s.* EXCLUDE (store_id, rn, mi)"), **FIFTH_STEPS)
def _(t):
    return labels.nn_fifth_month(t, AS_OF, SINCE)


FIFTH_DANP = f"""SELECT w.store_id, mx.id AS match_id, mx.vendor_1_id, w.store_name AS platform_store_name,
 mx.restaurant_name AS external_store_name, w.sp_id AS starting_point_id, w.business_id, p.submarket_id,
 CASE WHEN mx.vendor_1_id IS NULL THEN 'not_requestable' ELSE 'requestable' END AS requestable,
 o.last_np_live_day AS {DEA}, o.activation_date AS {REACT},
 CASE WHEN o.activation_date - o.last_np_live_day BETWEEN 0 AND 28 THEN 'active_np'
      WHEN o.activation_date - o.last_np_live_day > 28 AND coalesce(np.total_nonpartner_orders_lifetime, 0) <> 0 THEN 'deactivated_np'
      WHEN coalesce(np.total_nonpartner_orders_lifetime, 0) = 0 THEN 'net_new' END AS merchant_type,
 month(o.activation_date) AS reactivation_month, year(o.activation_date) AS reactivation_year,
 month(o.last_np_live_day) AS deactivation_month, year(o.last_np_live_day) AS deactivation_year,
 o.activation_date - o.last_np_live_day AS num_days_deactive, DATE '{AS_OF}' - 8 - o.activation_date AS num_days_since_reactivation,
 (SELECT sum(subtotal) / 100.0 FROM core WHERE core.store_id = w.store_id
   AND active_date BETWEEN o.activation_date + 120 AND o.activation_date + 148) AS total_subtotal_first_120_148_days,
 DATE '{AS_OF}' AS create_date
FROM week_ago w JOIN once o ON o.store_id = w.store_id JOIN {{registry}} mx ON mx.store_id = w.store_id
LEFT JOIN np ON np.store_id = w.store_id LEFT JOIN {{starting_points}} p ON p.id = w.sp_id
WHERE o.activation_date IS NOT NULL AND DATE '{AS_OF}' - 8 - o.activation_date > 28
 AND (SELECT count(DISTINCT active_date) FROM core WHERE core.store_id = w.store_id AND active_date <= o.last_np_live_day) > 0
 AND {NOT_FRAUD.replace('store_id IS NULL', 'w.store_id IS NULL').replace('store_id NOT IN', 'w.store_id NOT IN')}"""


@query(
    "k31_danp_fifth_month", FIFTH_DANP,
    core=CORE, once=ONCE, week_ago=WEEK_AGO, np=nonpartner_sql("1998-01-01"),
)
def _(t):
    return labels.danp_fifth_month(t, AS_OF, SINCE)
