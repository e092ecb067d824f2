"""Registry filters and the merchants to score."""

from __future__ import annotations

import datetime as dt

from queryset.base import DAY, query
from queryset.features import CORE, LATEST_DANP, LATEST_NN
from tamarind.plans import population

SNAPSHOTS = dt.date(1997, 1, 1)

OPEN_ALL = """SELECT * FROM {registry_filtered} r WHERE NOT EXISTS
 (SELECT 1 FROM {stores} s WHERE s.store_id = r.store_id AND s.is_active = 1 AND s.is_partner = 1)"""
OPEN_SAFE = """SELECT * FROM open_all WHERE store_id IS NULL OR store_id NOT IN
 (SELECT store_id FROM {stores} WHERE last_deactivation_reason = 'Fraudulent Store')"""
REG = dict(open_all=OPEN_ALL, open_safe=OPEN_SAFE)


@query("k21_open_registry", "SELECT * FROM open_safe", **REG)
def _(t):
    return population.open_registry(t)


@query("k21_open_registry_with_fraud", "SELECT * FROM open_all", open_all=OPEN_ALL)
def _(t):
    return population.open_registry(t, drop_fraud=False)


DESCRIBED = """SELECT r.id AS match_id, r.store_id, coalesce(r.vendor_1_id, e.external_id) AS vendor_1_id, r.vendor_2_id,
 coalesce(r.restaurant_name, s.name) AS name, s.business_id,
 coalesce(r.sp_id, s.starting_point_id, e.starting_point_id) AS starting_point_id,
 coalesce(r.sub_id, s.submarket_id) AS submarket_id, s.market_id, r.is_active, r.is_partner
FROM open_safe r LEFT JOIN {stores} s ON s.store_id = r.store_id LEFT JOIN {external_stores} e ON e.store_id = r.store_id"""

GONE = """SELECT g.match_id, g.store_id, g.vendor_1_id, g.vendor_2_id, g.name, g.business_id,
 coalesce(g.starting_point_id, c.starting_point_id) AS starting_point_id, g.submarket_id,
 CAST(timezone(coalesce(max(m.timezone), 'US/Pacific'), timezone('UTC', CAST(coalesce(max(c.created_at),
   (SELECT max(created_at) FROM {store_deactivations} x WHERE x.store_id = g.store_id)) AS TIMESTAMP))) AS DATE) AS most_recent_deactivation_date
FROM described g JOIN core c ON c.store_id = g.store_id LEFT JOIN {markets} m ON m.id = g.market_id
WHERE g.is_active IS NOT TRUE GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""

ACTIVE = f"""SELECT match_id, store_id, vendor_1_id, vendor_2_id, name, business_id, starting_point_id, submarket_id,
 DATE '{DAY}' - 1 AS most_recent_deactivation_date FROM described WHERE is_active AND is_partner IS NOT TRUE"""

PRECISE = f"""SELECT store_id, max(date_stamp) AS d FROM {{store_status}}
WHERE active_eop = 1 AND partner_eop = 0 AND date_stamp > DATE '1997-01-01' GROUP BY 1 HAVING max(date_stamp) < DATE '{DAY}' - 7"""
REASONS = """SELECT DISTINCT ON (store_id) store_id, CAST(created_at AS DATE) AS d, reason_id
FROM {store_deactivations} ORDER BY store_id, created_at DESC, id DESC"""
LAST_DAYS = f"""SELECT s.store_id, coalesce(r.d, p.d) AS last_np_live_day FROM {{stores}} s
LEFT JOIN precise p ON p.store_id = s.store_id LEFT JOIN reasons r ON r.store_id = s.store_id
WHERE s.is_active = 0 AND (r.reason_id <> 1 OR r.reason_id IS NULL)
 AND (coalesce(p.d, r.d) < DATE '{DAY}' - 7 OR coalesce(p.d, r.d) IS NULL)"""

LATER_DANP = f"""SELECT match_id, store_id, vendor_1_id, CAST(NULL AS VARCHAR) AS vendor_2_id, external_store_name AS name,
 business_id, starting_point_id, submarket_id, most_recent_deactivation_timestamp, DATE '{DAY}' - 1 AS activation_date,
 CASE merchant_type WHEN 'active_np' THEN 'active' WHEN 'deactivated_np' THEN 'deactivated' END AS merchant_type_prod
FROM latest_danp WHERE reactivation_timestamp > DATE '{DAY}'"""
LATER_NN = f"""SELECT match_id AS id, store_activation_date AS activation_date, starting_point_id AS sp_id,
 submarket_id AS sub_id, vendor_1_id, restaurant_name FROM latest_nn WHERE store_activation_date >= DATE '{DAY}'"""

KNOWN = f"""SELECT g.* EXCLUDE (most_recent_deactivation_date),
  coalesce(most_recent_deactivation_date, last_np_live_day) AS most_recent_deactivation_timestamp,
  DATE '{DAY}' - 1 AS activation_date, 'deactivated' AS merchant_type_prod
 FROM gone g LEFT JOIN last_days l ON l.store_id = g.store_id
UNION SELECT * EXCLUDE (most_recent_deactivation_date), most_recent_deactivation_date, DATE '{DAY}' - 1, 'active' FROM act
UNION SELECT * FROM later_danp"""

NET_NEW = """SELECT id AS match_id, restaurant_name AS store_name, vendor_1_id, sp_id AS starting_point_id, sub_id AS submarket_id
FROM open_all WHERE is_active IS NOT TRUE OR (is_partner IS NOT TRUE
  AND id NOT IN (SELECT match_id FROM {prior_danp_inputs} WHERE match_id IS NOT NULL))
UNION SELECT id, restaurant_name, vendor_1_id, sp_id, sub_id FROM later_nn"""

GONE_STEPS = dict(core=CORE, **REG, described=DESCRIBED, gone=GONE)
LAST_STEPS = dict(precise=PRECISE, reasons=REASONS, last_days=LAST_DAYS)
KNOWN_STEPS = dict(
    **GONE_STEPS, act=ACTIVE, **LAST_STEPS, latest_danp=LATEST_DANP, later_danp=LATER_DANP, known=KNOWN
)
NET_NEW_STEPS = dict(open_all=OPEN_ALL, latest_nn=LATEST_NN, later_nn=LATER_NN, net_new=NET_NEW)


@query("k22_deactivated_merchants", "SELECT * FROM gone", **GONE_STEPS)
def _(t):
    return population.deactivated_merchants(t)


@query("k23_active_nonpartners", "SELECT * FROM act", **REG, described=DESCRIBED, act=ACTIVE)
def _(t):
    return population.active_nonpartners(t, DAY)


@query("k24_last_nonpartner_day", "SELECT * FROM last_days", **LAST_STEPS)
def _(t):
    return population.last_nonpartner_days(t, DAY, SNAPSHOTS)


@query("k25_activated_after_danp", "SELECT * FROM later_danp", latest_danp=LATEST_DANP, later_danp=LATER_DANP)
def _(t):
    return population.activated_after_danp(t, DAY)


@query("k25_activated_after_nn", "SELECT * FROM later_nn", latest_nn=LATEST_NN, later_nn=LATER_NN)
def _(t):
    return population.activated_after_nn(t, DAY)


@query("k26_known_merchants", "SELECT * FROM known", **KNOWN_STEPS)
def _(t):
    return population.known_merchants(t, DAY, SNAPSHOTS)


@query("k27_net_new_merchants", "SELECT * FROM net_new", **NET_NEW_STEPS)
def _(t):
    return population.net_new_merchants(t, DAY)
