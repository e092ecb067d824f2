"""Predictions, activity, market size, deciles."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.base import DAY, DAYS, query
from queryset.features import CORE, DATES, chain_sql
from tamarind.plans import enterprise, ranking
from tamarind.session import cut_lineage

PRED_DAY = "1998-05-31"

DEDUPED = """SELECT match_id, create_date, avg(pred) AS pred, max(data_preprocess_model_version) AS data_preprocess_model_version,
 max(ml_model_version) AS ml_model_version, max(bias_adj_model_version) AS bias_adj_model_version, max(model) AS model
FROM {predictions} WHERE match_id IS NOT NULL GROUP BY 1, 2"""


@query("k37_deduped_predictions", DEDUPED)
def _(t):
    return ranking.dedupe_predictions(t.predictions)


# The day before the labels' activation of interest differs per merchant, so
# the label tables are read with all activations moved onto one day.
SHIFTED_DANP = f"SELECT * REPLACE (DATE '{PRED_DAY}' + CAST(1 + store_id % 2 AS INT) AS reactivation_timestamp) FROM {{label_danp}}"
SHIFTED_NN = f"SELECT * REPLACE (DATE '{PRED_DAY}' + CAST(1 + coalesce(store_id, 0) % 2 AS INT) AS store_activation_date) FROM {{label_nn}}"

FULL = f"""SELECT a.activation_date_actual, coalesce(a.actual, p.pred * 1.1) AS actual, p.match_id,
 mx.restaurant_name AS external_store_name, mx.store_id, mx.vendor_1_id, mx.vendor_2_id, s.name AS platform_store_name,
 mx.sub_id AS submarket_id, mx.sp_id AS starting_point_id, p.data_preprocess_model_version, p.ml_model_version,
 p.bias_adj_model_version, p.pred * 1.1 AS pred, p.model AS model_id, p.create_date
FROM deduped p LEFT JOIN {{registry}} mx ON mx.id = p.match_id LEFT JOIN {{stores}} s ON s.store_id = mx.store_id
LEFT JOIN (SELECT store_id, match_id, max(d) AS activation_date_actual, avg(v) AS actual FROM (
  SELECT store_id, match_id, reactivation_timestamp AS d, actual AS v FROM danp
   WHERE reactivation_timestamp = DATE '{PRED_DAY}' + 1 AND actual IS NOT NULL AND create_date = (SELECT max(create_date) FROM danp)
  UNION SELECT store_id, match_id, store_activation_date, actual FROM nn
   WHERE store_activation_date = DATE '{PRED_DAY}' + 1 AND actual IS NOT NULL AND create_date = (SELECT max(create_date) FROM nn)) u
  GROUP BY 1, 2) a ON a.match_id = p.match_id
WHERE p.create_date = DATE '{PRED_DAY}'"""
FULL_STEPS = dict(deduped=DEDUPED, danp=SHIFTED_DANP, nn=SHIFTED_NN, full_pred=FULL)


def shifted_labels(t):
    day = F.lit(PRED_DAY).cast("date")

    def moved(df, col):
        by = (1 + F.coalesce("store_id", F.lit(0)) % 2).cast("int")
        return df.withColumn(col, F.date_add(day, by))

    return moved(t.label_danp, "reactivation_timestamp"), moved(t.label_nn, "store_activation_date")


def predictions_full(t):
    danp, nn = shifted_labels(t)
    rows = ranking.dedupe_predictions(t.predictions)
    return ranking.predictions_with_actuals(t, rows, PRED_DAY, danp, nn, factor=1.1)


def market(t, full, value="pred"):
    return cut_lineage(ranking.market_size(t, full, DAY, PRED_DAY, value), "market-size")


@query("k38_predictions_with_actuals", "SELECT * FROM full_pred", **FULL_STEPS)
def _(t):
    return predictions_full(t)


RECENT = f"""SELECT date_stamp, store_id, business_id, sp_id, sp_name, sub_id, sub_name,
 max(CASE WHEN (partner_eop = 1 AND active_eop = 1) OR (partner_bop = 1 AND active_bop = 1) THEN 1 ELSE 0 END)
   OVER w AS active_partner,
 max(CASE WHEN active_eop = 1 OR active_bop = 1 THEN 1 ELSE 0 END) OVER w AS active
FROM {{store_status}} WHERE date_stamp > DATE '{DAY}' - 20 AND date_stamp < DATE '{DAY}'
WINDOW w AS (PARTITION BY store_id ORDER BY date_stamp ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
LAST = "SELECT * FROM recent WHERE date_stamp = (SELECT max(date_stamp) FROM recent)"


@query("k39_recent_activity", RECENT)
def _(t):
    return ranking.recent_activity(t, DAY)


@query("k39_live_partners", "SELECT * FROM last WHERE active_partner = 1", recent=RECENT, last=LAST)
def _(t):
    return ranking.live_partners(ranking.recent_activity(t, DAY))


@query("k39_live_nonpartners", "SELECT * FROM last WHERE active = 1 AND active_partner = 0", recent=RECENT, last=LAST)
def _(t):
    return ranking.live_nonpartners(ranking.recent_activity(t, DAY))


LIVE = f"""SELECT mx.id AS match_id, l.store_id, mx.vendor_1_id, mx.vendor_2_id, mx.restaurant_name AS merchant_name, mx.national,
 l.sub_id AS submarket_id, l.sp_id AS starting_point_id, l.active AS is_active, l.active_partner AS is_partner,
 coalesce((SELECT sum(subtotal) / 100.0 FROM core WHERE core.store_id = l.store_id AND is_partner
   AND created_at BETWEEN DATE '{DAY}' - 29 AND DATE '{DAY}' - 1), 0) AS tam_value, 'live sales' AS model_id, DATE '{DAY}' - 1 AS dte
FROM last l LEFT JOIN {{registry}} mx ON mx.store_id = l.store_id WHERE l.active_partner = 1"""
LIVE_STEPS = dict(core=CORE, recent=RECENT, last=LAST, live=LIVE)


@query("k40_live_partner_sales", "SELECT * FROM live", **LIVE_STEPS)
def _(t):
    return ranking.live_sales(t, DAY)


VALID = f"""SELECT DISTINCT m.id FROM {{registry}} m
LEFT JOIN (SELECT * FROM {{registry_checks}} WHERE place_id IS NOT NULL) g ON g.mx_id = m.id
LEFT JOIN {{stores}} s ON s.store_id = m.store_id
WHERE s.activated_at > DATE '{PRED_DAY}' OR (
   (s.is_active = 1 AND s.is_partner = 0)
   OR (m.existence_score >= 0.6 AND m.country IS NOT NULL AND coalesce(g.permanently_closed, 0) = 0)
   OR (((m.existence_score < 0.6 AND m.country IS NOT NULL) OR m.directory_id IS NULL)
       AND g.is_valid_restaurant IS NOT FALSE AND coalesce(g.permanently_closed, 0) = 0
       AND ((m.existence_score > 0 AND m.country IS NOT NULL) OR m.directory_id IS NULL)
       AND ((g.is_valid_restaurant AND coalesce(g.permanently_closed, 0) = 0) OR m.existence_score > 0.5
            OR (m.vendor_1_id IS NOT NULL)::INT + (m.vendor_2_id IS NOT NULL)::INT + (m.store_id IS NOT NULL)::INT
               + (m.directory_id IS NOT NULL)::INT + (m.panel_id IS NOT NULL)::INT > 1)
       AND m.restaurant_name IS NOT NULL AND m.street IS NOT NULL AND m.lat IS NOT NULL AND m.lng IS NOT NULL AND m.sp_id IS NOT NULL))"""


@query("k41_valid_leads", VALID)
def _(t):
    return ranking.valid_leads(t, PRED_DAY)


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def off_sql(value: str) -> str:
    names = " AND ".join(f"NOT contains(merchant_name, '{p}')" for p in ranking.EXCLUDED_NAME_PARTS)
    return f"""SELECT DISTINCT ON (match_id) * FROM (
SELECT p.match_id, p.store_id, p.vendor_1_id, p.vendor_2_id, coalesce(p.external_store_name, s.name) AS merchant_name, mx.national,
 p.submarket_id, p.starting_point_id, coalesce(z.active, 0) AS is_active, coalesce(z.active_partner, 0) AS is_partner,
 greatest(p.{value}, 0) AS tam_value, p.model_id, DATE '{DAY}' - 1 AS dte
FROM full_pred p JOIN valid v ON v.id = p.match_id LEFT JOIN {{stores}} s ON s.store_id = p.store_id
LEFT JOIN {{external_stores}} e ON e.external_id = p.vendor_1_id
LEFT JOIN (SELECT * FROM recent WHERE date_stamp = (SELECT max(date_stamp) FROM {{store_status}})) z ON z.store_id = p.store_id
LEFT JOIN {{registry}} mx ON mx.id = p.match_id
WHERE p.create_date = DATE '{PRED_DAY}' AND s.order_protocol IS DISTINCT FROM 'DRIVE'
 AND s.creation_method IS DISTINCT FROM 'DRIVE_AUTO_ONBOARDING'
 AND (e.cuisine_type IS NULL OR e.cuisine_type NOT IN ({_quoted(ranking.EXCLUDED_CUISINES)})) AND {names}) q
ORDER BY match_id, tam_value DESC NULLS LAST, store_id, model_id"""


TAM = """SELECT * FROM live WHERE match_id IS NULL OR match_id NOT IN (SELECT match_id FROM off_platform)
UNION ALL SELECT * FROM off_platform"""


def tam_steps(value: str) -> dict[str, str]:
    return dict(**FULL_STEPS, **LIVE_STEPS, valid=VALID, off_platform=off_sql(value), tam=TAM)


@query("k42_market_size", "SELECT * FROM tam", **tam_steps("pred"))
def _(t):
    return ranking.market_size(t, predictions_full(t), DAY, PRED_DAY)


@query(
    "k42_off_platform_window_status",
    "SELECT o.* EXCLUDE (is_active, is_partner), coalesce(l.active, 0) AS is_active, coalesce(l.active_partner, 0) AS is_partner "
    "FROM off_platform o LEFT JOIN last l ON l.store_id = o.store_id",
    **tam_steps("pred"),
)
def _(t):
    return ranking.off_platform(t, predictions_full(t), DAY, PRED_DAY, "pred", status_as_of="window_max")


def decile_sql(where: str = "") -> str:
    return f"""SELECT DISTINCT match_id, store_id, submarket_id, tam_value,
 ntile(10) OVER (PARTITION BY dte, submarket_id ORDER BY tam_value DESC NULLS FIRST, match_id NULLS FIRST, store_id NULLS FIRST) AS decile_rank
FROM tam {where}"""


@query("k43_decile_rank", decile_sql(), **tam_steps("pred"))
def _(t):
    return ranking.decile_rank(market(t, predictions_full(t)))


@query("k43_decile_rank_without_partners", decile_sql("WHERE model_id <> 'live sales'"), **tam_steps("pred"))
def _(t):
    return ranking.decile_rank(market(t, predictions_full(t)), include_partner=False)


COMBINED_STEPS = dict(
    **tam_steps("pred"),
    rank_pred=decile_sql(),
    off_actual=off_sql("actual"),
    tam_actual=TAM.replace("off_platform", "off_actual"),
    rank_actual=decile_sql().replace("FROM tam ", "FROM tam_actual "),
)
COMBINED = """SELECT f.match_id, f.create_date AS pred_date, f.model_id, f.data_preprocess_model_version, f.ml_model_version,
 f.bias_adj_model_version, p.submarket_id, a.store_id AS store_id_actual, a.tam_value AS tam_value_actual,
 a.decile_rank AS decile_rank_actual, p.store_id AS store_id_pred, p.tam_value AS tam_value_pred, p.decile_rank AS decile_rank_pred
FROM full_pred f JOIN rank_actual a ON a.match_id IS NOT DISTINCT FROM f.match_id
JOIN rank_pred p ON p.match_id IS NOT DISTINCT FROM a.match_id AND p.submarket_id IS NOT DISTINCT FROM a.submarket_id
WHERE f.activation_date_actual IS NOT NULL"""


@query("k44_combined_ranks", COMBINED, **COMBINED_STEPS)
def _(t):
    full = cut_lineage(predictions_full(t), "predictions-full")
    predicted = ranking.decile_rank(market(t, full, "pred"))
    actual = ranking.decile_rank(market(t, full, "actual"))
    return ranking.combine_ranks(actual, predicted, full)


@query(
    "k45_enterprise_adjusted",
    """SELECT p.*, a.l28d_avg_sales, b.l28d_avg_sales AS sub_l28d_avg_sales, c.l28d_avg_sales AS global_l28d_avg_sales,
 0.5 * p.pred + 0.5 * coalesce(a.l28d_avg_sales, b.l28d_avg_sales, c.l28d_avg_sales, p.pred) AS pred_ent_adj
FROM deduped p LEFT JOIN {registry} mx ON mx.id = p.match_id
LEFT JOIN by_point a ON a.restaurant_name = mx.restaurant_name AND a.sub_id = mx.sub_id AND a.sp_id = mx.sp_id AND a.created_date = p.create_date
LEFT JOIN by_sub b ON b.restaurant_name = mx.restaurant_name AND b.sub_id = mx.sub_id AND b.created_date = p.create_date
LEFT JOIN overall c ON c.restaurant_name = mx.restaurant_name AND c.created_date = p.create_date""",
    deduped=DEDUPED, core=CORE, dates=DATES,
    by_point=chain_sql("sub_id sp_id restaurant_name"), by_sub=chain_sql("sub_id restaurant_name"),
    overall=chain_sql("restaurant_name"),
)
def _(t):
    sales = [enterprise.chain_sales(t, DAYS, g) for g in ("starting_point", "submarket", "global")]
    return enterprise.adjust_predictions(t, ranking.dedupe_predictions(t.predictions), *sales)
