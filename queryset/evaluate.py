"""Cohorts, rolling windows, balance and calibration."""

from __future__ import annotations

import datetime as dt

from queryset.base import query
from tamarind.plans import evaluate

# Thirty dates; only every fifth day has predictions.
ACTIVATIONS = [str(dt.date(1998, 5, 26) + dt.timedelta(days=k)) for k in (*range(28), 59, 60)]

COHORTS = """SELECT s.store_id, s.business_id, CASE
 WHEN EXISTS (SELECT 1 FROM {business_group_links} l JOIN {business_groups} g ON g.id = l.business_group_id
   WHERE l.business_id = s.business_id AND g.is_active AND NOT g.is_test AND g.business_group_type = 'ENTERPRISE') THEN 'Enterprise'
 WHEN EXISTS (SELECT 1 FROM {business_group_links} l JOIN {business_groups} g ON g.id = l.business_group_id
   WHERE l.business_id = s.business_id AND g.is_active AND NOT g.is_test AND g.business_group_type = 'MID_MARKET') THEN 'Mid-Market'
 ELSE 'Local' END AS cohort FROM {stores} s"""


@query("k46_store_cohorts", COHORTS)
def _(t):
    return evaluate.store_cohorts(t)


GRAIN = """SELECT a AS activation_date, CAST(unnest(generate_series(a - 83, a, INTERVAL 1 DAY)) AS DATE) AS dm_date
FROM (SELECT DISTINCT pred_date + 1 AS a FROM {decile_metrics} WHERE decile_rank_pred IS NOT NULL)"""


@query("k47_rolling_grain", GRAIN)
def _(t):
    return evaluate.rolling_grain(t.decile_metrics)


def rolling_sql(keep: str, countries: str, cohorts: str, poor: str = "") -> str:
    dates = ", ".join(f"DATE '{d}'" for d in ACTIVATIONS)
    return f"""SELECT DISTINCT g.activation_date, g.dm_date, mx.store_id, mx.sub_id, d.match_id, c.cohort, {keep}
FROM grain g JOIN {{decile_metrics}} d ON g.dm_date = d.pred_date + 1 JOIN {{registry}} mx ON mx.id = d.match_id
JOIN cohorts c ON c.store_id = mx.store_id JOIN {{regions}} r ON r.submarket_id = mx.sub_id
WHERE g.activation_date IN ({dates}) AND d.decile_rank_pred IS NOT NULL AND upper(mx.restaurant_name) NOT LIKE '%JUST WINGS%'
 AND r.country_id IN ({countries}) AND c.cohort IN ({cohorts}) {poor}"""


ALL = dict(countries="1, 2, 5", cohorts="'Enterprise', 'Mid-Market', 'Local'")
RANKS = "decile_rank_pred, decile_rank_actual, tam_value_pred, tam_value_actual"
SIZES = "decile_rank_pred, tam_value_pred, tam_value_actual"
NOT_POOR = "AND d.match_id NOT IN (SELECT match_id FROM {poor_activations})"

BALANCE = """SELECT activation_date, sum(n) AS tot_store_cnt, sum(b) AS tot_balance_score,
 round(CAST(sum(b) AS DOUBLE) / sum(n), 2) AS normalized_balance_score
FROM (SELECT activation_date, decile_rank_actual, decile_rank_pred, count(DISTINCT match_id) AS n,
        sum(abs(decile_rank_pred - decile_rank_actual)) AS b FROM rolling GROUP BY 1, 2, 3) GROUP BY 1"""


def steps(keep: str, **narrow) -> dict[str, str]:
    return dict(cohorts=COHORTS, grain=GRAIN, rolling=rolling_sql(keep, **{**ALL, **narrow}))


@query("k47_rolling_rows", "SELECT * FROM rolling", **steps(RANKS))
def _(t):
    return evaluate.rolling_rows(t, t.decile_metrics, ACTIVATIONS, RANKS.split(", "))


@query("k48_rank_balance", BALANCE, **steps(RANKS))
def _(t):
    return evaluate.rank_balance(t, t.decile_metrics, ACTIVATIONS)


@query(
    "k48_rank_balance_narrow", BALANCE,
    **steps(RANKS, countries="1, 2", cohorts="'Enterprise', 'Mid-Market'", poor=NOT_POOR),
)
def _(t):
    return evaluate.rank_balance(
        t, t.decile_metrics, ACTIVATIONS, countries=(1, 2), cohorts=("Enterprise", "Mid-Market"),
        exclude_poor_activation=True,
    )


BY_DECILE = """SELECT *, avg_tam_value_actual / sum(avg_tam_value_actual) OVER (PARTITION BY activation_date) AS decile_weight,
 abs((avg_tam_value_actual - avg_tam_value_pred) / nullif(avg_tam_value_actual, 0)) AS avg_rolling_cpe
FROM (SELECT activation_date, decile_rank_pred, count(DISTINCT date_trunc('week', dm_date)) AS rolling_weeks_cnt,
        avg(tam_value_actual) AS avg_tam_value_actual, avg(tam_value_pred) AS avg_tam_value_pred FROM rolling GROUP BY 1, 2)"""


@query("k49_calibration_by_decile", BY_DECILE, **steps(SIZES))
def _(t):
    return evaluate.calibration_by_decile(t, t.decile_metrics, ACTIVATIONS)


@query(
    "k49_weighted_calibration_error",
    "SELECT activation_date, sum(avg_rolling_cpe * decile_weight) * 100 AS weighted_cpe FROM by_decile GROUP BY 1",
    **steps(SIZES), by_decile=BY_DECILE,
)
def _(t):
    return evaluate.weighted_calibration_error(t, t.decile_metrics, ACTIVATIONS)
