"""Scoring features, training sets and scoring sets."""

from __future__ import annotations

import datetime as dt

from queryset.base import DAY, query
from queryset.features import (
    CATEGORIES,
    CORE,
    DAILY,
    DEA,
    LATEST_DANP,
    LATEST_NN,
    REVIEWS,
    _train_spans,
    business_sql,
    geo_columns,
    growth_sql,
    nonpartner_sql,
    point_sql,
    requests_sql,
    store_sql,
    ACTS_DANP,
    ACTS_NN,
    _spans,
    week_sql,
)
from queryset.labels import DANP_STEPS, END, FROM, NN_STEPS, PER_DAY, START, STORE_COLS
from queryset.population import KNOWN_STEPS, NET_NEW_STEPS, SNAPSHOTS
from tamarind.operators.snapshot import latest_load
from tamarind.session import cut_lineage
from tamarind.plans import assembly, geography, labels, requests, scoring_features, search

HISTORY = dt.date(1996, 1, 1)
ONE_DAY = f"SELECT DATE '{DAY}' AS t"


def danp_sql(aov: bool) -> str:
    country = "" if aov else ", rg.country_id, 0 AS rar_not_shown"
    region = "" if aov else "LEFT JOIN {regions} rg ON rg.submarket_id = sp.submarket_id"
    extra = "aov_before, " if aov else ""
    active = "AND num_days_active_before > 0" if aov else ""
    return f"""SELECT s.store_id, s.name, coalesce(s.match_id, rx.id) AS match_id, s.vendor_1_id, s.starting_point_id, sp.submarket_id,
 CASE WHEN s.vendor_1_id IS NULL THEN 'not_requestable' ELSE 'requestable' END AS requestable, s.{DEA},
 CASE WHEN date_diff('day', np.last_np_order, np.first_partner_order) BETWEEN 0 AND 28 THEN 'nonpartner_partner_conversion'
      WHEN np.total_nonpartner_orders_lifetime > 0 THEN 'nonpartner_deactivated_partner'
      WHEN np.total_nonpartner_orders_lifetime = 0 THEN 'partner_deactivated_partner' ELSE 'other' END AS merchant_type,
 {extra}{STORE_COLS}, {PER_DAY}, coalesce(sc.avg_n, 0) AS avg_search_count_84_days_before,
 month(s.activation_date) AS reactivation_month, year(s.activation_date) AS reactivation_year,
 month(s.{DEA}) AS deactivation_month, year(s.{DEA}) AS deactivation_year, s.merchant_type_prod, DATE '{DAY}' AS create_date{country}
FROM known s LEFT JOIN np ON np.store_id = s.store_id LEFT JOIN sc ON sc.m = s.match_id
LEFT JOIN own ON own.store_id = s.store_id AND own.dea = s.{DEA}
LEFT JOIN firm ON firm.business_id = s.business_id AND firm.a = s.activation_date
LEFT JOIN grown ON grown.store_id = s.store_id AND grown.starting_point_id = s.starting_point_id AND grown.activation_date = s.activation_date
LEFT JOIN {{starting_points}} sp ON sp.id = s.starting_point_id
LEFT JOIN asked r ON r.match_id = s.match_id LEFT JOIN {{registry}} rx ON rx.vendor_1_id = s.vendor_1_id {region}
WHERE date_diff('day', s.{DEA}, s.activation_date) <= 364 {active}"""


def danp_steps(aov: bool) -> dict[str, str]:
    return dict(
        **KNOWN_STEPS,
        people=f"SELECT *, {DEA} AS dea FROM known",
        own=store_sql(True, None if aov else 180, aov),
        firms="SELECT DISTINCT business_id, activation_date AS a FROM known",
        firm=business_sql(None if aov else 180),
        before=point_sql(DEA, "before"),
        after=point_sql("activation_date", "after", "2.25"),
        grown=growth_sql(DEA, "activation_date"),
        np=nonpartner_sql("1996-01-01"),
        daily=DAILY,
        sc=f"SELECT m, avg(n) AS avg_n FROM daily WHERE d BETWEEN DATE '{DAY}' - 84 AND DATE '{DAY}' - 1 GROUP BY 1",
        ask_people=f"SELECT DISTINCT match_id, DATE '{DAY}' AS a FROM known",
        asked=requests_sql(*requests.SCORE).replace("FROM people p", "FROM ask_people p"),
        danp_rows=danp_sql(aov),
    )


@query("k32_danp_features", "SELECT * FROM danp_rows", **danp_steps(False))
def _(t):
    return scoring_features.danp_features(t.written("deliveries"), DAY, False, HISTORY, SNAPSHOTS)


@query("k34_aov_danp_features", "SELECT * FROM danp_rows", **danp_steps(True))
def _(t):
    return scoring_features.danp_features(t.written("deliveries"), DAY, True, HISTORY, SNAPSHOTS)


def nn_sql(aov: bool) -> str:
    country = "" if aov else ", rg.country_id, 0 AS rar_not_shown"
    region = "" if aov else "LEFT JOIN {regions} rg ON rg.submarket_id = n.submarket_id"
    return f"""SELECT n.*, CASE WHEN n.vendor_1_id IS NULL THEN 'not_requestable' ELSE 'requestable' END AS requestable,
 month(DATE '{DAY}' - 1) AS activation_month, year(DATE '{DAY}' - 1) AS activation_year, first_request_requested_at,
 last_request_requested_at, num_requests_l84days, num_requests_l28days, num_requests_all_time, {PER_DAY},
 avg_subtotal_from_consumer_request, num_delivery_to_requests_ratio, sps.* EXCLUDE (starting_point_id),
 sbs.* EXCLUDE (submarket_id), coalesce(sc.avg_n, 0) AS avg_search_count_84_days_before, DATE '{DAY}' AS create_date{country}
FROM net_new n LEFT JOIN sc ON sc.m = n.match_id LEFT JOIN asked r ON r.match_id = n.match_id
LEFT JOIN sps ON sps.starting_point_id = n.starting_point_id LEFT JOIN sbs ON sbs.submarket_id = n.submarket_id {region}"""


def nn_steps(aov: bool) -> dict[str, str]:
    window = f"FROM core WHERE active_date BETWEEN DATE '{DAY}' - 29 AND DATE '{DAY}' - 1 GROUP BY 1"
    return dict(
        **NET_NEW_STEPS,
        core=CORE,
        sps=f"SELECT starting_point_id, {geo_columns('sp', aov)} {window}",
        sbs=f"SELECT submarket_id, {geo_columns('submarket', aov)} {window}",
        daily=DAILY,
        sc=f"SELECT m, avg(n) AS avg_n FROM daily WHERE d BETWEEN DATE '{DAY}' - 86 AND DATE '{DAY}' - 2 GROUP BY 1",
        people=f"SELECT DISTINCT match_id, DATE '{DAY}' AS a FROM net_new",
        asked=requests_sql(*requests.SCORE),
        nn_rows=nn_sql(aov),
    )


@query("k33_nn_features", "SELECT * FROM nn_rows", **nn_steps(False))
def _(t):
    return scoring_features.nn_features(t, DAY)


@query("k34_aov_nn_features", "SELECT * FROM nn_rows", **nn_steps(True))
def _(t):
    return scoring_features.nn_features(t, DAY, aov=True)


# Training sets ---------------------------------------------------------------

SEARCHED = {
    "danp": dict(daily=DAILY, latest_danp=LATEST_DANP, acts=ACTS_DANP.replace("latest", "latest_danp"), found=_train_spans()),
    "nn": dict(daily=DAILY, latest_nn=LATEST_NN, acts=ACTS_NN.replace("latest", "latest_nn"), found=_train_spans()),
}
VENDOR = dict(reviews=REVIEWS, cats=CATEGORIES)


def vendor_joins(key: str, aov: bool = False) -> tuple[str, str]:
    """Columns and joins; both parts are joined by merchant only."""
    reviews = assembly.AOV_REVIEWS if aov else assembly.BASE_REVIEWS
    cats = assembly.AOV_CATEGORIES if aov else assembly.BASE_CATEGORIES
    cols = ", ".join([f"rr.{c}" for c in reviews] + [f"cf.{c}" for c in cats])
    return cols, f"LEFT JOIN reviews rr ON rr.match_id = {key} LEFT JOIN cats cf ON cf.match_id = {key}"


CALENDAR = "month(min_active_date) AS sales_month, quarter(min_active_date) AS sales_quarter, year(min_active_date) AS sales_year"


def nn_training(t, vendors=None):
    t = t.written("deliveries")
    rows = labels.nn_monthly_label(t, START, END, FROM)
    weeks = [
        geography.week_stats_at(t, latest_load(t.label_nn), g, "store_activation_date")
        for g in ("submarket", "starting_point")
    ]
    return assembly.training_set(t, "nn", rows, *weeks, vendors=vendors)


def _nn_training_sql() -> tuple[str, dict[str, str]]:
    cols, joins = vendor_joins("x.match_id")
    rates = ", ".join(f"{a}.{p}_{c}" for a, p in (("ws", "submarket"), ("wp", "sp")) for c in assembly.GEO_RATES)
    steps = dict(NN_STEPS)
    steps |= dict(
        dates="SELECT DISTINCT store_activation_date AS t FROM latest",
        ws=week_sql("submarket_id", "sub_id", "submarket"),
        wp=week_sql("starting_point_id", "sp_id", "sp"),
        daily=DAILY,
        acts=ACTS_NN,
        found=_train_spans(),
        **VENDOR,
    )
    sql = f"""SELECT x.match_id, x.store_id, x.store_activation_date AS activation_date, x.total_subtotal_month, x.requestable,
 x.num_requests_l28days, x.avg_subtotal_from_consumer_request, x.min_active_date, x.age_month,
 year(x.store_activation_date) AS activation_year, month(x.store_activation_date) AS activation_month, {CALENDAR},
 rg.country_id, 0 AS rar_not_shown, {rates}, f.* EXCLUDE (match_id), {cols}
FROM nn_label x LEFT JOIN {{regions}} rg ON rg.submarket_id = x.submarket_id
LEFT JOIN ws ON ws.submarket_id = x.submarket_id AND ws.create_date = x.store_activation_date
LEFT JOIN wp ON wp.starting_point_id = x.starting_point_id AND wp.create_date = x.store_activation_date
LEFT JOIN found f ON f.match_id = x.match_id {joins}"""
    return sql, steps


_sql, _steps = _nn_training_sql()


@query("k35_training_set_nn", _sql, **_steps)
def _(t):
    return nn_training(t)


def danp_training(t, segment):
    t = t.written("deliveries")
    return assembly.training_set(t, segment, labels.danp_monthly_label(t, START, END, FROM))


for _segment, _kind in assembly.KIND.items():
    _cols, _joins = vendor_joins("x.match_id")

    @query(
        f"k35_training_set_{_segment}",
        f"""SELECT x.*, x.reactivation_timestamp AS activation_date, {CALENDAR}, rg.country_id, 0 AS rar_not_shown,
 f.* EXCLUDE (match_id), {_cols}
FROM danp_label x LEFT JOIN {{regions}} rg ON rg.submarket_id = x.submarket_id
LEFT JOIN found f ON f.match_id = x.match_id {_joins} WHERE x.merchant_type = '{_kind}'""",
        **DANP_STEPS, daily=DAILY, acts=ACTS_DANP, found=_train_spans(), **VENDOR,
    )
    def _(t, segment=_segment):
        return danp_training(t, segment)


AOV_EXTRA = {
    "v0": (", CASE WHEN x.aov_first_148_days >= 40 THEN 1 ELSE 0 END AS aov_first_148_days_high", ""),
    "v1": (", b.premium AS is_premium", "JOIN {premium_flags} b ON b.store_id = x.store_id"),
    "v2": (", b.subtotal_per_order", "JOIN {order_values} b ON b.store_id = x.store_id"),
}
AOV_AFTER = dt.date(1997, 12, 1)


def aov_training_sql(segment: str, version: str, table: str) -> str:
    """Order-value training rows, of the labels in ``table``."""
    col, join = AOV_EXTRA[version]
    act = "store_activation_date" if segment == "nn" else "reactivation_timestamp"
    where = "" if segment == "nn" else f"AND x.merchant_type = '{assembly.KIND[segment]}'"
    cols, joins = vendor_joins("x.match_id", aov=True)
    return f"""SELECT x.*, x.{act} AS activation_date{col}, f.* EXCLUDE (match_id), {cols}
FROM {table} x {join} LEFT JOIN found f ON f.match_id = x.match_id {joins}
WHERE x.create_date = (SELECT max(create_date) FROM {table}) AND x.total_subtotal_first_120_148_days >= 0
 AND x.{act} > DATE '{AOV_AFTER}' {where}"""


for _version in AOV_EXTRA:
    for _segment in ("nn", "ac", "da"):
        _kind = "nn" if _segment == "nn" else "danp"

        @query(
            f"k35_aov_{_version}_training_set_{_segment}",
            aov_training_sql(_segment, _version, f"{{aov_label_{_kind}}}"),
            **SEARCHED[_kind], **VENDOR,
        )
        def _(t, segment=_segment, version=_version):
            return assembly.aov_training_set(t, segment, version, AOV_AFTER)


# Scoring sets ----------------------------------------------------------------

SCORED_SEARCH = f"SELECT m AS match_id, {_spans(-2, 't')} FROM daily CROSS JOIN one_day WHERE d BETWEEN t - 86 AND t - 2 GROUP BY 1, t"
# Feature rows of the same merchant repeat, so search features do as well.
REPEAT = "SELECT x.match_id, s.* EXCLUDE (match_id) FROM {rows} x LEFT JOIN scored s ON s.match_id = x.match_id"


def _scoring_sql(segment: str, version: str | None) -> tuple[str, dict[str, str]]:
    nn = segment == "nn"
    rows = "nn_rows" if nn else "danp_rows"
    steps = dict(nn_steps(version is not None) if nn else danp_steps(version is not None))
    steps |= dict(daily=DAILY, one_day=ONE_DAY, scored=SCORED_SEARCH, feats=REPEAT.replace("{rows}", rows), **VENDOR)
    cols, joins = vendor_joins("x.match_id", aov=version is not None)
    where = "" if nn else f"WHERE x.merchant_type_prod = '{assembly.KIND_SCORED[segment]}'"
    how = "JOIN" if version == "v1" else "LEFT JOIN"
    if version is not None:
        return f"""SELECT x.*, f.* EXCLUDE (match_id), {cols}, DATE '{DAY}' AS activation_date
FROM {rows} x {how} feats f ON f.match_id = x.match_id {joins} {where}""", steps
    later = f"4 AS age_month, year(DATE '{DAY}' + INTERVAL 4 MONTH) AS sales_year, month(DATE '{DAY}' + INTERVAL 4 MONTH) AS sales_month, DATE '{DAY}' AS activation_date"
    if not nn:
        return f"SELECT x.*, f.* EXCLUDE (match_id), {cols}, {later} FROM danp_rows x LEFT JOIN feats f ON f.match_id = x.match_id {joins} {where}", steps
    steps |= dict(
        dates=ONE_DAY, ws=week_sql("submarket_id", "sub_id", "submarket"), wp=week_sql("starting_point_id", "sp_id", "sp")
    )
    rates = ", ".join(f"{a}.{p}_{c}" for a, p in (("ws", "submarket"), ("wp", "sp")) for c in assembly.GEO_RATES)
    base = """x.match_id, x.store_name, x.vendor_1_id, x.starting_point_id, x.submarket_id, x.requestable, x.activation_month,
 x.activation_year, x.first_request_requested_at, x.last_request_requested_at, x.num_requests_l84days, x.num_requests_l28days,
 x.num_requests_all_time, x.num_request_per_day, x.avg_subtotal_from_consumer_request, x.num_delivery_to_requests_ratio,
 x.create_date, x.country_id, x.rar_not_shown"""
    return f"""SELECT {base}, {rates}, f.* EXCLUDE (match_id), {cols}, {later}
FROM nn_rows x LEFT JOIN ws ON ws.submarket_id = x.submarket_id LEFT JOIN wp ON wp.starting_point_id = x.starting_point_id
LEFT JOIN feats f ON f.match_id = x.match_id {joins}""", steps


def scoring_inputs(t, segment: str, aov: bool, *days: str):
    if segment == "nn":
        rows = scoring_features.nn_features(t, days, aov)
    else:
        rows = scoring_features.danp_features(t, days, aov, HISTORY, SNAPSHOTS)
    rows = cut_lineage(rows, "feature-rows")
    return rows, search.daily_table(t, rows, days)


def scoring(t, segment: str, version: str | None = None, day: str = DAY):
    t = t.written("deliveries")
    return scoring_of(t, segment, version, day, *scoring_inputs(t, segment, version is not None, day))


def scoring_of(t, segment: str, version: str | None, day: str, rows, found, vendors=None):
    if version is not None:
        return assembly.aov_scoring_set(t, segment, version, day, rows, found, vendors=vendors)
    weeks = (None, None)
    if segment == "nn":
        weeks = (geography.week_stats(t, [day], "submarket"), geography.week_stats(t, [day], "starting_point"))
    return assembly.scoring_set(t, segment, day, rows, found, *weeks, vendors=vendors)


for _segment in ("nn", "ac", "da"):
    for _version in (None, "v0", "v1", "v2"):
        _sql, _steps = _scoring_sql(_segment, _version)
        _name = "k36_scoring_set" if _version is None else f"k36_aov_{_version}_scoring_set"

        @query(f"{_name}_{_segment}", _sql, **_steps)
        def _(t, segment=_segment, version=_version):
            return scoring(t, segment, version)
