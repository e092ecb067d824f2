"""The logical tables, derived from the given tables.

Each view is one SQL text that both engines read: Spark builds its input frame
from it, and the checking SQL takes it as a common table expression.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tamarind.session import cut_lineage
from tamarind.sources.tables import Tables

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()



def _loads(text: str, n: int) -> str:
    """The text once per load, ``#`` standing for its number."""
    return "\nUNION ALL\n".join(text.replace("#", str(i)) for i in range(n))


VIEWS: dict[str, str] = {
    "deliveries": """
SELECT l.l_orderkey AS delivery_id, l.l_suppkey AS store_id,
       CAST(floor(l.l_suppkey / 5.0) AS BIGINT) AS business_id, l.l_suppkey % 25 AS starting_point_id,
       CAST(s.s_nationkey AS BIGINT) AS submarket_id, o.o_custkey AS creator_id,
       CAST(l.l_shipdate AS DATE) AS active_date, l.l_shipdate AS created_at,
       CASE l.l_suppkey % 3 WHEN 0 THEN 'America/Los_Angeles' WHEN 1 THEN 'America/New_York' ELSE 'UTC' END AS timezone,
       CAST(round(l.l_extendedprice) AS BIGINT) AS subtotal, CAST(round(l.l_tax * 10000) AS BIGINT) AS fee,
       l.l_discount AS commission_rate,
       CASE l.l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS is_partner,
       l.l_linestatus = 'F' AS is_core, l.l_linenumber = 1 AS is_first_order
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {supplier} s ON l.l_suppkey = s.s_suppkey""",
    "registry": """
SELECT concat('s', CAST(s_suppkey AS STRING)) AS id,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey END AS store_id,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat('v1-', CAST(s_suppkey AS STRING)) END AS vendor_1_id,
       CASE WHEN s_suppkey % 4 = 1 THEN concat('v2-', CAST(s_suppkey AS STRING)) END AS vendor_2_id,
       concat('CHAIN ', CAST(s_suppkey % 12 AS STRING), CASE WHEN s_suppkey % 13 = 0 THEN ' BUFFET'
              WHEN s_suppkey % 13 = 1 THEN ' JUST WINGS' ELSE '' END) AS restaurant_name,
       CASE WHEN s_suppkey % 19 = 0 THEN NULL ELSE s_name END AS street,
       s_acctbal / 100.0 AS lat, s_acctbal / 50.0 AS lng,
       CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE s_suppkey % 25 END AS sp_id,
       CAST(s_nationkey AS BIGINT) AS sub_id, CAST(s_suppkey % 2 AS DOUBLE) AS national,
       CASE s_suppkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false END AS is_active,
       CASE s_suppkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_partner,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat('d-', CAST(s_suppkey AS STRING)) END AS directory_id,
       CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE concat('p-', CAST(s_suppkey AS STRING)) END AS panel_id,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE (s_suppkey % 11) / 10.0 END AS existence_score,
       CASE WHEN s_suppkey % 2 = 0 THEN 'USA' ELSE 'CAN' END AS country
FROM {supplier}
UNION ALL
SELECT concat('c', CAST(c_custkey AS STRING)), CAST(NULL AS BIGINT),
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('v1-c', CAST(c_custkey AS STRING)) END,
       CASE WHEN c_custkey % 4 = 1 THEN concat('v2-c', CAST(c_custkey AS STRING)) END,
       concat(CASE WHEN c_custkey % 29 = 0 THEN 'TEST ' WHEN c_custkey % 29 = 1 THEN 'HILTON ' ELSE '' END, c_name),
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_name END, c_acctbal / 100.0, c_acctbal / 50.0,
       CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_custkey % 25 END, CAST(c_nationkey AS BIGINT),
       CAST(c_custkey % 2 AS DOUBLE), CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END,
       CASE c_custkey % 5 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('d-c', CAST(c_custkey AS STRING)) END,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('p-c', CAST(c_custkey AS STRING)) END,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE (c_custkey % 11) / 10.0 END,
       CASE WHEN c_custkey % 2 = 0 THEN 'USA' ELSE 'CAN' END
FROM {customer}""",
    "registry_filtered": """
SELECT id, store_id, vendor_1_id, vendor_2_id, restaurant_name, sp_id, sub_id, is_active, is_partner
FROM {registry} WHERE existence_score IS NULL OR existence_score >= 0.1""",
    "registry_checks": """
SELECT id AS mx_id, CASE WHEN store_id % 10 = 3 THEN NULL ELSE concat('g-', id) END AS place_id,
       CASE CAST(floor(abs(lat)) AS BIGINT) % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_valid_restaurant,
       CASE CAST(floor(abs(lng)) AS BIGINT) % 5 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE 0 END AS permanently_closed
FROM {registry} WHERE existence_score IS NULL OR existence_score <> 0.7""",
    "stores": """
SELECT s_suppkey AS store_id, CASE WHEN s_suppkey % 21 = 2 THEN NULL ELSE s_name END AS name,
       concat('BIZ ', CAST(s_suppkey % 40 AS STRING)) AS business_name,
       CAST(floor(s_suppkey / 5.0) AS BIGINT) AS business_id, s_suppkey % 25 AS starting_point_id,
       CAST(s_nationkey AS BIGINT) AS submarket_id, s_suppkey % 5 AS market_id,
       CASE WHEN s_suppkey % 4 = 0 OR s_suppkey % 9 = 0 THEN 1 ELSE 0 END AS is_active,
       CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS is_partner,
       DATE '1998-01-01' + CAST(s_suppkey % 300 AS INT) AS activated_at,
       CASE WHEN s_suppkey % 17 = 3 THEN 'Fraudulent Store' WHEN s_suppkey % 4 = 1 THEN 'Closed' END AS last_deactivation_reason,
       CASE s_suppkey % 14 WHEN 5 THEN 'DRIVE' WHEN 6 THEN NULL ELSE 'TABLET' END AS order_protocol,
       CASE s_suppkey % 16 WHEN 7 THEN 'DRIVE_AUTO_ONBOARDING' WHEN 8 THEN NULL ELSE 'MANUAL' END AS creation_method
FROM {supplier}""",
    "store_status": """
SELECT CAST(l.l_shipdate AS DATE) AS date_stamp, l.l_suppkey AS store_id, max(s.s_name) AS store_name,
       concat('BIZ ', CAST(l.l_suppkey % 40 AS STRING)) AS business_name,
       CAST(floor(l.l_suppkey / 5.0) AS BIGINT) AS business_id,
       l.l_suppkey % 25 AS sp_id, concat('SP ', CAST(l.l_suppkey % 25 AS STRING)) AS sp_name,
       CAST(max(s.s_nationkey) AS BIGINT) AS sub_id, concat('SUB ', CAST(max(s.s_nationkey) AS STRING)) AS sub_name,
       max(CASE WHEN l.l_linenumber <= 6 THEN 1 ELSE 0 END) AS active_bop,
       max(CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END) AS active_eop,
       max(CASE WHEN l.l_returnflag <> 'N' THEN 1 ELSE 0 END) AS partner_bop,
       max(CASE WHEN l.l_returnflag = 'A' THEN 1 ELSE 0 END) AS partner_eop
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey GROUP BY l.l_suppkey, CAST(l.l_shipdate AS DATE)""",
    "store_deactivations": """
SELECT l_orderkey AS id, CASE WHEN max(l_shipdate) < TIMESTAMP '1998-06-15 00:00:00' THEN l_suppkey END AS store_id,
       max(l_shipdate) AS created_at,
       CAST(max(l_linenumber) % 4 AS BIGINT) AS reason_id, max(l_returnflag) AS notes
FROM {lineitem} GROUP BY l_suppkey, l_orderkey""",
    "deact_react": """
SELECT s_suppkey AS store_id, DATE '1998-01-01' + CAST(s_suppkey % 120 AS INT) AS most_recent_deact FROM {supplier}""",
    "external_stores": """
SELECT CASE WHEN s_suppkey % 6 <> 5 THEN s_suppkey END AS store_id,
       concat(CASE WHEN s_suppkey % 6 = 5 THEN 'x1-' ELSE 'v1-' END, CAST(s_suppkey AS STRING)) AS external_id,
       s_suppkey % 25 AS starting_point_id,
       CASE s_suppkey % 8 WHEN 0 THEN 'Bar' WHEN 1 THEN 'Pizza Place' WHEN 2 THEN NULL WHEN 3 THEN 'Food Court'
            ELSE 'Diner' END AS cuisine_type
FROM {supplier}""",
    "markets": """
SELECT CAST(r_regionkey AS BIGINT) AS id,
       CASE r_regionkey WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Denver' WHEN 2 THEN 'Asia/Tokyo'
            WHEN 3 THEN 'UTC' END AS timezone FROM {region}""",
    "starting_points": """
SELECT CAST(n_nationkey AS BIGINT) AS id, CAST((n_nationkey * 7) % 25 AS BIGINT) AS submarket_id FROM {nation}""",
    "regions": """
SELECT CAST(n_nationkey AS BIGINT) AS submarket_id, CAST(n_regionkey % 3 + 1 AS BIGINT) AS country_id FROM {nation}""",
    "store_requests": """
SELECT CASE WHEN l.l_returnflag = 'N' THEN concat('c', CAST(l.l_partkey AS STRING))
            ELSE concat('s', CAST(l.l_suppkey AS STRING)) END AS mx_id,
       o.o_custkey AS consumer_id, o.o_orderdate AS requested_at
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "search_counts": """
SELECT CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 2 = 0 THEN concat('s', CAST(user_id AS STRING))
            ELSE concat('c', CAST(user_id AS STRING)) END AS store_id,
       CAST(CAST(ts AS DATE) - INTERVAL '9376' DAY AS DATE) AS search_date,
       CAST(floor(value) AS DOUBLE) AS query_count,
       CASE event_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 ELSE 4.0 END AS store_count
FROM {events}""",
    "merchant_dates": """
SELECT s_suppkey AS store_id, DATE '1997-06-01' + CAST((s_suppkey * 37) % 200 AS INT) AS last_np_live_day,
       DATE '1997-07-01' + CAST((s_suppkey * 53) % 290 AS INT) AS activation_date,
       CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 2 END AS level_verification FROM {supplier}
UNION ALL
SELECT s_suppkey, DATE '1997-06-01' + CAST((s_suppkey * 37) % 200 AS INT),
       DATE '1997-07-01' + CAST((s_suppkey * 53) % 290 AS INT),
       CASE WHEN s_suppkey % 10 = 4 THEN 3 ELSE CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 2 END END
FROM {supplier} WHERE s_suppkey % 10 IN (4, 6)""",
    "vendor_features": """
SELECT concat('s', CAST(CAST(floor(p_partkey / 20.0) AS BIGINT) AS STRING)) AS match_id,
       CASE WHEN p_partkey % 400 = 19 THEN NULL ELSE CAST(floor(p_partkey / 20.0) AS BIGINT) END AS store_id,
       CAST(p_size AS DOUBLE) AS reviews_mes, p_retailprice / 10.0 AS reviews_yelp,
       CAST(p_size % 5 AS DOUBLE) AS rating_mes, CAST(p_size % 7 AS DOUBLE) AS rating_yelp,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size / 10.0 END AS rating_factus,
       p_retailprice AS sales_chdus, CAST(p_size % 4 AS DOUBLE) AS stars_al,
       CAST(p_partkey % 9 AS DOUBLE) AS reviews_al,
       CASE p_partkey % 80 WHEN 7 THEN 2 WHEN 8 THEN 1 ELSE 0 END AS cohort_encoded, p_brand AS cohort,
       p_size % 6 AS sales_chd_agg_encoded, p_size % 8 AS years_in_business_encoded,
       p_partkey % 4 AS price_yelp_encoded, p_partkey % 3 AS price_mes_encoded, p_size % 3 AS price_factus_encoded,
       p_size % 2 AS price_al_encoded, p_partkey % 5 AS number_of_units_encoded, p_size % 5 AS dayparts_encoded,
       p_partkey % 6 AS average_check_encoded, p_partkey % 7 AS average_check_amt_encoded,
       p_size % 9 AS credit_score_rating_encoded
FROM {part}
UNION ALL
SELECT concat(CASE WHEN p_partkey % 4 = 3 THEN 'x' ELSE 'c' END, CAST(p_partkey AS STRING)), CAST(NULL AS BIGINT), CAST(p_size AS DOUBLE), p_retailprice / 10.0,
       CAST(p_size % 5 AS DOUBLE), CAST(p_size % 7 AS DOUBLE),
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size / 10.0 END, p_retailprice, CAST(p_size % 4 AS DOUBLE),
       CAST(p_partkey % 9 AS DOUBLE), CASE p_partkey % 8 WHEN 7 THEN 2 WHEN 5 THEN NULL ELSE 0 END, p_brand,
       p_size % 6, p_size % 8, p_partkey % 4, p_partkey % 3, p_size % 3, p_size % 2, p_partkey % 5, p_size % 5,
       p_partkey % 6, p_partkey % 7, p_size % 9
FROM {part}""",
    "label_nn": _loads("""
SELECT concat(CASE WHEN (s.s_suppkey + #) % 4 = 0 THEN 'x' ELSE 's' END, CAST(s.s_suppkey AS STRING)) AS match_id,
       CASE WHEN s.s_suppkey % 15 = 9 OR (s.s_suppkey + #) % 4 = 0 THEN NULL ELSE s.s_suppkey END AS store_id,
       concat('CHAIN ', CAST(s.s_suppkey % 12 AS STRING)) AS restaurant_name,
       CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE concat('v1-', CAST(s.s_suppkey AS STRING)) END AS vendor_1_id,
       s.s_suppkey % 25 AS starting_point_id, CAST(s.s_nationkey AS BIGINT) AS submarket_id,
       DATE '1997-12-01' + CAST((s.s_suppkey * 13) % 240 AS INT) AS store_activation_date,
       DATE '1997-12-01' + CAST((s.s_suppkey * 13) % 240 AS INT) AS first_partner_order_date,
       CASE WHEN s.s_suppkey % 6 = 1 THEN NULL ELSE s.s_acctbal END AS actual,
       DATE '1998-05-01' + 45 * # AS create_date
FROM {supplier} s""", 2),
    "label_danp": _loads("""
SELECT CASE WHEN (s.s_suppkey + #) % 5 <> 0 THEN s.s_suppkey END AS store_id,
       concat(CASE WHEN (s.s_suppkey + #) % 5 = 0 THEN 'x' ELSE 's' END, CAST(s.s_suppkey AS STRING)) AS match_id,
       CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE concat('v1-', CAST(s.s_suppkey AS STRING)) END AS vendor_1_id,
       s.s_name AS store_name, concat('CHAIN ', CAST(s.s_suppkey % 12 AS STRING)) AS external_store_name,
       CASE WHEN s.s_suppkey % 7 <> 3 THEN CAST(floor(s.s_suppkey / 5.0) AS BIGINT) END AS business_id, s.s_suppkey % 25 AS starting_point_id,
       CAST(s.s_nationkey AS BIGINT) AS submarket_id,
       DATE '1997-11-01' + CAST((s.s_suppkey * 29) % 200 AS INT) AS most_recent_deactivation_timestamp,
       DATE '1997-11-01' + CAST((s.s_suppkey * 29) % 200 + s.s_suppkey % 60 AS INT) AS reactivation_timestamp,
       CASE s.s_suppkey % 3 WHEN 0 THEN 'active_np' WHEN 1 THEN 'deactivated_np' ELSE 'net_new' END AS merchant_type,
       CAST(month(DATE '1997-11-01' + CAST((s.s_suppkey * 29) % 200 + s.s_suppkey % 60 AS INT)) AS BIGINT) AS reactivation_month,
       CAST(year(DATE '1997-11-01' + CAST((s.s_suppkey * 29) % 200 + s.s_suppkey % 60 AS INT)) AS BIGINT) AS reactivation_year,
       CAST(month(DATE '1997-11-01' + CAST((s.s_suppkey * 29) % 200 AS INT)) AS BIGINT) AS deactivation_month,
       CAST(year(DATE '1997-11-01' + CAST((s.s_suppkey * 29) % 200 AS INT)) AS BIGINT) AS deactivation_year,
       s.s_suppkey % 60 AS num_days_deactive, s.s_suppkey % 90 AS num_days_since_reactivation,
       CASE WHEN s.s_suppkey % 8 = 1 THEN NULL ELSE s.s_acctbal + 10 END AS actual,
       DATE '1998-05-01' + 45 * # AS create_date
FROM {supplier} s""", 2),
    "prior_danp_inputs": """
SELECT CASE WHEN c_custkey % 8 = 2 THEN NULL
            ELSE concat(CASE WHEN c_custkey % 4 = 2 THEN 'c' ELSE 'x' END, CAST(c_custkey AS STRING)) END AS match_id
FROM {customer}""",
    "enterprise_merchants": """
SELECT sub_id, sp_id, restaurant_name, store_id FROM {registry} WHERE national = 1""",
    "business_groups": """
SELECT s_suppkey AS id, s_suppkey % 4 <> 0 AS is_active, s_suppkey % 5 = 0 AS is_test,
       CASE s_suppkey % 3 WHEN 0 THEN 'ENTERPRISE' WHEN 1 THEN 'MID_MARKET' ELSE 'OTHER' END AS business_group_type
FROM {supplier}""",
    "business_group_links": """
SELECT CAST(floor(s_suppkey / 10.0) AS BIGINT) AS business_id, s_suppkey AS business_group_id FROM {supplier}""",
    "poor_activations": """
SELECT concat(CASE WHEN s_suppkey % 9 = 1 THEN 's' ELSE 'x' END, CAST(s_suppkey AS STRING)) AS match_id FROM {supplier}""",
    "premium_flags": """
SELECT CASE WHEN s_suppkey % 10 <> 8 THEN s_suppkey END AS store_id, s_suppkey % 2 AS premium FROM {supplier}""",
    "order_values": """
SELECT CASE WHEN s_suppkey % 10 <> 7 THEN s_suppkey END AS store_id, s_acctbal / 10.0 AS subtotal_per_order FROM {supplier}""",
    "aov_label_nn": """
SELECT match_id, store_id, CASE WHEN vendor_1_id IS NULL THEN 'not_requestable' ELSE 'requestable' END AS requestable,
       starting_point_id, submarket_id, store_activation_date,
       CAST(year(store_activation_date) AS BIGINT) AS activation_year, abs(actual) / 100.0 AS aov_first_148_days,
       CASE WHEN store_id % 11 = 0 THEN -1.0 ELSE actual END AS total_subtotal_first_120_148_days, create_date
FROM {label_nn}""",
    "aov_label_danp": """
SELECT match_id, store_id, merchant_type, reactivation_timestamp, most_recent_deactivation_timestamp,
       abs(actual) / 100.0 AS aov_first_148_days,
       CASE WHEN store_id % 11 = 0 THEN -1.0 ELSE actual END AS total_subtotal_first_120_148_days, create_date
FROM {label_danp}""",
    "predictions": _loads("""
SELECT concat('c', CAST(c_custkey AS STRING)) AS match_id, DATE '1998-05-31' + # AS activation_date, c_acctbal + # AS pred,
       CASE c_custkey % 2 WHEN 0 THEN 'nn_9_Staging' ELSE 'nn_10_Staging' END AS model,
       '9' AS data_preprocess_model_version, CASE c_custkey % 2 WHEN 0 THEN '9' ELSE '10' END AS ml_model_version,
       '1' AS bias_adj_model_version, DATE '1998-05-31' + # AS create_date
FROM {customer}""", 2) + "\nUNION ALL\n" + _loads("""
SELECT CASE WHEN s_suppkey % 33 = 32 THEN NULL ELSE concat('s', CAST(s_suppkey AS STRING)) END AS match_id,
       DATE '1998-05-31' + # % 2 AS activation_date, s_acctbal * (# + 1) AS pred,
       CASE WHEN # < 2 THEN 'ac_9_Staging' ELSE 'da_10_Staging' END AS model, '9' AS data_preprocess_model_version,
       CASE WHEN # < 2 THEN '9' ELSE '10' END AS ml_model_version, '1' AS bias_adj_model_version,
       DATE '1998-05-31' + # % 2 AS create_date
FROM {supplier}""", 4),
    "decile_metrics": """
SELECT match_id, pred_date, tam_value_pred, tam_value_actual,
       CASE WHEN match_id = 's4' THEN NULL ELSE ntile(10) OVER (PARTITION BY pred_date, grp ORDER BY tam_value_pred DESC, match_id) END AS decile_rank_pred,
       ntile(10) OVER (PARTITION BY pred_date, grp ORDER BY tam_value_actual DESC, match_id) AS decile_rank_actual
FROM (SELECT concat('s', CAST(l_suppkey AS STRING)) AS match_id, l_suppkey % 2 AS grp,
             DATE '1998-03-01' + CAST(5 * (l_orderkey % 30) AS INT) AS pred_date,
             CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) * 25 AS tam_value_pred,
             CAST(sum(CAST(round(l_extendedprice) AS BIGINT)) AS DOUBLE) / 100.0 AS tam_value_actual
      FROM {lineitem} GROUP BY l_suppkey, l_orderkey % 30) t""",
}

_REF = re.compile(r"\{(\w+)\}")


def _uses(text: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(text)))


def needed_views(names: list[str]) -> list[str]:
    """The named views and all views below them, lowest first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order or name not in VIEWS:
            return
        for below in _uses(VIEWS[name]):
            visit(below)
        order.append(name)

    for n in names:
        visit(n)
    return order


def check_sql(body: str, ctes: dict[str, str] | None = None) -> str:
    """SQL for the other engine: ``{view}`` marks become common table expressions.

    ``ctes`` adds named steps of the query itself, in order.
    """
    steps = dict(ctes or {})
    marks: list[str] = []
    for text in [*steps.values(), body]:
        marks += [m for m in _uses(text) if m not in marks]
    with_items = [(v, VIEWS[v]) for v in needed_views(marks)] + list(steps.items())
    head = ",\n".join(f"{name} AS ({_REF.sub(r'\1', text)})" for name, text in with_items)
    tail = _REF.sub(r"\1", body)
    return f"WITH {head}\n{tail}" if head else tail


class GivenTables(Tables):
    """Logical tables over one folder of the given parquet files, built on use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__({})
        self._spark, self._dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._done: frozenset[str] = frozenset()  # views that are written

    def raw(self, name: str) -> DataFrame:
        """A given table, or a derived view before normalisation."""
        if name not in self._raw:
            if name in GIVEN:
                self._raw[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
            else:
                parts = {u: self.raw(u) for u in _uses(VIEWS[name])}
                self._raw[name] = self._spark.sql(VIEWS[name], **parts)
        return self._raw[name]

    def __getattr__(self, name: str) -> DataFrame:
        if not name.startswith("_") and name in VIEWS and name not in self._frames:
            self._frames[name] = self.raw(name)
        return super().__getattr__(name)

    def written(self, *names: str) -> "GivenTables":
        """The same tables with the named views written once for this query,
        as the physical tables they stand for; jobs that read deliveries a
        dozen times then scan them instead of joining them again. Views that are
        written already stay as they are."""
        left = [n for n in dict.fromkeys(names) if n not in self._done]
        if not left:
            return self
        out = self.with_frames(**{n: cut_lineage(getattr(self, n), n) for n in left})
        out._done |= frozenset(left)
        return out

    def with_frames(self, **frames: DataFrame) -> "GivenTables":
        out = GivenTables(self._spark, self._dir)
        out._raw = dict(self._raw)
        out._frames = {**self._frames, **frames}
        out._done = self._done - frames.keys()
        return out
