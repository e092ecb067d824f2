"""Reading, writing and backfilling tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from queryset import ranking as q_ranking
from queryset.assembly import HISTORY
from queryset.base import CHECKS, DAY, DAYS, query
from queryset.features import CORE, DAILY, DATES, SCORED, chain_sql, week_sql
from queryset.labels import DANP_STEPS, END, FROM, NN_STEPS, START
from queryset.population import SNAPSHOTS
from queryset.views import check_sql
from tamarind.operators import snapshot
from tamarind.plans import ranking
from tamarind.plans.assembly import Dataset
from tamarind.session import scratch_path
from tamarind.sources import publish, warehouse

WEEK = week_sql("submarket_id", "sub_id", "submarket")
STORES = "SELECT store_id, name, business_id, submarket_id FROM {stores}"


def _name() -> str:
    return f"tamarind_{uuid.uuid4().hex}"


def _spark(t):
    return t.deliveries.sparkSession


@query(
    "a01_query_with_date",
    f"SELECT store_id, sum(subtotal) AS cents FROM core WHERE active_date BETWEEN DATE '{DAY}' - 28 AND DATE '{DAY}' - 1 GROUP BY 1",
    core=CORE,
)
def _(t):
    view = _name()
    t.core.createOrReplaceTempView(view)
    text = (
        f"SELECT store_id AS STORE_ID, sum(subtotal) AS Cents FROM {view} "
        "WHERE active_date BETWEEN date_add(:test_date, -28) AND date_add(:test_date, -1) GROUP BY store_id"
    )
    return warehouse.run_query(_spark(t), text, DAY)


@query("a02_lower_case_names", STORES)
def _(t):
    loud = t.stores.select(*[F.col(c).alias(c.upper()) for c in ("store_id", "name", "business_id", "submarket_id")])
    return warehouse.lower_names(loud)


@query(
    "a03_dataset_contract",
    "SELECT match_id, CAST(reactivation_timestamp AS VARCHAR) AS reactivation_timestamp, actual FROM {label_danp}",
)
def _(t):
    return Dataset(
        "danp", lambda: t.label_danp, ["match_id", "reactivation_timestamp", "actual"], ["reactivation_timestamp"]
    ).load()


@query("a04_append_table", f"SELECT * FROM ({STORES}) UNION ALL SELECT * FROM ({STORES})")
def _(t):
    rows = t.stores.select("store_id", "name", "business_id", "submarket_id")
    name, path = _name(), scratch_path(_spark(t), "append")
    warehouse.write_table(rows, name, "overwrite", path=path)
    warehouse.write_table(rows, name, "append", path=path)
    return _spark(t).table(name)


@query("a05_upload_with_schema", "SELECT store_id, name, CAST(is_active AS BIGINT) AS is_active FROM {stores}")
def _(t):
    name = _name()
    rows = t.raw("stores").select("store_id", "name", "is_active", "business_id")
    warehouse.upload(
        rows, name, "store_id long, name string, is_active long", path=scratch_path(_spark(t), "upload")
    )
    return _spark(t).table(name)


@query("a06_batched_upload", "SELECT delivery_id, store_id, subtotal FROM {deliveries}")
def _(t):
    name = _name()
    rows = t.deliveries.select("delivery_id", "store_id", "subtotal")
    warehouse.batch_upload(rows, name, batch_rows=10_000, path=scratch_path(_spark(t), "batch"))
    return _spark(t).table(name)


@query("a07_create_table", "SELECT submarket_id, count(*) AS n FROM core GROUP BY 1", core=CORE)
def _(t):
    name = _name()
    rows = t.core.groupBy("submarket_id").agg(F.count(F.lit(1)).alias("n"))
    warehouse.create_table(rows, name, path=scratch_path(_spark(t), "create"))
    return _spark(t).table(name)


@query("a08_latest_load", "SELECT * FROM {label_danp} WHERE create_date IN (SELECT max(create_date) FROM {label_danp})")
def _(t):
    return snapshot.latest_load(t.label_danp)


@query(
    "a09_last_day_in_window",
    "SELECT store_id, active_eop FROM w WHERE date_stamp = (SELECT max(date_stamp) FROM w)",
    w=f"SELECT * FROM {{store_status}} WHERE date_stamp < DATE '{DAY}'",
)
def _(t):
    window = t.store_status.where(F.col("date_stamp") < F.lit(dt.date.fromisoformat(DAY)))
    return snapshot.at_last_day(window, "date_stamp").select("store_id", F.col("active_eop").cast("long").alias("active_eop"))


@query("a10_drop_table", "SELECT count(*) > 0 AS had_rows, 0 AS tables_left FROM {stores}")
def _(t):
    spark, name = _spark(t), _name()
    warehouse.create_table(t.stores, name, path=scratch_path(spark, "drop"))
    had = spark.table(name).agg((F.count(F.lit(1)) > 0).alias("had_rows"))
    had_rows = had.first()[0]
    warehouse.drop_table(spark, name)
    warehouse.drop_table(spark, name)  # dropping again is allowed
    left = int(spark.catalog.tableExists(name))
    return t.stores.agg((F.count(F.lit(1)) > 0).alias("had_rows")).select(
        (F.col("had_rows") & F.lit(had_rows)).alias("had_rows"), F.lit(left).alias("tables_left")
    )


@query(
    "a11_replace_partitions",
    "SELECT match_id, CASE WHEN create_date = DATE '1998-06-15' THEN actual * 2 ELSE actual END AS actual, create_date FROM {label_nn}",
)
def _(t):
    path = scratch_path(_spark(t), "partitions")
    rows = t.label_nn.select("match_id", "actual", "create_date")
    warehouse.replace_partitions(rows, path)
    newer = snapshot.latest_load(rows).withColumn("actual", F.col("actual") * 2)
    warehouse.replace_partitions(newer, path)
    return warehouse.read_dated(_spark(t), path, rows)


@query("a12_backfill_rerun", WEEK, core=CORE, dates=DATES)
def _(t):
    path = scratch_path(_spark(t), "backfill")
    warehouse.backfill(t, "submarket_week", DAYS, path)
    return warehouse.backfill(t, "submarket_week", DAYS[1:], path)


def _filled(t, feature, dates):
    return warehouse.backfill(t, feature, dates, scratch_path(_spark(t), "feature"))


def on_days(name: str) -> str:
    """The checking SQL of a job of one test date, for three."""
    return "\nUNION ALL ".join(f"SELECT * FROM (\n{CHECKS[name].replace(DAY, d)}\n)" for d in DAYS)


BUILDERS = warehouse.feature_builders(HISTORY, SNAPSHOTS)
A13 = {
    "submarket_week": (WEEK, dict(core=CORE, dates=DATES), DAYS),
    "starting_point_week": (
        week_sql("starting_point_id", "sp_id", "sp"), dict(core=CORE, dates=DATES), DAYS,
    ),
    "enterprise_starting_point": (
        "SELECT * RENAME (created_date AS create_date) FROM s",
        dict(core=CORE, dates=DATES, s=chain_sql("sub_id sp_id restaurant_name")), DAYS,
    ),
    "enterprise_submarket": (
        "SELECT * RENAME (created_date AS create_date) FROM s",
        dict(core=CORE, dates=DATES, s=chain_sql("sub_id restaurant_name")), DAYS,
    ),
    "enterprise_global": (
        "SELECT * RENAME (created_date AS create_date) FROM s",
        dict(core=CORE, dates=DATES, s=chain_sql("restaurant_name")), DAYS,
    ),
    "danp": (on_days("k32_danp_features"), {}, DAYS),
    "nn": (on_days("k33_nn_features"), {}, DAYS),
    "aov_danp": (on_days("k34_aov_danp_features"), {}, DAYS),
    "aov_nn": (on_days("k34_aov_nn_features"), {}, DAYS),
}

for _feature, (_sql, _steps, _dates) in A13.items():

    @query(f"a13_backfill_{_feature}", _sql, **_steps)
    def _(t, feature=_feature, dates=_dates):
        return _filled(t, BUILDERS[feature], dates)


def _search_sql(ids: str) -> str:
    return (
        f"SELECT p.match_id, t AS create_date, s.* EXCLUDE (match_id, create_date) FROM ({ids}) p CROSS JOIN dates "
        "LEFT JOIN scored s ON s.match_id = p.match_id AND s.create_date = t"
    )


SEARCH_IDS = {
    "danp": ("label_danp", "SELECT DISTINCT match_id FROM {label_danp}"),
    "nn": ("label_nn", "SELECT DISTINCT match_id FROM {label_nn}"),
}
for _kind, (_table, _ids) in SEARCH_IDS.items():

    @query(f"a13_backfill_search_{_kind}", _search_sql(_ids), daily=DAILY, dates=DATES, scored=SCORED)
    def _(t, table=_table):
        days = F.explode(F.array(*[F.lit(dt.date.fromisoformat(d)) for d in DAYS]))
        rows = getattr(t, table).select("match_id").distinct().withColumn("create_date", days)
        return _filled(t, warehouse.search_backfill(rows), DAYS)


@query(
    "a13_backfill_enterprise_adjusted",
    """SELECT p.*, a.l28d_avg_sales, b.l28d_avg_sales AS sub_l28d_avg_sales, c.l28d_avg_sales AS global_l28d_avg_sales,
 0.5 * p.pred + 0.5 * coalesce(a.l28d_avg_sales, b.l28d_avg_sales, c.l28d_avg_sales, p.pred) AS pred_ent_adj
FROM deduped p LEFT JOIN {registry} mx ON mx.id = p.match_id
LEFT JOIN by_point a ON a.restaurant_name = mx.restaurant_name AND a.sub_id = mx.sub_id AND a.sp_id = mx.sp_id AND a.created_date = p.create_date
LEFT JOIN by_sub b ON b.restaurant_name = mx.restaurant_name AND b.sub_id = mx.sub_id AND b.created_date = p.create_date
LEFT JOIN overall c ON c.restaurant_name = mx.restaurant_name AND c.created_date = p.create_date
WHERE p.create_date = DATE '1998-06-01'""",
    deduped=q_ranking.DEDUPED, core=CORE, dates=DATES,
    by_point=chain_sql("sub_id sp_id restaurant_name"), by_sub=chain_sql("sub_id restaurant_name"),
    overall=chain_sql("restaurant_name"),
)
def _(t):
    return _filled(t, warehouse.adjustment_backfill(ranking.dedupe_predictions(t.predictions)), [DAY])


@query(
    "a14_generate_labels_nn",
    "SELECT * FROM nn_label", **NN_STEPS,
)
def _(t):
    root = scratch_path(_spark(t), "labels")
    t = t.written("deliveries")
    return publish.generate_labels(t, START, END, f"{root}-nn", f"{root}-danp", FROM)[0]


@query("a14_generate_labels_danp", "SELECT * FROM danp_label", **DANP_STEPS)
def _(t):
    root = scratch_path(_spark(t), "labels")
    t = t.written("deliveries")
    return publish.generate_labels(t, START, END, f"{root}-nn", f"{root}-danp", FROM)[1]


# Evaluation dates, 31 days after their prediction dates; on the last nothing was predicted.
EVALUATED = {"1998-07-01": "1998-05-31", "1998-07-02": "1998-06-01", "1998-07-03": "1998-06-02"}


def _evaluated(sql: str) -> str:
    """``sql`` over the ranking steps for each evaluation date, with the test
    and the prediction date on the same day."""

    def moved(text: str, day: str) -> str:
        for literal in (DAY, q_ranking.PRED_DAY):
            text = text.replace(f"DATE '{literal}'", f"DATE '@{day}'")
        return text.replace("@", "").replace("p.pred * 1.1", "p.pred")

    parts = []
    for current, day in EVALUATED.items():
        steps = {k: v if k in ("danp", "nn") else moved(v, day) for k, v in q_ranking.COMBINED_STEPS.items()}
        parts.append(f"SELECT *, DATE '{current}' AS create_date FROM (\n{check_sql(moved(sql, day), steps)}\n)")
    return "\nUNION ALL ".join(parts)


def _metrics(t):
    danp, nn = q_ranking.shifted_labels(t)
    return publish.publish_metrics(
        t, ranking.dedupe_predictions(t.predictions), danp, nn, EVALUATED, scratch_path(_spark(t), "metrics")
    )


METRICS = {
    "combined": q_ranking.COMBINED,
    "predicted": f"SELECT *, DATE '{q_ranking.PRED_DAY}' AS pred_date FROM rank_pred",
    "actual": f"SELECT *, DATE '{q_ranking.PRED_DAY}' AS pred_date FROM rank_actual",
}
for _kind, _sql in METRICS.items():

    @query(f"a16_backfill_metrics_{_kind}", _evaluated(_sql))
    def _(t, kind=_kind):
        return _metrics(t)[kind]
