"""Jobs on small hand-made tables: window bounds, branches, null handling."""

import datetime as dt
import random

import pytest
from moments import at, day
from pyspark.sql import functions as F

from tamarind.ml.split import enterprise_rows, local_rows, split_by_date
from tamarind.plans import assembly, business, evaluate, geography, labels, population, ranking, requests, search, store_stats, vendor
from tamarind.sources import publish, warehouse
from tamarind.sources.tables import normalise, schema_of

T = "2020-06-01"


def test_prior_orders_match_brute_force(spark, tables):
    rng = random.Random(7)
    when = lambda: dt.datetime(2020, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 20))
    who = lambda: 0 if rng.random() < 0.34 else rng.randrange(1, 8)
    creator = [who() for _ in range(120)]
    orders = [
        dict(delivery_id=i % 120, creator_id=creator[i % 120], created_at=when(), subtotal=rng.choice([0, 100, 250]), is_core=True)
        for i in range(300)
    ]
    asks = [dict(mx_id=f"m{rng.randrange(5)}", consumer_id=who(), requested_at=when()) for _ in range(80)]
    asks.append(dict(mx_id="m1", consumer_id=None, requested_at=when()))
    t = tables(deliveries=orders, store_requests=asks)
    anchor = day("2020-01-15")
    people = spark.createDataFrame([(f"m{i}", anchor) for i in range(7)], "match_id string, a date")
    got = {r.match_id: r for r in requests.request_features(t, people, "a", requests.TRAIN).collect()}
    limit = dt.datetime(2020, 1, 15)
    for i in range(7):
        mine = [a for a in asks if a["mx_id"] == f"m{i}" and a["requested_at"] < limit]
        met = [
            (o["subtotal"], o["delivery_id"])
            for a in mine
            for o in orders
            if o["creator_id"] == a["consumer_id"] and a["requested_at"] > o["created_at"] and o["subtotal"] > 0
        ]
        consumers = {a["consumer_id"] for a in mine} - {None}
        r = got[f"m{i}"]
        assert r.num_requests_all_time == len(consumers)
        assert r.avg_subtotal_from_consumer_request == (sum(x for x, _ in met) // len(met) if met else None)
        ratio = len({d for _, d in met}) / len(consumers) if consumers else 0
        assert r.num_delivery_to_requests_ratio == pytest.approx(ratio)
        days = [a["requested_at"] for a in mine]
        assert r.first_request_requested_at == (min(days) if days else None)


def test_request_windows_end_at_midnight(spark, tables):
    asks = [
        dict(mx_id="m", consumer_id=i, requested_at=at(x))
        for i, x in enumerate(["2020-05-30 00:00:00", "2020-05-31 00:00:00", "2020-05-31 10:00:00", "2020-03-09 00:00:00", "2020-03-08 23:00:00"])
    ]
    t = tables(store_requests=asks)
    people = spark.createDataFrame([("m", day(T))], "match_id string, a date")
    r = requests.request_features(t, people, "a", requests.TRAIN).first()
    assert (r.num_requests_all_time, r.num_requests_l84days, r.num_requests_l28days) == (5, 3, 2)


def test_search_windows_hold_one_day_more_than_named(tables):
    rows = [dict(store_id="m", search_date=day(d), query_count=1.0, store_count=1.0) for d in ("2020-05-31", "2020-05-30", "2020-05-16", "2020-05-15", "2020-03-07", "2020-03-06")]
    r = search.scoring_lookbacks(tables(search_counts=rows), [T]).first()
    assert r.total_search_count_14_days_before == 2  # [t-16, t-2]
    assert r.total_search_count_28_days_before == 3
    assert r.total_search_count_84_days_before == 4


def test_store_history_windows_and_cents(spark, tables):
    dea = day("2020-06-30")
    orders = [
        dict(store_id=1, delivery_id=i, active_date=dea - dt.timedelta(days=n), subtotal=100 * (i + 1), fee=None, is_core=True, is_first_order=True)
        for i, n in enumerate([0, 9, 10, 30, 31, 180, 181])
    ]
    people = spark.createDataFrame([(1, dea), (2, dea)], "store_id long, most_recent_deactivation_timestamp date")
    rows = {r.store_id: r for r in store_stats.before_deactivation(tables(deliveries=orders), people).collect()}
    r = rows[1]
    assert (r.num_orders_before, r.num_orders_7days_before, r.num_orders_28days_before) == (6, 2, 4)
    assert (r.total_subtotal_7days_before, r.total_subtotal_28days_before) == (300, 10)
    assert (r.median_subtotal_before, r.max_subtotal_before, r.avg_fee_before) == (3.5, 6, None)
    assert rows[2].num_orders_before == 0 and rows[2].avg_subtotal_before == 0
    assert rows[2].median_commission_rate_7days_before is None


def test_rows_without_store_business_or_date_stay(spark, tables):
    dea = day("2020-06-30")
    orders = [dict(store_id=s, business_id=s, delivery_id=i, active_date=dea, subtotal=100, is_core=True) for i, s in enumerate([1, 1, None])]
    people = spark.createDataFrame(
        [(1, 1, dea), (None, None, dea), (None, None, dea), (1, 1, None), (None, None, None)],
        "store_id long, business_id long, most_recent_deactivation_timestamp date",
    )
    at = "most_recent_deactivation_timestamp"
    for history in (180, None):
        rows = store_stats.before_deactivation(tables(deliveries=orders), people, history_days=history).collect()
        got = {(r.store_id, r[at]): (r.num_orders_before, r.num_first_ordercarts_before, r.pct_partner_delivs_before, r.avg_subtotal_before) for r in rows}
        assert got == {(1, dea): (2, 0, 0, 1), (None, dea): (0, 0, 0, 0), (1, None): (0, 0, 0, 0), (None, None): (0, 0, 0, 0)}
        rows = business.business_before(tables(deliveries=orders), people, at, history).collect()
        got = {(r.business_id, r[at]): (r.num_orders_business_before, r.total_subtotal_business_before) for r in rows}
        assert got == {(1, dea): (2, 2), (None, dea): (0, None), (1, None): (0, None), (None, None): (0, None)}


def test_week_stats_count_known_merchants_and_null_partners(tables):
    orders = [
        dict(store_id=s, delivery_id=i, submarket_id=1, creator_id=i % 2, active_date=day(d), subtotal=100, is_partner=p, is_core=True)
        for i, (s, d, p) in enumerate([(1, "2020-05-25", True), (1, "2020-05-31", None), (2, "2020-05-31", False), (3, "2020-06-01", True), (3, "2020-05-24", True)])
    ]
    reg = [dict(id=str(i), sub_id=1) for i in range(4)]
    r = geography.week_stats(tables(deliveries=orders, registry_filtered=reg), [T]).first()
    assert (r.submarket_total_orders, r.submarket_live_stores, r.submarket_total_stores) == (3, 2, 4)
    assert r.submarket_delivery_partner_percent == pytest.approx(1 / 3)
    assert (r.submarket_store_partner_percent, r.submarket_store_partner_percent_overall) == (0.5, 0.25)


def test_net_new_check_guards_active_nonpartners_only(tables):
    reg = [
        dict(id="inactive", is_active=False, is_partner=True),
        dict(id="unknown", is_active=None, is_partner=True),
        dict(id="new", is_active=True, is_partner=False),
        dict(id="scored", is_active=True, is_partner=None),
        dict(id="partner", is_active=True, is_partner=True),
        dict(id="inactive_scored", is_active=False, is_partner=False),
    ]
    prior = [dict(match_id=m) for m in ("scored", "inactive_scored", None)]
    t = tables(registry_filtered=reg, prior_danp_inputs=prior)
    got = {r.match_id for r in population.net_new_merchants(t, T).collect()}
    assert got == {"inactive", "unknown", "new", "inactive_scored"}


def test_lead_rules_guard_the_last_group_only(tables):
    base = dict(restaurant_name="x", street="s", lat=1.0, lng=1.0, sp_id=1, country="USA")
    reg = [
        {**base, "id": "later", "store_id": 1, "existence_score": 0.0, "directory_id": "d", "street": None},
        {**base, "id": "nonpartner", "store_id": 2, "existence_score": 0.0, "directory_id": "d", "street": None},
        {**base, "id": "good", "existence_score": 0.9, "directory_id": "d", "street": None},
        {**base, "id": "good_closed", "existence_score": 0.9, "directory_id": "d"},
        {**base, "id": "low_incomplete", "existence_score": 0.55, "directory_id": "d", "street": None},
        {**base, "id": "low", "existence_score": 0.55, "directory_id": "d"},
        {**base, "id": "low_one_source", "existence_score": 0.4, "directory_id": "d"},
        {**base, "id": "low_two_sources", "existence_score": 0.4, "directory_id": "d", "panel_id": "p"},
        {**base, "id": "zero", "existence_score": 0.0, "directory_id": "d", "panel_id": "p"},
        {**base, "id": "not_a_restaurant", "existence_score": 0.55, "directory_id": "d"},
        {**base, "id": "no_country", "existence_score": 0.9, "directory_id": "d", "country": None},
    ]
    checks = [
        dict(mx_id="good_closed", place_id="g", is_valid_restaurant=True, permanently_closed=1),
        dict(mx_id="not_a_restaurant", place_id="g", is_valid_restaurant=False, permanently_closed=0),
        dict(mx_id="low", place_id=None, is_valid_restaurant=False, permanently_closed=1),  # ignored: no place
    ]
    stores = [
        dict(store_id=1, is_active=False, is_partner=True, activated_at=at("2020-06-05 00:00:00")),
        dict(store_id=2, is_active=True, is_partner=False, activated_at=at("2019-01-01 00:00:00")),
    ]
    t = tables(registry=reg, registry_checks=checks, stores=stores)
    got = {r.id for r in ranking.valid_leads(t, T).collect()}
    assert got == {"later", "nonpartner", "good", "low", "low_two_sources"}


def test_activity_looks_at_rows_not_days(tables):
    rows = [dict(store_id=1, date_stamp=day("2020-05-13"), active_eop=True)] + [
        dict(store_id=1, date_stamp=day(d), active_eop=False)
        for d in ("2020-05-20", "2020-05-22", "2020-05-24", "2020-05-26", "2020-05-28", "2020-05-30")
    ]
    t = tables(store_status=rows)
    assert [r.active for r in ranking.recent_activity(t, T).orderBy("date_stamp").collect()] == [1] * 7
    more = tables(store_status=rows + [dict(store_id=1, date_stamp=day("2020-05-31"), active_eop=False)])
    assert ranking.recent_activity(more, T).orderBy(F.desc("date_stamp")).first().active == 0


def test_deduped_predictions_drop_null_merchants_and_compare_versions_as_text(spark, frame):
    rows = [
        dict(match_id=m, pred=p, ml_model_version=v, create_date=day(T))
        for m, p, v in (("a", 1.0, "9"), ("a", 3.0, "10"), (None, 5.0, "1"))
    ]
    out = ranking.dedupe_predictions(frame("predictions", rows)).collect()
    assert [(r.match_id, r.pred, r.ml_model_version) for r in out] == [("a", 2.0, "9")]
    adj = ranking.dedupe_predictions(frame("predictions", rows).withColumn("pred_adj", F.lit(4.0))).first()
    assert adj.pred_adj == 4.0


def test_combined_ranks_match_missing_submarkets(spark):
    side = "match_id string, submarket_id long, store_id long, tam_value double, decile_rank long"
    one = spark.createDataFrame([("a", None, 1, 2.0, 1), ("b", 3, 2, 1.0, 2)], side)
    full = spark.createDataFrame(
        [("a", day(T), day(T), "m", "1", "1", "1"), ("b", None, day(T), "m", "1", "1", "1")],
        "match_id string, activation_date_actual date, create_date date, model_id string, "
        "data_preprocess_model_version string, ml_model_version string, bias_adj_model_version string",
    )
    assert [r.match_id for r in ranking.combine_ranks(one, one, full).collect()] == ["a"]


def test_vendor_rows_repeat_per_store_unless_deduped(spark, tables):
    rows = [dict(match_id="m", store_id=1, reviews_mes=1.0, cohort_encoded=0), dict(match_id="m", store_id=2, reviews_mes=3.0, cohort_encoded=2)]
    t = tables(vendor_features=rows)
    base = spark.createDataFrame([("m",)], "match_id string")
    assert vendor.join_vendor(base, t, ["reviews_mes"], ["cohort"]).count() == 4
    once = vendor.join_vendor(base, t, ["reviews_mes"], ["cohort"], dedupe=True).collect()
    assert [(r.reviews_mes, r.cohort) for r in once] == [(2.0, 2)]


def test_rows_without_cohort_are_enterprise(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "cohort long")
    assert local_rows(df).count() == 1 and enterprise_rows(df).count() == 2


def test_splits(spark):
    df = spark.createDataFrame(
        [(day("2020-01-01"), day("2020-01-01"), 1), (day("2020-02-01"), day("2020-02-01"), 5), (day("2020-03-01"), day("2020-02-15"), 5), (None, None, 5)],
        "min_active_date date, activation_date date, age_month long",
    )
    cuts = ("2020-01-31", "2020-02-10", "2020-03-31")
    assert [p.count() for p in split_by_date(df, "min_active_date", *cuts)] == [1, 1, 1]
    assert split_by_date(df, "min_active_date", *cuts, by_activation=True)[2].count() == 1


def test_backfill_twice_leaves_the_same_rows(spark, tables, tmp_path):
    orders = [dict(store_id=1, delivery_id=i, submarket_id=1, creator_id=i, active_date=day("2020-05-28"), subtotal=100, is_core=True) for i in range(3)]
    t = tables(deliveries=orders)
    path = str(tmp_path / "week")
    first = warehouse.backfill(t, "submarket_week", [T, "2020-06-02"], path).collect()
    again = warehouse.backfill(t, "submarket_week", ["2020-06-02"], path).collect()
    assert len(first) == 2 and sorted(map(str, first)) == sorted(map(str, again))


def test_publishing_predictions_skips_dates_without_rows(spark, tmp_path):
    def scorer(d):
        if d == day("2020-06-02"):
            return None
        return spark.createDataFrame([("a", 1.0, "m", "1", "1", "1")], "match_id string, pred double, model string, data_preprocess_model_version string, ml_model_version string, bias_adj_model_version string")

    raw, deduped = publish.publish_predictions(scorer, [T, "2020-06-02"], str(tmp_path / "raw"), str(tmp_path / "dd"))
    assert raw.count() == 1 and deduped.first().create_date == day(T)
    assert publish.publish_predictions(lambda d: None, [T], str(tmp_path / "x"), str(tmp_path / "y")) is None


def test_metric_table_names():
    assert publish.metric_table_names("p", "v1", 1.5, "_x")["actual"] == "p_v1_decile_actual_df_5thmonth_projected_factor_1_5_x"
    assert publish.metric_table_names("p", "v2")["predicted"] == "p_decile_df_5thmonth_projected_factor_1"


def test_contract_rejects_duplicates_and_missing_columns(spark):
    with pytest.raises(ValueError):
        assembly.Dataset("x", lambda: None, ["a", "b", "a"])
    with pytest.raises(ValueError):
        normalise(spark.sql("SELECT 1L id"), schema_of("markets"))
    out = normalise(spark.sql("SELECT '7' ID, 'UTC' TimeZone, 1 more"), schema_of("markets"))
    assert out.first().asDict() == {"id": 7, "timezone": "UTC"}


def test_names_pasted_into_sql_are_checked():
    with pytest.raises(ValueError):
        warehouse.checked_name("t; DROP TABLE x")


def test_cohorts_prefer_enterprise(tables):
    groups = [
        dict(id=1, is_active=True, is_test=False, business_group_type="ENTERPRISE"),
        dict(id=2, is_active=True, is_test=False, business_group_type="MID_MARKET"),
        dict(id=3, is_active=True, is_test=True, business_group_type="ENTERPRISE"),
    ]
    links = [dict(business_id=b, business_group_id=g) for b, g in ((1, 1), (1, 2), (2, 2), (3, 3))]
    stores = [dict(store_id=s, business_id=s) for s in (1, 2, 3)]
    got = {r.store_id: r.cohort for r in evaluate.store_cohorts(tables(business_groups=groups, business_group_links=links, stores=stores)).collect()}
    assert got == {1: "Enterprise", 2: "Mid-Market", 3: "Local"}


def test_fifth_month_sums(tables):
    act = day("2020-01-01")
    orders = [dict(store_id=1, delivery_id=i, starting_point_id=1, active_date=act + dt.timedelta(days=n), created_at=dt.datetime(2020, 1, 1, 12) + dt.timedelta(days=n), timezone="UTC", subtotal=100, is_partner=True, is_core=True) for i, n in enumerate([0, 27, 28, 29, 30, 119, 120, 148, 149])]
    t = tables(
        deliveries=orders,
        registry=[dict(id="m", store_id=1, restaurant_name="r")],
        store_status=[dict(store_id=1, date_stamp=day("2020-06-01"), active_bop=True, partner_bop=True, sp_id=1, sub_id=1)],
        merchant_dates=[dict(store_id=1, activation_date=act, level_verification=2)],
    )
    r = labels.nn_fifth_month(t, "2020-06-08").first()
    assert (r.total_subtotal_first_28_days, r.total_subtotal_first_30_days, r.total_subtotal_first_120_148_days) == (2.0, 4.0, 2.0)
