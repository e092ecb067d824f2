"""Shared operators against brute force, with a hot key in every fixture."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tamarind.functions import exprs as X
from tamarind.operators import asof, keyed, ranking, rollup, sliding, snapshot

BASE = dt.date(2020, 1, 1)


def _days(rng, n, span=200):
    return [BASE + dt.timedelta(days=rng.randrange(span)) for _ in range(n)]


def _keys(rng, n):
    """A third of all rows belong to one key."""
    return [0 if rng.random() < 0.34 else rng.randrange(1, 12) for _ in range(n)]


def test_pair_in_window_matches_brute_force(spark):
    rng = random.Random(1)
    facts = list(zip(_keys(rng, 600), _days(rng, 600), range(600)))
    anchors = list({(k, d) for k, d in zip(_keys(rng, 40), _days(rng, 40))}) + [(3, None)]
    f = spark.createDataFrame(facts, "k long, d date, i long")
    a = spark.createDataFrame(anchors, "k long, a date")
    for lo, hi in ((-7, -1), (-27, 0), (-180, 0), (0, 148), (120, 148), (0, 0)):
        got = {tuple(r) for r in asof.pair_in_window(a, f, ["k"], "a", "d", lo, hi).select("k", "a", "i").collect()}
        want = {
            (k, x, i) for k, x in anchors if x for kk, d, i in facts if kk == k and lo <= (d - x).days <= hi
        }
        assert got == want, (lo, hi)


def test_serving_many_dates_equals_one_date_at_a_time(spark):
    rng = random.Random(2)
    facts = spark.createDataFrame(list(zip(_keys(rng, 300), _days(rng, 300))), "k long, d date")
    dates = [BASE + dt.timedelta(days=n) for n in (20, 21, 60)]
    many = asof.serve_dates(facts, dates, "d", -7, -1).select("k", "d", "create_date").collect()
    single = [
        r for x in dates for r in asof.serve_dates(facts, [x], "d", -7, -1).select("k", "d", "create_date").collect()
    ]
    assert sorted(map(tuple, many)) == sorted(map(tuple, single)) and many


def test_weighted_medians(spark):
    rng = random.Random(3)
    rows = [(k, v, rng.random() < 0.4) for k, v in zip(_keys(rng, 900), [rng.choice([0, -3, 17, rng.randrange(1, 9000)]) for _ in range(900)])]
    dist = (
        spark.createDataFrame(rows, "k long, v long, f boolean")
        .groupBy("k", "v")
        .agg(F.count("*").alias("n"), F.sum(X.flag(F.col("f"))).alias("m"))
    )
    got = rollup.weighted_medians(dist, ["k"], "v", ["n", "m"], ["all", "some"]).toPandas().set_index("k")
    pdf = pd.DataFrame(rows, columns=["k", "v", "f"])
    want_all, want_some = pdf.groupby("k").v.median(), pdf[pdf.f].groupby("k").v.median()
    for k in want_all.index:
        assert got.loc[k, "all"] == want_all[k]
        if k in want_some.index:
            assert got.loc[k, "some"] == want_some[k]


@pytest.mark.parametrize("shape", ["unit", "far", "ties"])
def test_medians_of_dense_keys_take_small_bins(spark, monkeypatch, shape):
    """One key with nine tenths of the rows, whose values all fall into few coarse bins."""
    monkeypatch.setattr(rollup, "BIN_VALUES", 12)
    monkeypatch.setattr(rollup, "SPLIT", 16)
    written, whole = [], rollup.cut_lineage

    def watched(df, label="stage"):
        out = whole(df, label)
        if label == "bins":
            written.append(max(r["__values"] for r in out.collect()))
        return out

    monkeypatch.setattr(rollup, "cut_lineage", watched)
    rng = random.Random(31)
    value = {
        "unit": lambda: rng.random() ** 9,
        "far": lambda: rng.choice([-1, 1]) * (1e15 + rng.randrange(400)),
        "ties": lambda: rng.choice([0.25, 0.25 + rng.randrange(60) * 2**-50]),
    }[shape]
    rows = [(None if rng.random() < 0.05 else 0 if rng.random() < 0.9 else 1, value(), rng.random() < 0.2) for _ in range(700)]
    rows += [(0, None, True), (2, None, False)]
    dist = (
        spark.createDataFrame(rows, "k long, v double, f boolean")
        .groupBy("k", "v")
        .agg(F.count("*").alias("n"), F.sum(X.flag(F.col("f"))).alias("m"))
    )
    got = {r.k: (r.all, r.some) for r in rollup.weighted_medians(dist, ["k"], "v", ["n", "m"], ["all", "some"]).collect()}
    for k in (None, 0, 1):
        values = [(v, f) for key, v, f in rows if key == k and v is not None]
        some = [v for v, f in values if f]
        assert got[k] == (np.median([v for v, _ in values]), np.median(some) if some else None)
    assert len(written) > 1 and written[-1] <= 12 < written[0]


def test_distinct_counts_and_totals_with_many_windows(spark):
    rng = random.Random(4)
    rows = [
        (k, d, rng.randrange(9), rng.randrange(30), i // 2, rng.randrange(100), 5, rng.choice([True, False, None]))
        for i, (k, d) in enumerate(zip(_keys(rng, 500), _days(rng, 500, 40)))
    ]
    cols = ["k", "active_date", "store_id", "creator_id", "delivery_id", "subtotal", "fee", "is_partner"]
    facts = spark.createDataFrame(
        rows, "k long, active_date date, store_id long, creator_id long, delivery_id long, subtotal long, fee long, is_partner boolean"
    )
    dates = [BASE + dt.timedelta(days=n) for n in (10, 12, 30)]
    got = rollup.delivery_totals(
        facts, ["k"], lambda df: asof.serve_dates(df, dates, "active_date", -7, -1), ["k", "create_date"],
        ids=["creator_id", "delivery_id"], days=True,
    ).toPandas()
    pdf = pd.DataFrame(rows, columns=cols)
    for r in got.itertuples():
        age = (pd.to_datetime(pdf.active_date) - pd.Timestamp(r.create_date)).dt.days
        part = pdf[(pdf.k == r.k) & age.between(-7, -1)]
        partner = part[part.is_partner == True]  # noqa: E712
        assert (r.cents, r.orders, r.stores) == (part.subtotal.sum(), len(part), part.store_id.nunique())
        assert (r.n_creator_id, r.n_delivery_id) == (part.creator_id.nunique(), part.delivery_id.nunique())
        assert (r.n_days, r.partner_rows) == (part.active_date.nunique(), len(partner))
        assert r.partner_stores == partner.store_id.nunique()


def test_ranks_and_tiles_with_ties_nulls_and_a_hot_group(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        value = rng.choice([0.0, 0.0, None, round(rng.uniform(-50, 5000), 2)])
        rows.append((group, value, f"m{i:05d}"))
    df = spark.createDataFrame(rows, "g string, v double, id string")
    out = ranking.rank_descending(df, ["g"], "v", ["id"]).withColumn(
        "tile", ranking.ntile_of(F.col("__rank"), F.col("__size"), 10)
    )
    got = {r["id"]: (r["__rank"], r["tile"]) for r in out.collect()}
    for g in ("hot", "a", "b", None):
        part = sorted(
            (r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, -(r[1] or 0), r[2])
        )
        assert [got[r[2]][0] for r in part] == list(range(1, len(part) + 1))
        want = np.concatenate([[t + 1] * len(c) for t, c in enumerate(np.array_split(np.arange(len(part)), 10))])
        assert [got[r[2]][1] for r in part] == want.tolist()


def test_ranges_stay_even_when_one_value_fills_the_table(spark):
    """Nine tenths of the rows have one value, the others lie in [0, 1], ids share a head."""
    rng = random.Random(7)
    rows = [("g", 0.25 if i % 10 else rng.random(), f"merchant-{i:06d}") for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double, id string")
    parts = ranking.in_ranges(df, F.col("v").desc(), F.col("id").asc()).groupBy("__part").count().collect()
    assert sum(r["count"] for r in parts) == len(rows) and max(r["count"] for r in parts) < len(rows) / 2  # of four ranges
    got = {r["id"]: r["__rank"] for r in ranking.rank_descending(df, ["g"], "v", ["id"]).collect()}
    assert [got[r[2]] for r in sorted(rows, key=lambda r: (-r[1], r[2]))] == list(range(1, len(rows) + 1))


def test_small_groups_have_fewer_tiles(spark):
    df = spark.createDataFrame([("a", 3.0, "x"), ("a", None, "y"), ("a", 1.0, "z")], "g string, v double, id string")
    out = ranking.rank_descending(df, ["g"], "v", ["id"])
    tiles = {r["id"]: r["t"] for r in out.select("id", ranking.ntile_of(F.col("__rank"), F.col("__size"), 10).alias("t")).collect()}
    assert tiles == {"y": 1, "x": 2, "z": 3}  # NULL ranks as the largest


def test_running_totals(spark):
    steps = spark.createDataFrame(
        [(1, BASE, 5), (1, BASE, 2), (1, BASE + dt.timedelta(3), 1), (2, BASE, 9)], "k long, d date, n long"
    )
    anchors = spark.createDataFrame(
        [(1, BASE), (1, BASE + dt.timedelta(2)), (1, BASE + dt.timedelta(3)), (2, BASE - dt.timedelta(1))], "k long, a date"
    )
    got = {(r.k, r.a): r.n for r in rollup.running_totals(steps, ["k"], "d", ["n"], anchors, "a").collect()}
    assert got == {
        (1, BASE): 7, (1, BASE + dt.timedelta(2)): 7, (1, BASE + dt.timedelta(3)): 8, (2, BASE - dt.timedelta(1)): None,
    }


def test_spread_join_equals_join(spark):
    rng = random.Random(6)
    big = spark.createDataFrame(list(zip(_keys(rng, 400), range(400))), "k long, i long")
    small = spark.createDataFrame([(0, "a"), (0, "b"), (5, "c")], "k long, s string")
    spread = keyed.spread_join(big, small, ["k"], by="i").select("k", "i", "s")
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, big.join(small, "k").select("k", "i", "s").collect()))


def test_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "m long, s string")
    right = spark.createDataFrame([(1, "a", 10), (2, None, 20)], "m long, s string, v long")
    merged = keyed.join_null_safe(left, right, ["m", "s"], "inner")
    assert sorted(r.v for r in merged.collect()) == [10, 20]
    keys = spark.createDataFrame([(1,), (None,)], "x long")
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    assert sorted([r.k for r in keyed.without_keys(rows, "k", keys, "x").collect()], key=str) == [2, None]
    assert [r.k for r in keyed.not_in_keys(rows, "k", keys, "x").collect()] == [2]


def test_keys_seen_once(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, None)], "k long, v string")
    assert sorted(map(tuple, keyed.keys_seen_once(df, "k").collect())) == [(1, "a"), (3, None)]


def test_latest_load(spark):
    df = spark.createDataFrame([(1, BASE), (2, BASE + dt.timedelta(1)), (3, BASE + dt.timedelta(1))], "k long, create_date date")
    assert sorted(r.k for r in snapshot.latest_load(df).collect()) == [2, 3]


def test_date_differences(spark):
    row = spark.sql(
        "SELECT DATE'2021-01-31' a, DATE'2021-02-01' b, TIMESTAMP_NTZ'2021-01-01 23:00:00' c, TIMESTAMP_NTZ'2021-01-02 01:00:00' d"
    ).select(X.month_diff("a", "b").alias("m"), X.day_diff("c", "d").alias("n")).first()
    assert (row.m, row.n) == (1, 1)


def test_toward_zero_and_ratios(spark):
    row = spark.sql("SELECT -2.7D x, 0L z, 5L y").select(
        X.toward_zero("x").alias("t"), X.safe_ratio("y", "z").alias("s"), X.ratio("y", "z").alias("r")
    ).first()
    assert (row.t, row.s, row.r) == (-2.0, 0.0, None)


@pytest.mark.parametrize("dates, lo, hi", [(30, -7, -1), (30, -29, -1), (1, -28, -1), (12, -3, 2)])
def test_sliding_windows_equal_repeated_facts(spark, dates, lo, hi):
    """Thirty dates, some of them apart, against facts repeated for each date."""
    rng = random.Random(dates)
    start = dt.date(2021, 3, 1)
    wanted = sorted({start + dt.timedelta(days=rng.randrange(50)) for _ in range(dates)})
    rows = [
        (rng.choice([1, 1, 1, 2, None]), start + dt.timedelta(days=rng.randrange(-40, 60)), rng.choice([None, 1, 2, 3]), rng.choice([None, *range(9)]),
         rng.choice([None, i]), rng.choice([None, 100, 250]), rng.choice([None, True, False]), rng.choice([None, 5]))
        for i in range(400)
    ]
    names = "submarket_id long, active_date date, store_id long, creator_id long, delivery_id long, subtotal long, is_partner boolean, fee long"
    facts = spark.createDataFrame(rows, names)
    want = rollup.delivery_totals(facts, ["submarket_id"], lambda df: asof.serve_dates(df, wanted, "active_date", lo, hi), ["submarket_id", "create_date"], ids=["creator_id"])
    got = rollup.delivery_windows(facts, ["submarket_id"], wanted, lo, hi, ids=["creator_id"])
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    assert sorted(map(tuple, got.select(*order).collect()), key=repr) == sorted(map(tuple, want.select(*order).collect()), key=repr)


def test_sliding_windows_do_not_repeat_facts(spark):
    """Rows that are shuffled don't grow with the window."""
    facts = spark.sql("SELECT id % 7 AS k, date_add(DATE'2021-01-01', CAST(id % 300 AS int)) AS d, id % 50 AS who, id AS v FROM range(6000)")
    dates = [dt.date(2021, 3, 1) + dt.timedelta(days=n) for n in range(120)]

    def exploded(lo):
        out = sliding.sliding_totals(facts, ["k"], dates, lo, -1, {"v": F.col("v")}, {"n": ("who", None)}, day="d")
        out.collect()
        text = out._jdf.queryExecution().executedPlan()
        nodes, todo = [], [text]
        while todo:
            node = todo.pop()
            kind = node.getClass().getSimpleName()
            todo += [node.finalPhysicalPlan()] if kind == "AdaptiveSparkPlanExec" else []
            todo += [node.plan()] if kind.endswith("QueryStageExec") else []
            todo += [node.children().apply(i) for i in range(node.children().size())]
            if kind == "GenerateExec" and "__end" in node.toString():
                nodes.append(node.metrics().apply("numOutputRows").value())
        return nodes

    short, long = exploded(-7), exploded(-90)
    assert short and sum(long) <= 2 * 2 * 6000 and sum(long) <= 2 * sum(short)


def test_spread_join_cuts_heavy_keys_only(spark):
    """One key with half of the rows: no part above its share, cold keys not repeated."""
    big = spark.sql("SELECT CASE WHEN id % 2 = 0 THEN 1 WHEN id % 97 = 0 THEN NULL ELSE id % 1000 + 2 END AS k, id AS i FROM range(20000)")
    small = spark.sql("SELECT id + 1 AS k, id AS s FROM range(1500) UNION ALL SELECT NULL, -1L UNION ALL SELECT 1L, -2L")
    heavy = keyed.heavy_keys(big, ["k"], part_rows=1000).collect()
    assert [(r.k, r["__parts"]) for r in heavy] == [(1, 10)]
    got = keyed.spread_join(big, small, ["k"], by="i", part_rows=1000)
    want = sorted(map(tuple, small.join(big, "k").select("k", "s", "i").collect()))
    assert sorted(map(tuple, got.select("k", "s", "i").collect())) == want
    parts = keyed.F.pmod(keyed.F.xxhash64("i"), keyed.F.lit(10))
    sizes = [r["count"] for r in big.where("k = 1").groupBy(parts).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 1.2 * 1000


def test_window_join_with_a_heavy_slot(spark, monkeypatch):
    monkeypatch.setattr(keyed, "PART_ROWS", 50)
    monkeypatch.setattr(keyed.spread_join, "__defaults__", (None, None, 50))
    facts = spark.sql("SELECT CAST(id % 3 = 0 AS int) AS k, date_add(DATE'2021-01-01', CAST(id % 40 AS int)) AS d, id FROM range(3000)")
    anchors = spark.sql("SELECT CAST(id % 2 AS int) AS k, date_add(DATE'2021-01-10', CAST(id AS int)) AS a FROM range(20)")
    got = asof.pair_in_window(anchors, facts, ["k"], "a", "d", -6, 0, spread_by="id")
    want = anchors.join(facts, "k").where("d BETWEEN date_add(a, -6) AND a")
    assert sorted(map(tuple, got.select("k", "a", "id").collect())) == sorted(map(tuple, want.select("k", "a", "id").collect()))
