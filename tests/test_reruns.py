"""Reruns, shared folders and windows without counts."""

import os
import time
from types import SimpleNamespace

import pytest
from moments import day
from pyspark.sql import functions as F

from tamarind import session
from tamarind.operators.asof import pair_in_window
from tamarind.plans import search
from tamarind.session import shared_dir
from tamarind.sources.dated import DatedTable
from tamarind.sources.warehouse import backfill, read_dated, replace_partitions


def test_search_window_of_days_without_counts_is_zero(tables):
    counts = [dict(store_id=1, search_date=day("2021-05-01"), query_count=None, store_count=None)]
    row = search.scoring_lookbacks(tables(search_counts=counts), ["2021-05-20"]).first()
    assert row.total_search_count_28_days_before == 0 and row.avg_search_count_84_days_before_null_excluded == 0
    assert row.total_search_count_14_days_before is None  # no day at all


def test_backfill_clears_dates_that_lost_their_rows(spark, tables, tmp_path):
    path = str(tmp_path / "feature")
    left = [("2021-05-01", 1), ("2021-05-02", 2), ("2021-05-03", 3)]

    def build(_, dates):
        rows = [(d, v) for d, v in left if day(d) in dates]
        return spark.createDataFrame(rows, "create_date string, v int").selectExpr("CAST(create_date AS date) AS create_date", "v")

    assert backfill(tables(), build, ["2021-05-01", "2021-05-02", "2021-05-03"], path).count() == 3
    del left[1]
    left[1] = ("2021-05-03", 9)
    got = backfill(tables(), build, ["2021-05-02", "2021-05-03"], path)
    assert sorted((str(r.create_date), r.v) for r in got.collect()) == [("2021-05-01", 1), ("2021-05-03", 9)]


def dated(spark, rows):
    return spark.createDataFrame(rows, "create_date string, v int").selectExpr("CAST(create_date AS date) AS create_date", "v")


def held(df):
    return sorted((str(r.create_date), r.v) for r in df.collect())


def test_a_failed_replace_leaves_the_former_rows(spark, tables, tmp_path):
    path = str(tmp_path / "feature")
    before = [("2021-05-01", 1), ("2021-05-02", 2), (None, 7)]
    replace_partitions(dated(spark, before), path)
    like = dated(spark, [])
    broken = dated(spark, [("2021-05-01", 5), ("2021-05-02", 6)]).repartition(2).withColumn("v", F.when(F.col("v") == 6, F.raise_error("half way").cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="half way"):
        replace_partitions(broken, path)
    with pytest.raises(Exception, match="half way"):
        backfill(tables(), lambda *_: broken, ["2021-05-01"], path)
    assert held(read_dated(spark, path, like)) == sorted((str(d), v) for d, v in before)
    assert len([n for n in os.listdir(path) if n.startswith("load=")]) == 1  # what the failed jobs wrote is gone


def test_a_job_may_read_what_it_replaces(spark, tables, tmp_path):
    path = str(tmp_path / "feature")
    replace_partitions(dated(spark, [("2021-05-01", 1), ("2021-05-02", 2)]), path)
    like = dated(spark, [])
    old = read_dated(spark, path, like)
    got = backfill(tables(), lambda *_: read_dated(spark, path, like).withColumn("v", F.col("v") + 10), ["2021-05-01", "2021-05-02"], path)
    assert held(got) == [("2021-05-01", 11), ("2021-05-02", 12)]
    assert held(old) == [("2021-05-01", 1), ("2021-05-02", 2)]  # a reader of the former state still ends
    for n in range(4):
        replace_partitions(dated(spark, [("2021-05-03", n)]), path)
    assert held(read_dated(spark, path, like)) == [("2021-05-01", 11), ("2021-05-02", 12), ("2021-05-03", 3)]
    assert len([n for n in os.listdir(path) if n.startswith("load=")]) == 3  # 11 and 12, the last two of the third date


def test_writers_at_the_same_time_both_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "feature")
    table = DatedTable(spark, path)
    table.replace(dated(spark, [("2021-05-01", 1)]))
    state, other = DatedTable.state, [True]

    def late(self):
        found = state(self)
        if other.pop() if other else False:  # another writer commits between this one's look and its own manifest
            monkeypatch.setattr(DatedTable, "state", state)
            DatedTable(spark, path).replace(dated(spark, [("2021-05-02", 2)]))
            monkeypatch.setattr(DatedTable, "state", late)
        return found

    monkeypatch.setattr(DatedTable, "state", late)
    table.replace(dated(spark, [("2021-05-03", 3)]))
    monkeypatch.setattr(DatedTable, "state", state)
    schema = dated(spark, []).schema
    assert held(table.read(schema)) == [("2021-05-01", 1), ("2021-05-02", 2), ("2021-05-03", 3)]
    number = table.state()[0]
    (tmp_path / "feature" / "_manifests" / f"{number + 1:08d}").write_text('{"create')  # a writer that died
    assert len(held(table.read(schema))) == 3 and not table._commit(number + 1, {})
    table.replace(dated(spark, [("2021-05-04", 4)]))
    assert len(held(table.read(schema))) == 4
    assert DatedTable(spark, str(tmp_path / "none")).read(dated(spark, []).schema).count() == 0


def test_a_cluster_must_name_its_shared_folder():
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_dir(session)


def test_window_joins_bound_the_facts(spark, tmp_path):
    path = str(tmp_path / "facts")
    facts = spark.sql("SELECT 1L AS k, date_add(DATE'2021-01-01', CAST(id AS int)) AS d, id AS v FROM range(60)")
    facts.write.partitionBy("d").parquet(path)
    anchors = spark.sql("SELECT 1L AS k, DATE'2021-02-01' AS a")
    pairs = pair_in_window(anchors, spark.read.parquet(path), ["k"], "a", "d", -7, -1)
    assert pairs.count() == 7
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(d" in scan and "ubquery" in scan


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_shuffles_go_with_their_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("id").alias("n")).groupBy("n").agg(F.max("k"))
    former = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        before = _shuffle_files(spark)
        with session.shuffles_dropped(spark):
            assert session.cut_lineage(rows, "t").count() == 1
        end = time.time() + 20
        while (left := _shuffle_files(spark) - before) and time.time() < end:
            time.sleep(0.2)
        assert not left and spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key) if former is None else spark.conf.set(key, former)


def test_views_are_written_once(spark, monkeypatch):
    from queryset import views

    labels, write = [], views.cut_lineage
    monkeypatch.setattr(views, "cut_lineage", lambda df, label: labels.append(label) or write(df, label))
    t = views.GivenTables(spark, "/root/testdata/sf0.001").written("deliveries")
    again = t.written("deliveries", "store_requests").written("store_requests")
    assert labels == ["deliveries", "store_requests"]
    assert again.store_requests.count() == t.store_requests.count() and again.deliveries.count() == t.deliveries.count()
    t.with_frames(deliveries=t.deliveries.limit(5)).written("deliveries")
    assert labels == ["deliveries", "store_requests", "deliveries"]


def test_steps_of_request_features_are_deleted(spark):
    from queryset import views
    from tamarind.operators.snapshot import latest_load
    from tamarind.plans import requests

    t = views.GivenTables(spark, "/root/testdata/sf0.001")
    here = set(os.listdir(session.shared_dir(spark)))
    rows = requests.request_features(t, latest_load(t.label_nn), "store_activation_date", requests.TRAIN)
    left = {p.rsplit("-", 1)[0] for p in set(os.listdir(session.shared_dir(spark))) - here}
    assert "request-totals" in left and not left & {"requests", "prior-orders"}
    assert rows.where("num_requests_all_time > 0").count() > 0


def test_scoring_sets_follow_the_training_rows(spark, monkeypatch):
    """Both read all facts: side by side they would hold the shuffles of both."""
    from queryset import models

    seen, table = [], SimpleNamespace(deliveries=spark.range(1))
    table.written = lambda *names: table
    monkeypatch.setattr(models, "_registry", lambda t: None)
    monkeypatch.setattr(models, "_trained_on", lambda t: time.sleep(0.5) or seen.append("rows") or "rows")
    monkeypatch.setattr(models, "_scored", lambda t, *days: seen.append("sets") or days)
    _, sets = models._trained_and_scored(table, lambda reg, rows: seen.append(rows), "1998-06-01")
    assert sets == ("1998-06-01",) and seen[0] == "rows" and sorted(seen[1:]) == ["rows", "sets"]


def test_scoring_sets_of_many_days_share_their_inputs(spark, monkeypatch):
    """Searches, vendors' features and closings are found once, not for each day and segment; the rows stay the same."""
    from queryset import assembly, models, views
    from tamarind.plans import population

    written, write, days = [], session.cut_lineage, ("1998-06-01", "1998-06-08")

    def counted(df, label="stage", path=None):
        written.append(label)
        return write(df, label, path)

    for module in (models, models.vendor, population):
        monkeypatch.setattr(module, "cut_lineage", counted)
    t = views.GivenTables(spark, "/root/testdata/sf0.001")
    sets = models._scored(t, *days)
    assert written.count("search") == 2 and written.count("vendor-features") == 1 and written.count("closings") == 1
    assert written.count("scoring") == 6
    for s in ("nn", "da"):
        got, alone = sets[days[1], s], assembly.scoring(t, s, None, days[1])
        assert got.columns == alone.columns and got.count() == alone.count() > 0
        same = [c for c, kind in got.dtypes if kind != "double"]
        assert got.select(*same).exceptAll(alone.select(*same)).isEmpty()
        for c in [c for c, kind in got.dtypes if kind == "double"]:
            a, b = (df.agg(F.count(c), F.sum(c)).first() for df in (got, alone))
            assert a[0] == b[0] and a[1] == pytest.approx(b[1])
