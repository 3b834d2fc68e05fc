import datetime as dt

from pyspark.sql import functions as F

from govframe.operators import reports as R
from govframe.plans.recipes import changed_orders
from govframe.session import shared_path
from govframe.sources import sinks
from govframe.sources.tables import load_table
from tests.conftest import SF_SMALL

AS_OF = dt.datetime(2024, 1, 31)


def test_full_plus_diff_rebuilds_current(spark):
    orders = load_table(spark, SF_SMALL, "orders")
    base = shared_path(spark, "test-snap")
    paths, log = sinks.snapshot_full({"orders": orders}, base, "academy", AS_OF)
    assert log.first().status == "SUCCESS" and paths["orders"].endswith("academy_FULL_20240131_000000/orders")
    full = spark.read.schema(orders.schema).parquet(paths["orders"])
    current = changed_orders(orders)
    path, dlog = sinks.snapshot_diff_write(current, full, ["o_orderkey"], base, "academy", AS_OF)
    assert dlog.first().kind == "DIFF"
    diff = spark.read.parquet(path)
    rebuilt = sinks.restore(full, diff, ["o_orderkey"])
    assert rebuilt.exceptAll(current).count() == 0 and current.exceptAll(rebuilt).count() == 0


def test_snapshot_failure_is_logged(spark):
    orders = load_table(spark, SF_SMALL, "orders")
    base = shared_path(spark, "test-snap-fail")
    sinks.snapshot_full({"orders": orders}, base, "X", AS_OF)
    try:
        sinks.snapshot_full({"orders": orders}, base, "X", AS_OF)  # same folder again
    except sinks.SnapshotError as e:
        row = e.log.first()
        assert row.status == "FAILED" and row.error
    else:
        raise AssertionError("expected a failure")


def test_checklist_numbering_by_severity(spark):
    one = spark.range(1).select(F.lit(0).cast("long").alias("n"))
    rules = [
        R.CheckRule("b ok", one, R.status_if(lambda n: n == 0), lambda n: n.cast("string")),
        R.CheckRule("a fail", one, R.status_if(lambda n: n > 0), lambda n: n.cast("string")),
        R.CheckRule("c warn", one, R.status_if(lambda n: n > 0, R.STATUS_WARN), lambda n: n.cast("string")),
    ]
    got = [(r.num, r.item, r.status) for r in R.quality_checklist(rules).orderBy("num").collect()]
    assert got == [(1, "a fail", R.STATUS_FAIL), (2, "c warn", R.STATUS_WARN), (3, "b ok", R.STATUS_OK)]


def test_top_k_per_group_uses_partial_limit(spark):
    li = load_table(spark, SF_SMALL, "lineitem")
    df = R.top_k_per_group(li, ["l_returnflag"], [F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_partkey"], 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 9
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_archive_split_is_complementary(spark):
    ev = load_table(spark, SF_SMALL, "events")
    kept, old = R.archive_split(ev, "ts", "2024-01-31 00:00:00", days=20)
    assert kept.count() + old.count() == ev.count()
    assert old.filter(F.col("ts") >= F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")).count() == 0


def test_archive_write_is_date_partitioned(spark):
    ev = load_table(spark, SF_SMALL, "events")
    _, old = R.archive_split(ev, "ts", "2024-01-31 00:00:00", days=20)
    path = shared_path(spark, "test-archive")
    R.write_archive(old, path, "ts", run_id="r1")
    R.write_archive(old, path, "ts", run_id="r1")  # a retried run replaces its own partitions
    back = spark.read.parquet(path)
    assert back.count() == old.count()
    one_day = back.filter(F.col("archive_day") == F.lit("2024-01-05").cast("date"))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(archive_day" in plan
    assert one_day.count() == ev.filter(F.to_date("ts") == F.lit("2024-01-05").cast("date")).count()


def test_versions_never_overwrite(spark):
    import pytest

    orders = load_table(spark, SF_SMALL, "orders")
    base = shared_path(spark, "test-versions")
    p1 = sinks.write_version(orders, base, 1)
    p2 = sinks.write_version(orders.filter("o_orderstatus = 'F'"), base, 2)
    assert spark.read.parquet(p1).count() == orders.count()
    assert spark.read.parquet(p2).count() < orders.count()
    with pytest.raises(Exception):
        sinks.write_version(orders, base, 1)


def test_run_history_on_snapshot_logs(spark):
    orders = load_table(spark, SF_SMALL, "orders")
    base = shared_path(spark, "test-history")
    logs = []
    for day in (1, 2, 3):
        at = dt.datetime(2024, 1, day)
        paths, log = sinks.snapshot_full({"orders": orders}, base, "academy", at)
        full = spark.read.schema(orders.schema).parquet(paths["orders"])
        _, dlog = sinks.snapshot_diff_write(changed_orders(orders), full, ["o_orderkey"], base, "academy", at)
        logs += [log, dlog]
    runs = logs[0]
    for lg in logs[1:]:
        runs = runs.unionByName(lg)
    hist = R.snapshot_history(runs, "kind", "started_at", "finished_at",
                              [F.desc("started_at"), F.desc("path")], k=2).collect()
    assert sorted(r.kind for r in hist) == ["DIFF", "DIFF", "FULL", "FULL"]
    assert all(r.duration_s >= 0 and r.status == "SUCCESS" and r.size_mb is not None and r.size_mb > 0 for r in hist)


def test_diff_sees_a_value_moving_between_null_columns(spark):
    base = spark.createDataFrame([(1, None, "x"), (2, "a", "b")], "k int, c1 string, c2 string")
    cur = spark.createDataFrame([(1, "x", None), (2, "a", "b")], "k int, c1 string, c2 string")
    got = [(r.k, r.change_kind) for r in sinks.snapshot_diff(cur, base, ["k"]).collect()]
    assert got == [(1, "UPDATE")]


def test_sorted_version_pushes_range_filter(spark):
    ev = load_table(spark, SF_SMALL, "events")
    base = shared_path(spark, "test-sorted")
    path = sinks.write_version(ev, base, 1, sort_within=["ts"])
    back = spark.read.parquet(path).filter(F.col("ts") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert back.count() == ev.filter(F.col("ts") >= F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")).count()


def test_bucketed_tables_join_without_shuffle(spark):
    import uuid

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = shared_path(spark, "test-bucketed")
        tag = uuid.uuid4().hex[:8]
        o = sinks.write_bucketed(load_table(spark, SF_SMALL, "orders"), f"b_orders_{tag}", ["o_orderkey"], 4, base)
        li = sinks.write_bucketed(load_table(spark, SF_SMALL, "lineitem"), f"b_lines_{tag}", ["l_orderkey"], 4, base)
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == load_table(spark, SF_SMALL, "lineitem").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
