import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from govframe.operators import history as H
from govframe.operators import numbering as N
from govframe.sources.tables import load_table
from tests.conftest import SF_MID


def test_global_row_number_matches_window(spark):
    part = load_table(spark, SF_MID, "part").select("p_partkey", "p_retailprice")
    order = [F.desc("p_retailprice"), F.asc("p_partkey")]
    mine = N.global_row_number(part, order, out="rn", num_partitions=7)
    ref = part.withColumn("ref", F.row_number().over(Window.orderBy(*order)))
    j = mine.join(ref, "p_partkey")
    assert j.count() == 2000 and j.filter(F.col("rn") != F.col("ref")).count() == 0


def test_global_row_number_has_no_single_partition_exchange(spark):
    part = load_table(spark, SF_MID, "part").select("p_partkey", "p_retailprice")
    df = N.global_row_number(part, [F.desc("p_retailprice"), F.asc("p_partkey")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is over the per-partition counts (one row each)
    assert plan.count("SinglePartition") <= 1
    assert "BroadcastHashJoin" in plan


def test_assign_ids_sequence(spark):
    df = spark.range(0, 50).withColumnRenamed("id", "k")
    got = [r.new_id for r in N.assign_ids(df, ["k"], out="new_id", start=1000, step=1).orderBy("k").collect()]
    assert got == list(range(1000, 1050))


def test_lead_by_key_with_hot_key(spark):
    # key 0 holds most rows: its history is split over many range partitions
    rows = [(0, i, i * 10) for i in range(3000)] + [(k, i, i) for k in range(1, 40) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    mine = H.lead_by_key(df, ["k"], ["t"], "v", "nxt", num_partitions=8)
    ref = df.withColumn("ref", F.lead("v").over(Window.partitionBy("k").orderBy("t")))
    j = mine.join(ref, ["k", "t"])
    assert j.count() == len(rows)
    assert j.filter(~F.col("nxt").eqNullSafe(F.col("ref"))).count() == 0


def test_scd2_intervals_do_not_overlap(spark):
    o = load_table(spark, SF_MID, "orders")
    h = H.scd2(o, ["o_custkey"], "o_orderdate", ["o_orderkey"], ["o_orderstatus"])
    assert h.count() == o.count()
    assert h.filter(F.col("valid_to") < F.col("valid_from")).count() == 0
    w = Window.partitionBy("o_custkey").orderBy("valid_from", "o_orderkey")
    gaps = h.withColumn("prev_to", F.lag("valid_to").over(w)).filter(F.col("prev_to") != F.col("valid_from"))
    assert gaps.count() == 0
    assert H.current_view(h).count() == o.select("o_custkey").distinct().count()


def test_scd2_apply(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    cur = spark.createDataFrame([(1, "a", t0), (2, "b", t0), (3, "c", t0)], "id int, v string, valid_from timestamp_ntz")
    hist = spark.createDataFrame([], "id int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    batch = spark.createDataFrame([(1, "U", "a2"), (2, "D", None), (4, "U", "d")], "id int, op string, v string")
    c2, h2 = H.scd2_apply(cur, hist, batch, ["id"], F.lit(t1).cast("timestamp_ntz"))
    assert sorted((r.id, r.v, r.valid_from) for r in c2.collect()) == [(1, "a2", t1), (3, "c", t0), (4, "d", t1)]
    assert sorted((r.id, r.v, r.valid_to) for r in h2.collect()) == [(1, "a", t1), (2, "b", t1)]


def test_refresh_counts_equals_recompute(spark):
    li = load_table(spark, SF_MID, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    stored = li.groupBy("l_partkey").agg(F.count("*").alias("total"))
    ins = li.filter("l_returnflag = 'R'")
    dele = li.filter("l_linestatus = 'O' AND l_returnflag = 'N'")
    refreshed, neg = H.refresh_counts(stored, ins.select("l_partkey"), dele.select("l_partkey"), ["l_partkey"])
    recomputed = li.unionByName(ins).exceptAll(dele).groupBy("l_partkey").agg(F.count("*").alias("total"))
    assert neg.count() == 0
    assert refreshed.exceptAll(recomputed).count() == 0 and recomputed.exceptAll(refreshed).count() == 0


def test_refresh_counts_reports_negative(spark):
    stored = spark.createDataFrame([(1, 1)], "k int, total long")
    deleted = spark.createDataFrame([(1,), (1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    ok, neg = H.refresh_counts(stored, empty, deleted, ["k"])
    assert ok.count() == 0 and neg.first().total == -1
