"""Operators stay exact when one key holds a third of the rows."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from govframe.operators import audit as A
from govframe.operators import joins as J
from govframe.operators import reports as R
from govframe.operators import security as S
from govframe.operators import history as H
from govframe.sources.tables import load_table
from tests.conftest import SF_MID

HOT = 7


def _hot_orders(spark):
    o = load_table(spark, SF_MID, "orders")
    return o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(HOT).cast("long")).otherwise(F.col("o_custkey")))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_key_share(spark):
    o = _hot_orders(spark)
    assert o.filter(F.col("o_custkey") == HOT).count() * 3 >= o.count() - 3


def test_exists_and_counts_under_skew(spark):
    o, c = _hot_orders(spark), load_table(spark, SF_MID, "customer").select("c_custkey")
    flag = J.flag_exists(c, o, ["c_custkey"], ["o_custkey"], "has")
    naive = c.join(o.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True)), "c_custkey", "left") \
        .select("c_custkey", F.coalesce("has", F.lit(False)).alias("has"))
    assert _same(flag, naive)
    cnt = J.add_child_count(c, o, ["c_custkey"], ["o_custkey"], "n")
    assert cnt.filter(F.col("c_custkey") == HOT).first().n == o.filter(F.col("o_custkey") == HOT).count()
    assert cnt.agg(F.sum("n")).first()[0] == o.join(c, o.o_custkey == c.c_custkey, "left_semi").count()


def test_left_join_fanout_equals_left_join(spark):
    o = _hot_orders(spark).select("o_orderkey", "o_custkey")
    c = load_table(spark, SF_MID, "customer").select("c_custkey", "c_name")
    mine = J.left_join_fanout(c, o, ["c_custkey"], ["o_custkey"])
    plain = c.join(o, c.c_custkey == o.o_custkey, "left").select(*mine.columns)
    assert _same(mine, plain)


def test_visibility_under_skew(spark):
    o = _hot_orders(spark)
    t = dt.datetime(2024, 1, 1)
    sess = spark.createDataFrame([("hot", HOT, True, t, None), ("cold", 8, True, t, None)],
                                 "usuario string, subject bigint, active boolean, started_at timestamp_ntz, expires_at timestamp_ntz")
    got = {r.usuario: r.n_visible for r in S.visibility_counts(o, "o_custkey", sess, t).collect()}
    assert got == {"hot": o.filter(F.col("o_custkey") == HOT).count(), "cold": o.filter(F.col("o_custkey") == 8).count()}


def test_scd2_lead_under_skew(spark):
    o = _hot_orders(spark)
    h = H.scd2(o, ["o_custkey"], "o_orderdate", ["o_orderkey"], ["o_orderstatus"])
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    ref = o.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("valid_from"),
                   F.coalesce(F.lead("o_orderdate").over(w), F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).alias("valid_to"))
    assert _same(h.select(*ref.columns), ref)


def test_top_k_per_hot_group(spark):
    o = _hot_orders(spark)
    top = R.top_k_per_group(o, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 2)
    hot = [r.o_orderkey for r in top.filter(F.col("o_custkey") == HOT).orderBy(F.desc("o_totalprice"), "o_orderkey").collect()]
    want = [r.o_orderkey for r in o.filter(F.col("o_custkey") == HOT).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(2).collect()]
    assert hot == want


def test_session_state_hot_user(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", "LOGIN" if i % 2 == 0 else "LOGOUT", 1 if i % 2 == 0 else None, base + dt.timedelta(seconds=i), i, None)
            for i in range(4001)] + [("cold", "LOGIN", 2, base, 10_000, None)]
    ev = spark.createDataFrame(rows, "usuario string, kind string, subject bigint, event_at timestamp_ntz, seq bigint, expires_at timestamp_ntz")
    people = spark.range(0, 5).withColumnRenamed("id", "k")
    sess, log, _ = S.apply_session_events(None, ev, people, "k")
    got = {r.usuario: (r.active, r.started_at) for r in sess.collect()}
    assert got["hot"] == (True, base + dt.timedelta(seconds=4000)) and got["cold"][0] is True
    assert log.count() == 4002


def test_append_audit_ids_continue(spark):
    ch = spark.createDataFrame([("t1", "SELECT", 1, 1), ("t2", "INSERT", 0, 2)], "object_name string, permission_type string, granted int, _order int")
    a1 = A.append_audit(None, A.permission_changes(ch), "admin", "2024-01-31 00:00:00")
    fl = spark.createDataFrame([("eve", "3 tries", 1)], "login_name string, details string, _order int")
    a2 = A.append_audit(a1, A.failed_logins(fl), "admin", "2024-01-31 00:00:00")
    rows = {r.audit_id: r for r in a2.collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[3].login_name == "eve" and rows[3].database_user == "admin" and rows[3].success is False
    assert rows[1].login_name == "admin" and rows[1].details is None and rows[1].event_time == dt.datetime(2024, 1, 31)


def test_aqe_splits_the_hot_key_of_a_fanout_join(spark):
    """With thresholds scaled down to test size, the inner part of left_join_fanout
    (big side streamed) is split by AQE's skew join: the hot customer's partition is cut."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        o = _hot_orders(spark).repartition(8).select("o_orderkey", "o_custkey")  # several map tasks to split along
        c = load_table(spark, SF_MID, "customer").select("c_custkey", "c_name")
        df = J.left_join_fanout(c, o, ["c_custkey"], ["o_custkey"])
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
        assert len(rows) == o.count() + c.join(o, c.c_custkey == o.o_custkey, "left_anti").count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
