import datetime as dt

import pytest
from pyspark.sql import functions as F

from govframe.operators import visibility as VB
from govframe.session import shared_path

T0 = dt.datetime(2030, 5, 1)
SESSIONS = "usuario string, subject bigint, active boolean, started_at timestamp_ntz, expires_at timestamp_ntz"
SETS = {"n_all": [], "n_a": ["a"], "n_b": ["b"], "n_ab": ["a", "b"]}


def _sessions(spark, subjects):
    rows = [(f"u{s}", s, True, T0, None) for s in subjects]
    rows += [("closed", subjects[0], False, T0, T0), ("expired", subjects[0], True, T0, T0), ("twin", subjects[0], True, T0, None)]
    return spark.createDataFrame(rows, SESSIONS)


def test_counts_equal_brute_force_over_several_buckets(spark):
    """100,000 rows, four buckets; subject 7 holds a third of them and crosses bucket ends."""
    n = 100_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 97).cast("long").alias("subject"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.xxhash64("id") % 5 > 0).alias("x"), (F.xxhash64("id", F.lit(1)) % 7 > 2).alias("y"))
    maps = VB.write_policy_bitmaps(df, "subject", {"a": F.col("x"), "b": F.col("y")}, shared_path(spark, "test-bitmaps"))
    assert maps.bits(spark).select("bucket").distinct().count() >= 3
    got = {r.usuario: r[1:] for r in VB.visible_to_holders(spark, maps, _sessions(spark, [7, 0, 50, 96, 1000]), T0, SETS).collect()}
    want = {r.subject: r[1:] for r in df.groupBy("subject").agg(
        F.count("*"), F.count_if("x"), F.count_if("y"), F.count_if(F.col("x") & F.col("y"))).collect()}
    for s in (7, 0, 50, 96):
        assert got[f"u{s}"] == (s, *want[s])
    assert got["u1000"] == (1000, 0, 0, 0, 0) and got["twin"] == got["u7"] and "closed" not in got and "expired" not in got


def test_every_bit_position_counts(spark):
    """One subject per row: ranges begin and end at every place of a byte."""
    df = spark.range(40).select(F.col("id").alias("subject"), (F.col("id") % 3 == 1).alias("x"))
    maps = VB.write_policy_bitmaps(df, "subject", {"a": F.col("x")}, shared_path(spark, "test-bitmaps"))
    got = {r.subject: r.n for r in VB.visible_to_holders(spark, maps, _sessions(spark, list(range(40))), T0, {"n": ["a"]}).collect()}
    assert got == {i: int(i % 3 == 1) for i in range(40)}


def test_empty_table_and_unknown_policy(spark):
    df = spark.createDataFrame([], "subject bigint, x boolean")
    maps = VB.write_policy_bitmaps(df, "subject", {"a": F.col("x"), "b": ~F.col("x")}, shared_path(spark, "test-bitmaps"))
    got = VB.visible_to_holders(spark, maps, _sessions(spark, [1]), T0, SETS).filter("usuario = 'u1'").collect()
    assert [tuple(r) for r in got] == [("u1", 1, 0, 0, 0, 0)]
    with pytest.raises(ValueError, match="no bitmap"):
        VB.visible_to_holders(spark, maps, _sessions(spark, [1]), T0, {"n": ["c"]})


def test_several_policies_need_no_join_each(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("subject"), (F.col("id") % 2 == 0).alias("x"))
    maps = VB.write_policy_bitmaps(df, "subject", {p: F.col("x") for p in "abcdef"}, shared_path(spark, "test-bitmaps"))
    joins = []
    for names in ("ab", "abcdef"):
        out = VB.visible_to_holders(spark, maps, _sessions(spark, [1]), T0, {"n": list(names)})
        joins.append(out._jdf.queryExecution().optimizedPlan().toString().count("Join "))
    assert joins[0] == joins[1]
