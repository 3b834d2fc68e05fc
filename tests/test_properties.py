"""Randomised property tests of the constraint and history operators."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from govframe.operators import constraints as C
from govframe.operators import history as H


def test_validated_append_invariants(spark):
    rnd = random.Random(5)
    parents = spark.createDataFrame([(p,) for p in range(1, 21)], "pid int")
    for _ in range(4):
        target_rows = [(i, rnd.choice([None, *range(1, 25)]), f"e{i}", rnd.randint(-5, 50)) for i in range(1, 40)]
        target = spark.createDataFrame(target_rows, "id int, pid int, email string, qty int").dropDuplicates(["id"])
        target = target.join(parents, "pid", "left_semi").unionByName(target.filter("pid IS NULL"))
        target = target.filter("qty >= 0")
        batch_rows = [(rnd.choice([None, *range(30, 60)]), rnd.choice([None, *range(1, 25)]),
                       rnd.choice([None, "e3", "e7", f"n{k}", f"n{k}"]), rnd.randint(-5, 50)) for k in range(40)]
        batch = spark.createDataFrame(batch_rows, "id int, pid int, email string, qty int")
        acc, rej = C.validated_append(target, batch, ["id"], foreign_keys=[(parents, ["pid"], ["pid"], "parent")],
                                      checks={"qty": F.col("qty") >= 0}, unique={"email": ["email"]})
        assert acc.count() + rej.count() == batch.count()
        assert acc.unionByName(rej.drop("rules")).exceptAll(batch).count() == 0
        new = target.unionByName(acc)
        assert C.pk_violations(new, ["id"]).count() == 0
        assert C.fk_violations(new, parents, ["pid"], ["pid"]).count() == 0
        assert C.unique_violations(new, ["email"]).count() == 0
        assert C.check_violations(new, {"qty": F.col("qty") >= 0}).count() == 0
        assert rej.filter(F.size("rules") == 0).count() == 0


def test_lead_by_key_random(spark):
    rnd = random.Random(9)
    for parts in (3, 8, 13):
        rows = []
        for key in range(12):
            n = 600 if key in (0, 5) else rnd.randint(1, 30)  # two hot keys
            ts = rnd.sample(range(10_000), n)
            rows += [(key, t, rnd.randint(0, 99)) for t in ts]
        df = spark.createDataFrame(rows, "k int, t int, v int")
        mine = H.lead_by_key(df, ["k"], ["t"], "v", "nxt", num_partitions=parts)
        ref = df.withColumn("ref", F.lead("v").over(Window.partitionBy("k").orderBy("t")))
        j = mine.join(ref, ["k", "t"])
        assert j.count() == len(rows)
        assert j.filter(~F.col("nxt").eqNullSafe(F.col("ref"))).count() == 0


def test_lead_by_key_null_key_group(spark):
    rows = [(None, t, t) for t in range(400)] + [(1, t, t) for t in range(50)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    mine = H.lead_by_key(df, ["k"], ["t"], "v", "nxt", num_partitions=8)
    ref = df.withColumn("ref", F.lead("v").over(Window.partitionBy("k").orderBy("t")))
    j = mine.join(ref, [mine.k.eqNullSafe(ref.k), mine.t == ref.t])
    assert j.count() == len(rows)
    assert j.filter(~F.col("nxt").eqNullSafe(F.col("ref"))).count() == 0
